"""Numbers inside text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from tessera.functions.common import at

from tessera.functions.text import strip


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _digits_to_int(s: Column) -> Column:
    d = F.regexp_replace(s, r"[^0-9]", "")
    return F.when(d == "", F.lit(None).cast("bigint")).otherwise(d.try_cast("bigint"))


def parse_currency(s, allow_plain: bool = False) -> Column:
    """The first ``$1,234`` amount as an integer, else null.  With
    ``allow_plain`` a cell holding only digits (and commas) is accepted too
    (decision D6: write-back reads plain integers)."""
    x = F.coalesce(_c(s), F.lit(""))
    money = F.regexp_extract(x, r"\$[0-9,]+", 0)
    v = F.when(money != "", _digits_to_int(money))
    if allow_plain:
        plain = strip(x)
        v = F.coalesce(v, F.when(plain.rlike(r"^[0-9][0-9,]*$"), _digits_to_int(plain)))
    return v


def is_decimal_number(s) -> Column:
    """S3: ``^\\d+\\.\\d+$`` after trimming."""
    return strip(F.coalesce(_c(s), F.lit(""))).rlike(r"^[0-9]+\.[0-9]+$")


def first_integer(s) -> Column:
    """The first run of digits and commas as an integer."""
    m = F.regexp_extract(F.coalesce(_c(s), F.lit("")), r"[0-9,]+", 0)
    return F.when(F.regexp_replace(m, ",", "") != "", _digits_to_int(m))


def gpa_token(s, strict: bool = False) -> Column:
    """First ``d.d+`` token as a double (note ``13.5`` gives ``3.5``);
    ``strict`` uses the last-resort form ``\\b\\d\\.\\d{2}\\b``."""
    rx = r"\b[0-9]\.[0-9]{2}\b" if strict else r"[0-9]\.[0-9]+"
    m = F.regexp_extract(F.coalesce(_c(s), F.lit("")), rx, 0)
    return F.when(m != "", m.try_cast("double"))


def points_value(s) -> Column:
    """The first signed number in a cell as a double."""
    m = F.regexp_extract(F.coalesce(_c(s), F.lit("")), r"[-+]?[0-9]*\.?[0-9]+", 0)
    return F.when(m != "", m.try_cast("double"))


# Fixed value: header words that name a points column.
POINTS_HEADER = r"(?i)\b(c?pts?|points?)\b"


def points_column_index(header: Column) -> Column:
    """0-based index of the first header naming points, else null."""
    idx = F.filter(F.sequence(F.lit(0), F.size(header) - 1),
                   lambda i: F.coalesce(at(header, i + 1), F.lit("")).rlike(POINTS_HEADER))
    return F.when(F.size(header) > 0, at(idx, 1))


RECORD_RE = r"[0-9]+\s*[-–][ \t]*[0-9]+"


def is_record(s) -> Column:
    """S32 predicate: a ``W-L`` record is present."""
    return F.coalesce(_c(s), F.lit("")).rlike(r"[0-9]+\s*[-–]\s*[0-9]+")


def record_struct(s) -> Column:
    """First ``W-L[-T]`` record as ``struct(w, l, t)`` of ints."""
    x = F.coalesce(_c(s), F.lit(""))
    rx = r"([0-9]+)\s*[-–]\s*([0-9]+)(?:\s*[-–]\s*([0-9]+))?"
    w, l, t = (F.regexp_extract(x, rx, i) for i in (1, 2, 3))
    return F.when(w != "", F.struct(w.try_cast("int").alias("w"), l.try_cast("int").alias("l"),
                                    F.when(t != "", t.try_cast("int")).alias("t")))
