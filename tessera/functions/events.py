"""Event and camp fields (S19-S26) as native Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from tessera.functions.common import at, bound

from tessera.functions.text import strip


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def extract_division(text) -> Column:
    """NAIA, else D1/D2/D3 from ``d1``.. or ``division i/ii/iii``.

    Decision D7: roman numerals are matched as whole words, longest first, so
    ``Division II`` is D2 (the reference's prefix test returns D1)."""
    t = F.lower(F.coalesce(_c(text), F.lit("")))
    return (F.when(t.contains("naia"), "NAIA")
            .when(t.contains("d1"), "D1").when(t.contains("d2"), "D2").when(t.contains("d3"), "D3")
            .when(t.rlike(r"division iii\b"), "D3")
            .when(t.rlike(r"division ii\b"), "D2")
            .when(t.rlike(r"division i\b"), "D1")
            .otherwise(""))


def division_from_filename(path) -> Column:
    """``DI``/``DII``/``DIII``/``NAIA`` as a separate token of the base
    name, upper-cased (decision D8: ``Division``/``Indiana`` do not match)."""
    base = F.regexp_extract(F.coalesce(_c(path), F.lit("")), r"([^/\\]*)$", 1)
    m = F.regexp_extract(base, r"(?i)(?:^|[^A-Za-z])(DI{1,3}|NAIA)(?:[^A-Za-z]|$)", 1)
    return F.when(m != "", F.upper(m))


def grade_levels(ages) -> Column:
    """Drop ``+``, split on the en dash, keep integer parts; bands
    2-12 Elementary, 13-14 Middle, 15-18 High, comma-joined.  Endpoints only:
    ``8–17`` is Elementary and High."""
    parts = F.transform(F.split(F.regexp_replace(F.coalesce(_c(ages), F.lit("")), r"\+", ""), "–"),
                        lambda s: strip(s))
    nums = F.transform(F.filter(parts, lambda s: s.rlike(r"^[0-9]+$")), lambda s: s.cast("int"))
    band = lambda lo, hi, name: F.when(F.exists(nums, lambda a: (a >= lo) & (a <= hi)), F.lit(name))
    return F.concat_ws(", ", band(2, 12, "Elementary School"), band(13, 14, "Middle School"),
                       band(15, 18, "High School"))


def gender_from_title(title) -> Column:
    """S22 (camp title): boys -> Boys, girls -> Girls, else Coed."""
    t = F.lower(F.coalesce(_c(title), F.lit("")))
    return F.when(t.contains("boys"), "Boys").when(t.contains("girls"), "Girls").otherwise("Coed")


def gender_from_name(name) -> Column:
    """S22 (file name / URL): ``women`` tested before ``men``; else null."""
    t = F.lower(F.coalesce(_c(name), F.lit("")))
    return F.when(t.contains("women"), "women").when(t.contains("men"), "men")


def ages_from_text(text) -> Column:
    """``ages? 8-12`` style value, case-insensitive."""
    return F.regexp_extract(F.coalesce(_c(text), F.lit("")), r"(?i)ages?\s*([0-9\-\+]+)", 1)


# Month and weekday names by their first letters, and the hours
# that zone names lie ahead of UTC.
MONTHS = ["jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec"]
_MONTH = r"\b(jan(?:uary)?|feb(?:ruary)?|mar(?:ch)?|apr(?:il)?|may|june?|july?|aug(?:ust)?|sept?(?:ember)?|oct(?:ober)?|nov(?:ember)?|dec(?:ember)?)\b\.?"
_WEEKDAY = r"\b(?:mon|tue|tues|wed|weds|thu|thur|thurs|fri|sat|sun)(?:day|sday|nesday|rsday|urday)?\b\.?"
ZONES = {"z": 0, "utc": 0, "gmt": 0, "est": -5, "edt": -4, "cst": -6, "cdt": -5, "mst": -7, "mdt": -6, "pst": -8, "pdt": -7}
_FILLER = r"\b(?:at|on|of|the|and|a\.?d)\b\.?"
_CLOCK = r"\b(\d{1,2}):(\d{2})(?::(\d{2})(?:[.,]\d+)?)?(?:\s*([ap])\.?m\b\.?)?"
_HOUR = r"\b(\d{1,2})\s*([ap])\.?m\b\.?"
_ZONE = r"(?:(?<![a-z])(" + "|".join(ZONES) + r")\b)?\s*(?:([+-])(\d{2}):?(\d{2})\b)?"


def parse_date(s, default_year: int | None = None) -> Column:
    """Free date text -> struct(epoch, reason).  ``epoch`` is in seconds
    (a text without a zone is UTC), null where ``reason`` tells why there is
    none: empty, no day, no month, no year, unknown word, several dates, no
    such date.

    The text is read as typed tokens, in any order: a time (``14:05``, ``2:05
    pm``, ``2 pm``) with a zone (name or offset), weekdays, fillers, ordinals
    (``3rd``), a month name, and numbers.  With a month name the year is the
    number of four digits (or the last of two), the day the other one.
    Without one, numbers are ``year month day`` if the first has four digits,
    ``yyyymmdd``, else ``month day year``, or ``day month year`` if the first
    is above 12.  Years of two digits lie in 1969-2068.  A text without a year
    takes ``default_year`` if one is given.  A range is no single date."""
    text = F.regexp_replace(F.lower(strip(F.coalesce(_c(s), F.lit("")))), r"(\d)t(\d)", "$1 $2")
    return bound(text, lambda x: bound(F.struct(x.alias("x"), _time(x).alias("t"), _words(x).alias("w")), lambda r: _date(r, default_year)))


def _time(x: Column) -> Column:
    """struct(seconds of the day before the zone, bad, zone seconds, times)."""
    part = lambda g: F.nullif(F.regexp_extract(x, "(?:" + _CLOCK + "|" + _HOUR + r")\s*" + _ZONE, g), F.lit(""))
    names = F.create_map(*[F.lit(v) for kv in ZONES.items() for v in kv])
    read = F.struct(F.coalesce(part(1), part(5)).cast("int").alias("h"), F.coalesce(part(4), part(6), F.lit("")).alias("half"),
                    F.coalesce(part(2).cast("int"), F.lit(0)).alias("m"), F.coalesce(part(3).cast("int"), F.lit(0)).alias("s"),
                    (F.coalesce(names[part(7)] * 3600, F.lit(0)) + F.when(part(8) == "-", -1).otherwise(1)
                     * F.coalesce(part(9).cast("int") * 3600 + part(10).cast("int") * 60, F.lit(0))).alias("ahead"))

    def of(r):
        hour = F.when(r["half"] == "p", F.pmod(r["h"], F.lit(12)) + 12).when(r["half"] == "a", F.pmod(r["h"], F.lit(12))).otherwise(F.coalesce(r["h"], F.lit(0)))
        bad = r["h"].isNotNull() & F.when(r["half"] != "", (r["h"] < 1) | (r["h"] > 12)).otherwise(r["h"] > 23)
        return F.struct((hour * 3600 + r["m"] * 60 + r["s"]).alias("seconds"), (bad | (r["m"] > 59) | (r["s"] > 59)).alias("bad"), r["ahead"].alias("ahead"),
                        F.size(F.regexp_extract_all(x, F.lit("(?:" + _CLOCK + "|" + _HOUR + r")\s*" + _ZONE), F.lit(0))).alias("times"))
    return bound(read, of)


def _words(x: Column) -> Column:
    """struct(month number, month names, unknown words, numbers) of the rest."""
    d = F.regexp_replace(x, "(?:" + _CLOCK + "|" + _HOUR + r")\s*" + _ZONE, " ")
    d = F.regexp_replace(F.regexp_replace(d, _WEEKDAY + "|" + _FILLER, " "), r"(\d)(?:st|nd|rd|th)\b", "$1")

    def of(d):
        rest = F.regexp_replace(d, _MONTH, " ")
        month = F.array_position(F.array(*[F.lit(m) for m in MONTHS]), F.substring(F.regexp_extract(d, _MONTH, 1), 1, 3)).cast("int")
        return F.struct(month.alias("month"), F.size(F.regexp_extract_all(d, F.lit(_MONTH), F.lit(1))).alias("names"),
                        (F.regexp_replace(rest, r"[\d\s,./'\-]", "") != "").alias("unknown"),
                        F.transform(F.regexp_extract_all(rest, F.lit(r"\d+"), F.lit(0)), lambda t: F.struct(
                            t.try_cast("int").alias("v"), F.length(t).alias("n"), t.alias("t"))).alias("nums"))
    return bound(d, of)


def _date(r: Column, default_year: int | None) -> Column:
    nums, month, named = r["w"]["nums"], r["w"]["month"], r["w"]["names"] > 0
    n = F.size(nums)
    num = lambda i: F.try_element_at(nums, F.lit(i))["v"]
    size = lambda i: F.try_element_at(nums, F.lit(i))["n"]
    null, fixed = F.lit(None).cast("int"), F.lit(default_year).cast("int")
    year = lambda i: F.when(size(i) > 2, num(i)).when(num(i) > 68, 1900 + num(i)).otherwise(2000 + num(i))
    ymd = lambda y, m, d: F.struct(y.cast("int").alias("y"), m.cast("int").alias("m"), d.cast("int").alias("d"))
    eight = F.try_element_at(nums, F.lit(1))["t"]
    read = (F.when(named & (n == 2) & (size(1) == 4), ymd(num(1), month, num(2)))
            .when(named & (n == 2), ymd(year(2), month, num(1)))
            .when(named & (n == 1) & (size(1) == 4), ymd(num(1), month, null))
            .when(named, ymd(fixed, month, F.when(n == 1, num(1))))
            .when((n == 1) & (size(1) == 8), ymd(F.substring(eight, 1, 4), F.substring(eight, 5, 2), F.substring(eight, 7, 2)))
            .when((n == 3) & (size(1) == 4), ymd(num(1), num(2), num(3)))
            .when((n == 3) & (num(1) > 12), ymd(year(3), num(2), num(1)))
            .when(n == 3, ymd(year(3), num(1), num(2)))
            .when((n == 2) & (size(1) == 4), ymd(num(1), num(2), null))
            .when((n == 2) & (size(2) == 4), ymd(num(2), num(1), null))
            .when((n == 2) & (num(1) > 12), ymd(fixed, num(2), num(1)))
            .when(n == 2, ymd(fixed, num(1), num(2)))
            .otherwise(ymd(F.when(size(1) == 4, num(1)), null, null)))
    many = (r["w"]["names"] > 1) | (n > F.when(named, 2).otherwise(3)) | (r["t"]["times"] > 1)

    def of(d):
        ts = F.try_make_timestamp(d["y"], d["m"], d["d"], F.lit(0), F.lit(0), F.lit(0.0))
        reason = (F.when(r["x"] == "", "empty").when(r["w"]["unknown"], "unknown word").when(many, "several dates")
                  .when(d["m"].isNull(), "no month").when(d["d"].isNull(), "no day").when(d["y"].isNull(), "no year")
                  .when(ts.isNull() | r["t"]["bad"], "no such date"))
        return F.struct(F.when(reason.isNull(), F.unix_timestamp(ts) + r["t"]["seconds"] - r["t"]["ahead"]).alias("epoch"), reason.alias("reason"))
    return bound(read, of)


def to_unix(s, default_year: int | None = None) -> Column:
    """Free date text -> epoch seconds, 0 where ``parse_date`` has none."""
    return F.coalesce(parse_date(s, default_year)["epoch"], F.lit(0).cast("bigint"))


def split_date_range(s) -> Column:
    """``a to b`` -> struct(start, end) (decision D10: the word ``to``
    between spaces, so ``October`` is not split)."""
    x = F.coalesce(_c(s), F.lit(""))
    rx = r"^(.*?)\s+to\s+(.*)$"
    hit = x.rlike(rx)
    return F.struct(F.when(hit, strip(F.regexp_extract(x, rx, 1))).otherwise(F.lit("")).alias("start_date"),
                    F.when(hit, strip(F.regexp_extract(x, rx, 2))).otherwise(F.lit("")).alias("end_date"))


def split_city_state(s) -> Column:
    """``City, ST`` -> struct(city, state), parts trimmed."""
    parts = F.split(strip(F.coalesce(_c(s), F.lit(""))), ",")
    return F.struct(strip(at(parts, 1)).alias("city"),
                    F.coalesce(strip(F.try_element_at(parts, F.lit(2))), F.lit("")).alias("state"))


def after_last_colon(s) -> Column:
    """B21 helper: the text after the last ``:``, trimmed."""
    return strip(at(F.split(strip(F.coalesce(_c(s), F.lit(""))), ":"), -1))
