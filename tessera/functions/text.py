"""Text normalisation as native Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Python's str.split()/strip() treat Unicode spaces as white space; Java's \s
# is ASCII only, so the class is spelled out (\x{..} works in Java and RE2).
WS = r"[\s\x{0b}\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


# The same set as characters: Unicode spaces Java's \s lacks, and all of them.
_UNI_SPACES = "".join(chr(c) for c in [0x0B, 0x1C, 0x1D, 0x1E, 0x1F, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
                                       0x2028, 0x2029, 0x202F, 0x205F, 0x3000])
WS_CHARS = "\t\n\x0c\r " + _UNI_SPACES


def strip(s) -> Column:
    """Python ``str.strip()``: ``trim`` with the white-space character set
    (linear, no regex)."""
    return F.trim(_c(s), F.lit(WS_CHARS))


def collapse_ws(s) -> Column:
    r"""Runs of (Unicode) white space -> one space: Unicode spaces are first
    translated to a plain space so the regex is the fast ASCII ``\s+``."""
    return F.regexp_replace(F.translate(_c(s), _UNI_SPACES, " " * len(_UNI_SPACES)), r"\s+", " ")


def clean_text(s) -> Column:
    """Collapse white space to one space and trim."""
    return strip(collapse_ws(_c(s)))


def normalize_title(s) -> Column:
    """Trim, lower, collapse white space, drop a leading ``1. ``."""
    x = collapse_ws(F.lower(strip(F.coalesce(_c(s), F.lit("")))))
    return F.regexp_replace(x, r"^[0-9]+\.\s*", "")


def normalize_header(s) -> Column:
    """Remove bracketed text, collapse white space, lower."""
    x = F.regexp_replace(F.coalesce(_c(s), F.lit("")), r"[\[\(].*?[\]\)]", "")
    return F.lower(clean_text(x))


def strip_camp_suffix(s) -> Column:
    """Drop a trailing `` Camp``/`` camp`` word."""
    return strip(F.regexp_replace(_c(s), r"\s+[Cc]amp$", ""))


def person_name_keys(s) -> Column:
    """Name forms searched in links: spaced, hyphenated, underscored, joined
    (all lower case, white space collapsed)."""
    base = F.lower(clean_text(_c(s)))
    return F.array(base, F.regexp_replace(base, " ", "-"), F.regexp_replace(base, " ", "_"),
                   F.regexp_replace(base, " ", ""))


def full_name(first, last) -> Column:
    """``first last`` trimmed; null parts are left out (decision D11)."""
    return strip(F.concat_ws(" ", _c(first), _c(last)))


def safe(v) -> Column:
    """Null -> '', trimmed."""
    return strip(F.coalesce(_c(v).cast("string"), F.lit("")))


def word_tokens(s) -> Column:
    """distinct lower-case word tokens, Unicode aware (Python ``\\w+``)."""
    return F.array_distinct(F.regexp_extract_all(F.lower(F.coalesce(_c(s), F.lit(""))),
                                                 F.lit(r"[\p{L}\p{N}_]+"), 0))


def clean_school(s) -> Column:
    """Remove ``[..]``, ``(..)`` and ``*``; trim."""
    return strip(F.regexp_replace(F.regexp_replace(F.coalesce(_c(s), F.lit("")), r"[\[\(].*?[\]\)]", ""), r"\*", ""))


def text_chunks(s, size: int) -> Column:
    """S42 without loss: the text in consecutive pieces of at most ``size``
    characters (one empty piece for a null or empty text).  Their
    concatenation is the whole text."""
    x = F.coalesce(F.col(s) if isinstance(s, str) else s, F.lit(""))
    n = F.greatest(F.ceil(F.length(x) / size), F.lit(1)).cast("int")
    return F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.substring(x, i * size + 1, F.lit(size)))
