"""Positions and class years (S14-S18, S43) as native Column expressions."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F
from tessera.functions.common import at

from tessera.functions.text import strip

# Fixed values (must equal the reference's lookup tables).
# Class-year words -> academic level.
YEAR_MAP = {
    "sr.": "senior", "sr": "senior", "senior": "senior",
    "jr.": "junior", "jr": "junior", "junior": "junior",
    "so.": "sophomore", "so": "sophomore", "sophomore": "sophomore",
    "fr.": "freshman", "fr": "freshman", "fy.": "freshman", "fy": "freshman", "freshman": "freshman",
    "first-year": "freshman",
    "graduate": "graduate student",
}
# Position words -> canonical position code.
POSITION_MAP = {
    "gk": "GK", "goal keeper": "GK", "goalkeeper": "GK", "keeper": "GK",
    "d": "D", "def": "D", "defender": "D", "back": "D", "cb": "D", "rb": "D", "lb": "D", "fb": "D",
    "m": "M", "mid": "M", "midfield": "M", "midfielder": "M", "dm": "M", "cm": "M", "am": "M", "rm": "M",
    "lm": "M", "wing": "M",
    "f": "F", "fw": "F", "forward": "F", "striker": "F", "st": "F", "cf": "F", "winger": "F", "fwd": "F",
}
# Free-text position tokens, searched case-insensitively on word boundaries.
POSITION_TOKEN_RE = (r"(?i)\b(gk|goal keeper|goalkeeper|keeper|d|def|defender|back|cb|rb|lb|fb|"
                     r"m|mid|midfield|midfielder|dm|cm|am|rm|lm|wing(?!erless)|"
                     r"f|fw|forward|striker|st|cf|winger)\b")
# Count buckets of the roster summary.
POSITION_BUCKETS = {"D": "defenders", "F": "forwards", "M": "midfielders", "GK": "goalkeepers"}
YEAR_BUCKETS = ["freshman", "sophomore", "junior", "senior", "graduate student"]
# Last-resort keyword searches when no position token could be mapped.
POSITION_KEYWORDS = [
    ("D", r"(?i)\b(defense|defender|back|def)\b"),
    ("M", r"(?i)\b(midfield|midfielder|mid)\b"),
    ("F", r"(?i)\b(forward|forwarder|forw|attacker|fw)\b"),
    ("GK", r"(?i)\b(goalkeeper|keeper|gk|goal)\b"),
]


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _lit_map(d: dict) -> Column:
    return F.create_map(*[F.lit(x) for x in chain.from_iterable(d.items())])


def canon_pos(s) -> Column:
    """Lower, drop dots, split on ``/ , - space``, map, distinct in
    order, join with ``/``; '' when nothing maps."""
    x = F.lower(strip(F.coalesce(_c(s), F.lit(""))))
    x = F.regexp_replace(F.regexp_replace(x, r"\.", ""), r"\\", "/")
    m = _lit_map(POSITION_MAP)
    mapped = F.filter(F.transform(F.split(x, r"[/,\-\s]+"), lambda t: at(m, t)),
                      lambda t: t.isNotNull())
    return F.array_join(F.array_distinct(mapped), "/")


def position_token(s) -> Column:
    """First position token in free text (lower case), '' if none."""
    return F.lower(F.regexp_extract(F.coalesce(_c(s), F.lit("")), POSITION_TOKEN_RE, 1))


def class_year(y) -> Column:
    """Class-year word -> level; unknown words pass through."""
    return F.coalesce(at(_lit_map(YEAR_MAP), F.lower(strip(_c(y)))), _c(y))


def season_start_year(now) -> Column:
    """June or later -> this year, else last year."""
    d = _c(now)
    return F.when(F.month(d) >= 6, F.year(d)).otherwise(F.year(d) - 1)


def academic_level(text, now) -> Column:
    """A ``20dd`` graduation year -> level by its distance to the season
    end (0 senior .. 3 freshman, earlier graduate student, later freshman);
    otherwise the class-year word without dots through YEAR_MAP.
    ``now`` is a column or literal date: the plan never reads a clock."""
    t = F.coalesce(_c(text).cast("string"), F.lit(""))
    s = F.lower(t)
    yr = F.regexp_extract(s, r"\b(20[0-9]{2})\b", 1)
    delta = yr.try_cast("int") - (season_start_year(now) + 1)
    by_year = (F.when(delta == 0, "senior").when(delta == 1, "junior").when(delta == 2, "sophomore")
               .when(delta == 3, "freshman").when(delta < 0, "graduate student").otherwise("freshman"))
    clean = strip(F.regexp_replace(s, r"\.", ""))
    by_word = F.coalesce(at(_lit_map(YEAR_MAP), clean), clean)
    return F.when(t == "", F.lit("")).when(yr != "", by_year).otherwise(by_word)


def normalize_players(players, position: str = "position", year: str = "year"):
    """Canonical position and class year on a player table."""
    return players.withColumn(position, canon_pos(position)).withColumn(year, class_year(year))


def position_classes(position) -> Column:
    """F1 per player: the canonical codes it adds to (with repeats).

    Whole value through POSITION_MAP; else split on ``/ & | ,`` and map each
    part, with a first-letter fallback (D, M, F, G->GK); else keyword search.
    """
    p = F.lower(F.coalesce(_c(position), F.lit("")))
    m = _lit_map(POSITION_MAP)
    parts = F.filter(F.transform(F.split(p, r"\s*[/&|,]\s*"), lambda t: strip(t)), lambda t: t != "")
    first = lambda t: F.upper(F.substring(t, 1, 1))
    cls = F.transform(parts, lambda t: F.coalesce(
        at(m, t),
        F.when(first(t) == "D", "D").when(first(t) == "M", "M").when(first(t) == "F", "F")
         .when(first(t) == "G", "GK")))
    counted = F.filter(cls, lambda c: c.isNotNull())
    kw = F.filter(F.array(*[F.when(p.rlike(rx), F.lit(code)) for code, rx in POSITION_KEYWORDS]),
                  lambda c: c.isNotNull())
    direct = at(m, p)
    return (F.when(direct.isNotNull(), F.array(direct))
            .when(F.size(counted) > 0, counted)
            .otherwise(kw))
