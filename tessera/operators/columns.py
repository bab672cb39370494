"""Column resolution and mapping.

Two kinds: resolving the columns of a *DataFrame* by header variants is a
metadata step on ``df.columns`` (C3, C4); mapping the columns of a scraped
*HTML table* is data (each table has its own header row) and runs per table
on the header table, then is applied to all rows with array lookups.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from tessera.functions.common import at

from tessera.functions.facts import points_column_index, is_record, points_value
from tessera.functions.text import clean_school, normalize_header, strip


# ------------------------------------------------------------------ C3, C4

def resolve_columns(df: DataFrame, variants: dict, positions: dict | None = None,
                    mode: str = "exact") -> DataFrame:
    """Rename to canonical names: the first column whose
    case-insensitive name equals (``mode='exact'``) or contains
    (``mode='contains'``) a variant; else the column at the fallback
    position; else a null column.  Metadata only: no data is read."""
    cols = list(df.columns)
    low = [c.lower().strip() for c in cols]
    out = []
    for canon, vs in variants.items():
        vs = [v.lower() for v in vs]
        hit = None
        for i, c in enumerate(low):
            if (mode == "exact" and c in vs) or (mode == "contains" and any(v in c for v in vs)):
                hit = cols[i]
                break
        if hit is None and positions and canon in positions and positions[canon] < len(cols):
            hit = cols[positions[canon]]
        out.append(F.col(f"`{hit}`").alias(canon) if hit is not None else F.lit(None).cast("string").alias(canon))
    return df.select(*out)


# ------------------------------------------------------------------ C5

# Header keywords per standings field, tested in this order.
STANDING_KEYWORDS = {
    "school": ["school", "team", "institution", "university", "college", "teamname"],
    "conf_record": ["conf", "conference record", "conf_record", "conference_record", "conference"],
    "overall_record": ["overall", "overall record", "overall_record", "record"],
    "standing": ["standing", "place", "pos", "position", "rank"],
}


def _keyword_field(h: Column) -> Column:
    hn = F.lower(F.coalesce(h, F.lit("")))
    out = F.lit(None).cast("string")
    for field, kws in reversed(list(STANDING_KEYWORDS.items())):
        cond = F.lit(False)
        for k in kws:
            cond = cond | hn.contains(k)
        out = F.when(cond, F.lit(field)).otherwise(out)
    return out


def map_by_keyword(headers: DataFrame) -> DataFrame:
    """Per table, visible header -> field by the first keyword group that
    matches; per field the first visible position.  ``accepted`` when school
    and one other field mapped (decision D1: the *fields* are tested).
    Input ``(page_id, table_id, header, visible)``; output adds
    ``field_idx map<string,int>`` and ``accepted``."""
    x = headers.select("page_id", "table_id", F.explode("visible").alias("i"),
                       "header").withColumn("h", at(F.col("header"), F.col("i") + 1))
    x = x.withColumn("field", _keyword_field(F.col("h"))).filter(F.col("field").isNotNull())
    per = x.groupBy("page_id", "table_id", "field").agg(F.min("i").alias("i"))
    m = per.groupBy("page_id", "table_id").agg(
        F.map_from_entries(F.collect_list(F.struct("field", "i"))).alias("field_idx"))
    acc = (at(F.col("field_idx"), F.lit("school")).isNotNull()
           & (at(F.col("field_idx"), F.lit("conf_record")).isNotNull()
              | at(F.col("field_idx"), F.lit("overall_record")).isNotNull()
              | at(F.col("field_idx"), F.lit("standing")).isNotNull()))
    return headers.join(m, ["page_id", "table_id"], "left").withColumn("accepted", F.coalesce(acc, F.lit(False)))


# ------------------------------------------------------------------ C7

def map_by_name(headers: DataFrame, names: dict) -> DataFrame:
    """Normalised header text -> field, or -> list of fields used in order
    of appearance (a repeated header name maps its k-th occurrence to the
    k-th field, the last field after that); the first position per field
    wins.  Occurrences are numbered per table header, i.e. the same for every
    row (decision D2).  Adds ``field_idx``."""
    entries = []
    for k, v in names.items():
        vs = v if isinstance(v, list) else [v]
        entries.append(F.struct(F.lit(k).alias("k"), F.array(*[F.lit(x) for x in vs]).alias("v")))
    mp = F.map_from_entries(F.array(*entries))
    x = headers.select("page_id", "table_id", F.posexplode("header").alias("i", "h"), "visible")
    x = x.filter(F.array_contains("visible", F.col("i")))
    x = x.withColumn("hn", normalize_header(F.col("h")))
    w = Window.partitionBy("page_id", "table_id", "hn").orderBy("i")
    x = x.withColumn("occ", F.row_number().over(w) - 1)
    tgt = at(mp, F.col("hn"))
    x = x.withColumn("field", F.when(tgt.isNotNull(), at(tgt, F.least(F.col("occ") + 1, F.size(tgt)))))
    per = x.filter(F.col("field").isNotNull()).groupBy("page_id", "table_id", "field").agg(F.min("i").alias("i"))
    m = per.groupBy("page_id", "table_id").agg(F.map_from_entries(F.collect_list(F.struct("field", "i"))).alias("field_idx"))
    return headers.join(m, ["page_id", "table_id"], "left")


# ------------------------------------------------------------------ C15, C16, C17

def indices_to_names(header: Column, idx: Column, required=("school", "conf_record", "overall_record")) -> Column:
    """When every required field has a valid index, map the header text
    at each index to its field (``pts`` too); else null."""
    n = F.size(header)
    ok = F.lit(True)
    for r in required:
        v = at(idx, F.lit(r))
        ok = ok & v.isNotNull() & (v >= 0) & (v < n)
    ents = F.filter(F.map_entries(idx), lambda e: (e["value"] >= 0) & (e["value"] < n))
    names = F.map_from_entries(F.transform(ents, lambda e: F.struct(at(header, e["value"] + 1).alias("k"),
                                                                    e["key"].alias("v"))))
    return F.when(ok, names)


def names_to_indices(headers: DataFrame, names: dict) -> tuple[DataFrame, DataFrame]:
    """Field -> index where exactly one header equals the field's name
    (case-insensitive, trimmed); fields with several hits go to a review
    table.  Returns ``(resolved (page_id, table_id, field, i), review)``."""
    pairs = F.array(*[F.struct(F.lit(f).alias("field"), F.lit(n.lower()).alias("n")) for f, n in names.items()])
    x = headers.select("page_id", "table_id", F.posexplode("header").alias("i", "h"))
    f = headers.select("page_id", "table_id", F.explode(pairs).alias("p")).select("page_id", "table_id", "p.*")
    j = x.join(f, ["page_id", "table_id"]).filter(F.lower(strip(F.col("h"))) == F.col("n"))
    w = Window.partitionBy("page_id", "table_id", "field")
    j = j.withColumn("hits", F.count(F.lit(1)).over(w))
    return (j.filter("hits = 1").select("page_id", "table_id", "field", "i"),
            j.filter("hits > 1").select("page_id", "table_id", "field", "i", "h"))


def th_td_index(tags: Column, v: Column) -> Column:
    """C17: on sites that count the leading ``th`` as 0 and the n-th ``td`` as
    n, translate to the true cell position."""
    n = F.size(tags)
    tds = F.filter(F.sequence(F.lit(0), n - 1), lambda i: at(tags, i + 1) == "td")
    return F.when(v == 0, F.lit(0)).otherwise(at(tds, v))


# ------------------------------------------------------------------ C6, C8 + points: row extraction

def extract_standing_rows(rec: DataFrame, explicit: bool | Column = False) -> DataFrame:
    """C6 + C8 + S31 + G2 inputs: per aligned row the mapped fields.

    ``rec`` holds ``cells``, ``header``, ``visible``, ``field_idx``,
    ``row_idx``.  Without explicit indices (``explicit``, a flag or a condition
    on the row: positions are taken as they are) a school value without a letter
    falls back to the first cell with a letter, a record value that is not
    ``W-L`` to the first cell that is.  School: mapped, else first visible
    cell, else first cell; brackets, parentheses and ``*`` removed; blank
    schools dropped.  Standing: mapped, else the row number (over all
    aligned rows).  Points: the first header naming points."""
    cells = F.col("cells")
    get = lambda f: F.when(at(F.col("field_idx"), F.lit(f)).isNotNull(),
                           strip(at(cells, at(F.col("field_idx"), F.lit(f)) + 1)))
    first_alpha = at(F.filter(cells, lambda c: c.rlike("[A-Za-z]")), 1)
    first_rec = at(F.filter(cells, lambda c: is_record(c)), 1)
    school = get("school")
    conf, overall = get("conf_record"), get("overall_record")
    if explicit is not True:
        guess = ~explicit if isinstance(explicit, Column) else F.lit(True)
        school = F.when(guess & school.isNotNull() & ~school.rlike("[A-Za-z]") & first_alpha.isNotNull(),
                        strip(first_alpha)).otherwise(school)
        conf = F.when(guess & conf.isNotNull() & ~is_record(conf) & first_rec.isNotNull(), strip(first_rec)).otherwise(conf)
        overall = F.when(guess & overall.isNotNull() & ~is_record(overall) & first_rec.isNotNull(),
                         strip(first_rec)).otherwise(overall)
    first_vis = at(cells, at(F.col("visible"), 1) + 1)
    school = F.coalesce(F.nullif(school, F.lit("")), F.nullif(first_vis, F.lit("")), at(cells, 1))
    school = clean_school(school)
    pts_i = points_column_index(F.col("header"))
    pts = F.when(pts_i.isNotNull(), points_value(at(cells, pts_i + 1)))
    standing = F.coalesce(F.nullif(get("standing"), F.lit("")), F.col("row_idx").cast("string"))
    return (rec.select("*", school.alias("school"), F.coalesce(conf, F.lit("")).alias("conf_record"),
                       F.coalesce(overall, F.lit("")).alias("overall_record"), standing.alias("standing"),
                       pts.alias("pts"))
            .filter(F.col("school") != ""))


# ------------------------------------------------------------------ C12, C13

def config_report(config: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Config rows ready to run (url and xpath present) and a status
    line for the others naming what is missing."""
    has_url = F.coalesce(strip(F.col("url")) != "", F.lit(False))
    has_xp = F.coalesce(strip(F.col("xpath")) != "", F.lit(False))
    ready = config.filter(has_url & has_xp)
    rest = config.filter(~(has_url & has_xp)).withColumn(
        "missing", F.concat_ws(", ", F.when(~has_url, F.lit("url")), F.when(~has_xp, F.lit("xpath"))))
    return ready, rest


def start_at(config: DataFrame, conference: str | None) -> DataFrame:
    """Skip conferences before the named one (by ``seq`` within each
    gender/division); all when ``conference`` is None or unknown."""
    if conference is None:
        return config
    first = (config.filter(F.col("conference") == conference).groupBy("gender", "division")
             .agg(F.min("seq").alias("_start")))
    x = config.join(first, ["gender", "division"], "left")
    return x.filter(F.col("_start").isNull() | (F.col("seq") >= F.col("_start"))).drop("_start")
