"""Aggregates, rankings, top-k and first/last values.

Skew: every per-key result that can be a partial aggregate is one
(``count``, ``count_if``, ``min_by``/``max_by``), so a key holding a third of
the rows is combined map-side before the shuffle.  Per-group positions
(G1/G2) come from ``rank_in_group``, which cuts each group into cells of its
score range, so a hot group is spread over many tasks instead of one window
partition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.roster import POSITION_BUCKETS, YEAR_BUCKETS, position_classes
from tessera.sources.sinks import cut_lineage


# ------------------------------------------------------------------ counts

def duplicate_count(df: DataFrame, keys: list[str], count_col: str = "dup_count",
                    flag_col: str = "duplicate") -> DataFrame:
    """rows per key (partial aggregate) joined back, with the
    ``Duplicate`` flag for keys seen more than once (only rows of that key,
    decision D17)."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias(count_col))
    out = df.join(counts, keys, "left")
    return out.withColumn(flag_col, F.when(F.col(count_col) > 1, F.lit("Duplicate")).otherwise(F.lit("")))


def _bucket_name(v: str) -> str:
    return v.replace(" ", "_")


def roster_counts(players: DataFrame, keys: list[str], position: str = "position",
                  year: str = "year") -> DataFrame:
    """per team, 4 position counts and 5 class-year counts.

    A player whose position maps to two codes (``D/M``) adds to both; the
    class year counts when its lower-case value is one of the five levels.
    """
    x = players.withColumn("_cls", position_classes(F.col(position))) \
               .withColumn("_yr", F.lower(F.coalesce(F.col(year), F.lit(""))))
    def n_code(code):
        # a one-argument lambda: Spark reads a second argument as the index
        return F.size(F.filter("_cls", lambda c: c == F.lit(code)))

    aggs = []
    for code, bucket in POSITION_BUCKETS.items():
        aggs.append(F.sum(n_code(code)).cast("long").alias(bucket))
    for y in YEAR_BUCKETS:
        aggs.append(F.count_if(F.col("_yr") == y).alias(_bucket_name(y)))
    out = x.groupBy(*keys).agg(*aggs)
    return out.select(*keys, *[F.coalesce(F.col(b), F.lit(0)).cast("long").alias(b)
                               for b in list(POSITION_BUCKETS.values()) + [_bucket_name(y) for y in YEAR_BUCKETS]])


def wide_by(df: DataFrame, key: list[str], pivot: str, values: list[str], cols: list[str],
            fill=0) -> DataFrame:
    """one row per key with ``<value>_<col>`` columns (men and women side
    by side); conditional aggregation, i.e. a pivot with known values."""
    aggs = [F.coalesce(F.max(F.when(F.col(pivot) == v, F.col(c))), F.lit(fill)).alias(f"{v}_{c}")
            for v in values for c in cols]
    return df.groupBy(*key).agg(*aggs)


def text_roster_counts(cards: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """counts over roster-card text: a card adds one per position word it
    contains as a whole word (Unicode word boundaries, case-insensitive) to
    that word's bucket, and one per class-year word it contains as a
    substring.  Decision D5: counts go to the plural bucket of the code (the
    reference's key lookup fails).  The card is tokenised once; single words
    are token-set lookups, the two-word key a bounded regex."""
    from tessera.functions.roster import POSITION_MAP
    from tessera.functions.text import word_tokens
    low = F.lower(F.coalesce(F.col(text), F.lit("")))
    x = cards.select(*keys, low.alias("_low")).withColumn("_tok", word_tokens(F.col("_low")))

    def has(word):
        if " " in word:
            return F.col("_low").rlike(r"(?<![\p{L}\p{N}_])" + word + r"(?![\p{L}\p{N}_])")
        return F.array_contains("_tok", word)

    aggs = []
    for code, bucket in POSITION_BUCKETS.items():
        words = [w for w, c in POSITION_MAP.items() if c == code]
        n = sum((F.when(has(w), 1).otherwise(0) for w in words), F.lit(0))
        aggs.append(F.sum(n).cast("long").alias(bucket))
    for y in ["freshman", "sophomore", "junior", "senior"]:
        aggs.append(F.count_if(F.col("_low").contains(y)).alias(y))
    return x.groupBy(*keys).agg(*aggs)


def run_counters(df: DataFrame, **conds: Column) -> DataFrame:
    """one row of named counters (``count_if`` per condition)."""
    return df.agg(F.count(F.lit(1)).alias("rows"), *[F.count_if(c).alias(n) for n, c in conds.items()])


# ------------------------------------------------------------------ positions

_CELLS = 256    # cells per level of a group's score range


def _same(left: list[Column], right: list[Column]) -> Column:
    cond = F.lit(True)
    for x, y in zip(left, right):
        cond = cond & x.eqNullSafe(y)
    return cond


def _cell(df: DataFrame, keys: list[str], value: str, out: str, descending: bool) -> DataFrame:
    """Cut the range of ``value`` inside each ``keys`` group into ``_CELLS``
    cells, numbered in rank order; nulls come last.  The range is a partial
    aggregate, and the cell a fixed expression of the row and the range."""
    span = df.groupBy(*keys).agg(F.min(value).cast("double").alias("_lo"), F.max(value).cast("double").alias("_hi"))
    span = span.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], "_lo", "_hi")
    x = df.join(span, _same([F.col(k) for k in keys], [F.col(f"_k{i}") for i in range(len(keys))]), "left")
    v = F.col(value).cast("double")
    share = ((F.col("_hi") - v) if descending else (v - F.col("_lo"))) / (F.col("_hi") - F.col("_lo"))
    cell = (F.when(F.col(value).isNull(), F.lit(_CELLS))
            .when(F.col("_hi") > F.col("_lo"), F.least(F.floor(share * _CELLS), F.lit(_CELLS - 1)))
            .otherwise(F.lit(0)).cast("int"))
    return x.withColumn(out, cell).drop("_lo", "_hi", *[f"_k{i}" for i in range(len(keys))])


def rank_in_group(df: DataFrame, group: list[str], score: str, pos: str, out: str = "rank",
                  descending: bool = True) -> DataFrame:
    """1-based position of each row inside its group by ``score`` (nulls
    last), ties by ``pos`` (numeric, unique in its group; a null one last).  A
    null group is a group.

    One large group spans many tasks: its score range is cut into cells by
    fixed expressions, crowded cells are cut again, and rows of one cell that
    tie in the score are cut by ``pos``.  Rows are counted per cell (partial
    aggregate), the counts are summed up in cell order, and rows are only
    numbered inside their own cell.  Nothing depends on how rows are dealt to
    partitions.  The steps work on the narrow keys, cut from their lineage in
    the shared checkpoint folder so that the plan stays small; the ranks are
    joined back to the rows at the end.
    """
    keys = [f"_q{i}" for i in range(len(group))]
    x = df.select(*[F.col(g).alias(k) for g, k in zip(group, keys)], F.col(score).cast("double").alias("_s"),
                  F.col(pos).alias("_pos"), F.col(pos).cast("double").alias("_p"))
    x = cut_lineage(x)
    levels = list(keys)
    for name in ("_c1", "_c2"):
        x = cut_lineage(_cell(x, levels, "_s", name, descending))
        levels.append(name)
    # positions only order rows that tie: cells of several scores stay whole
    tie = x.groupBy(*levels).agg((F.min("_s") < F.max("_s")).alias("_several"))
    tie = tie.select(*[F.col(k).alias(f"_t{i}") for i, k in enumerate(levels)], "_several")
    x = x.join(tie, _same([F.col(k) for k in levels], [F.col(f"_t{i}") for i in range(len(levels))]), "left")
    x = x.drop(*[f"_t{i}" for i in range(len(levels))])
    x = _cell(x, levels, "_p", "_c4", False)
    x = cut_lineage(x.withColumn("_c4", F.when(F.coalesce("_several", F.lit(False)), F.lit(0)).otherwise(F.col("_c4"))))
    cells = [*levels, "_c4"]
    count = x.groupBy(*cells).agg(F.count(F.lit(1)).alias("_n"))
    run = Window.partitionBy(*keys).orderBy("_c1", "_c2", "_c4").rowsBetween(Window.unboundedPreceding, -1)
    count = count.withColumn("_before", F.coalesce(F.sum("_n").over(run), F.lit(0)))
    count = count.select(*[F.col(k).alias(f"_g{i}") for i, k in enumerate(cells)], "_before")
    x = x.join(count, _same([F.col(k) for k in cells], [F.col(f"_g{i}") for i in range(len(cells))]))
    by = F.col("_s").desc_nulls_last() if descending else F.col("_s").asc_nulls_last()
    w = Window.partitionBy(*cells).orderBy(by, F.col("_pos").asc_nulls_last())
    ranks = x.select(*keys, "_pos", (F.col("_before") + F.row_number().over(w)).cast("int").alias(out))
    return df.join(ranks, _same([F.col(g) for g in group], [F.col(k) for k in keys]) & F.col(pos).eqNullSafe(F.col("_pos"))) \
             .drop(*keys, "_pos")


def points_standing(df: DataFrame, group: str | list[str] = "conference", pos: str = "pos", pts: str = "pts",
                    standing: str = "standing") -> DataFrame:
    """G1 + G2: when any row of the group has points, standing = rank by
    points descending (missing = 0.0), ties in original order; otherwise the
    given standing, or the 1-based row number when it is blank.  Standings
    are strings, as in the reference.  ``group`` may be several columns; null
    values form groups like any other."""
    group = [group] if isinstance(group, str) else list(group)
    has_pts = df.groupBy(*group).agg(F.count(pts).alias("_npts"))  # partial aggregate
    has_pts = has_pts.select(*[F.col(g).alias(f"_h{i}") for i, g in enumerate(group)], "_npts")
    x = df.join(has_pts, _same([F.col(g) for g in group], [F.col(f"_h{i}") for i in range(len(group))]), "left")
    x = x.drop(*[f"_h{i}" for i in range(len(group))])
    # one ordering serves both rules: by points (desc) where the group has
    # points, else the score is constant and rows follow ``pos``
    x = x.withColumn("_by", F.when(F.col("_npts") > 0, F.coalesce(F.col(pts).cast("double"), F.lit(0.0))).otherwise(F.lit(0.0)))
    ranked = rank_in_group(x, group, "_by", pos, "_rk")
    given = F.coalesce(F.col(standing), F.lit("")) if standing in df.columns else F.lit("")
    return (ranked.withColumn(standing, F.when(F.col("_npts") > 0, F.col("_rk").cast("string"))
                              .when(given != "", given)
                              .otherwise(F.col("_rk").cast("string")))
            .drop("_npts", "_rk", "_by"))


def lowest_n(df: DataFrame, score: str, pos: str, n: int = 30, confirmed: Column | None = None) -> DataFrame:
    """Unconfirmed rows with the lowest score (unparsable -> 0.0), ties in
    row order; a top-n report (TakeOrderedAndProject)."""
    x = df if confirmed is None else df.filter(~confirmed)
    sc = F.coalesce(F.trim(F.col(score).cast("string")).try_cast("double"), F.lit(0.0))
    return x.withColumn(score, sc).orderBy(F.col(score).asc(), F.col(pos).asc()).limit(n)


def head_n(df: DataFrame, order: list, n: int) -> DataFrame:
    """First ``n`` rows in ``order``."""
    return df.orderBy(*order).limit(n)


def slice_rows(df: DataFrame, order: list, offset: int, limit: int) -> DataFrame:
    """Rows ``offset+1 .. offset+limit`` in ``order`` (messages 2..10)."""
    return df.orderBy(*order).offset(offset).limit(limit)


def first_value(df: DataFrame, keys: list[str], value: str, order: str, out: str | None = None) -> DataFrame:
    """Value of the first row per key (``min_by``, partial aggregate)."""
    return df.groupBy(*keys).agg(F.min_by(F.col(value), F.col(order)).alias(out or value))


def last_value(df: DataFrame, keys: list[str], value: str, order: str, out: str | None = None) -> DataFrame:
    """Value of the last row per key (``max_by``, partial aggregate)."""
    return df.groupBy(*keys).agg(F.max_by(F.col(value), F.col(order)).alias(out or value))


def keep_first(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row per key in ``order``.  ``min_by`` over a struct
    of the row is a partial aggregate, so a hot key is reduced map-side."""
    others = [c for c in df.columns if c not in keys]
    ordkey = F.struct(*[F.col(o) for o in order])
    best = df.groupBy(*keys).agg(F.min_by(F.struct(*[F.col(c) for c in others]), ordkey).alias("_r"))
    return best.select(*keys, *[F.col("_r")[c].alias(c) for c in others])


def no_longer_exist(df: DataFrame, a: str, b: str, phrase: str = "no longer exist") -> Column:
    """C9 predicate: either cell contains the phrase (case-insensitive)."""
    return (F.lower(F.coalesce(F.col(a), F.lit(""))).contains(phrase)
            | F.lower(F.coalesce(F.col(b), F.lit(""))).contains(phrase))
