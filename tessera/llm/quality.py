"""Quality rules: statistics of every text, fixed base rules, and robust
multivariate outliers.

Per (language, source) a minimum-covariance-determinant (MCD) estimate gives
the centre and scatter of the transformed statistic vectors; a document whose
squared Mahalanobis distance exceeds the cut-off is rejected.

The estimate is the deterministic variant with three starts: coordinatewise
median and MAD; mean and covariance of all rows; covariance of the tanh of the
standardised rows about the median.  From each, concentration steps (keep the
``h`` share of rows that lie nearest, take their mean and covariance) go on
until the determinant falls no more, and the start that ends with the least
determinant counts.

All of it is exact and the same under any partitioning: statistics are read to
1/1024, so that a group's rows collapse to cells with counts, sums are sums of
integers, and quantiles are taken from running counts of cells.  A step over
all groups, levels and starts is one histogram and one aggregation.  Group
estimates are small rows (one per group) joined back.

A (language, source) of ``n`` rows gives its own estimate the weight
``n / (n + SHRINK)``, the rest goes to its language, whose own weight against
all rows is found alike: no verdict jumps when a group grows by a row.

Defined results: null text has no words and fails the base rules; null
language or source forms a group of its own; repeated rows are judged alike;
a statistic of less spread than its floor is judged by the floor; an empty table gives
an empty result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import as_column, bounded_batches, byte_view, encode_spans, owner, stored, word_spans

SYMBOLS = b"#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PCT = 50

FEATURES = ("mean_chars", "symbols", "dup_lines", "repeats")
H_SHARE = 0.75         # share of rows an estimate is concentrated on
MAX_STEPS = 60         # concentration steps; they end when the determinant stops falling
SCALE = 1024           # statistics are read in units of 1 / SCALE
BINS = 512             # bins of the distance per doubling of 1 + distance
SHRINK = 1000.0        # rows at which a group weighs as much as the level above it
CUTOFF = 18.467        # squared distance; the 0.999 quantile of chi-square with 4 degrees of freedom
CONSISTENCY = 1.486    # the scatter of the nearest H_SHARE of normal rows times this is that of all
# least standard deviation of each transformed statistic: most good texts have
# no repeated word at all, and a spread near nothing would reject the first one.
# With CUTOFF they pass, where a group has none, up to 30 repeated words and
# 46 duplicated lines of 100, and 7.5 symbols per 100 words
FLOORS = (0.1, 0.5, 0.9, 0.8)

_COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")
_STATS = ", ".join(f"{c} long" for c in _COUNTS)


def _unique_codes(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Dense codes of the pairs (a, b), both small non-negative integers."""
    import pandas as pd
    return pd.factorize(a * (int(b.max()) + 1 if b.size else 1) + b)[0]


def text_stats(arr) -> dict[str, np.ndarray]:
    """The statistics of every text of an Arrow column."""
    raw, off = byte_view(arr)
    n = len(off) - 1
    starts, ends = word_spans(raw, off)
    doc = owner(starts, off)
    per_doc = lambda idx, w=None: np.bincount(idx, weights=w, minlength=n).astype(np.int64)
    lead = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
    n_words = per_doc(doc)
    symbol = np.flatnonzero(np.isin(raw, np.frombuffer(SYMBOLS, np.uint8)))
    codes, _ = encode_spans(raw, starts, ends)
    # lines: a line holds a word if a word starts in it
    cut = np.unique(np.concatenate([off[:-1][np.diff(off) > 0], np.flatnonzero(raw == 10) + 1]))
    cut = cut[cut < raw.size]
    stop = np.append(cut[1:], raw.size)
    stop = stop - (raw[stop - 1] == 10) if cut.size else stop
    held = np.zeros(cut.size, bool)
    if cut.size and starts.size:
        held[np.searchsorted(cut, starts, side="right") - 1] = True
    lcode, _ = encode_spans(raw, cut, np.maximum(stop, cut))
    ldoc = owner(cut, off)
    lkey = _unique_codes(lcode[held], ldoc[held])
    first = np.ones(lkey.size, bool)
    if lkey.size:
        order = np.unique(lkey, return_index=True)[1]
        first[:] = False
        first[order] = True
    dup = per_doc(ldoc[held][~first])
    # three-word windows inside one document
    rep = np.zeros(n, np.int64)
    if codes.size >= 3:
        ok = doc[2:] == doc[:-2]
        pair = _unique_codes(codes[:-1], codes[1:])
        tri = _unique_codes(pair[:-1], codes[2:])
        at = np.flatnonzero(ok)
        key = _unique_codes(tri[at], doc[at])
        many = np.bincount(key)[key] >= 2
        hit = at[many]
        covered = np.zeros(codes.size, bool)
        for k in range(3):
            covered[hit + k] = True
        rep = per_doc(doc[covered])
    return {"n_words": n_words, "word_chars": per_doc(doc, (lead[ends] - lead[starts]).astype(float)),
            "n_symbols": per_doc(owner(symbol, off)), "n_dup_lines": dup, "n_repeat_words": rep, "n_lines": per_doc(ldoc[held])}


def statistics(docs: DataFrame) -> DataFrame:
    """``doc_id, lang, source`` and the counts of every whole text."""
    bounded_batches(docs.sparkSession)
    schema = pa.schema([("doc_id", pa.int64()), ("lang", pa.string()), ("source", pa.string()),
                        *((c, pa.int64()) for c in _COUNTS), ("text_hash", pa.int64())])

    def run(batches):
        for b in batches:
            s = text_stats(as_column(b, "text"))
            yield pa.RecordBatch.from_arrays(
                [as_column(b, "doc_id"), as_column(b, "lang"), as_column(b, "source"),
                 *(pa.array(s[c]) for c in _COUNTS),
                 as_column(b, "text_hash")], schema=schema)

    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"),
                      F.col("source").cast("string").alias("source"), F.col("text"), F.xxhash64("text").alias("text_hash"))
    return src.mapInArrow(run, f"doc_id long, lang string, source string, {_STATS}, text_hash long")


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PCT * F.col("n_words"))


def _vector() -> list[Column]:
    """Transformed statistics: logarithms tame the long right tails of counts
    and lengths, so that size alone does not make an outlier."""
    n = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    return [F.log(F.greatest(F.col("word_chars") / n, F.lit(0.5))).alias("mean_chars"),
            F.log1p(100 * F.col("n_symbols") / n).alias("symbols"),
            F.log1p(100 * F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1)).cast("double")).alias("dup_lines"),
            F.log1p(100 * F.col("n_repeat_words") / n).alias("repeats")]


def _cells(rows: DataFrame, gids: Column) -> DataFrame:
    """``gid, q0 .. q3, n``: rows of a group that agree to 1 / SCALE are one
    cell; ``gids`` lists the groups a row belongs to."""
    q = [F.round(F.col(f) * SCALE).cast("long").alias(f"q{i}") for i, f in enumerate(FEATURES)]
    first = rows.select(gids.alias("gids"), *q).groupBy("gids", *_Q).agg(F.count(F.lit(1)).alias("n"))
    return first.select(F.explode("gids").alias("gid"), *_Q, "n").groupBy("gid", *_Q).agg(F.sum("n").alias("n"))


_Q = [f"q{i}" for i in range(len(FEATURES))]
_PAIRS = [(i, j) for i in range(len(FEATURES)) for j in range(i, len(FEATURES))]


CELLS_PER_TASK = 50_000


def _few(df: DataFrame, rows: int) -> DataFrame:
    """A table of about ``rows`` small rows in as many tasks as that needs."""
    return df.coalesce(max(1, -(-rows // CELLS_PER_TASK)))


def _median(hist: DataFrame) -> DataFrame:
    """``gid, f, m``: the median of every statistic (``v`` with counts ``n``)."""
    w = Window.partitionBy("gid", "f").orderBy("v")          # distinct values of one statistic
    run = hist.withColumn("run", F.sum("n").over(w)).withColumn("total", F.sum("n").over(Window.partitionBy("gid", "f")))
    return run.where(2 * F.col("run") >= F.col("total")).groupBy("gid", "f").agg(F.min("v").alias("m"))


def _sums(rows: DataFrame, keys: list[str], x: list[Column]) -> DataFrame:
    """Exact integer moments: ``n, s`` (sums), ``p`` (sums of products)."""
    n = F.col("n")
    big = lambda c: c.cast("decimal(38,0)")
    return rows.groupBy(*keys).agg(F.sum("n").alias("n"), F.array(*[F.sum(n * c).cast("double") for c in x]).alias("s"),
                                   F.array(*[F.sum(big(n * x[i] * x[j])).cast("double") for i, j in _PAIRS]).alias("p"))


def _estimate(s, p, n: int, factor: float):
    """(mean, covariance) in the statistics' own units."""
    d = len(FEATURES)
    mu = np.array(s, float) / n
    cov = np.empty((d, d))
    for (i, j), v in zip(_PAIRS, p):
        cov[i, j] = cov[j, i] = v / n - mu[i] * mu[j]
    return mu / SCALE, cov * factor / SCALE**2


def _floored(cov: np.ndarray):
    """(eigenvalues, eigenvectors) of the scatter in units of ``FLOORS``: in no
    direction is the spread less than one; wider spreads stay as they are."""
    m = cov / np.outer(FLOORS, FLOORS)
    w, v = np.linalg.eigh((m + m.T) / 2)
    return np.maximum(w, 1.0), v


def _row(mu: np.ndarray, cov: np.ndarray) -> tuple:
    """mu, cov, inv and the logarithm of the determinant, as lists."""
    w, v = _floored(cov)
    inv = (v / w) @ v.T / np.outer(FLOORS, FLOORS)
    return mu.tolist(), cov.ravel().tolist(), inv.ravel().tolist(), float(np.log(w).sum())


_EST = "gid string, start int, n long, mu array<double>, cov array<double>, inv array<double>, logdet double"
_EST_TYPES = [pa.string(), pa.int32(), pa.int64(), *[pa.list_(pa.float64())] * 3, pa.float64()]
_EST_NAMES = ["gid", "start", "n", "mu", "cov", "inv", "logdet"]


def _as_estimates(sums: DataFrame, each) -> DataFrame:
    """``each(row)`` -> (start, n, mu, cov) tuples, one small row per group."""
    def run(batches):
        for b in batches:
            out = []
            for r in pa.Table.from_batches([b]).to_pylist():
                out += [(r["gid"], start, n, *_row(mu, cov)) for start, n, mu, cov in each(r)]
            cols = list(zip(*out)) if out else [[]] * len(_EST_NAMES)
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(cols, _EST_TYPES)], names=_EST_NAMES)
    return sums.mapInArrow(run, _EST)


def _starts(cells: DataFrame, size: int) -> DataFrame:
    """The three starts of every group, over ``size`` cells."""
    hist = cells.select("gid", "n", F.posexplode(F.array(*_Q)).alias("f", "v")).groupBy("gid", "f", "v").agg(F.sum("n").alias("n"))
    hist = stored(_few(hist, size), "mcd-values")
    med = stored(_few(_median(hist), size), "mcd-median")
    dev = hist.join(med, ["gid", "f"]).select("gid", "f", F.abs(F.col("v") - F.col("m")).alias("v"), "n").groupBy("gid", "f", "v").agg(F.sum("n").alias("n"))
    mad = _median(dev).withColumnRenamed("m", "mad")
    place = lambda c: F.transform(F.array_sort(F.collect_list(F.struct("f", c))), lambda x: x[c])
    both = stored(_few(med.join(mad, ["gid", "f"]).groupBy("gid").agg(place("m").alias("m"), place("mad").alias("mad")), size), "mcd-mad")
    x = cells.join(both, "gid")
    # floors stand in for a spread of nothing
    unit = [F.greatest(F.element_at("mad", i + 1) * 1.4826, F.lit(FLOORS[i] * SCALE)) for i in range(len(FEATURES))]
    tanh = [F.round(F.tanh((F.col(q) - F.element_at("m", i + 1)) / unit[i]) * SCALE).cast("long") for i, q in enumerate(_Q)]
    plain = _sums(cells, ["gid"], [F.col(q) for q in _Q])
    curved = _sums(x, ["gid"], tanh).select("gid", F.col("s").alias("ts"), F.col("p").alias("tp"))

    def each(r):
        m, u = np.array(r["m"], float) / SCALE, np.maximum(np.array(r["mad"], float) * 1.4826, np.array(FLOORS) * SCALE) / SCALE
        mu, cov = _estimate(r["s"], r["p"], r["n"], 1.0)
        _, bent = _estimate(r["ts"], r["tp"], r["n"], 1.0)
        return [(0, r["n"], m, np.diag((np.array(r["mad"], float) * 1.4826 / SCALE) ** 2)), (1, r["n"], mu, cov), (2, r["n"], m, bent * np.outer(u, u))]
    rows = plain.join(both, "gid").join(curved, "gid").select("gid", "n", "s", "p", "m", "mad", "ts", "tp")
    return _as_estimates(_few(rows, size), each)


def _step(cells: DataFrame, est: DataFrame, size: int) -> DataFrame:
    """One concentration step of every group and start in ``est``."""
    d2 = _distance([F.col(q) / float(SCALE) for q in _Q])
    scored = cells.join(est.select("gid", "start", "mu", "inv"), "gid").withColumn("bin", F.floor(F.log2(1 + d2) * BINS))
    scored = stored(_few(scored.select("gid", "start", *_Q, "n", "bin"), 3 * size), "mcd-scored")
    hist = scored.groupBy("gid", "start", "bin").agg(F.sum("n").alias("n"))
    w = Window.partitionBy("gid", "start").orderBy("bin")    # bins of one group
    run = hist.withColumn("run", F.sum("n").over(w)).withColumn("total", F.sum("n").over(Window.partitionBy("gid", "start")))
    cut = run.where(F.col("run") >= F.ceil(F.col("total") * H_SHARE)).groupBy("gid", "start").agg(F.min("bin").alias("cut"), F.max("total").alias("total"))
    cut = stored(_few(cut, size), "mcd-cut")
    near = scored.join(cut, ["gid", "start"]).where(F.col("bin") <= F.col("cut"))
    sums = _sums(near, ["gid", "start", "total"], [F.col(q) for q in _Q])
    return _as_estimates(_few(sums.select("gid", "start", "total", "n", "s", "p"), size),
                         lambda r: [(r["start"], r["total"], *_estimate(r["s"], r["p"], r["n"], CONSISTENCY))])


def _concentrated(cells: DataFrame) -> DataFrame:
    """The estimate of least determinant of every group, over ``cells`` (stored)."""
    size = cells.count()
    open_ = stored(_starts(cells, size), "mcd-start").withColumn("logdet", F.lit(float("inf")))   # a start is no estimate yet
    ended = []
    for _ in range(MAX_STEPS):
        new = stored(_step(cells, open_, size), "mcd-step")
        old = open_.select("gid", "start", F.col("logdet").alias("before"))
        new = stored(_few(new.join(old, ["gid", "start"]), size), "mcd-step")
        falls = F.col("logdet") < F.col("before") - 1e-9
        # what falls no more has ended: in its new estimate if that is as low,
        # else in the one before (one of them: equal determinants are no tie)
        lower = F.col("logdet") <= F.col("before")
        back = new.where(~falls & ~lower).select("gid", "start")
        ended += [new.where(~falls & lower).drop("before"), open_.join(back, ["gid", "start"], "left_semi")]
        open_ = new.where(falls).drop("before")
        if open_.isEmpty():
            break
    every = open_
    for e in ended:
        every = every.unionByName(e)
    return every.groupBy("gid").agg(F.min_by(F.struct("n", "mu", "cov", "inv"), F.struct("logdet", "start")).alias("b")).select("gid", "b.*")


def _gid(level: int, keys: list[str]) -> Column:
    """Name of a row's group at a level; null keys are values."""
    return F.to_json(F.struct(F.lit(level).alias("level"), *keys), {"ignoreNullFields": "false"})


def mcd(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Estimates ``keys, n, mu, inv`` over the feature columns of ``rows``."""
    cells = stored(_cells(rows, F.array(_gid(len(keys), keys))), "mcd-cells")
    names = stored(rows.select(*keys, _gid(len(keys), keys).alias("gid")).distinct(), "mcd-names")
    return names.join(_concentrated(cells), "gid").select(*keys, "n", "mu", "inv")


def shrunk(rows: DataFrame) -> DataFrame:
    """``lang, source, mu, inv`` of every (language, source), shrunk towards
    its language and all rows; one pass over three levels."""
    keys = [[], ["lang"], ["lang", "source"]]
    gids = [_gid(level, k) for level, k in enumerate(keys)]
    cells = stored(_cells(rows, F.array(*gids)), "mcd-cells")
    size = cells.count()
    est = stored(_few(_concentrated(cells), size), "mcd-estimates")
    names = rows.select("lang", "source", *[g.alias(f"g{level}") for level, g in enumerate(gids)]).distinct()
    for level in range(3):
        names = names.join(est.select(F.col("gid").alias(f"g{level}"), *[F.col(c).alias(f"{c}{level}") for c in ("n", "mu", "cov")]), f"g{level}")
    w1, w2 = (F.col(f"n{i}") / (F.col(f"n{i}") + SHRINK) for i in (1, 2))
    mix = lambda c: F.zip_with(f"{c}2", F.zip_with(f"{c}1", f"{c}0", lambda a, b: a * w1 + b * (1 - w1)), lambda a, b: a * w2 + b * (1 - w2))
    mixed = names.select("lang", "source", F.col("g2").alias("gid"), F.col("n2").alias("n"), mix("mu").alias("mu"), mix("cov").alias("cov"))
    mixed = stored(_few(mixed, size), "mcd-mixed")
    d = len(FEATURES)
    inv = _as_estimates(mixed.select("gid", "n", "mu", "cov"),
                        lambda r: [(0, r["n"], np.array(r["mu"]), np.array(r["cov"]).reshape(d, d))]).select("gid", "mu", "inv")
    return stored(_few(mixed.select("lang", "source", "gid").join(inv, "gid").drop("gid"), size), "mcd-shrunk")


def _distance(x: list[Column]) -> Column:
    d = len(FEATURES)
    diff = [x[i] - F.element_at("mu", i + 1) for i in range(d)]
    total = F.lit(0.0)
    for i in range(d):
        for j in range(d):
            total = total + diff[i] * F.element_at("inv", i * d + j + 1) * diff[j]
    return total


def judge(docs: DataFrame, cutoff: float = CUTOFF) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, the five statistics,
    ``base_failed, distance, kept`` and ``text_hash`` (xxhash64 of the text).
    The estimates learn from the rows that pass the base rules."""
    rows = statistics(docs).withColumn("base_failed", base_failed())
    rows = stored(rows.select("*", *_vector()), "quality")
    est = shrunk(rows.where(~F.col("base_failed"))).select(F.col("lang").alias("e_lang"), F.col("source").alias("e_source"), "mu", "inv")
    out = rows.join(est, F.col("lang").eqNullSafe(F.col("e_lang")) & F.col("source").eqNullSafe(F.col("e_source")), "left")
    distance = _distance([F.round(F.col(f) * SCALE) / float(SCALE) for f in FEATURES])
    out = out.withColumn("distance", F.when(~F.col("base_failed"), distance))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                      "distance", (~F.col("base_failed") & F.coalesce(F.col("distance") <= cutoff, F.lit(True))).alias("kept"),
                      "text_hash")
