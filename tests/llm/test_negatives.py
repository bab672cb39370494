"""Hard negatives against plain code and SQL."""
import math

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F
from tests_llm_helpers import got, make, package  # noqa: F401

from tessera.llm import negatives as ng
from tessera.llm import queries, rtree

SCHEMA = "vec_id long, embedding array<float>, label int, score int, tile string"


def plain(rows, every=5, positives=5, negatives=10):
    """The same by comparing every anchor with every row."""
    use, seen = [], set()
    for i, v, label in rows:
        if label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        c = tuple(math.floor(256 * float(np.float32(x))) for x in v)
        if (i, c, label) not in seen:
            seen.add((i, c, label))
            use.append((i, c, label))
    out = []
    for a, av, al in use:
        if a is None or a % every:
            continue
        score = sorted([(-sum(x * y for x, y in zip(av, bv)), b is None, b or 0, b, bl) for b, bv, bl in use if (b, bv, bl) != (a, av, al)], key=lambda r: r[:3])
        pos = [r for r in score if r[4] == al and r[3] != a][:positives]
        for p in pos:
            neg = [r for r in score if r[4] != al and 30 * -p[0] <= 100 * -r[0] <= 90 * -p[0]][:negatives]
            out += [(a, p[3], k + 1, r[3], -p[0], -r[0]) for k, r in enumerate(neg)]
    return sorted(out, key=str)


def result(spark, rows, every=5, **options):
    df = spark.createDataFrame([(*r, 9, "clash") for r in rows], SCHEMA).repartition(3)
    res = got(ng.mine(ng.prepared(df, "vec_id", "embedding", F.col("label")), F.col("id") % every == 0, **options))
    return sorted([tuple(r[c] for c in ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")) for r in res], key=str)


def vectors(seed, n, dims, centers=0):
    rng = np.random.default_rng(seed)
    mid = rng.normal(size=(max(centers, 1), dims)) * (3 if centers else 0)
    which = rng.integers(0, max(centers, 1), n)
    x = mid[which] + rng.normal(size=(n, dims))
    label = which % 4 if centers else rng.integers(0, 3, n)
    return [(int(k), [float(c) for c in np.round(x[k], 3)], int(label[k])) for k in range(n)]


@pytest.mark.parametrize("dims,centers,options", [
    (6, 0, {}), (6, 5, {"tile_rows": 20}), (2, 3, {"tile_rows": 7, "sample": 30}), (12, 4, {"tile_rows": 40, "max_tiles": 5})])
def test_matches_all_pairs(spark, dims, centers, options):
    rows = vectors(dims, 240, dims, centers)
    assert result(spark, rows, **options) == plain(rows) != []


def test_ties_copies_and_edge_rows(spark):
    rows = vectors(3, 60, 3) + [(1000 + k, [1.0, 1.0, 1.0], k % 3) for k in range(120)] + [(5000, [1.0, 1.0, 1.0], 0)] * 4
    rows += [(None, [1.0, 1.0, 1.0], k % 2) for k in range(2)] + [(10, None, 1), (15, [1.0, None, 2.0], 1), (20, [float("nan"), 1.0, 1.0], 0)]
    rows += [(25, [float("inf"), 0.0, 0.0], 1), (30, [0.0, 0.0, 0.0], None), (35, [0.0, 0.0, 0.0], 2), (40, [], 1), (45, [2.0], 1)]
    rows = [r for r in rows if r[0] is None or r[0] >= 1000 or r[0] > 45 or len(r[1] or []) != 3 or r[0] in (10, 15, 20, 25, 30, 35)]
    rows = [(i, None if v is None else v + [0.0] * (3 - len(v)), lab) for i, v, lab in rows]
    assert result(spark, rows, tile_rows=16) == plain(rows) != []
    short = [(i, v if v is None else v[:2] if v[2:] == [0.0] else v, lab) for i, v, lab in rows]
    assert result(spark, short, tile_rows=16) == plain(rows)
    assert result(spark, []) == [] and result(spark, [(0, [1.0], 1)]) == []


def test_large_components_do_not_crash(spark):
    rows = [(k, [1e30 if k % 2 else 3e4, float(k)], k % 2) for k in range(20)]
    assert isinstance(result(spark, rows), list)


def test_blocks_of_anchors(spark):
    rows = vectors(8, 120, 4, 3)
    df = spark.createDataFrame([(*r, 9, "x") for r in rows], SCHEMA)
    index = ng.Index(ng.stored(ng.prepared(df, "vec_id", "embedding", F.col("label")), "t"), tile_rows=16)
    asked = ng.stored(df.select(F.col("vec_id").alias("a_id"), F.lit(0).cast("long").alias("a_tag"), F.col("label").cast("long").alias("a_label"),
                                F.transform("embedding", lambda x: F.floor(x.cast("double") * 256)).alias("v"),
                                F.array(F.lit(-float("inf"))).alias("low"), F.array(F.lit(float("inf"))).alias("high")), "t")
    rows_of = [{tuple(r.values()) for r in got(index.first(asked, 3, True, block))} for block in (10, 1000)]
    assert rows_of[0] == rows_of[1] and len(rows_of[0]) == 3 * 120


def test_boxes_are_pruned():
    """Clustered vectors: most leaves stay closed."""
    x = np.floor(np.array([v for _, v, _ in vectors(5, 8000, 4, 12)]) * 256)
    x = x[rtree.packed_order(x, 32)]
    tree = rtree.Tree(x, 32)
    opened = []

    def allowed(who, rows):
        opened.append(rows[0] // 32)
        return np.ones(rows.size, bool)
    (_, _, score, rows), = tree.search(x[:1], [[-np.inf]], [[np.inf]], [[-np.inf]], 10, allowed, np.arange(8000))
    want = np.argsort(-(x @ x[0]), kind="stable")[:10]
    assert rows.tolist() == want.tolist() and len(set(opened)) < 40 < 8000 / 32


def test_sql_says_the_same(spark):
    sf = "/root/testdata/sf0.01"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{sf}/embeddings.parquet'")
    want = con.execute(queries.ORACLE["op13_hard_negatives"]).fetchall()
    cols = [d[0] for d in con.description]
    res = got(queries.QUERIES["op13_hard_negatives"](spark, sf))
    assert sorted(tuple(r[c] for c in cols) for r in res) == sorted(want) and len(want) > 100
