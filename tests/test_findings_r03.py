"""Cases of the third review."""

import random

from tests.conftest import rows


def table(spark, folder, name, data, schema):
    spark.createDataFrame(data, schema).coalesce(1).write.parquet(f"{folder}/{name}.parquet")


def test_a_standings_page_holds_the_whole_nation(spark, tmpdir_run):
    from tessera.plans.page_catalog import standings_tables
    data = [(k, f"S{k}", k % 2, 1.0) for k in range(130)]
    table(spark, tmpdir_run, "supplier", data, "s_suppkey long, s_name string, s_nationkey int, s_acctbal double")
    got = rows(standings_tables(spark, tmpdir_run), "page_id", "school", "standing")
    assert {r[0] for r in got} == {0, 1} and len(got) == 130
    assert sorted(int(r[2]) for r in got if r[0] == 1) == list(range(1, 66))
    assert [r[2] for r in got if r[:2] == (1, "S129")] == ["65"]


def test_the_longest_common_subsequence_ends_a_search_of_like_names():
    from tessera.operators import topk
    ids = list(range(2000))
    names = [f"Supplier#{n:09d}" for n in ids]
    tile = topk._Tile(names, [["supplier", f"{n:09d}"] for n in ids], [""] * 2000, [""] * 2000, ids)
    scored = []
    top = tile.best(names[1234], ["supplier", f"{1234:09d}"], "", "", 0.0, 10, lambda a, b: (scored.append(b), topk.seq_ratio_py(a, b))[1], 0.15)
    assert top[0][2] == 1234 and len(top) == 10 and len(scored) < 200


def test_common_subsequences_of_masters():
    import numpy as np

    from tessera.operators import topk

    def lcs(a, b):
        line = [0] * (len(b) + 1)
        for x in a:
            last = line
            line = [0]
            for j, y in enumerate(b):
                line.append(last[j] + 1 if x == y else max(last[j + 1], line[j]))
        return line[-1]
    rng = random.Random(4)
    word = lambda n: "".join(rng.choice("abcdé ") for _ in range(n))
    names = [word(rng.randint(0, 90)) for _ in range(60)]
    tile = topk._Tile(names, [[] for _ in names], [""] * 60, [""] * 60, list(range(60)))
    for n in (0, 1, 20, 63, 64, 65, 150):
        low = word(n)
        got, want = tile.common(low, np.arange(60)), [lcs(low, m) for m in names]
        assert all(g == w if n <= 64 else g >= w for g, w in zip(got.tolist(), want))


def test_names_of_frequent_words_skip_the_first_round(spark):
    from tests.test_topk import brute
    from tessera.functions.similarity import combined_py
    from tessera.operators import topk
    left = [(f"Supplier#{n:04d}", "", None) for n in range(0, 60, 7)]
    master = [(f"Supplier#{n:04d}", "", None) for n in range(60)]
    L = spark.createDataFrame([(i, *r) for i, r in enumerate(left)], "id long, name string, pref string, division string")
    M = spark.createDataFrame([(j, *r) for j, r in enumerate(master)], "row_id long, master_name string, conference string, m_div string")
    got = {}
    for r in topk.exact_topk(L, M, 4, name="name", tile_rows=16, pairs=20).collect():
        got.setdefault(r["id"], []).append((r["rank"], r["row_id"], round(r["score"], 9)))
    assert {i: [x[1:] for x in sorted(v)] for i, v in got.items()} == brute(left, master, 4, combined_py)


def plan_of(df):
    return df._jdf.queryExecution().toString()


def test_masters_of_a_gram_are_not_broadcast(spark):
    from pyspark.sql import functions as F

    from tessera.operators.match import substring_candidates
    master = spark.range(300).select(F.col("id").alias("row_id"), F.concat(F.lit("large ring "), F.col("id").cast("string")).alias("master_name"))
    left = spark.createDataFrame([("la",), ("ring 29",)], "name string")
    out = substring_candidates(left, master, k=3)
    assert "sortmerge" in plan_of(out).lower().replace(" ", "") and "_s#" in plan_of(out)
    assert rows(out, "name", "rank", "row_id") == [("la", 1, 0), ("la", 2, 1), ("la", 3, 2), ("ring 29", 1, 29), ("ring 29", 2, 290), ("ring 29", 3, 291)]


def test_pages_of_a_small_file_are_dealt_over_tasks(spark, tmpdir_run):
    from tessera.session import read_table, spread
    table(spark, tmpdir_run, "part", [(k % 24,) for k in range(25)] + [(None,)], "p_partkey long")
    part = read_table(spark, tmpdir_run, "part")
    dealt = spread(part, "p_partkey", per_task=5)
    assert dealt.rdd.getNumPartitions() == 6
    assert rows(dealt.na.fill(-1)) == rows(part.na.fill(-1))
    assert spread(part.limit(0), "p_partkey").count() == 0
