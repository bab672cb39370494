"""Ranks of large groups, null groups and crowded scores."""
from pyspark.sql import functions as F
from tessera.operators import aggregate as ag


def test_ranks_of_a_million_rows_are_1_to_n(spark):
    df = (spark.range(0, 1_000_000, numPartitions=16)
          .withColumn("g", F.when(F.col("id") % 3 == 0, F.lit(None)).otherwise(F.col("id") % 3))
          .withColumn("v", F.when(F.col("id") % 5 == 0, F.lit(7.0)).when(F.col("id") % 7 == 0, F.lit(None)).otherwise(F.hash("id") * 1.0))
          .withColumn("wide", F.concat(F.lit("x" * 50), F.col("id").cast("string"))))
    out = ag.rank_in_group(df, ["g"], "v", "id")
    got = {r["g"]: r for r in out.groupBy("g").agg(F.count("*").alias("n"), F.min("rank").alias("lo"), F.max("rank").alias("hi"),
                                                   F.countDistinct("rank").alias("d")).collect()}
    assert set(got) == {None, 1, 2} and sum(r["n"] for r in got.values()) == 1_000_000
    for r in got.values():
        assert r["lo"] == 1 and r["hi"] == r["n"] == r["d"]
    # ranks follow the scores: compare with the neighbour in rank order, group by group, on a slice
    from pyspark.sql import Window
    w = Window.partitionBy("g", F.floor(F.col("rank") / 5000)).orderBy("rank")
    bad = (out.withColumn("pv", F.lag("v").over(w)).withColumn("pi", F.lag("id").over(w))
           .filter(F.col("pi").isNotNull() & ((F.col("pv") < F.col("v")) | (F.col("pv").isNull() & F.col("v").isNotNull())
                                              | (F.col("pv").eqNullSafe(F.col("v")) & (F.col("pi") > F.col("id"))))))
    assert bad.count() == 0


def test_null_group_keeps_its_rows(spark):
    df = spark.createDataFrame([(1, None, 5.0, ""), (2, None, 7.0, ""), (3, "a", None, "4")], "pos long, conference string, pts double, standing string")
    got = {r["pos"]: r["standing"] for r in ag.points_standing(df).collect()}
    assert got == {1: "2", 2: "1", 3: "4"}


def test_empty(spark):
    df = spark.createDataFrame([], "g string, v double, id long")
    assert ag.rank_in_group(df, ["g"], "v", "id").count() == 0


def test_a_row_without_a_position_keeps_its_rank(spark):
    df = spark.createDataFrame([("a", 1.0, None), ("a", 1.0, 5), ("a", 2.0, 7), ("b", 1.0, None), (None, None, None)], "g string, v double, id long")
    got = sorted(((r["g"], r["v"], r["id"], r["rank"]) for r in ag.rank_in_group(df, ["g"], "v", "id").collect()), key=str)
    assert got == sorted([("a", 2.0, 7, 1), ("a", 1.0, 5, 2), ("a", 1.0, None, 3), ("b", 1.0, None, 1), (None, None, None, 1)], key=str)
