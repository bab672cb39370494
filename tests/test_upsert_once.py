"""An upsert runs its merge once; units without a whole key are done."""
import os

from pyspark.sql import functions as F

from tessera.streaming import keyed, runs
from tessera.streaming.tables import Tables


def test_the_merge_is_not_counted(spark, tmpdir_run, monkeypatch):
    tables = Tables(spark, os.path.join(tmpdir_run, "t"), buckets=3)
    frame = type(spark.range(1))
    merged, plain = [], frame.count
    monkeypatch.setattr(frame, "count", lambda self: merged.append("Aggregate" in self._jdf.queryExecution().analyzed().toString()) or plain(self))
    for n in range(2):
        batch = spark.range(20).select((F.col("id") % 7 + n).alias("k"), F.col("id").alias("v"))
        keyed.upsert(tables, "t", batch, ["k"], F.col("v") + 100 * n, batch_id=n)
    assert not any(merged)
    assert sorted((r["k"], r["v"]) for r in keyed.snapshot(tables, "t").collect()) == [(0, 14), (1, 14), (2, 15), (3, 16), (4, 17), (5, 18), (6, 19), (7, 13)]


def test_rows_of_batch_and_table_bound_the_merge(spark, tmpdir_run, monkeypatch):
    tables = Tables(spark, os.path.join(tmpdir_run, "t"), buckets=1)
    bounds, plain = [], Tables.write
    monkeypatch.setattr(Tables, "write", lambda self, *a: bounds.append(a[4]) or plain(self, *a))
    for n in range(2):
        keyed.upsert(tables, "t", spark.range(300).select("id", F.lit(n).alias("v")), ["id"], F.lit(n), batch_id=n)
    assert bounds == [300, 600]
    assert keyed.snapshot(tables, "t").where("v = 1").count() == 300


def test_units_with_null_keys(spark, tmpdir_run):
    tables = Tables(spark, os.path.join(tmpdir_run, "t"), buckets=3)
    units = spark.createDataFrame([("A", 1), (None, 2), ("B", None)], "a string, b int")

    def work(u):
        return u.select("a", "b", F.lit(1).alias("seq"), F.lit(5).alias("row_id"), F.lit("c").alias("column"), F.lit("v").alias("value"))

    n = runs.run_units(tables, units, ["a", "b"], work, lambda w: w.withColumn("failed", F.lit(True)), "cells")
    assert n == {"version": 0, "units": 3, "applied": 0, "pending": 1}
    assert tables.read(runs.PENDING).count() == 3
