import datetime
import os

from pyspark.sql import functions as F

from conftest import rows
from tessera.streaming import incremental as inc


def test_split_pending(spark):
    w = spark.createDataFrame([(1, 1, False), (1, 2, True), (1, 3, False), (2, 1, False)], "g int, s int, f boolean")
    out = inc.split_pending(w, "g", "s", "f")
    assert rows(out, "g", "s", "state") == [(1, 1, "applied"), (1, 2, "pending"), (1, 3, "pending"), (2, 1, "applied")]


def test_stream_dedup_and_upsert_restart(spark, tmpdir_run):
    src = os.path.join(tmpdir_run, "src")
    sink = os.path.join(tmpdir_run, "sink")
    ck = os.path.join(tmpdir_run, "ck")
    schema = "k string, ts timestamp, v int"
    t0 = datetime.datetime(2024, 1, 1)
    spark.createDataFrame([("a", t0, 1), ("b", t0, 2)], schema).write.mode("append").parquet(src)

    def transform(b):
        return b.withColumn("v2", F.col("v") * 10)

    q = inc.stream_upsert(spark, src, spark.createDataFrame([], schema).schema, transform, sink, ck)
    q.awaitTermination()
    spark.createDataFrame([("c", t0, 3)], schema).write.mode("append").parquet(src)
    q = inc.stream_upsert(spark, src, spark.createDataFrame([], schema).schema, transform, sink, ck)
    q.awaitTermination()
    q = inc.stream_upsert(spark, src, spark.createDataFrame([], schema).schema, transform, sink, ck)   # nothing new
    q.awaitTermination()
    assert rows(spark.read.parquet(sink), "k", "v2") == [("a", 10), ("b", 20), ("c", 30)]
    # stream dedup by key within the watermark
    s = spark.readStream.schema(spark.createDataFrame([], schema).schema).parquet(src)
    d = inc.stream_dedup(s.union(s), ["k"], "ts")
    out = d.writeStream.format("memory").queryName("dedup_t").trigger(availableNow=True) \
        .option("checkpointLocation", os.path.join(tmpdir_run, "ck2")).start()
    out.awaitTermination()
    assert sorted(r["k"] for r in spark.sql("select k from dedup_t").collect()) == ["a", "b", "c"]
