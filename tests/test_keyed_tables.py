"""Committed tables: keyed upserts, processed keys, retries and restarts."""
import os
import random

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tessera.streaming import keyed
from tessera.streaming.tables import Tables

SCHEMA = "k string, seq int, a string, b int, gone boolean"


def frame(spark, data):
    return spark.createDataFrame(data, SCHEMA).repartition(3)


def plain_upsert(batches, merge="row"):
    """The same by a dictionary of all rows seen, oldest batch first."""
    seen = {}
    for n, batch in enumerate(batches):
        for r in batch:
            seen.setdefault(r[0], []).append((r[1], n, r))
    out = []
    for k, rs in seen.items():
        rs.sort(key=lambda x: (x[0], x[1]))
        if merge == "row":
            if not rs[-1][2][4]:
                out.append((k, *rs[-1][2][2:4]))
        else:
            a = b = None
            for _, _, r in rs:
                a, b = (None, None) if r[4] else (r[2] if r[2] is not None else a, r[3] if r[3] is not None else b)
            if not rs[-1][2][4]:
                out.append((k, a, b))
    return sorted(out, key=str)


def batches(seed, n=4):
    rng = random.Random(seed)
    order = list(range(400))
    rng.shuffle(order)       # rows arrive late and out of order
    out, at = [], 0
    for _ in range(n):
        out.append([(rng.choice(["x", "y", None, *(f"k{j}" for j in range(15))]), order[at + i], rng.choice([None, "p", "q"]),
                     rng.choice([None, 1, 2]), rng.random() < 0.15) for i in range(60)])
        at += 60
    return out


@pytest.mark.parametrize("merge", ["row", "cells"])
def test_upsert_equals_a_dictionary(spark, tmpdir_run, merge):
    tables = Tables(spark, os.path.join(tmpdir_run, "t"), buckets=5)
    seen = []
    for n, batch in enumerate(batches(3)):
        seen.append(batch)
        v = keyed.upsert(tables, "people", frame(spark, batch), ["k"], F.col("seq"), stream="s", batch_id=n, deleted=F.col("gone"), merge=merge)
        assert v == n
        assert sorted(rows(keyed.snapshot(tables, "people"), "k", "a", "b"), key=str) == plain_upsert(seen, merge)
    # earlier versions stay readable; a batch that comes again changes nothing
    assert sorted(rows(keyed.snapshot(tables, "people", version=1), "k", "a", "b"), key=str) == plain_upsert(seen[:2], merge)
    assert keyed.upsert(tables, "people", frame(spark, seen[0]), ["k"], F.col("seq"), stream="s", batch_id=0) == 3
    assert tables.version() == 3


def rows(df, *cols):       # noqa: F811  (keys may be null)
    return [tuple(r[c] for c in cols) for r in df.collect()]


def test_only_touched_buckets_are_rewritten(spark, tmpdir_run):
    tables = Tables(spark, os.path.join(tmpdir_run, "t"), buckets=16)
    keyed.upsert(tables, "t", frame(spark, [(f"k{i}", 1, "a", i, False) for i in range(200)]), ["k"], F.col("seq"))
    before = tables.state()["tables"]["t"]
    keyed.upsert(tables, "t", frame(spark, [("k7", 2, "new", 0, False), ("k7", 3, "newer", 1, False)]), ["k"], F.col("seq"))
    after = tables.state()["tables"]["t"]
    assert len(before) == 16 and sum(before[b] != after[b] for b in before) == 1
    assert len(keyed.snapshot(tables, "t").where("k = 'k7' and a = 'newer'").collect()) == 1
    assert keyed.snapshot(tables, "t").count() == 200


def test_columns_grow_and_empty_batches(spark, tmpdir_run):
    tables = Tables(spark, os.path.join(tmpdir_run, "t"), buckets=4)
    keyed.upsert(tables, "t", frame(spark, []), ["k"], F.col("seq"))
    keyed.upsert(tables, "t", frame(spark, [("x", 1, "a", 1, False)]), ["k"], F.col("seq"))
    more = spark.createDataFrame([("y", 2, 2.5)], "k string, seq int, c double")
    keyed.upsert(tables, "t", more, ["k"], F.col("seq"))
    assert sorted(rows(keyed.snapshot(tables, "t"), "k", "a", "b", "c")) == [("x", "a", 1, None), ("y", None, None, 2.5)]
    assert rows(keyed.snapshot(tables, "t", version=1), "k", "a", "b") == [("x", "a", 1)]


def test_a_failed_attempt_is_not_seen(spark, tmpdir_run, monkeypatch):
    tables = Tables(spark, os.path.join(tmpdir_run, "t"), buckets=4)
    keyed.upsert(tables, "t", frame(spark, [("x", 1, "a", 1, False)]), ["k"], F.col("seq"), batch_id=0)
    monkeypatch.setattr(Tables, "commit", lambda *a, **k: (_ for _ in ()).throw(IOError("lost")))
    with pytest.raises(IOError):
        keyed.upsert(tables, "t", frame(spark, [("x", 2, "b", 2, False)]), ["k"], F.col("seq"), batch_id=1)
    monkeypatch.undo()
    assert rows(keyed.snapshot(tables, "t"), "a") == [("a",)]
    keyed.upsert(tables, "t", frame(spark, [("x", 2, "b", 2, False)]), ["k"], F.col("seq"), batch_id=1)
    assert rows(keyed.snapshot(tables, "t"), "a") == [("b",)]


def test_a_second_writer_fails(spark, tmpdir_run):
    tables = Tables(spark, os.path.join(tmpdir_run, "t"), buckets=4)
    base = tables.state()
    tables.commit(base, {})
    with pytest.raises(RuntimeError):
        tables.commit(base, {})


def test_stream_upsert_across_restarts(spark, tmpdir_run):
    src, ck = os.path.join(tmpdir_run, "src"), os.path.join(tmpdir_run, "ck")
    tables = Tables(spark, os.path.join(tmpdir_run, "t"), buckets=4)
    parts = batches(8, 3)
    for n, part in enumerate(parts):
        frame(spark, part).coalesce(1).write.mode("append").parquet(src)
        stream = spark.readStream.schema(spark.createDataFrame([], SCHEMA).schema).option("maxFilesPerTrigger", 1).parquet(src)
        q = keyed.stream_keyed_upsert(stream, tables, "t", ["k"], F.col("seq"), ck, deleted=F.col("gone"))
        q.awaitTermination()
        assert sorted(rows(keyed.snapshot(tables, "t"), "k", "a", "b"), key=str) == plain_upsert(parts[:n + 1])
    assert tables.seen("t", 2) and not tables.seen("t", 3)


EV = "id string, ts timestamp, v int"


def events(spark, data):
    import datetime
    return spark.createDataFrame([(i, datetime.datetime(2024, 1, 1) + datetime.timedelta(hours=h), v) for i, h, v in data], EV)


def handle(df):
    return df.select("id", (F.col("v") * 10).alias("v10"))


def test_keys_are_processed_once(spark, tmpdir_run):
    tables = Tables(spark, os.path.join(tmpdir_run, "t"), buckets=4)
    run = lambda data, n: keyed.process_once(tables, events(spark, data), ["id"], "ts", handle, "out", batch_id=n)
    run([("a", 1, 1), ("a", 0, 2), ("b", 1, 3), (None, 1, 4)], 0)
    run([("a", 900, 9), ("c", 901, 5), (None, 1, 4)], 1)
    run([("c", 902, 7)], 1)               # the same batch again
    assert sorted(rows(tables.read("out"), "id", "v10"), key=str) == sorted([("a", 20), ("b", 30), ("c", 50), (None, 40), (None, 40)], key=str)
    assert sorted(rows(tables.read(keyed.LOG), "id", "status", "batch_id")) == [("a", "done", 0), ("b", "done", 0), ("c", "done", 1)]


def test_failed_handling_logs_nothing_and_outcomes_are_kept(spark, tmpdir_run):
    tables = Tables(spark, os.path.join(tmpdir_run, "t"), buckets=4)

    @F.udf("int")
    def broken(v):
        raise ValueError("bad row")
    with pytest.raises(Exception):
        keyed.process_once(tables, events(spark, [("a", 1, 1)]), ["id"], "ts", lambda d: d.select("id", broken("v").alias("v10")), "out", batch_id=0)
    assert tables.version() == -1
    notes = lambda d: d.select("id", F.when(F.col("v") > 1, "error").otherwise("done").alias("status"), F.lit("n").alias("notes"))
    keyed.process_once(tables, events(spark, [("a", 1, 1), ("b", 1, 2)]), ["id"], "ts", handle, "out", batch_id=0, outcome=notes)
    assert sorted(rows(tables.read(keyed.LOG), "id", "status", "notes")) == [("a", "done", "n"), ("b", "error", "n")]


def test_log_folders_are_merged(spark, tmpdir_run, monkeypatch):
    monkeypatch.setattr("tessera.streaming.tables.COMPACT_AT", 2)
    tables = Tables(spark, os.path.join(tmpdir_run, "t"), buckets=1)
    for n in range(5):
        keyed.process_once(tables, events(spark, [("same", n, n), (f"k{n}", n, n)]), ["id"], "ts", handle, "out", batch_id=n)
    assert max(len(p) for p in tables.state()["tables"]["out"].values()) <= 2
    assert sorted(rows(tables.read("out"), "id", "v10")) == sorted([("same", 0), *((f"k{n}", 10 * n) for n in range(5))])


def test_stream_once_beyond_the_watermark(spark, tmpdir_run):
    src, ck = os.path.join(tmpdir_run, "src"), os.path.join(tmpdir_run, "ck")
    tables = Tables(spark, os.path.join(tmpdir_run, "t"), buckets=4)
    for data in ([("a", 1, 1), ("a", 1, 1), ("b", 2, 2)], [("z", 5000, 3)], [("y", 5001, 4), ("a", 5002, 5), ("b", 5002, 6)]):
        events(spark, data).coalesce(1).write.mode("append").parquet(src)
        stream = spark.readStream.schema(spark.createDataFrame([], EV).schema).option("maxFilesPerTrigger", 1).parquet(src)
        keyed.stream_once(stream, tables, ["id"], "ts", handle, "out", ck, delay="2 hours").awaitTermination()
    assert sorted(rows(tables.read("out"), "id", "v10")) == [("a", 10), ("b", 20), ("y", 40), ("z", 30)]
    assert tables.read(keyed.LOG).count() == 4
