"""Mixing sources to target weights (native DataFrame code only).

Efraimidis-Spirakis weighted sampling: every document draws an exponential
key ``-ln(u) / quality`` from a uniform ``u`` that is a hash of its id, so a
rerun draws the same keys.  Within a source, documents in ascending key order
are a weighted sample without replacement.  A source whose target is ``e``
whole epochs and a rest takes every document ``e`` times, then the documents
in key order up to the rest (prefix sums of sizes); the document that crosses
the rest is taken if that ends nearer to it.

A source may hold a third of all rows: keys are cut into ``buckets`` ranges of
equal expected weight, sizes are pre-aggregated per (source, bucket), running sums
are taken over buckets, and only then inside a bucket.

Defined results: null text or text without words has size 0 and is never
taken; null source is a source of its own, last in order; rows with the same
id and text are separate rows in a fixed order (equal rows are
interchangeable); an empty table gives an empty result; other columns are
ignored.  Quality weights must be positive; null counts as 1.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import WORD

CYCLE = (5, 2, 1)      # weights of the sources in code point order
MAX_EPOCHS = 3         # a target is at most this many times its source's size
BUCKETS = 1024


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame) -> DataFrame:
    """``source, source_size`` -> plus ``target`` (one row per source).

    Water-filling in closed form: with caps ``3 * size`` the final targets are
    ``min(cap, level * weight)``.  Sources sorted by ``size / weight`` reach
    their cap in that order, so the level is the first one at which the
    remaining words shared by the remaining weights stay below the next cap.
    The table has one row per source; its windows hold that table only.
    """
    code = F.hex(F.encode("source", "UTF-8"))  # code point order is UTF-8 byte order
    by_name = Window.partitionBy(F.lit(0)).orderBy(F.col("source").isNull(), code)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in CYCLE]),
                          (F.pmod(F.row_number().over(by_name) - 1, F.lit(len(CYCLE))) + 1).cast("int"))
    s = sizes.withColumn("weight", weight)
    everything = Window.partitionBy(F.lit(0))
    fill = everything.orderBy(F.col("source_size") / F.col("weight"), F.col("source").isNull(), code)
    before = fill.rowsBetween(Window.unboundedPreceding, -1)
    s = (s.withColumn("total", F.sum("source_size").over(everything))
          .withColumn("left", F.col("total") - MAX_EPOCHS * F.coalesce(F.sum("source_size").over(before), F.lit(0)))
          .withColumn("weight_left", F.sum("weight").over(fill.rowsBetween(0, Window.unboundedFollowing)))
          .withColumn("level", F.col("left") / F.col("weight_left"))
          .withColumn("capped", F.col("level") * F.col("weight") > MAX_EPOCHS * F.col("source_size")))
    # the level of the first source in fill order that keeps below its cap; later ones are not above it
    s = s.withColumn("final", F.max(F.when(~F.col("capped"), F.col("level"))).over(everything))
    cap = (MAX_EPOCHS * F.col("source_size")).cast("double")
    return s.select("source", "source_size",
                    F.when(F.col("capped"), cap).otherwise(F.least(cap, F.col("final") * F.col("weight"))).alias("target"))


def uniform(doc_id: Column) -> Column:
    """A number in (0, 1) from the id: 52 bits of its MD5."""
    return (F.conv(F.substring(F.md5(F.coalesce(doc_id.cast("string"), F.lit("null")).cast("binary")), 1, 13), 16, 10).cast("double") + 0.5) / F.lit(float(2 ** 52))


def mix(docs: DataFrame, weights: DataFrame | None = None, buckets: int = BUCKETS) -> DataFrame:
    """``doc_id, text, source`` -> ``doc_id, size, source_size, target,
    taken`` (words the mix takes of the document, repeats counted),
    ``source`` and ``text_hash``.  ``weights`` holds the document weights (``doc_id,
    weight``, one row per id; ids without a row weigh 1)."""
    # texts end here: only sizes and keys are joined and shuffled
    rows = docs.select(F.col("doc_id"), F.col("source"), word_count(F.col("text")).alias("size"),
                       F.xxhash64("text").alias("text_hash"), (-F.log(uniform(F.col("doc_id")))).alias("draw"))
    if weights is not None:
        w = weights.select(F.col("doc_id").alias("w_id"), F.col("weight").cast("double").alias("weight"))
        rows = rows.join(w, F.col("doc_id") == F.col("w_id"), "left").drop("w_id")
        rows = rows.withColumn("draw", F.col("draw") / F.coalesce("weight", F.lit(1.0))).drop("weight")
    rows = rows.withColumn("bucket", F.floor((1 - F.exp(-F.col("draw"))) * buckets).cast("int"))
    parts = rows.groupBy("source", "bucket").agg(F.sum("size").alias("bucket_size"))
    targets = source_targets(parts.groupBy("source").agg(F.sum("bucket_size").cast("long").alias("source_size")))
    run = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    heads = (parts.withColumn("before", F.coalesce(F.sum("bucket_size").over(run), F.lit(0)))
                  .select(F.col("source").alias("s2"), F.col("bucket").alias("b2"), "before"))
    inside = (Window.partitionBy("source", "bucket").orderBy("draw", "doc_id", "text_hash")
                    .rowsBetween(Window.unboundedPreceding, -1))
    rows = rows.withColumn("inner", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    rows = (rows.join(heads, F.col("source").eqNullSafe(F.col("s2")) & (F.col("bucket") == F.col("b2")))
                .join(targets.withColumnRenamed("source", "s3"), F.col("source").eqNullSafe(F.col("s3"))))
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    rest = F.col("target") - epochs * F.col("source_size")
    start = F.col("before") + F.col("inner")
    extra = F.when((start + F.col("size") / 2) <= rest, F.lit(1)).otherwise(F.lit(0))
    extra = F.when(epochs >= MAX_EPOCHS, F.lit(0)).otherwise(extra)
    return rows.select("doc_id", "size", "source_size", "target",
                       (F.col("size") * (epochs + extra)).cast("long").alias("taken"), "source", "text_hash")


def quality_weights(labels: DataFrame) -> DataFrame:
    """``doc_id, weight`` from ``labels`` (doc_id, quality): 2 for good, 0.5
    for bad; several labels: the best."""
    best = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.max("quality").alias("best"))
    return best.select("doc_id", F.when(F.col("best") > 0, 2.0).otherwise(0.5).alias("weight"))
