"""The corpus pipeline: five stages, each one operator of ``tessera.llm``.

Every stage takes ``(spark, docs, sf_dir)`` and works on all rows that the
stage before kept; all but the last return the columns of ``docs``.  Between
stages the rows are written as Parquet and read again.

Defined results: null columns are values like any other; a null text counts as
empty; an empty table passes through all stages; columns beyond those of
``documents`` are kept by all stages but the last.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.llm import bytebpe, mixing, quality, queries, simhash, suffixdedup
from tessera.llm.common import stored
from tessera.session import read_table, ship_package


# A passage of 50 words of running text: the least length, in bytes, of a
# string that the suffix-array stage removes where it repeats; its anchors are
# hashes of GRAM_BYTES.
PASSAGE_BYTES = 240
GRAM_BYTES = 96


def _keyed(docs: DataFrame) -> DataFrame:
    """``docs`` with the key by which verdicts name rows."""
    return docs.withColumns({"_t_id": F.col("doc_id").cast("long"), "_t_hash": F.xxhash64("text")})


def _named(left: DataFrame, right: DataFrame) -> Column:
    return left["_t_id"].eqNullSafe(right["_v_id"]) & (left["_t_hash"] == right["_v_hash"])


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the quality rules keep.  Rows of one id and text in several
    languages or sources go together if one of them is rejected."""
    ship_package(spark)
    bad = (quality.judge(docs).where("not kept")
           .select(F.col("doc_id").alias("_v_id"), F.col("text_hash").alias("_v_hash")).distinct())
    src = _keyed(docs)
    return src.join(bad, _named(src, bad), "left_anti").select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each component: that of the smallest id, then of the
    smallest text hash; of rows that agree in both, the one whose other columns
    come first."""
    ship_package(spark)
    rows = simhash.groups(docs)
    first = rows.groupBy("group").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")).alias("w"))
    keep = stored(first.select(F.col("w.doc_id").alias("_v_id"), F.col("w.text_hash").alias("_v_hash")), "kept")
    src = _keyed(docs)
    # repeated rows of one id and text: the same one under any partitioning;
    # all other rows need no grouping, so their texts move once
    twice = stored(src.groupBy("_t_id", "_t_hash").count().where("count > 1").select(F.col("_t_id").alias("_v_id"), F.col("_t_hash").alias("_v_hash")), "repeated")
    alone = src.join(twice, _named(src, twice), "left_anti")
    alone = alone.join(keep, _named(alone, keep), "left_semi").select(*docs.columns)
    many = src.join(twice, _named(src, twice), "left_semi")
    order = F.to_json(F.struct(*[c for c in docs.columns if c != "text"]))
    one = many.join(keep, _named(many, keep), "left_semi").groupBy("_t_id", "_t_hash").agg(F.min_by(F.struct(*docs.columns), order).alias("_t_row"))
    return alone.unionByName(one.select("_t_row.*"))


def repeated_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the bytes of repeated strings of ``PASSAGE_BYTES`` or more;
    bytes of a character that was cut apart go too.  ``n_chars`` follows the
    text."""
    ship_package(spark)
    src = _keyed(docs)
    cuts = suffixdedup.repeats(suffixdedup.with_hash(docs), PASSAGE_BYTES, GRAM_BYTES)
    cuts = cuts.select(F.col("doc_id").alias("_v_id"), F.col("text_hash").alias("_v_hash"), F.col("cuts").alias("_cuts"))
    joined = src.join(cuts, _named(src, cuts), "left")

    @F.pandas_udf("string")
    def left(text, cut):
        return text.combine(cut, lambda t, c: t if c is None else
                            suffixdedup.remove(t.encode(), c)[0].decode("utf-8", "ignore"))

    text = F.when(F.col("_cuts").isNull(), F.col("text")).otherwise(left("text", "_cuts"))
    out = joined.withColumn("text", text)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("_cuts").isNull(), F.col("n_chars")).otherwise(
            F.length("text").cast(docs.schema["n_chars"].dataType)))
    return out.select(*docs.columns)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows as often as the mix takes them: whole epochs and the sample."""
    ship_package(spark)
    weights = mixing.quality_weights(read_table(spark, sf_dir, "labels"))
    # rows that agree in id, text and source are interchangeable: the n-th row
    # takes the n-th of their verdicts
    taken = mixing.mix(docs, weights).select(
        F.col("doc_id").cast("long").alias("_v_id"), F.col("text_hash").alias("_v_hash"), F.col("source").alias("_v_source"),
        F.when(F.col("size") > 0, F.col("taken") / F.col("size")).otherwise(0).cast("int").alias("_v_times"))
    taken = taken.withColumn("_v_nth", F.row_number().over(Window.partitionBy("_v_id", "_v_hash", "_v_source").orderBy("_v_times")))
    src = _keyed(docs)
    src = src.withColumn("_t_nth", F.row_number().over(Window.partitionBy("_t_id", "_t_hash", "source").orderBy("_t_hash")))
    rows = src.join(taken.where("_v_times > 0"), _named(src, taken) & src["source"].eqNullSafe(taken["_v_source"]) & (F.col("_t_nth") == F.col("_v_nth")))
    return rows.withColumn("_t_copy", F.explode(F.sequence(F.lit(1), F.col("_v_times")))).select(*docs.columns)


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every row: number, digest, and digest of their decoding."""
    ship_package(spark)
    return bytebpe.digests(docs, queries.vocabulary("byte_bpe_multi_50k.tiktoken"))


STAGES = [
    ("quality_rules", quality_rules),
    ("simhash_near_dedup", near_duplicates),
    ("suffix_array_dedup", repeated_strings),
    ("mixing", source_mix),
    ("byte_bpe", byte_bpe),
]

# iterative estimates, components and suffix arrays are beyond SQL
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
