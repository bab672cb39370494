"""Scans of master tables, change logs, CSV and JSON files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.events import division_from_filename, gender_from_name
from tessera.functions.text import strip
from tessera.sources.csv_scan import csv_records


def scan_master(master: DataFrame, gender: str, attr: str = "division") -> DataFrame:
    """A1/A2: ``(row_id, name, <attr>)`` of the master table for one gender:
    trimmed names, blank names dropped; ``attr`` is ``division`` (the
    ``<gender>_ncaa_division`` column) or ``conference``."""
    col = f"{gender}_ncaa_division" if attr == "division" else f"{gender}_conference"
    return (master.select("row_id", strip(F.coalesce(F.col("university_name"), F.lit(""))).alias("name"),
                          strip(F.coalesce(F.col(col), F.lit(""))).alias(attr))
            .filter(F.col("name") != ""))


CHANGE_SCHEMA = T.StructType([
    T.StructField("file_name", T.StringType()), T.StructField("pos", T.IntegerType()),
    T.StructField("conference", T.StringType()), T.StructField("school", T.StringType()),
    T.StructField("position", T.StringType()), T.StructField("first_name", T.StringType()),
    T.StructField("last_name", T.StringType()), T.StructField("change", T.StringType()),
    T.StructField("email_address", T.StringType()),
])
# Change-log header names (case-insensitive) -> our columns.
CHANGE_HEADERS = {"conference": "conference", "school": "school", "position": "position",
                  "first name": "first_name", "last name": "last_name", "change": "change",
                  "email address": "email_address", "email": "email_address"}
PREAMBLE_ROWS = 5   # Fixed value: rows before the header in files that do not start with it.


def read_change_logs(spark: SparkSession, paths: str) -> DataFrame:
    """A3 + A4: every change-log CSV under ``paths`` (a glob), cut into records
    in parallel (``csv_scan.csv_records``; a quoted line break stays inside its
    cell).  A file that does not start with the header loses its first 5
    records; the header is padded to 6 and the 6th column is ``Change``.
    Gender (women before men) and division come from the file name; files
    with neither gender are dropped.  Source files are never rewritten."""
    rec = csv_records(spark, paths)
    # a file's header is one of its first records: one small row per file
    top = rec.filter(F.col("pos") <= PREAMBLE_ROWS).groupBy("file_name").agg(
        F.max(F.when(F.col("pos") == 0, F.col("cells"))).alias("c0"),
        F.max(F.when(F.col("pos") == PREAMBLE_ROWS, F.col("cells"))).alias("c5"))
    plain = F.coalesce(F.try_element_at("c0", F.lit(1)) == "Conference", F.lit(False))
    top = top.select(F.col("file_name").alias("h_file"), F.when(plain, 0).otherwise(PREAMBLE_ROWS).alias("h_pos"),
                     F.when(plain, F.col("c0")).otherwise(F.col("c5")).alias("header")).filter(F.col("header").isNotNull())
    names = F.create_map(*[F.lit(x) for kv in CHANGE_HEADERS.items() for x in kv])
    padded = F.concat("header", F.array_repeat(F.lit(""), F.greatest(F.lit(0), 6 - F.size("header"))))
    padded = F.transform(padded, lambda h, i: F.when(i == 5, F.lit("Change")).otherwise(h))
    top = top.withColumn("at", F.transform(padded, lambda h: F.coalesce(F.try_element_at(names, F.lower(strip(h))), F.lit(""))))
    rows = rec.join(top, F.col("file_name") == F.col("h_file")).filter(F.col("pos") > F.col("h_pos"))
    fields = [f.name for f in CHANGE_SCHEMA.fields if f.name not in ("file_name", "pos")]
    place = lambda c: F.array_position("at", c).cast("int")
    rows = rows.select("file_name", (F.col("pos") - F.col("h_pos") - 1).cast("int").alias("pos"), *[
        F.when(place(c) > 0, F.nullif(F.try_element_at("cells", F.greatest(place(c), F.lit(1))), F.lit(""))).alias(c) for c in fields])
    return (rows.withColumn("gender", gender_from_name(F.regexp_extract("file_name", r"([^/]*)$", 1)))
            .withColumn("division", division_from_filename(F.col("file_name")))
            .filter(F.col("gender").isNotNull()))


def require_columns(df: DataFrame, required: list[str]) -> DataFrame:
    """Fail early when a required column is missing."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"missing required columns: {missing}")
    return df


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None,
             required: list[str] | None = None) -> DataFrame:
    """CSV with a header row and a declared schema (no inference)."""
    r = spark.read.option("header", "true")
    df = r.schema(schema).csv(path) if schema is not None else r.csv(path)
    return require_columns(df, required or [])


def read_json_array(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """A JSON file holding one array of objects."""
    return spark.read.option("multiLine", "true").schema(schema).json(path)


def row_range(df: DataFrame, start: int, end: int, row_id: str = "row_id") -> DataFrame:
    """Rows ``start..end`` by sheet row number."""
    return df.filter(F.col(row_id).between(start, end))
