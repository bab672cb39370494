"""Sinks (A13-A17).

Every write goes to a path the caller names; an upsert result is written to
a new path (never over the table being read).  Task commit makes a failed or
retried task invisible, which replaces the reference's progress files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def ensure_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    """The fixed output columns in order; absent ones (``error`` when
    nothing failed) are added as null strings, so the schema never depends on
    the data (decision D13)."""
    return df.select(*[F.col(c) if c in df.columns else F.lit(None).cast("string").alias(c) for c in columns])


def write_csv(df: DataFrame, path: str, columns: list[str], mode: str = "overwrite") -> None:
    """CSV with a header and the fixed columns; the rows are written
    (decision D12)."""
    ensure_columns(df, columns).write.mode(mode).option("header", "true").csv(path)


def write_json_lines(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """JSON lines (one object per row)."""
    df.write.mode(mode).json(path)


def append_parquet(df: DataFrame, path: str) -> None:
    """Append rows; each task's files appear only on commit."""
    df.write.mode("append").parquet(path)


def cut_lineage(df: DataFrame) -> DataFrame:
    """The rows written as a table in the shared checkpoint folder (never a
    machine-local one on a cluster) and read back; used between long stages so
    that plans stay small and a lost executor does not force recomputation
    from the sources."""
    import uuid

    from tessera.session import checkpoint_dir
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark, allow_local_default=True).rstrip('/')}/tessera-tables/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
