"""Helpers shared by the operators: session limits, row keys, shared folder,
bounded row order, and byte-level views of Arrow text columns."""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.session import checkpoint_dir

# words are maximal runs of anything but these six bytes (fixed by the contracts)
WORD = r"[^\x20\x09-\x0D]+"
BATCH_ROWS = 250


def bounded_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Bound the rows of one Arrow batch, so that a batch of texts stays a
    few MB in a Python worker."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared checkpoint folder of the session."""
    return f"{checkpoint_dir(spark, allow_local_default=True).rstrip('/')}/tessera-llm/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back: cuts the
    lineage, survives lost executors, and fixes the rows for later readers."""
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def texts(docs: DataFrame) -> DataFrame:
    """``doc_id, text`` with a null text read as the empty text."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(F.col("text"), F.lit("")).alias("text"))


def n_parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def chunk_count(docs: DataFrame, chunk_bytes: int) -> int:
    """How many chunks of about ``chunk_bytes`` the texts fill (one number)."""
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return max(1, -(-int(total) // chunk_bytes))


def words(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def release_memory() -> None:
    """Hand freed memory of a Python worker back to the system: workers are
    kept for later stages."""
    import ctypes
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):    # not this C library
        pass


# ------------------------------------------------------------- Arrow <-> numpy

def as_column(batch, name: str):
    col = batch.column(name) if isinstance(batch, pa.Table) else batch.column(batch.schema.get_field_index(name))
    return col.combine_chunks() if isinstance(col, pa.ChunkedArray) else col


def byte_view(arr) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary array; null counts as empty.
    ``offsets`` has one entry more than rows and starts at 0."""
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
        if isinstance(arr, pa.ChunkedArray):
            arr = pa.concat_arrays(arr.chunks) if arr.num_chunks else pa.array([], pa.string())
    arr = arr.cast(pa.large_binary())
    if arr.null_count:
        arr = arr.fill_null(b"")
    if not len(arr):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    off = np.frombuffer(arr.buffers()[1], np.int64, count=len(arr) + 1 + arr.offset)[arr.offset:]
    data = arr.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[off[0]:off[-1]], off - off[0]


_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def word_spans(raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of every word; words never cross a document's end."""
    if not raw.size:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    space = _SPACE[raw]
    edge = np.zeros(raw.size + 1, bool)
    edge[off] = True
    inside = ~space
    start = inside.copy()
    start[1:] &= space[:-1] | edge[1:-1]
    end = inside.copy()
    end[:-1] &= space[1:] | edge[1:-1]
    return np.flatnonzero(start), np.flatnonzero(end) + 1


def owner(starts: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Index of the document that holds each start."""
    return np.searchsorted(off, starts, side="right") - 1


def encode_spans(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray):
    """Dictionary-encode byte spans (ordered, disjoint): codes and the array
    of distinct spans.  Gaps between spans are encoded too and dropped."""
    if not starts.size:
        return np.zeros(0, np.int64), pa.array([], pa.large_binary())
    cuts = np.empty(2 * starts.size + 1, np.int64)
    cuts[0:-1:2] = starts
    cuts[1::2] = ends
    cuts[-1] = ends[-1]
    arr = pa.LargeBinaryArray.from_buffers(pa.large_binary(), cuts.size - 1,
                                           [None, pa.py_buffer(cuts), pa.py_buffer(np.ascontiguousarray(raw))])
    enc = arr.take(pa.array(np.arange(0, cuts.size - 1, 2))).dictionary_encode()
    return enc.indices.to_numpy(zero_copy_only=False).astype(np.int64), enc.dictionary


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (multiply-xorshift); input and output uint64."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


# ------------------------------------------------------------- bounded order

_LEVELS = (10, 18, 18, 18)


def following(ids: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``id -> next_id`` in ascending order over distinct non-null ids; the
    last wraps to the first.  Ids are grouped by their high bits level by
    level, so that no window holds more than 2^18 rows however many ids
    there are: a group's last id takes the first id of the next group."""
    from pyspark.sql import Window
    cur = ids.select(F.col(id_col).alias("id")).where("id is not null").distinct()
    base = stored(cur, "ids")
    levels = []
    rows = base.select(F.col("id").alias("node"), F.col("id").alias("first"))
    for k, bits in enumerate(_LEVELS):
        # the last level is one window: at most 2^18 nodes are left by then
        g = F.shiftright("node", bits) if k < len(_LEVELS) - 1 else F.lit(0).cast("long")
        w = Window.partitionBy("grp").orderBy("node")
        rows = rows.withColumn("grp", g).withColumn("succ", F.lead("first").over(w))
        levels.append(rows)
        rows = rows.groupBy("grp").agg(F.min("first").alias("first")).withColumnRenamed("grp", "node")
    first = base.agg(F.min("id")).first()[0]
    succ = None
    for lv in reversed(levels):
        if succ is not None:
            up = succ.select(F.col("node").alias("grp"), F.col("succ").alias("up"))
            lv = lv.join(up, "grp", "left").withColumn("succ", F.coalesce("succ", "up"))
        succ = lv.select("node", "succ")
    return succ.select(F.col("node").alias(id_col), F.coalesce("succ", F.lit(first)).cast("long").alias("next_id"))
