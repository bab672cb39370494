"""Token-ID output: the ids of all texts in one sequence of compressed files.

Texts are sorted by ascending id over range partitions; every partition writes its texts'
ids as segments.  A segment holds whole documents (about ``SEGMENT`` ids, at least one document): its
coded blocks (``idcoder``), and an index with the id and the number of ids of each
document.  Segments are rows of a Parquet table in the shared folder, so a
lost task is written again and a half-written file is never seen.  Reading
decodes each segment alone, checks every block, and adds up the segments'
sizes to the position of each document.

Defined results: null and empty texts hold the end id only; rows with the same
id are in order of their texts, null ids first; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.llm import idcoder
from tessera.llm.common import as_column, bounded_batches, chunk_count, scratch, texts
from tessera.llm.wordbpe import tokenizer

END_ID = 2
SEGMENT = 1 << 21
PART_BYTES = 24 << 20
_SEGMENT = "part long, seq long, n_ids long, doc_ids array<bigint>, sizes array<bigint>, blocks array<binary>"


def write(docs: DataFrame, path: str, vocabulary: str, end_id: int = END_ID, segment: int = SEGMENT) -> None:
    """Write the ids of ``doc_id, text``, each text's followed by ``end_id``."""
    bounded_batches(docs.sparkSession)

    def run(batches):
        part, seq = TaskContext.get().partitionId(), 0
        bpe = tokenizer(vocabulary)
        ids, sizes, flat, held = [], [], [], 0

        def flush():
            nonlocal ids, sizes, flat, held, seq
            blocks = idcoder.encode(np.concatenate(flat))
            row = pa.RecordBatch.from_pydict({"part": [part], "seq": [seq], "n_ids": [held], "doc_ids": [ids], "sizes": [sizes], "blocks": [blocks]},
                                             schema=pa.schema([("part", pa.int64()), ("seq", pa.int64()), ("n_ids", pa.int64()), ("doc_ids", pa.list_(pa.int64())),
                                                               ("sizes", pa.list_(pa.int64())), ("blocks", pa.list_(pa.binary()))]))
            ids, sizes, flat, held, seq = [], [], [], 0, seq + 1
            return row

        for b in batches:
            got, n = bpe.encode(as_column(b, "text").to_pylist())
            out = np.full(got.size + n.size, end_id, np.int64)
            ends = np.cumsum(n + 1) - 1
            keep = np.ones(out.size, bool)
            keep[ends] = False
            out[keep] = got
            first = np.concatenate([[0], ends + 1])
            for k, i in enumerate(as_column(b, "doc_id").to_pylist()):
                size = int(n[k]) + 1
                if ids and held + size > segment:
                    yield flush()
                ids.append(i)
                sizes.append(size)
                flat.append(out[first[k]:first[k + 1]])
                held += size
        if ids:
            yield flush()

    parts = chunk_count(docs, PART_BYTES)
    rows = texts(docs).repartitionByRange(parts, "doc_id").sortWithinPartitions("doc_id", "text")
    rows.mapInArrow(run, _SEGMENT).write.option("compression", "uncompressed").parquet(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, ids`` (binary, little-endian unsigned 32-bit integers)
    of every document, from the files."""
    rows = spark.read.schema(_SEGMENT).parquet(path)
    # one row per part, then running sums inside the parts
    totals = rows.groupBy("part").agg(F.sum("n_ids").alias("total"))
    before = Window.partitionBy(F.lit(0)).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    heads = totals.select("part", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("head"))
    inside = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    starts = (rows.select("part", "seq", "n_ids").join(heads, "part")
                  .select("part", "seq", (F.col("head") + F.coalesce(F.sum("n_ids").over(inside), F.lit(0))).cast("long").alias("first")))
    located = rows.join(starts, ["part", "seq"])

    def run(batches):
        for b in batches:
            for first, ids, sizes, blocks in zip(*(as_column(b, c).to_pylist() for c in ("first", "doc_ids", "sizes", "blocks"))):
                flat = idcoder.decode(blocks).astype("<u4")
                ends = np.cumsum(sizes)
                if flat.size != ends[-1]:
                    raise ValueError("segment does not match its index")
                for a in range(0, len(ids), 256):
                    z = min(a + 256, len(ids))
                    lo = int(ends[a] - sizes[a])
                    off = (np.concatenate([[lo], ends[a:z]]) - lo) * 4
                    out = pa.LargeBinaryArray.from_buffers(pa.large_binary(), z - a, [None, pa.py_buffer(off.astype(np.int64)), pa.py_buffer(flat[lo:ends[z - 1]].tobytes())])
                    yield pa.RecordBatch.from_arrays([pa.array(ids[a:z], pa.int64()), pa.array(first + ends[a:z] - np.array(sizes[a:z])), out.cast(pa.binary())],
                                                     names=["doc_id", "start", "ids"])

    return located.select("first", "doc_ids", "sizes", "blocks").mapInArrow(run, "doc_id long, start long, ids binary")


def round_trip(docs: DataFrame, vocabulary: str) -> DataFrame:
    """Write all texts, read the files back: ``doc_id, start, n_tokens,
    ids_crc32`` of every document."""
    spark = docs.sparkSession
    path = scratch(spark, "token-ids")
    write(docs, path, vocabulary)
    return read(spark, path).select("doc_id", "start", (F.length("ids") / 4).cast("long").alias("n_tokens"),
                                    F.crc32("ids").alias("ids_crc32"))
