"""A3: CSV records from files of any size, cut in parallel.

A quoted cell may hold line breaks, so whether a line starts a record depends
on every quote before it in its file.  A line maps the state before it (inside
quotes or not) to the state after it; a block of a file (what one scan task
reads) maps its first state to its last.

1. Every block is read once for its two answers: the state after it and the
   records begun in it, for either state before it.
2. A running composition over a file's blocks (a prefix sum of swaps since the
   last block whose answer does not depend on its start) gives the state and
   the record number at the start of each block.
3. Lines that are whole records are parsed where they are.  Only the lines of
   records that run over line ends are shuffled, by file and record number.

Cells follow the rules of the standard library's ``csv``: a quote opens a
quoted cell only at its start, two quotes inside stand for one.  A record
longer than ``max_record`` (a quote that is never closed) is not gathered: its
lines come back one by one with an ``error``, as do lines the parser refuses.
"""

from __future__ import annotations

import csv
import io

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

MAX_RECORD = 64 << 20       # characters of one record


def ends_inside(line: str, inside: bool, sep: str = ",") -> bool:
    """Whether the line ends inside quotes, from the state before it."""
    at = 0
    while True:
        if inside or line.startswith('"', at):
            at += not inside
            while True:
                at = line.find('"', at)
                if at < 0:
                    return True
                if not line.startswith('"', at + 1):
                    break
                at += 2
            at += 1
            inside = False
        # outside quotes up to the next cell
        at = line.find(sep, at)
        if at < 0:
            return False
        at += len(sep)


class _Block:
    """States and record numbers of the lines read so far, for both first states."""

    def __init__(self):
        self.state, self.begun, self.rows = [0, 1], [0, 0], 0

    def lines(self, values: pa.Array, sep: str):
        """Per line and first state: state before, state after, records begun."""
        n = len(values)
        quoted = np.flatnonzero(np.asarray(pc.fill_null(pc.match_substring(values, '"'), False)))
        answer = [[int(ends_inside(t, s, sep)) for t in values.take(pa.array(quoted)).to_pylist()] for s in (False, True)]
        out = []
        for h in (0, 1):
            before, cur, at = np.empty(n, np.int8), self.state[h], 0
            for k, i in enumerate(quoted.tolist()):
                before[at:i + 1] = cur
                cur, at = answer[cur][k], i + 1
            before[at:] = cur
            after = np.append(before[1:], cur).astype(np.int8)
            begun = self.begun[h] + np.cumsum(before == 0)
            self.state[h], self.begun[h] = cur, int(begun[-1]) if n else self.begun[h]
            out.append((before, after, begun))
        self.rows += n
        return out


def _segments(batch: pa.RecordBatch):
    """(first row, last row) of the runs of one file and block."""
    path, block = batch.column(0), batch.column(1).to_numpy()
    code = np.asarray(path.dictionary_encode().indices)
    cut = np.flatnonzero((code[1:] != code[:-1]) | (block[1:] != block[:-1])) + 1
    return zip([0, *cut.tolist()], [*cut.tolist(), batch.num_rows])


def _scan(batches, sep: str):
    """(file, block, rows, states) of every run of lines, states carried over
    the batches of a block; a block's lines arrive in order."""
    name, held = None, None
    for batch in batches:
        if not batch.num_rows:
            continue
        for a, b in _segments(batch):
            at = (batch.column(0)[a].as_py(), batch.column(1)[a].as_py())
            if at != name:
                name, held = at, _Block()
            part = batch.slice(a, b - a)
            yield name, held, part, held.lines(part.column(2), sep)


def _lines(spark: SparkSession, paths) -> DataFrame:
    return spark.read.option("lineSep", "\n").text(paths).select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"), "value")


def block_starts(spark: SparkSession, paths, sep: str = ",") -> DataFrame:
    """``path, block, inside, first``: state and record number at the start of
    every block; one row per block of a file."""
    def run(batches):
        done: dict = {}
        for name, held, _, _ in _scan(batches, sep):
            done[name] = held
        yield pa.RecordBatch.from_arrays(
            [pa.array([n[0] for n in done], pa.string()), pa.array([n[1] for n in done], pa.int64()),
             *[pa.array([x for b in done.values() for x in (get(b),)], pa.int64()) for get in (
                 lambda b: b.state[0], lambda b: b.state[1], lambda b: b.begun[0], lambda b: b.begun[1])]],
            names=["path", "block", "end0", "end1", "n0", "n1"])

    blocks = _lines(spark, paths).mapInArrow(run, "path string, block long, end0 long, end1 long, n0 long, n1 long")
    w = Window.partitionBy("path").orderBy("block")
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    swap = ((F.col("end0") == 1) & (F.col("end1") == 0)).cast("long")
    blocks = blocks.withColumn("swaps", F.sum(swap).over(w))
    fixed = F.when(F.col("end0") == F.col("end1"), F.struct(F.col("end0").alias("state"), F.col("swaps").alias("swaps")))
    blocks = blocks.withColumns({"last": F.last(fixed, ignorenulls=True).over(before), "done": F.coalesce(F.lag("swaps").over(w), F.lit(0))})
    inside = F.pmod(F.coalesce("last.state", F.lit(0)) + F.col("done") - F.coalesce("last.swaps", F.lit(0)), F.lit(2))
    blocks = blocks.withColumn("inside", inside)
    n = F.when(F.col("inside") == 0, F.col("n0")).otherwise(F.col("n1"))
    return blocks.select("path", "block", "inside", F.coalesce(F.sum(n).over(before), F.lit(0)).alias("first"))


_RECORD = "file_name string, pos long, cells array<string>, error string"


def _parsed(batches, sep: str):
    """``file_name, pos, record`` -> cells."""
    csv.field_size_limit(1 << 62)
    for b in batches:
        cells, errors = [], []
        for text in b.column(2).to_pylist():
            try:
                rows = list(csv.reader(io.StringIO(text, newline=""), delimiter=sep))
                cells.append(rows[0] if rows else [])
                errors.append(None if len(rows) < 2 else "several records in one")
            except csv.Error as e:
                cells.append([text])
                errors.append(str(e))
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(cells, pa.list_(pa.string())), pa.array(errors, pa.string())],
                                         names=["file_name", "pos", "cells", "error"])


def csv_records(spark: SparkSession, paths, sep: str = ",", max_record: int = MAX_RECORD) -> DataFrame:
    """``file_name, pos, cells, error``: every record of the files, numbered
    from 0 per file; blank lines are records without cells."""
    names = ["path", "block", "value", "line", *[f"{k}{h}" for h in (0, 1) for k in ("before", "after", "begun")]]
    schema = "path string, block long, value string, line long, " + ", ".join(
        f"before{h} byte, after{h} byte, begun{h} long" for h in (0, 1))

    def run(batches):
        for _, held, part, states in _scan(batches, sep):
            line = pa.array(np.arange(held.rows - part.num_rows, held.rows))
            yield pa.RecordBatch.from_arrays([*part.columns, line, *[pa.array(x) for s in states for x in s]], names=names)

    starts = block_starts(spark, paths, sep).withColumnsRenamed({"path": "s_path", "block": "s_block"})
    x = _lines(spark, paths).mapInArrow(run, schema).join(starts, (F.col("path") == F.col("s_path")) & (F.col("block") == F.col("s_block")))
    of = lambda k: F.when(F.col("inside") == 0, F.col(f"{k}0")).otherwise(F.col(f"{k}1"))
    x = x.select(F.col("path").alias("file_name"), (F.col("first") + of("begun") - 1).alias("pos"), "value", "block", "line",
                 of("before").alias("before"), of("after").alias("after"))
    parse = lambda df: df.mapInArrow(lambda bs: _parsed(bs, sep), _RECORD)
    whole = (F.col("before") == 0) & (F.col("after") == 0)
    alone = parse(x.where(whole).select("file_name", "pos", "value"))
    part = x.where(~whole)
    size = part.groupBy("file_name", "pos").agg(F.sum(F.length("value") + 1).alias("size")).where(F.col("size") > max_record).drop("size")
    large = part.join(size, ["file_name", "pos"], "left_semi").select(
        "file_name", "pos", F.array("value").alias("cells"), F.lit("a quote is not closed").alias("error"))
    lines = F.array_sort(F.collect_list(F.struct("block", "line", "value")))
    joined = part.join(size, ["file_name", "pos"], "left_anti").groupBy("file_name", "pos").agg(
        F.array_join(F.transform(lines, lambda r: r["value"]), "\n").alias("value"))
    return alone.unionByName(parse(joined.select("file_name", "pos", "value"))).unionByName(large)
