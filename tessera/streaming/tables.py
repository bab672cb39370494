"""Bucketed tables with one commit per batch: the shared base of the keyed
upsert (T5), the processed-key log (T1, U9), resumable runs (T3, T4), saved
column maps (C7) and gap-free appends (U7).

A ``Tables`` folder holds data folders that are written once and never
changed, and commits.  A commit names, for each table, the folders whose rows
count, bucket by bucket (bucket: hash of the key).  It appears by one rename,
so a batch that writes several tables is seen whole or not at all, and a
failed attempt leaves only folders that no commit names.  A commit also holds
the last batch of every stream: a batch that comes again is skipped.

One writer at a time is assumed; a second one that commits the same version
fails.  Commits list folders (buckets x tables), never rows.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BUCKET = "_bucket"
COMPACT_AT = 16          # folders of one bucket before a batch merges them


class Tables:
    """The committed tables below ``root`` (a folder all executors share)."""

    def __init__(self, spark: SparkSession, root: str, buckets: int = 64):
        self.spark, self.root = spark, root.rstrip("/")
        self.buckets = buckets
        state = self.state()
        if state["version"] >= 0:
            self.buckets = state["buckets"]      # fixed by the first commit

    # ---------------------------------------------------------- commits

    def _fs(self, path: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()), p

    def _names(self, path: str) -> list[str]:
        fs, p = self._fs(path)
        return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []

    def version(self) -> int:
        """The newest committed version, -1 without any."""
        done = [n for n in self._names(f"{self.root}/_commits") if n.endswith(".json") and not n.startswith((".", "_"))]
        return int(done[-1][:-5]) if done else -1

    def state(self, version: int | None = None) -> dict:
        """The commit ``version`` (the newest one by default)."""
        v = self.version() if version is None else version
        if v < 0:
            return {"version": -1, "buckets": self.buckets, "tables": {}, "schemas": {}, "batches": {}, "facts": {}}
        text = self.spark.read.text(f"{self.root}/_commits/{v:012d}.json", wholetext=True).first()[0]
        return json.loads(text)

    def seen(self, stream: str, batch_id: int) -> bool:
        """Whether this batch of the stream is committed."""
        last = self.state()["batches"].get(stream)
        return last is not None and batch_id <= last

    def commit(self, base: dict, changes: dict, stream: str | None = None, batch_id: int | None = None, facts: dict | None = None) -> int:
        """Make ``changes`` (table -> (schema, {bucket: folders}, whole)) the
        next version after ``base``; with ``whole`` the table holds nothing
        else.  ``facts`` are small values kept with the commit."""
        new = json.loads(json.dumps(base)) | {"version": base["version"] + 1, "buckets": self.buckets}
        for table, (schema, folders, whole) in changes.items():
            kept = {} if whole else new["tables"].get(table, {})
            new["tables"][table] = kept | folders
            new["schemas"][table] = json.loads(schema.json())
        if stream is not None:
            new["batches"][stream] = batch_id
        new["facts"].update(facts or {})
        fs, final = self._fs(f"{self.root}/_commits/{new['version']:012d}.json")
        _, tmp = self._fs(f"{self.root}/_commits/.{uuid.uuid4().hex}.tmp")
        if fs.exists(final):
            raise RuntimeError(f"version {new['version']} was committed by another writer")
        out = fs.create(tmp, False)
        out.write(bytearray(json.dumps(new).encode()))
        out.close()
        if not fs.rename(tmp, final):
            raise RuntimeError(f"version {new['version']} could not be committed")
        return new["version"]

    # ---------------------------------------------------------- rows

    def bucket_of(self, keys: list[str]):
        return F.pmod(F.xxhash64(*keys), F.lit(self.buckets)).cast("int")

    def touched(self, rows: DataFrame, keys: list[str]) -> list[int]:
        """The buckets of the rows' keys (at most ``buckets`` numbers)."""
        return sorted(rows.select(self.bucket_of(keys).alias("b")).distinct().toArrow().column("b").to_pylist())

    def read(self, table: str, buckets: list[int] | None = None, version: int | None = None, state: dict | None = None) -> DataFrame:
        """The committed rows of a table; with ``buckets`` only their folders
        are opened."""
        state = state or self.state(version)
        if table not in state["schemas"]:
            raise KeyError(f"no table {table} in version {state['version']}")
        schema = T.StructType.fromJson(state["schemas"][table])
        held = state["tables"].get(table, {})
        paths = [f"{self.root}/{p}" for b, ps in held.items() if buckets is None or int(b) in buckets for p in ps]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def has(self, table: str, state: dict | None = None) -> bool:
        return table in (state or self.state())["schemas"]

    def write(self, table: str, rows: DataFrame, keys: list[str], rows_per_task: int | None = None, most: int = 0) -> dict[str, list[str]]:
        """Write rows into a new folder, dealt by bucket and sorted by key;
        gives {bucket: [folder]} of the buckets that got rows.  With
        ``rows_per_task`` a bucket of more rows is dealt over several tasks:
        there are ``most`` rows at most."""
        name = f"data/{table}/{uuid.uuid4().hex}"
        x = rows.withColumn(BUCKET, self.bucket_of(keys))
        deal = [F.col(BUCKET)]
        if rows_per_task:
            deal.append(F.pmod(F.xxhash64(*keys, F.lit(5)), F.lit(max(1, -(-most // (rows_per_task * self.buckets))))))
        x = x.repartition(*deal).sortWithinPartitions(BUCKET, *keys)
        x.write.partitionBy(BUCKET).parquet(f"{self.root}/{name}")
        return {n.split("=")[1]: [f"{name}/{n}"] for n in self._names(f"{self.root}/{name}") if n.startswith(BUCKET + "=")}

    def append(self, state: dict, table: str, rows: DataFrame, keys: list[str]):
        """A change that adds rows to a table; buckets of many folders are
        merged on the way."""
        held = state["tables"].get(table, {})
        full = [int(b) for b, ps in held.items() if len(ps) >= COMPACT_AT]
        schema = rows.schema
        if self.has(table, state):
            known = T.StructType.fromJson(state["schemas"][table])
            rows, schema = with_schema(rows, known)
            if full:
                rows = rows.unionByName(with_schema(self.read(table, full, state=state), schema)[0])
        new = self.write(table, rows, keys)
        return schema, {b: ps if int(b) in full else held.get(b, []) + ps for b, ps in new.items()}, False


def with_schema(rows: DataFrame, known: T.StructType) -> tuple[DataFrame, T.StructType]:
    """``rows`` with the columns of ``known`` first (null where absent), and
    the schema of both: a table's columns only ever grow."""
    more = [f for f in rows.schema.fields if f.name not in known.fieldNames()]
    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in [*known.fields, *more]])
    cols = [(F.col(f"`{f.name}`") if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields]
    return rows.select(*cols), schema
