"""Exact dedup against immutable snapshots screened by binary-fuse filters.

Texts are equal when they are identical after deleting space and the control
characters 0x09 to 0x0D.

1. A batch is read once.  Per Arrow batch, rows of one normalised text become
   one packet: key (64 bits), SHA-256, the normalised bytes and the list of
   members; a text that a third of all rows share so needs few rows later.
2. Duplicates inside the batch are grouped by digest: one class per text.
3. An earlier snapshot is a table of classes and, for each shard of about
   ``SHARD_KEYS`` keys, a static binary-fuse filter.  The batch's class keys
   meet their shard's filter; only what passes joins the snapshot's exact
   buckets (rows of equal key), where the normalised bytes are compared.  A
   class that is equal to a snapshot's joins that class; all others are new
   and make up, with their own filters, the batch's snapshot.
4. Per class, sizes and the row that stays are merged over batches and go back
   to the members.

Of equal texts the row with the most code points in the original text stays,
then the smallest id (null last); of rows that agree in both, exactly one.

Defined results: a null text counts as empty; empty texts (after deletion) are
one group; rows of one id are separate rows; a null id stays only where no
other row of that length has an id; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm import fuse
from tessera.llm.common import _SPACE, as_column, bounded_batches, byte_view, stored

KEY_BITS = 64
SHARD_KEYS = 1 << 16
BATCHES = 3

_PACKETS = "batch int, key long, digest binary, body binary, members array<struct<id: long, chars: long>>"


def _packed(batch, key_bits: int):
    """One packet per dedup batch and distinct normalised text of an Arrow batch."""
    raw, off = byte_view(as_column(batch, "text"))
    keep = ~_SPACE[raw]
    cut = np.concatenate([[0], np.cumsum(keep)])[off]
    flat = raw[keep].tobytes()
    ids = as_column(batch, "doc_id").to_pylist()
    chars = pc.utf8_length(as_column(batch, "text")).to_pylist()
    number = as_column(batch, "batch").to_pylist()
    found: dict[tuple, list] = {}
    for k, (a, b) in enumerate(zip(cut[:-1].tolist(), cut[1:].tolist())):
        body = flat[a:b]
        name = number[k], hashlib.sha256(body).digest()
        if name not in found:
            found[name] = [body, []]
        found[name][1].append({"id": ids[k], "chars": chars[k]})
    keys = np.array([int.from_bytes(d[:8], "little") >> (64 - key_bits) for _, d in found], np.uint64).view(np.int64)
    return pa.RecordBatch.from_arrays(
        [pa.array([n for n, _ in found], pa.int32()), pa.array(keys, pa.int64()), pa.array([d for _, d in found], pa.binary()),
         pa.array([v[0] for v in found.values()], pa.binary()),
         pa.array([v[1] for v in found.values()], pa.list_(pa.struct([("id", pa.int64()), ("chars", pa.int64())])))],
        names=["batch", "key", "digest", "body", "members"])


def packets(docs: DataFrame, key_bits: int = KEY_BITS, number: Column | None = None) -> DataFrame:
    """The stored packets of ``docs``: one pass over the texts.  ``number``
    deals the rows to dedup batches (all to batch 0 without it)."""
    bounded_batches(docs.sparkSession)
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"),
                      (F.lit(0) if number is None else number).cast("int").alias("batch"))
    rows = src.mapInArrow(lambda batches: (_packed(b, key_bits) for b in batches if b.num_rows), _PACKETS)
    return stored(rows.withColumn("packet", F.monotonically_increasing_id()), "dedup-packets")


def _rank(member: Column, packet: Column, pos: Column) -> Column:
    """Order in which rows of a class are preferred (least first)."""
    return F.struct((-member["chars"]).alias("less"), member["id"].isNull().alias("none"), member["id"].alias("id"),
                    packet.alias("packet"), pos.cast("long").alias("pos"))


def classes(batch: DataFrame) -> DataFrame:
    """One row per text of the batch: ``key, digest, n, best, at`` (the packet
    that holds its bytes)."""
    best = F.array_min(F.transform("members", lambda m, i: _rank(m, F.col("packet"), i)))
    return stored(batch.select("key", "digest", F.size("members").alias("n"), best.alias("best"), "packet")
                       .groupBy("key", "digest").agg(F.sum("n").alias("n"), F.min("best").alias("best"), F.min("packet").alias("at")),
                  "dedup-classes")


@dataclass(frozen=True)
class Snapshot:
    """Immutable known texts: classes (``key, digest, at``) with their packets,
    and one filter per shard of keys."""

    number: int
    known: DataFrame
    batch: DataFrame
    filters: DataFrame
    shards: int


def _shard(key: Column, shards: int) -> Column:
    return F.pmod(F.xxhash64(key, F.lit(7)), F.lit(shards))


def freeze(number: int, known: DataFrame, batch: DataFrame, shard_keys: int = SHARD_KEYS) -> Snapshot:
    """Build the filters of a finished table of classes."""
    shards = max(1, -(-known.count() // shard_keys))

    def run(key, table):
        keys = np.unique(table.column("key").to_numpy()).view(np.uint64)
        return pa.table({"shard": pa.array([key[0].as_py()], pa.int64()), "filter": pa.array([fuse.build(keys)], pa.binary())})

    filters = (known.select("key", _shard(F.col("key"), shards).alias("shard"))
                    .groupBy("shard").applyInArrow(run, "shard long, filter binary"))
    return Snapshot(number, known, batch, stored(filters, "dedup-filters"), shards)


def screen(found: DataFrame, snap: Snapshot, shard_keys: int = SHARD_KEYS) -> DataFrame:
    """The classes whose key passes the snapshot's filter.  A shard's keys are
    dealt over several tasks when the batch is larger than the snapshot."""
    subs = max(1, -(-found.count() // (snap.shards * shard_keys)))
    asked = found.select("key", "digest", "at", _shard(F.col("key"), snap.shards).alias("shard"),
                         F.pmod(F.xxhash64("key", F.lit(11)), F.lit(subs)).alias("sub"))
    held = snap.filters.withColumn("sub", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(subs - 1).cast("long"))))

    def run(key, left, right):
        left = left.select(["key", "digest", "at"])
        if not left.num_rows or not right.num_rows:
            return left.slice(0, 0)
        return left.filter(pa.array(fuse.passes(right.column("filter")[0].as_py(), left.column("key").to_numpy().view(np.uint64))))

    return asked.groupBy("shard", "sub").cogroup(held.groupBy("shard", "sub")).applyInArrow(run, "key long, digest binary, at long")


def verified(found: DataFrame, batch: DataFrame, snap: Snapshot) -> DataFrame:
    """``key, digest, s_digest, origin`` of the classes whose bytes equal those
    of a class of the snapshot: filter, exact bucket, byte check."""
    hits = stored(screen(found, snap), "dedup-hits")
    bucket = snap.known.select(F.col("key").alias("s_key"), F.col("digest").alias("s_digest"), F.col("at").alias("s_at"))
    pairs = stored(hits.join(bucket, F.col("key") == F.col("s_key")).drop("s_key"), "dedup-pairs")
    mine = (batch.select("packet", "digest", "body").join(pairs.select(F.col("at").alias("packet"), "digest").distinct(), ["packet", "digest"])
                 .select(F.col("digest").alias("a_digest"), F.col("body").alias("a_body")))
    other = (snap.batch.select("packet", "digest", "body")
                 .join(pairs.select(F.col("s_at").alias("packet"), F.col("s_digest").alias("digest")).distinct(), ["packet", "digest"])
                 .select(F.col("digest").alias("b_digest"), F.col("body").alias("b_body")))
    checked = pairs.join(mine, F.col("digest") == F.col("a_digest")).join(other, F.col("s_digest") == F.col("b_digest"))
    return (checked.where(F.col("a_body") == F.col("b_body"))
                   .select("key", "digest", F.col("s_digest").alias("c_digest"), F.lit(snap.number).alias("origin")))


class Index:
    """Known texts as a list of immutable snapshots; ``add`` takes a batch."""

    def __init__(self, key_bits: int = KEY_BITS, shard_keys: int = SHARD_KEYS):
        self.key_bits, self.shard_keys = key_bits, shard_keys
        self.snapshots: list[Snapshot] = []
        self.batches: list[DataFrame] = []
        self.entries: list[DataFrame] = []

    def add(self, docs: DataFrame) -> DataFrame:
        """Screen a batch against all snapshots and freeze what is new.  Gives
        one row per text: ``batch, key, digest, origin, c_digest, n, best``
        (origin: the batch that first held the text)."""
        return self.add_packets(packets(docs, self.key_bits).drop("batch"))

    def add_packets(self, batch: DataFrame) -> DataFrame:
        """``add`` for packets that are stored already."""
        number = len(self.batches)
        found = classes(batch)
        known = None
        for snap in self.snapshots:
            more = verified(found, batch, snap)
            known = more if known is None else known.unionByName(more)
        if known is None:
            entry = found.withColumns({"origin": F.lit(number), "c_digest": F.col("digest")})
        else:
            known = stored(known, "dedup-known").withColumnsRenamed({"key": "k_key", "digest": "k_digest"})
            entry = (found.join(known, (F.col("key") == F.col("k_key")) & (F.col("digest") == F.col("k_digest")), "left")
                          .withColumns({"origin": F.coalesce("origin", F.lit(number)), "c_digest": F.coalesce("c_digest", "digest")}))
        entry = stored(entry.select(F.lit(number).alias("batch"), "key", "digest", "origin", "c_digest", "n", "best", "at"), "dedup-entry")
        fresh = entry.where(F.col("origin") == number)
        self.snapshots.append(freeze(number, fresh, batch, self.shard_keys))
        self.batches.append(batch)
        self.entries.append(entry)
        return entry

    def groups(self) -> DataFrame:
        """One row per row ever added: ``doc_id, keep_id, group_size, kept,
        text_sha256``."""
        entry = self.entries[0]
        member = self.batches[0].withColumn("batch", F.lit(0))
        for k in range(1, len(self.entries)):
            entry = entry.unionByName(self.entries[k])
            member = member.unionByName(self.batches[k].withColumn("batch", F.lit(k)))
        best = F.struct(F.col("best.less"), F.col("best.none"), F.col("best.id"), "batch", F.col("best.packet"), F.col("best.pos"))
        total = entry.groupBy("origin", "c_digest").agg(F.sum("n").alias("group_size"), F.min(best).alias("w"))
        named = (entry.select(F.col("batch").alias("e_batch"), F.col("digest").alias("e_digest"), "origin", "c_digest")
                      .join(total, ["origin", "c_digest"]))
        # stored, so that the join below exchanges both sides and Spark can
        # split a class that many packets belong to
        named = stored(named.drop("origin", "c_digest"), "dedup-groups")
        rows = member.drop("body", "key").join(named, (F.col("batch") == F.col("e_batch")) & (F.col("digest") == F.col("e_digest")))
        one = rows.select("batch", "packet", "digest", "group_size", "w", F.posexplode_outer("members").alias("pos", "m"))
        kept = ((F.col("w.batch") == F.col("batch")) & (F.col("w.packet") == F.col("packet")) & (F.col("w.pos") == F.col("pos")))
        return one.select(F.col("m.id").alias("doc_id"), F.col("w.id").alias("keep_id"), "group_size", kept.alias("kept"),
                          F.lower(F.hex("digest")).alias("text_sha256"))


def deduplicated(docs: DataFrame, batches: int = BATCHES, **options) -> DataFrame:
    """One row per row of ``docs``, which arrive in ``batches`` batches (dealt
    by a hash of the id): each is screened against the snapshots before it."""
    index = Index(**options)
    every = packets(docs, index.key_bits, F.pmod(F.xxhash64("doc_id"), F.lit(batches)))
    for k in range(batches):
        index.add_packets(every.where(F.col("batch") == k).drop("batch"))
    return index.groups()
