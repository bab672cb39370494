"""Suffix-array dedup: remove every byte covered by a 400-byte string that
also starts anywhere else in the corpus.

1. Sharding.  Of the 64-bit hashes of all 128-byte strings inside a 400-byte
   window, the smallest (leftmost) is the window's anchor.  Equal windows have equal anchors, so
   windows only need to be compared inside the group of their anchor's hash.
   Neighbouring windows with one anchor form a span (at most 672 bytes); a
   row per span, about one per 137 bytes, is all that is shuffled.
   Groups with one span in all cannot repeat and are dropped.
2. Equal spans collapse to one with its number of copies.  A group that holds
   one distinct span repeats as a whole.
3. The distinct spans of the other groups are cut from the texts and dealt to shards
   of about ``SHARD_BYTES``.  A span that agrees with no other of its group in the anchor and
   the half window on a side shares no window there.  Of what is left each shard builds its suffix array by induced sorting and
   its permuted common prefixes (``sais``): neighbours with a common prefix of 400
   bytes or more repeat.
4. A group with more than ``HOT`` distinct spans (the edges of a passage that
   very many texts share) does not go to one shard: its windows are counted by
   a 128-bit hash, pre-aggregated, so that no task holds the group.
5. The repeated stretches return to the rows of their texts and are removed.

Defined results: null and empty texts have nothing to remove; texts below 400
bytes stay; repeated rows are copies of each other and vanish when they are
long enough; rows with the same id but other texts are separate; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import as_column, bounded_batches, byte_view, mixed, release_memory, stored
from tessera.llm.sais import permuted_lcp, suffix_array

LENGTH = 400
GRAM = 128
SHARD_BYTES = 1 << 20
HOT = 2000
_CHUNK = 1 << 21       # window starts of one text treated at a time
_BASE = 0x9E3779B97F4A7C15 | 1
_POS = np.uint64((1 << 22) - 1)


class _Powers:
    """Powers of the hash base and of its inverse modulo 2^64."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def get(self, n: int):
        if self.up.size < n:
            size = max(n, 1 << 16)
            inv = pow(_BASE, -1, 1 << 64)
            for name, base in (("up", _BASE), ("down", inv)):
                x = np.full(size, base, np.uint64)
                x[0] = 1
                setattr(self, name, np.multiply.accumulate(x))
        return self.up[:n], self.down[:n]


_powers = _Powers()


def _prefix_hashes(raw: np.ndarray):
    up, down = _powers.get(raw.size + 1)
    total = np.zeros(raw.size + 1, np.uint64)
    np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * up[:-1], out=total[1:])
    return total, down


def _hash(total, down, lo, hi):
    return mixed((total[hi] - total[lo]) * down[lo])


def spans(raw: np.ndarray, length: int = LENGTH, gram: int = GRAM):
    """(first window start, bytes, anchor hash, span hash) of a text's spans."""
    out = []
    windows = raw.size - length + 1
    wide = length - gram + 1
    for a in range(0, max(windows, 0), _CHUNK):
        part = raw[a:min(a + _CHUNK, windows) + length - 1]
        n = part.size - length + 1
        total, down = _prefix_hashes(part)
        grams = part.size - gram + 1
        h = mixed((total[gram:] - total[:-gram]) * down[:grams])
        key = (h & ~_POS) | np.arange(grams, dtype=np.uint64)
        size, low = 1, key
        while 2 * size <= wide:
            low = np.minimum(low[:-size], low[size:])
            size *= 2
        low = np.minimum(low[:n], low[wide - size:wide - size + n])
        pos = (low & _POS).astype(np.int64)
        first = np.flatnonzero(np.concatenate([[True], pos[1:] != pos[:-1]]))
        last = np.append(first[1:], n) - 1
        end = last + length
        out.append((first + a, end - first, h[pos[first]], _hash(total, down, first, end) + (end - first).astype(np.uint64)))
    if not out:
        e = np.zeros(0, np.int64)
        return e, e, e.astype(np.uint64), e.astype(np.uint64)
    return tuple(np.concatenate(c) for c in zip(*out))


def _span_rows(docs: DataFrame, length: int, gram: int) -> DataFrame:
    names = ["doc_id", "text_hash", "start", "bytes", "anchor", "span"]

    def run(batches):
        for b in batches:
            raw, off = byte_view(as_column(b, "text"))
            each, cols = [], []
            for k in range(len(off) - 1):
                s = spans(raw[off[k]:off[k + 1]], length, gram)
                each.append(s[0].size)
                cols.append(s)
            who = pa.array(np.repeat(np.arange(len(each)), each))
            start, size, anchor, span = (np.concatenate(c) for c in zip(*cols)) if cols else ([], [], [], [])
            yield pa.RecordBatch.from_arrays(
                [as_column(b, "doc_id").take(who), as_column(b, "text_hash").take(who), pa.array(start, pa.int64()),
                 pa.array(np.asarray(size, np.int32)), pa.array(np.asarray(anchor, np.uint64).view(np.int64)),
                 pa.array(np.asarray(span, np.uint64).view(np.int64))], names=names)

    return docs.mapInArrow(run, "doc_id long, text_hash long, start long, bytes int, anchor long, span long")


def _cut(docs: DataFrame, need: DataFrame) -> DataFrame:
    """The bytes of needed spans: rows (anchor, span, copies, hot, piece)."""
    names = ["anchor", "span", "copies", "hot", "piece"]
    joined = docs.join(need, F.col("doc_id").eqNullSafe(F.col("n_id")) & (F.col("text_hash") == F.col("n_hash")))

    def run(batches):
        for b in batches:
            cols = [[], [], [], [], []]
            for text, wanted in zip(as_column(b, "text").cast(pa.binary()).to_pylist(), as_column(b, "wanted").to_pylist()):
                for w in wanted:
                    for c, v in zip(cols, (w["anchor"], w["span"], w["copies"], w["hot"], text[w["start"]:w["start"] + w["bytes"]])):
                        c.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.int64()),
                                              pa.array(cols[3], pa.bool_()), pa.array(cols[4], pa.binary())], names=names)

    return joined.select("text", "wanted").mapInArrow(run, "anchor long, span long, copies long, hot boolean, piece binary")


def _stretches(flag: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edge = np.diff(np.concatenate([[0], flag.astype(np.int8), [0]]))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def repeated_starts(pieces: list[bytes], copies: list[int], length: int = LENGTH) -> list[np.ndarray]:
    """For each piece a flag per window start: its string occurs elsewhere
    among the pieces, copies counted."""
    size = np.array([len(p) for p in pieces], np.int64)
    at = np.concatenate([[0], np.cumsum(size + 1)])
    codes = np.zeros(at[-1], np.int64)
    body = np.ones(at[-1], bool)
    body[at[1:] - 1] = False
    codes[body] = np.frombuffer(b"".join(pieces), np.uint8)
    # every piece ends with a code of its own, so no match crosses an end
    codes[~body] = 256 + np.arange(len(pieces))
    sa = suffix_array(codes)
    plcp = permuted_lcp(codes, sa)
    run = np.cumsum(plcp[sa] < length)
    owner = np.searchsorted(at, sa, side="right") - 1
    whole = sa + length <= at[owner] + size[owner]
    weight = np.where(whole, np.asarray(copies, np.int64)[owner], 0)
    many = np.bincount(run, weights=weight)[run] >= 2
    flag = np.zeros(at[-1], bool)
    flag[sa[whole & many]] = True
    return [flag[at[k]:at[k] + max(0, size[k] - length + 1)] for k in range(len(pieces))]


def shareable(anchors: list[int], pieces: list[bytes], length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray]:
    """For each piece the stretch (from, to) that holds every window which
    another piece of its anchor holds too; empty if there is none.

    A window has at least half of its room on one side of its anchor, so pieces
    that share one agree in the anchor with that half.  A piece that agrees
    with others on one side only shares no window that covers its other side."""
    half = (length - gram + 1) // 2
    size = np.array([len(p) for p in pieces], np.int64)
    off = np.concatenate([[0], np.cumsum(size)])
    group = np.asarray(anchors, np.int64)
    total, down = _prefix_hashes(np.frombuffer(b"".join(pieces), np.uint8))
    lo = np.arange(off[-1] - gram + 1)
    hit = np.flatnonzero(_hash(total, down, lo, lo + gram).view(np.int64) == np.repeat(group, size)[:lo.size])
    # the anchor is the first place in the piece that has its hash
    who, first = np.unique(np.searchsorted(off, hit, side="right") - 1, return_index=True)
    if who.size != len(pieces):
        raise ValueError("a piece without its anchor")
    at = hit[first]
    agrees = []
    for a, z in ((at - half, at + gram), (at, at + gram + half)):
        there = np.flatnonzero((a >= off[:-1]) & (z <= off[1:]))
        side = _hash(total, down, a[there], z[there])
        order = np.lexsort((side, group[there]))
        k, x, there = group[there][order], side[order], there[order]
        same = (k[1:] == k[:-1]) & (x[1:] == x[:-1])
        many = np.zeros(len(pieces), bool)
        many[there[1:][same]] = many[there[:-1][same]] = True
        agrees.append(many)
    left, right = agrees
    at = at - off[:-1]
    begin = np.where(left, 0, np.maximum(at - half + 1, 0))
    end = np.where(right, size, np.minimum(at + gram + half - 1, size))
    return begin, np.where((left | right) & (end - begin >= length), end, begin)


def piece_flags(anchors: list[int], pieces: list[bytes], copies: list[int], length: int = LENGTH, gram: int = GRAM) -> list[np.ndarray]:
    """``repeated_starts`` of whole groups, sorting only what can be shared."""
    # what a piece shares with no other repeats where the piece has copies
    flags = [np.full(max(0, len(p) - length + 1), c > 1) for p, c in zip(pieces, copies)]
    begin, end = shareable(anchors, pieces, length, gram)
    part = np.flatnonzero(end > begin).tolist()
    if part:
        found = repeated_starts([pieces[k][begin[k]:end[k]] for k in part], [copies[k] for k in part], length)
        for k, f in zip(part, found):
            flags[k][begin[k]:begin[k] + f.size] = f
    return flags


def _shards(pieces: DataFrame, n: int, length: int, gram: int) -> DataFrame:
    def run(key, table):
        seen = {}
        for a, s, c, p in zip(*(table.column(x).to_pylist() for x in ("anchor", "span", "copies", "piece"))):
            seen[a, s] = (c, p)   # identical rows of the texts bring a piece twice
        keys = sorted(seen)
        flags = piece_flags([k[0] for k in keys], [seen[k][1] for k in keys], [seen[k][0] for k in keys], length, gram)
        rows = [(k[0], k[1], np.stack(_stretches(f), 1).ravel().tolist()) for k, f in zip(keys, flags) if f.any()]
        del seen, flags
        release_memory()
        return pa.table({"anchor": pa.array([r[0] for r in rows], pa.int64()), "span": pa.array([r[1] for r in rows], pa.int64()),
                         "starts": pa.array([r[2] for r in rows], pa.list_(pa.int32()))})

    return (pieces.withColumn("shard", F.pmod(F.xxhash64("anchor"), F.lit(n)))
                  .groupBy("shard").applyInArrow(run, "anchor long, span long, starts array<int>"))


def _hot_windows(pieces: DataFrame, length: int) -> DataFrame:
    """Windows of large groups, counted by their hashes: the same result as a
    shard gives, without gathering the group."""
    names = ["anchor", "span", "copies", "at", "w1", "w2"]

    def run(batches):
        for b in batches:
            cols = [[], [], [], [], [], []]
            for a, s, c, p in zip(*(as_column(b, x).to_pylist() for x in ("anchor", "span", "copies", "piece"))):
                raw = np.frombuffer(p, np.uint8)
                n = raw.size - length + 1
                lo = np.arange(n)
                total, down = _prefix_hashes(raw)
                w1 = _hash(total, down, lo, lo + length)
                total, down = _prefix_hashes(raw ^ np.uint8(0x5A))
                w2 = _hash(total, down, lo, lo + length)
                for x, v in zip(cols, (np.full(n, a, np.int64), np.full(n, s, np.int64), np.full(n, c, np.int64), lo, w1.view(np.int64), w2.view(np.int64))):
                    x.append(v)
            if cols[0]:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in cols], names=names)

    rows = pieces.dropDuplicates(["anchor", "span"]).mapInArrow(run, "anchor long, span long, copies long, at long, w1 long, w2 long")
    rows = stored(rows, "hot-windows")
    many = rows.groupBy("anchor", "w1", "w2").agg(F.sum("copies").alias("n")).where("n >= 2").drop("n")
    hit = rows.join(many, ["anchor", "w1", "w2"], "left_semi")
    # windows of one span: at most a few hundred
    return hit.groupBy("anchor", "span").agg(
        F.flatten(F.transform(F.array_sort(F.collect_list("at")), lambda x: F.array(x, x + 1))).cast("array<int>").alias("starts"))


def repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, shard_bytes: int = SHARD_BYTES, hot: int = HOT) -> DataFrame:
    """``docs`` (doc_id, text, text_hash) -> per distinct (doc_id, text_hash)
    with a repeat: ``cuts``, array of (lo, hi) byte stretches, maybe overlapping."""
    every = stored(_span_rows(docs, length, gram), "spans")
    # tables that meet are stored first: both sides of a join are exchanged,
    # and Spark can split an anchor or a span that very many texts share
    groups = stored(every.groupBy("anchor").agg(F.count(F.lit(1)).alias("n"), F.min("span").alias("s1"), F.max("span").alias("s2"))
                    .where("n >= 2").select(F.col("anchor").alias("g_anchor"), (F.col("s1") == F.col("s2")).alias("whole")), "span-groups")
    found = stored(every.join(groups, F.col("anchor") == F.col("g_anchor")).drop("g_anchor"), "span-found")
    mixed_groups = found.where("not whole")
    distinct = stored(mixed_groups.groupBy("anchor", "span", "bytes").agg(
        F.count(F.lit(1)).alias("copies"), F.min(F.struct("doc_id", "text_hash", "start")).alias("at")), "span-kinds")
    # the few large groups, as a stored table: small, so Spark broadcasts it
    # and the spans of a large group are not brought together
    large = stored(distinct.groupBy("anchor").agg(F.count(F.lit(1)).alias("kinds")).where(F.col("kinds") > hot)
                   .select("anchor", F.lit(True).alias("hot")), "span-hot")
    need = (distinct.join(large, "anchor", "left").withColumn("hot", F.coalesce("hot", F.lit(False)))
                    .groupBy(F.col("at.doc_id").alias("n_id"), F.col("at.text_hash").alias("n_hash"))
                    .agg(F.collect_list(F.struct(F.col("at.start").alias("start"), "bytes", "anchor", "span", "copies", "hot")).alias("wanted")))
    pieces = stored(_cut(docs, need), "pieces")
    size = pieces.where("not hot").agg(F.sum(F.length("piece"))).first()[0] or 0
    cold = _shards(pieces.where("not hot"), max(1, -(-size // shard_bytes)), length, gram)
    ranges = stored(cold.unionByName(_hot_windows(pieces.where("hot"), length)), "ranges")
    # one row per span, its stretches in an array; copies of one row agree
    cuts = F.expr(f"transform(sequence(0, cast(size(starts) / 2 as int) - 1),"
                  f" i -> struct(start + starts[2 * i] as lo, start + starts[2 * i + 1] - 1 + {length} as hi))")
    part = mixed_groups.select("doc_id", "text_hash", "start", "anchor", "span").join(ranges, ["anchor", "span"]).select("doc_id", "text_hash", cuts.alias("cuts"))
    full = found.where("whole").select("doc_id", "text_hash", F.array(F.struct(F.col("start").alias("lo"), (F.col("start") + F.col("bytes")).alias("hi"))).alias("cuts"))
    return part.unionByName(full).groupBy("doc_id", "text_hash").agg(F.flatten(F.collect_set("cuts")).alias("cuts"))


def with_hash(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"),
                       F.xxhash64("text").alias("text_hash"))


def remove(text: bytes, cuts) -> tuple[bytes, int, int]:
    """(bytes left, bytes removed, maximal removed runs)."""
    if cuts is None or not len(cuts):
        return text, 0, 0
    out, at, runs = [], 0, 0
    end = -1
    for lo, hi in sorted((c["lo"], c["hi"]) for c in cuts):
        if lo > end:
            if end >= 0:
                at = end
            out.append(text[at:lo])
            runs += 1
            end = hi
        else:
            end = max(end, hi)
    out.append(text[end:])
    left = b"".join(out)
    return left, len(text) - len(left), runs


def deduplicated(docs: DataFrame, **options) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_bytes, n_removed, n_spans,
    kept_sha256, text_hash, kept`` (the remaining bytes)."""
    bounded_batches(docs.sparkSession)
    src = with_hash(docs)
    cuts = repeats(src, **options).select(F.col("doc_id").alias("c_id"), F.col("text_hash").alias("c_hash"), "cuts")
    joined = src.join(cuts, F.col("doc_id").eqNullSafe(F.col("c_id")) & (F.col("text_hash") == F.col("c_hash")), "left")
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "text_hash", "kept"]

    def run(batches):
        for b in batches:
            rows = []
            for text, cut in zip(as_column(b, "text").cast(pa.binary()).to_pylist(), as_column(b, "cuts").to_pylist()):
                left, removed, runs = remove(text, cut)
                rows.append((len(text), removed, runs, hashlib.sha256(left).hexdigest(), left))
            c = list(zip(*rows)) if rows else [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [as_column(b, "doc_id"), pa.array(c[0], pa.int64()), pa.array(c[1], pa.int64()), pa.array(c[2], pa.int64()),
                 pa.array(c[3], pa.string()), as_column(b, "text_hash"), pa.array(c[4], pa.binary())], names=names)

    return joined.select("doc_id", "text", "text_hash", "cuts").mapInArrow(
        run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, text_hash long, kept binary")
