"""SimHash near-duplicates by pigeonring filtering.

Fingerprint: 64 bits, one per bit of the XXH64 of the word shingles; a bit is
set if it is set in more than half of the shingle hashes.

Links (at most ``max_bits`` differing bits) are found without comparing all
pairs.  The 64 bits are a ring of 8 segments with a budget of ``max_bits / 8``
bits each.  If two fingerprints differ in at most ``max_bits`` bits, then from
some segment on, every chain of ``l`` consecutive segments differs in at most
``l * max_bits / 8`` bits (pigeonring).  With at most 4 bits, such a ring has
at least four segments without a difference: the places of four equal segments
and their 32 bits are a join key, one for each of the 70 choices.  A pair that
meets on a key must have a segment from which all chains keep their budgets,
and then pass the full Hamming check.

Large groups of near copies: copies collapse to distinct fingerprints first.
Members of a key are linked to the key's smallest member (a star, linear in
the rows), components are taken, and only keys that still hold members of
several components are searched pair by pair across components.  The result is
the exact set of components without listing the pairs inside a group.

Defined results: null and empty texts have fingerprint zero and link like any
other; rows with the same id are separate rows; a null id never names a
component unless the component has no other id; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import as_column, bounded_batches, byte_view, owner, stored, word_spans
from tessera.llm.graph import components

SHINGLE = 4
MAX_BITS = 4
SEGMENTS = 8
WIDTH = 64 // SEGMENTS
SEED = 42


_SLICE = 1 << 18   # shingles unpacked to bits at a time (16 MB)


def _majority(hashes: np.ndarray, doc: np.ndarray, n: int) -> np.ndarray:
    """Per document the bits set in more than half of its hashes (``doc`` is
    ascending), as uint64."""
    ones = np.zeros((n, 64), np.int64)
    for at in range(0, hashes.size, _SLICE):
        part, who = hashes[at:at + _SLICE], doc[at:at + _SLICE]
        first = np.flatnonzero(np.concatenate([[True], who[1:] != who[:-1]]))
        bits = np.unpackbits(part.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones[who[first]] += np.add.reduceat(bits, first, axis=0, dtype=np.int64)
    count = np.bincount(doc, minlength=n)
    return np.packbits((2 * ones > count[:, None]).astype(np.uint8), axis=1, bitorder="little").view("<u8").ravel()


def fingerprints_of(arr, shingle: int = SHINGLE) -> np.ndarray:
    """uint64 fingerprint of every text of an Arrow column."""
    raw, off = byte_view(pc.ascii_lower(arr.cast(pa.large_string())))
    n = len(off) - 1
    starts, ends = word_spans(raw, off)
    doc = owner(starts, off)
    out = np.zeros(n, np.uint64)
    if not starts.size:
        return out
    # the words of all texts, joined by single spaces
    length = ends - starts
    at = np.concatenate([[0], np.cumsum(length + 1)])
    flat = np.full(at[-1], 32, np.uint8)
    flat[_ranges(at[:-1], length)] = raw[_ranges(starts, length)]
    text = flat.tobytes()
    count = np.bincount(doc, minlength=n)
    first = np.concatenate([[0], np.cumsum(count)[:-1]])
    # a shingle starts at each word with enough words after it in its
    # document, or at the first word of a shorter document
    rank = np.arange(starts.size) - first[doc]
    full = rank + shingle <= count[doc]
    short = (count[doc] < shingle) & (rank == 0)
    head = np.flatnonzero(full | short)
    last = np.where(full[head], head + shingle - 1, first[doc[head]] + count[doc[head]] - 1)
    lo, hi = at[head].tolist(), (at[last] + length[last]).tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(text[a:b], SEED) for a, b in zip(lo, hi)), np.uint64, len(lo))
    return _majority(hashes, doc[head], n)


def _ranges(first: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Concatenated aranges ``first[i] .. first[i] + length[i]``."""
    total = int(length.sum())
    base = np.repeat(first - np.concatenate([[0], np.cumsum(length)[:-1]]), length)
    return base + np.arange(total)


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``doc_id, fp (long), text_hash (long)`` of every row."""
    bounded_batches(docs.sparkSession)

    def run(batches):
        for b in batches:
            fp = fingerprints_of(as_column(b, "text"), shingle).view(np.int64)
            yield pa.RecordBatch.from_arrays([as_column(b, "doc_id"), pa.array(fp), as_column(b, "text_hash")],
                                             names=["doc_id", "fp", "text_hash"])

    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"),
                      F.xxhash64("text").alias("text_hash"))
    return src.mapInArrow(run, "doc_id long, fp long, text_hash long")


def _masks() -> list[int]:
    """The 70 choices of four whole segments, as signed 64-bit masks."""
    one = (1 << WIDTH) - 1
    masks = [sum(one << (k * WIDTH) for k in c) for c in itertools.combinations(range(SEGMENTS), SEGMENTS - MAX_BITS)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def ring_keys(fps: DataFrame) -> DataFrame:
    """``fp, places, bits``: the keys of every fingerprint."""
    masks = F.array(*[F.lit(m).cast("long") for m in _masks()])
    return fps.select("fp", F.posexplode(masks).alias("places", "mask")).select("fp", "places", F.col("fp").bitwiseAND(F.col("mask")).alias("bits"))


def _turn(x: Column, bits: int) -> Column:
    """Rotate right, so that a chain's first segment is the lowest."""
    return x if bits == 0 else F.shiftrightunsigned(x, bits).bitwiseOR(F.shiftleft(x, 64 - bits))


def chain_holds(a: Column, b: Column, max_bits: int) -> Column:
    """From some segment on, every chain keeps its budget, the whole ring
    included."""
    diff = a.bitwiseXOR(b)
    found = F.lit(False)
    for i in range(SEGMENTS):
        turned = _turn(diff, i * WIDTH)
        ok = F.lit(True)
        for l in range(1, SEGMENTS + 1):
            part = turned if l == SEGMENTS else turned.bitwiseAND(F.lit((1 << (l * WIDTH)) - 1))
            ok = ok & (F.bit_count(part) <= l * max_bits // SEGMENTS)
        found = found | ok
    return found


def links(fps: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Distinct ``fp`` values (a stored table) -> edges ``a, b`` whose
    components are those of all links."""
    if max_bits > MAX_BITS:
        raise ValueError("the ring's keys are laid out for at most 4 bits")
    key = ["places", "bits"]
    keyed = ring_keys(fps)
    # stored, so that both sides of the join are exchanged and a crowded key can be split
    heads = stored(keyed.groupBy(*key).agg(F.min("fp").alias("low"), F.max("fp").alias("high")).where("low <> high").select(*key, "low"), "ring-heads")
    # merged at every size, so that small inputs take the same way
    members = stored(keyed.join(heads.hint("merge"), key), "ring")
    near = F.bit_count(F.col("low").bitwiseXOR(F.col("fp"))) <= max_bits
    star = members.where((F.col("low") != F.col("fp")) & near).select(F.col("low").alias("a"), F.col("fp").alias("b")).distinct()
    star = stored(star, "star-links")
    comp = components(star)
    named = (members.join(comp, members["fp"] == comp["node"], "left")
                    .select(*key, "fp", F.coalesce("component", "fp").alias("comp")))
    # only keys that still hold members of several components
    split = named.groupBy(*key).agg(F.min("comp").alias("c1"), F.max("comp").alias("c2")).where("c1 <> c2").select(*key)
    open_ = stored(named.join(split, key, "left_semi"), "ring-open")
    x = open_.select(*key, F.col("fp").alias("a"), F.col("comp").alias("ca"))
    y = open_.select(F.col("places").alias("places2"), F.col("bits").alias("bits2"), F.col("fp").alias("b"), F.col("comp").alias("cb"))
    rest = x.join(y, (F.col("places") == F.col("places2")) & (F.col("bits") == F.col("bits2")) & (F.col("ca") < F.col("cb"))
                  & chain_holds(F.col("a"), F.col("b"), max_bits)
                  & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits)).select("a", "b").distinct()
    return star.unionByName(rest)


def groups(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, fingerprint`` (16 hex digits),
    ``component_id`` (smallest id reachable, itself included), ``group`` (one
    number per component, also where it has no id), ``text_hash``."""
    rows = stored(fingerprints(docs, shingle), "simhash")
    fps = stored(rows.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "simhash-distinct")
    comp = components(links(fps.select("fp"), max_bits))
    named = fps.join(comp, fps["fp"] == comp["node"], "left").select("fp", "first_id", F.coalesce("component", "fp").alias("comp"))
    lowest = named.groupBy("comp").agg(F.min("first_id").alias("component_id"))
    label = named.join(lowest, "comp").select(F.col("fp").alias("l_fp"), "component_id", F.col("comp").alias("group"))
    out = rows.join(label, rows["fp"] == F.col("l_fp"))
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", "group", "text_hash")
