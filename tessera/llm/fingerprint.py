"""Document fingerprints: a homomorphic multiset hash of paragraph pieces.

A text is a multiset of pieces: its paragraphs (lines), each cut after its
sentence ends (``.``, ``!``, ``?`` before a space) and after commas.  A piece of
more than ``LONG`` bytes is cut again by its content (after words, or code
points where there are no words, whose hash says so), so that texts without
marks have pieces, too, and an edit changes the pieces around it only.  Every
piece hashes to a wide vector, and the fingerprint is the sum of the vectors of all
pieces, so it does not depend on their order, and a piece is inserted or
deleted by adding or subtracting its vector:

* ``SKETCH`` lanes of +1 / -1, summed modulo 2^32 (a piece may repeat two
  thousand million times).  The
  inner product of two such sums estimates that of the two multisets, hence their likeness (cosine).
* ``EXACT`` lanes of uniform 64-bit numbers, summed modulo 2^64, and the
  number of pieces: equality of these means equality of the multisets up to hash
  collisions.

The edited text shares the pieces before the edit with its text: its
fingerprint is the sum of that of the kept pieces and that of the new end.

Defined results: null and empty texts have no piece and the zero fingerprint;
two empty texts are alike (1), an empty and another text are not (0); equal
texts have equal fingerprints and likeness 1; rows with the same id follow
each other in order of their texts, and the next document of the last row of
an id is the first row of the next id; rows with a null id form a sequence
before the first id, and the last id is followed by the first non-null id; a
single row is its own next; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import as_column, bounded_batches, following, stored

SKETCH = 256
EXACT = 4
_GROUP_BITS = 9        # ids per group of consecutive documents: 2^9


LONG = 160             # bytes of a piece that is not cut by its content
_MARKS = (". ", "! ", "? ", ", ")
_WORDS_PER_CUT = 8     # on average
_POINTS_PER_CUT = 24


def _by_content(piece: bytes) -> list[bytes]:
    """A long piece cut after the words, and a long word after the code
    points, that a hash of them (and for code points the three before) picks."""
    out, held = [], []
    low = xxhash.xxh3_64_intdigest
    for word in piece.split(b" "):
        if len(word) > LONG:
            chars = word.decode("utf-8", "surrogatepass")
            at = 0
            for k in range(3, len(chars)):
                if low(chars[k - 3:k + 1].encode("utf-8", "surrogatepass")) % _POINTS_PER_CUT == 0:
                    out.append(b" ".join([*held, chars[at:k + 1].encode("utf-8", "surrogatepass")]))
                    held, at = [], k + 1
            word = chars[at:].encode("utf-8", "surrogatepass")
        held.append(word)
        if low(word) % _WORDS_PER_CUT == 0:
            out.append(b" ".join(held))
            held = []
    out.append(b" ".join(held))
    return [p for p in (x.strip() for x in out) if p]


def pieces(text: str) -> list[bytes]:
    """Paragraph pieces of a text, blanks around them dropped."""
    raw = text.encode("utf-8", "surrogatepass")
    for mark in _MARKS:
        raw = raw.replace(mark.encode(), mark[:1].encode() + b"\n")
    found = [p for p in (x.strip() for x in raw.split(b"\n")) if p]
    if not any(len(p) > LONG for p in found):
        return found
    return [q for p in found for q in (_by_content(p) if len(p) > LONG else [p])]


def seam(text: str, at: int) -> int:
    """The last place up to ``at`` where one piece surely ends and the next
    begins, whatever follows ``at``."""
    return max(text.rfind("\n", 0, at) + 1, *(text.rfind(m, 0, at) + 2 if text.rfind(m, 0, at) >= 0 else 0 for m in _MARKS))


_STEP = np.uint64(0x9E3779B97F4A7C15)


def _words_of(keys: np.ndarray, n: int) -> np.ndarray:
    """``n`` pseudo-random 64-bit words for each 64-bit key."""
    x = keys[:, None] + _STEP * np.arange(1, n + 1, dtype=np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Fingerprint:
    """The sum of piece vectors; ``+`` and ``-`` insert and delete."""

    __slots__ = ("sketch", "exact", "count")

    def __init__(self, sketch=None, exact=None, count: int = 0):
        self.sketch = np.zeros(SKETCH, np.uint32) if sketch is None else sketch
        self.exact = np.zeros(2 * EXACT, np.uint64) if exact is None else exact
        self.count = count

    def __add__(self, other: "Fingerprint") -> "Fingerprint":
        return Fingerprint(self.sketch + other.sketch, self.exact + other.exact, self.count + other.count)

    def __sub__(self, other: "Fingerprint") -> "Fingerprint":
        return Fingerprint(self.sketch - other.sketch, self.exact - other.exact, self.count - other.count)

    def hex(self) -> str:
        return (self.sketch.astype("<u4").tobytes() + self.exact.astype("<u8").tobytes()
                + (self.count % 2 ** 64).to_bytes(8, "little")).hex()

    @classmethod
    def of_hex(cls, text: str) -> "Fingerprint":
        raw = bytes.fromhex(text)
        a, b = 4 * SKETCH, 4 * SKETCH + 16 * EXACT
        return cls(np.frombuffer(raw[:a], "<u4").astype(np.uint32), np.frombuffer(raw[a:b], "<u8").astype(np.uint64),
                   int.from_bytes(raw[b:], "little"))


_SLICE = 1 << 15


def of_pieces(parts: list[bytes]) -> Fingerprint:
    digest = xxhash.xxh3_128_intdigest
    low = (1 << 64) - 1
    sketch = np.zeros(SKETCH, np.int64)
    exact = np.zeros(2 * EXACT, np.uint64)
    for at in range(0, len(parts), _SLICE):
        h = [digest(p) for p in parts[at:at + _SLICE]]
        a = np.fromiter((x & low for x in h), np.uint64, len(h))
        b = np.fromiter((x >> 64 for x in h), np.uint64, len(h))
        bits = np.unpackbits(_words_of(a, SKETCH // 64).astype("<u8").view(np.uint8).reshape(len(h), -1), axis=1)
        sketch += 2 * bits.sum(axis=0, dtype=np.int64) - len(h)
        exact += np.concatenate([_words_of(a ^ _STEP, EXACT).sum(axis=0, dtype=np.uint64),
                                 _words_of(b, EXACT).sum(axis=0, dtype=np.uint64)])
    return Fingerprint((sketch % 2**32).astype(np.uint32), exact, len(parts))


def of_text(text: str | None) -> Fingerprint:
    return of_pieces(pieces(text or ""))


def likeness(x: Fingerprint, y: Fingerprint) -> float:
    """Estimated cosine of the two multisets, 0 to 1 (1 if equal)."""
    if x.count == y.count and np.array_equal(x.exact, y.exact) and np.array_equal(x.sketch, y.sketch):
        return 1.0
    if not x.count or not y.count:
        return 0.0
    a, b = x.sketch.astype(np.int32).astype(float), y.sketch.astype(np.int32).astype(float)
    norm = float(np.sqrt((a @ a) * (b @ b)))
    return min(1.0, max(0.0, float(a @ b) / norm)) if norm else 0.0


def edited(text: str, nxt: str) -> str:
    """The last floor(n/2) code points replaced by the first as many of ``nxt``."""
    half = len(text) // 2
    return text[:len(text) - half] + nxt[:half]


def _sequence(docs: DataFrame) -> DataFrame:
    """Every row in the group of its id's high bits, and each group's first
    following row once more as its tail, sorted inside groups: consecutive
    rows of a group are consecutive documents.  One shuffle of the texts.

    Rows of one id may repeat: the tail is the row of the next id with the
    smallest text.  Rows of a null id form the sequence before the first id.
    """
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    src = src.withColumn("grp", F.shiftright("doc_id", _GROUP_BITS))
    heads = src.groupBy("grp").agg(F.min("doc_id").alias("head"), F.max("doc_id").alias("last"))
    heads = stored(heads, "groups")
    nxt = following(heads.select(F.col("head").alias("doc_id")))
    first = heads.agg(F.min("head")).first()[0]
    # the group whose last row is followed by group ``head``
    tails = (heads.join(nxt, heads["head"] == nxt["doc_id"], "left")
                  .select(F.col("grp").alias("to_grp"), F.coalesce("next_id", F.lit(first)).alias("tail_id")))
    # a stored table has a known size: Spark joins it to the texts without
    # shuffling them while it is small
    tails = stored(tails, "tails")
    tail = src.join(tails, src["doc_id"].eqNullSafe(F.col("tail_id")))
    tail = tail.select("doc_id", "text", F.col("to_grp").alias("grp"), F.lit(1).alias("tail"))
    return src.select("doc_id", "text", "grp", F.lit(0).alias("tail")).unionByName(tail)


def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next`` for every row."""
    bounded_batches(docs.sparkSession)
    rows = _sequence(docs).repartition("grp").sortWithinPartitions("grp", "tail", "doc_id", "text")
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]

    def run(batches):
        last = None  # (grp, doc_id, text, fingerprint, pieces before the edit, their fingerprint)

        def pair(row, nxt_text, nxt_fp):
            text, fp = row[2], row[3]
            new = edited(text, nxt_text)
            # the pieces before the edit stay, those of the new end come
            efp = row[5] + of_text(new[row[4]:])
            return (row[1], len(text), hashlib.sha256(new.encode("utf-8", "surrogatepass")).hexdigest(), fp.hex(), efp.hex(),
                    likeness(fp, efp), likeness(fp, nxt_fp))

        done = False  # the group's tail has been used
        for b in batches:
            out = []
            for i, t, g, is_tail in zip(as_column(b, "doc_id").to_pylist(), as_column(b, "text").to_pylist(),
                                        as_column(b, "grp").to_pylist(), as_column(b, "tail").to_pylist()):
                fresh = last is None or last[0] != g
                if not fresh and done:
                    continue  # further rows of the tail's id
                cut = seam(t, len(t) - len(t) // 2)
                kept = of_text(t[:cut])
                fp = kept + of_text(t[cut:])
                if not fresh:
                    out.append(pair(last, t, fp))
                done = bool(is_tail)
                last = (g, i, t, fp, cut, kept)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c) if k else pa.array(c, pa.int64()) for k, c in enumerate(zip(*out))], names=names)

    return rows.mapInArrow(run, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")
