"""Byte-level BPE encoding and decoding.

Texts are cut into the pattern's matches (``pretokens``), and each block of
texts is reduced to its distinct words, as arrays of byte tokens.  Spark
higher-order functions fold the ranked merges over these arrays: each step
looks up the rank of every neighbouring pair in a literal rank map and merges
the first pair of the lowest rank, until no pair has a rank.  A rank is the id
of the merged token.  The literal map is one array whose rows (of a left token)
are shifted into each other's gaps, so that a look-up is two indexes.  Ids of a text are the ids of its words in order;
decoding concatenates the binary pieces of the ids.

Everything is map-only: no text is shuffled, and a block (``BLOCK_BYTES`` of
texts at most, one text at least) bounds the memory.

Defined results: null and empty texts have no ids and decode to the empty
text; special strings are ordinary text; repeated rows are separate rows; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import base64
import functools
import json

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import as_column, bounded_batches, byte_view, release_memory
from tessera.llm.pretokens import byte_offsets, classes, code_points, cut
from tessera.llm.wordbpe import _ranges

BLOCK_BYTES = 32 << 20   # code points of a block
_LEFT, _MERGED = 47, 31   # bits of an entry: left token from 47, merged token from 31, index below
_MOST = (1 << 16) - 1      # token ids stay below
_TRIES = 1 << 11           # places tried at a time
_CUT_AT_ONCE = 1 << 20     # code points cut to words at a time


@functools.lru_cache(2)
def ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


def merge_pairs(table: dict[bytes, int]) -> list[tuple[int, int, int]]:
    """Every pair of tokens whose concatenation is a token: (left, right, it)."""
    return [(table[t[:k]], table[t[k:]], r) for t, r in table.items() for k in range(1, len(t))
            if t[:k] in table and t[k:] in table]


@functools.lru_cache(2)
def _literal(path: str) -> tuple[str, str]:
    """The rank map as two JSON literals: every left token has a place, and the
    entry of a pair lies in the table at the left token's place plus the right
    token.  An entry holds the left token, which tells it from an entry of
    another row, and the merged token.  The size is fixed by the vocabulary.

    Spark writes literals into plans and their descriptions, so the text is kept
    short: an empty entry is 0, that of the left token 0.  The row of token 0
    therefore stands alone behind all others, where empty entries bear a token
    whose row does not reach there."""
    rows: dict[int, dict[int, int]] = {}
    for a, b, merged in merge_pairs(ranks(path)):
        rows.setdefault(a, {})[b] = merged
    top = max(ranks(path).values()) + 1
    if top > _MOST:
        raise ValueError("token ids must be below 65535")
    size = 4 * max(top, sum(map(len, rows.values())))
    place, table, taken = np.zeros(top, np.int64), np.zeros(size + 3 * top, np.int64), np.zeros(size, bool)

    def put(a, right):
        table[place[a] + right] = a << _LEFT | np.array([rows[a][int(b)] for b in right], np.int64) << _MERGED

    # long rows first, each where its entries are free; rows of about one length go on where the last one was placed
    length = 0
    for a in sorted(rows.keys() - {0}, key=lambda a: (-len(rows[a]), a)):
        right = np.sort(np.fromiter(rows[a], np.int64, len(rows[a])))
        if length != int(right.size).bit_length():
            length, free, tried = int(right.size).bit_length(), np.flatnonzero(~taken), 0
        while True:
            at = free[tried:tried + _TRIES]
            at = at[at >= right[0]] - right[0]
            for b in right:
                at = at[~taken[at + b]]
            if at.size:
                break
            tried += _TRIES
        place[a] = at[0]
        taken[at[0] + right] = True
        put(a, right)
    if top > 1:
        other = 1 + int(place[1:].argmin())
        place[0] = max(int(np.flatnonzero(taken).max(initial=-1)) + 1, int(place[other]) + top)
        table[place[0]:] = other << _LEFT
    if 0 in rows:
        put(0, np.sort(np.fromiter(rows[0], np.int64, len(rows[0]))))
    # beyond the last entry there is none, whatever the right token
    table = table[:int(place.max()) + top]
    return json.dumps(place.tolist(), separators=(",", ":")), json.dumps(table.tolist(), separators=(",", ":"))


def _if(condition: Column, yes: Column, no: Column) -> Column:
    """A plain conditional: ``when`` walks a list of branches for every row."""
    return F.call_function("if", condition, yes, no)


def fold(word: Column, path: str) -> Column:
    """array<bigint> of byte tokens -> array<bigint> of the merged tokens."""
    place, table = _literal(path)
    lit_place = F.from_json(F.lit(place), "array<bigint>")
    lit_table = F.from_json(F.lit(table), "array<bigint>")

    def step(state: Column, _: Column) -> Column:
        n = F.size(state)

        def found(a: Column, i: Column) -> Column:
            # merged token and index of a pair with a rank; without one, the left tokens differ and leave high bits
            entry = F.get(lit_table, F.get(lit_place, a) + F.get(state, i + 1))
            return entry.bitwiseXOR(F.shiftleft(a, _LEFT)) + i

        def merge(low: Column) -> Column:
            at = low.bitwiseAND(F.lit((1 << _MERGED) - 1))
            merged = F.transform(F.slice(state, F.lit(1), n - 1), lambda a, i: _if(
                i < at, a, _if(i == at, F.shiftright(low, _MERGED), F.get(state, i + 1))))
            # a null at the end says that no pair has a rank any more
            return _if(low >= F.lit(1 << _LEFT), F.concat(state, F.array(F.lit(None).cast("long"))), merged)

        # the lowest rank, of equal ones the leftmost; the one-element array binds it, so that it is found once
        best = F.transform(F.array(F.array_min(F.transform(state, found))), merge)
        return _if((n < 2) | F.get(state, n - 1).isNull(), state, F.get(best, F.lit(0)))

    def done(state: Column) -> Column:
        n = F.size(state)
        return _if(F.get(state, n - 1).isNull(), F.slice(state, F.lit(1), n - 1), state)

    return F.when(F.size(word) < 2, word).otherwise(
        F.aggregate(F.sequence(F.lit(2), F.size(word)), word, step, done))


def _words(texts: list[str]) -> tuple[pa.DictionaryArray, np.ndarray]:
    """(all words in order, words per text)."""
    joined = "".join(texts)
    start_of = np.concatenate([[0], np.cumsum([len(t) for t in texts], dtype=np.int64)])
    cps = code_points(joined)
    edge = np.zeros(cps.size, bool)
    edge[start_of[:-1][np.diff(start_of) > 0]] = True
    head = np.flatnonzero(cut(cps, classes()[cps], edge, True))
    # words follow each other without gaps: one ends where the next one starts
    off = byte_offsets(cps)[np.append(head, cps.size)]
    words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), head.size, [None, pa.py_buffer(off), pa.py_buffer(joined.encode("utf-8"))])
    return words.dictionary_encode(), np.diff(np.searchsorted(head, start_of))


def _united(parts: list[pa.DictionaryArray]) -> tuple[bytes, pa.LargeBinaryArray]:
    """(codes of the parts' words in order, distinct words of all parts); no
    word becomes a Python object."""
    parts = pa.chunked_array(parts).unify_dictionaries().chunks
    return b"".join(p.indices.to_numpy(zero_copy_only=False).astype("<i4").tobytes() for p in parts), parts[0].dictionary


def _blocks(docs: DataFrame, path: str, block_bytes: int) -> DataFrame:
    """One row per block: its ids and word codes, and its distinct words as
    byte tokens (a word that is a token as that token)."""
    names = ["doc_id", "n_words", "codes", "words"]

    def run(batches):
        table = ranks(path)
        tokens, token_ids = pa.array(table.keys(), pa.large_binary()), np.fromiter(table.values(), np.int64, len(table))
        of_byte = np.zeros(256, np.int64)
        for k in range(256):
            of_byte[k] = table[bytes([k])]

        def block(ids, per_doc, parts):
            codes, words = _united(parts)
            raw, off = byte_view(words)
            found = pc.index_in(words, value_set=tokens).fill_null(-1).to_numpy(zero_copy_only=False)
            whole = np.where(found >= 0, token_ids[found], -1)
            size = np.where(whole >= 0, 1, np.diff(off))
            to = np.concatenate([[0], np.cumsum(size)])
            flat = np.empty(to[-1], np.int64)
            flat[to[:-1][whole >= 0]] = whole[whole >= 0]
            rest = np.flatnonzero(whole < 0)
            flat[_ranges(to[rest], size[rest])] = of_byte[raw[_ranges(off[rest], size[rest])]]
            lists = pa.ListArray.from_arrays(pa.array(to, pa.int32()), pa.array(flat))
            return pa.RecordBatch.from_arrays(
                [pa.array([ids], pa.list_(pa.int64())), pa.array([b"".join(per_doc)], pa.binary()),
                 pa.array([codes], pa.binary()),
                 pa.ListArray.from_arrays(pa.array([0, len(lists)], pa.int32()), lists)], names=names)

        # texts are cut some at a time; a block keeps their codes and distinct words
        ids, per_doc, parts, held = [], [], [], 0
        for b in batches:
            part_ids, texts = as_column(b, "doc_id").to_pylist(), [t or "" for t in as_column(b, "text").to_pylist()]
            ends = np.cumsum([0] + [len(t) for t in texts])
            a = 0
            while a < len(texts):
                z = max(a + 1, int(np.searchsorted(ends, ends[a] + _CUT_AT_ONCE, side="right")) - 1)
                if ids and held + int(ends[z] - ends[a]) > block_bytes:
                    yield block(ids, per_doc, parts)
                    ids, per_doc, parts, held = [], [], [], 0
                got, n = _words(texts[a:z])
                parts.append(got)
                per_doc.append(n.astype("<i4").tobytes())
                ids += part_ids[a:z]
                held += int(ends[z] - ends[a])
                a = z
        if ids:
            yield block(ids, per_doc, parts)
        del ids, per_doc, parts
        release_memory()

    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"))
    return src.mapInArrow(run, "doc_id array<bigint>, n_words binary, codes binary, words array<array<bigint>>")


def _pieces(path: str) -> pa.LargeBinaryArray:
    """The piece of every id; null where an id has none."""
    table = ranks(path)
    out = [None] * (max(table.values()) + 1)
    for piece, i in table.items():
        out[i] = piece
    return pa.array(out, pa.large_binary())


def _decoded(ids: np.ndarray, ends: np.ndarray, pieces: pa.LargeBinaryArray) -> pa.Array:
    """The pieces of ``ids``, concatenated between neighbouring ``ends``."""
    found = pieces.take(pa.array(ids, pa.uint32()))
    if found.null_count:
        raise ValueError("an id without a piece")
    raw, off = byte_view(found)
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(ends) - 1, [None, pa.py_buffer(off[ends]), pa.py_buffer(raw)]).cast(pa.binary())


def encode(docs: DataFrame, path: str, block_bytes: int = BLOCK_BYTES, decoded: bool = False) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, ids`` (binary: little-endian
    unsigned 32-bit integers), and with ``decoded`` the bytes that the ids
    stand for, as ``decode`` gives them (in the same Python worker)."""
    bounded_batches(docs.sparkSession)
    blocks = _blocks(docs, path, block_bytes).withColumn("words", F.transform("words", lambda w: fold(w, path)))

    def run(batches):
        pieces = _pieces(path) if decoded else None
        for b in batches:
            for k in range(b.num_rows):
                ids = as_column(b, "doc_id")[k].values
                per_doc = np.frombuffer(as_column(b, "n_words")[k].as_py(), "<i4")
                codes = np.frombuffer(as_column(b, "codes")[k].as_py(), "<i4")
                words = as_column(b, "words")[k].values
                off = words.offsets.to_numpy().astype(np.int64) if words is not None and len(words) else np.zeros(1, np.int64)
                flat = words.values.to_numpy(zero_copy_only=False).astype("<u4") if len(off) > 1 else np.zeros(0, "<u4")
                size = np.diff(off)
                ends = np.concatenate([[0], np.cumsum(per_doc)])
                # texts are put together some at a time: ids are four times their codes' space
                step = 64
                for a in range(0, len(per_doc), step):
                    z = min(a + step, len(per_doc))
                    part = codes[ends[a]:ends[z]]
                    out = flat[_ranges(off[part], size[part])] if part.size else flat[:0]
                    run_of = np.concatenate([[0], np.cumsum(size[part])])
                    text_ends = run_of[ends[a:z + 1] - ends[a]]
                    cuts = 4 * text_ends
                    got = pa.LargeBinaryArray.from_buffers(
                        pa.large_binary(), z - a, [None, pa.py_buffer(cuts.astype(np.int64)), pa.py_buffer(out.tobytes())]).cast(pa.binary())
                    cols = {"doc_id": ids.slice(a, z - a), "ids": got}
                    if decoded:
                        cols["decoded"] = _decoded(out, text_ends, pieces)
                    yield pa.RecordBatch.from_arrays(list(cols.values()), names=list(cols))
        release_memory()

    return blocks.mapInArrow(run, "doc_id bigint, ids binary" + ", decoded binary" * decoded)


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """``doc_id, ids`` -> plus ``decoded`` (binary)."""
    def run(batches):
        pieces = _pieces(path)
        for b in batches:
            raw, off = byte_view(as_column(b, "ids"))
            if (off % 4).any():
                raise ValueError("ids must be of 4 bytes each")
            yield pa.RecordBatch.from_arrays([as_column(b, "doc_id"), as_column(b, "ids"), _decoded(np.frombuffer(raw.tobytes(), "<u4"), off // 4, pieces)],
                                             names=["doc_id", "ids", "decoded"])

    return encoded.mapInArrow(run, "doc_id bigint, ids binary, decoded binary")


def digests(docs: DataFrame, path: str) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of every row."""
    out = encode(docs, path, decoded=True)
    return out.select("doc_id", (F.length("ids") / 4).cast("long").alias("n_tokens"),
                      F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
