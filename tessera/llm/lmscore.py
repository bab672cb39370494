"""Language-model scoring with a weighted backoff automaton.

Model: word n-grams (``ORDER`` words) over the training documents, Dirichlet
smoothing at every order: ``p(w | ctx) = (c(ctx w) + MU p(w | shorter)) /
(c(ctx) + MU)``; the lowest order is ``(c + 0.5) / (N + 0.5 (V + 1))``.
As an automaton: every seen context is a state, every seen n-gram an arc with
its log-probability, and a state's failure arc leads to the next shorter context
with weight ``MU / (c(ctx) + MU)``.  A text is scored by one left-to-right
traversal that carries the state: it follows the arc of the next token, or
failure arcs until a state has one; the root has an arc for every token.

The model grows with the corpus and is nowhere held as a whole:
1. Documents are dealt to chunks of about ``CHUNK_BYTES``.  A chunk lists its
   distinct n-grams with their training counts, as sorted 64-bit keys packed by
   shard (ranges of the key space, so no shard is hot).
2. A shard adds up the counts of all chunks and answers each chunk with the
   totals, in the order of its keys, so an answer holds no key.
3. A chunk builds the part of the automaton that its documents can reach, and
   traverses all of them in step.

Keys are 64-bit hashes; with n distinct n-grams about n^2 / 2^65 pairs share a
key (less than one up to 6e9).  Training documents are those whose crc32 of
the id as text is not 1 modulo 5; a null id reads "null".

Defined results: null and empty texts hold the end token only; a corpus
without training documents gives every token the base probability; repeated rows
are separate documents; an empty table gives an empty result; other columns
are ignored.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import bounded_batches, byte_view, chunk_count, encode_spans, mixed, owner, stored, texts, word_spans

ORDER = 2
MU = 500.0
CHUNK_BYTES = 6 << 20
_TIMES = np.uint64(0xD6E8FEB86659FD93)
# hashes of the two marks; a word never holds a blank
START, END = (np.uint64(xxhash.xxh3_64_intdigest(m)) for m in (b" start", b" end"))


def held_out(doc_id: int | None) -> bool:
    return zlib.crc32(("null" if doc_id is None else str(doc_id)).encode()) % 5 == 1


class Grams:
    """Tokens of a chunk's documents and the keys of their n-grams."""

    def __init__(self, ids: list, text, order: int):
        raw, off = byte_view(pc.ascii_lower(text.cast(pa.large_string())))
        starts, ends = word_spans(raw, off)
        doc = owner(starts, off)
        codes, words = encode_spans(raw, starts, ends)
        self.order = order
        self.n_docs = len(ids)
        # the vocabulary of the chunk: the end mark, then its words
        self.vocab = np.concatenate([[END], np.fromiter((xxhash.xxh3_64_intdigest(w) for w in words.to_pylist()), np.uint64, len(words))])
        count = np.bincount(doc, minlength=self.n_docs) + 1
        self.first = np.concatenate([[0], np.cumsum(count)])
        self.tok = np.zeros(self.first[-1], np.int64)      # 0 is the end mark
        if codes.size:
            rank = np.arange(codes.size) - np.concatenate([[0], np.cumsum(count - 1)])[doc]
            self.tok[self.first[doc] + rank] = codes + 1
        self.length = count
        train = np.array([not held_out(i) for i in ids], bool)
        self.held = ~train
        weight = np.repeat(train, count)
        who = np.repeat(np.arange(self.n_docs), count)
        place = np.arange(self.tok.size) - self.first[who]
        hashes = self.vocab[self.tok]
        # key of the n-gram of each order that ends at each token; contexts
        # that begin before the text hold the start mark once
        self.at, self.tables = [], []
        key = mixed(hashes * _TIMES)
        for m in range(1, order + 1):
            if m > 1:
                ok = place >= m - 2        # the mark is the farthest context
                back = np.where(place >= m - 1, np.roll(hashes, m - 1), START)
                key = mixed(key * _TIMES + back)
            else:
                ok = np.ones(self.tok.size, bool)
            tagged = (key & ~np.uint64(7)) | np.uint64(m)
            uniq, inv = np.unique(tagged[ok], return_inverse=True)
            where = np.full(self.tok.size, -1, np.int64)
            where[ok] = inv
            self.at.append(where)
            self.tables.append((uniq, np.bincount(inv, weights=weight[ok], minlength=uniq.size).astype(np.int64)))
        # the start mark as a context: as many as training documents
        self.keys = np.concatenate([t[0] for t in self.tables])
        self.counts = np.concatenate([t[1] for t in self.tables])
        self.base = np.cumsum([0] + [t[0].size for t in self.tables])
        self.sort = np.argsort(self.keys, kind="stable")
        self.n_train = int(train.sum())


def _planes(x: np.ndarray) -> bytes:
    """Bytes of integers, most alike bytes together, for the shuffle's codec."""
    return np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(-1, 8).T).tobytes()


def _unplanes(b: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(b, np.uint8).reshape(8, -1).T).view("<u8").ravel()


def _chunked(docs: DataFrame, n: int) -> DataFrame:
    return texts(docs).withColumn("chunk", F.pmod(F.xxhash64("doc_id", "text"), F.lit(n)))


def _requests(chunks: DataFrame, order: int, shards: int) -> DataFrame:
    bits = np.uint64(64 - (shards.bit_length() - 1))

    def run(key, table):
        g = Grams(table.column("doc_id").to_pylist(), table.column("text").combine_chunks(), order)
        keys, counts = g.keys[g.sort], g.counts[g.sort]
        shard = (keys >> bits).astype(np.int64) if shards > 1 else np.zeros(keys.size, np.int64)
        edge = np.searchsorted(shard, np.arange(shards + 1))
        rows = [(s, a, z) for s, (a, z) in enumerate(zip(edge[:-1], edge[1:])) if z > a]
        chunk = key[0].as_py()
        return pa.table({
            "shard": pa.array([r[0] for r in rows], pa.int64()), "chunk": pa.array([chunk] * len(rows), pa.int64()),
            "keys": pa.array([_planes(np.diff(keys[a:z], prepend=np.uint64(0))) for _, a, z in rows], pa.binary()),
            "counts": pa.array([_planes(counts[a:z]) for _, a, z in rows], pa.binary())})

    return chunks.groupBy("chunk").applyInArrow(run, "shard long, chunk long, keys binary, counts binary")


def _answers(requests: DataFrame) -> DataFrame:
    """(chunk, shard, totals) and, once per shard, the number of training
    tokens and of distinct ones."""
    def run(key, table):
        ks = [np.cumsum(_unplanes(b), dtype=np.uint64) for b in table.column("keys").to_pylist()]
        cs = [_unplanes(b).astype(np.int64) for b in table.column("counts").to_pylist()]
        uniq, inv = np.unique(np.concatenate(ks), return_inverse=True)
        total = np.bincount(inv, weights=np.concatenate(cs), minlength=uniq.size).astype(np.int64)
        single = (uniq & np.uint64(7)) == 1
        n, v = int(total[single].sum()), int((total[single] > 0).sum())
        cut = np.cumsum([0] + [k.size for k in ks])
        size = len(ks)
        return pa.table({
            "chunk": table.column("chunk"), "shard": pa.array([key[0].as_py()] * size, pa.int64()),
            "totals": pa.array([_planes(total[inv[a:z]]) for a, z in zip(cut[:-1], cut[1:])], pa.binary()),
            "n": pa.array([n] + [0] * (size - 1), pa.int64()), "v": pa.array([v] + [0] * (size - 1), pa.int64())})

    return requests.groupBy("shard").applyInArrow(run, "chunk long, shard long, totals binary, n long, v long")


class Automaton:
    """The states and arcs that a chunk's documents can reach.

    State 0 is the root, with an arc for every token.  ``keys`` are the other
    arcs, sorted, as ``state << 32 | token``.
    """

    def __init__(self, g: Grams, totals: np.ndarray, n: int, v: int, n_train: int, mu: float):
        self.g = g
        per = [totals[a:z] for a, z in zip(g.base[:-1], g.base[1:])]
        tok_of = np.zeros(g.tables[0][0].size, np.int64)
        tok_of[g.at[0]] = g.tok
        self.count = np.zeros(g.vocab.size, np.int64)
        self.count[tok_of] = per[0]
        self.root = np.log10((self.count + 0.5) / (n + 0.5 * (v + 1)))
        # states: the start mark, then every n-gram below the highest order
        # that training has seen (as a context)
        self.fail, self.bow = [0, 0], [0.0, np.log10(mu / (n_train + mu)) if n_train else 0.0]
        self.fail, self.bow = np.array(self.fail), np.array(self.bow)
        state = []             # per order below the highest: state of each n-gram, or the state it falls to
        arcs, weight, target = [], [], []
        self.root_next = np.zeros(g.vocab.size, np.int64)
        lower = None           # probability of each n-gram of the order below
        place = np.arange(g.tok.size) - np.repeat(g.first[:-1], g.length)
        for m in range(1, g.order + 1):
            uniq = g.tables[m - 1][0]
            where = g.at[m - 1]
            ok = where >= 0
            # one occurrence stands for each n-gram: it has the shorter ones
            rep = np.zeros(uniq.size, np.int64)
            rep[where[ok]] = np.flatnonzero(ok)
            c = per[m - 1]
            if m == 1:
                prob = 10.0 ** self.root[g.tok[rep]]
                source = np.zeros(uniq.size, np.int64)
                c_ctx = None
            else:
                short = lower[g.at[m - 2][rep]]
                prev = rep - 1
                if m == 2:
                    begin = place[rep] == 0
                    c_ctx = np.where(begin, n_train, per[0][g.at[0][np.maximum(prev, 0)]])
                    source = np.where(begin, 1, state[0][g.at[0][np.maximum(prev, 0)]])
                else:
                    # the context's own n-gram ends one token before; with the
                    # mark in front it is the n-gram of the lower order there
                    c_ctx = per[m - 2][g.at[m - 2][np.maximum(prev, 0)]]
                    source = state[m - 2][g.at[m - 2][np.maximum(prev, 0)]]
                prob = (c + mu * short) / (c_ctx + mu)
            lower = prob
            if m < g.order:
                seen = c > 0
                falls = np.zeros(uniq.size, np.int64) if m == 1 else state[m - 2][g.at[m - 2][rep]]
                own = np.where(seen, self.fail.size + np.cumsum(seen) - 1, falls)
                self.fail = np.concatenate([self.fail, falls[seen]])
                self.bow = np.concatenate([self.bow, np.log10(mu / (c[seen] + mu))])
                state.append(own)
                goes = own
            else:
                goes = state[m - 2][g.at[m - 2][rep]] if m > 1 else np.zeros(uniq.size, np.int64)
            if m == 1:
                self.root_next[tok_of] = goes
            else:
                use = c > 0
                arcs.append(source[use] << 32 | g.tok[rep][use])
                weight.append(np.log10(prob[use]))
                target.append(goes[use])
        keys = np.concatenate(arcs) if arcs else np.zeros(0, np.int64)
        order = np.argsort(keys)
        self.keys = keys[order]
        self.weight = np.concatenate(weight)[order] if arcs else np.zeros(0)
        self.target = np.concatenate(target)[order] if arcs else np.zeros(0, np.int64)

    def traverse(self) -> np.ndarray:
        """Score of every document: all documents move one token per step."""
        g = self.g
        long_first = np.argsort(-g.length, kind="stable")
        begin, length = g.first[:-1][long_first], g.length[long_first]
        # every text starts after its start mark; single words have no context
        score, state = np.zeros(g.n_docs), np.full(g.n_docs, 0 if g.order == 1 else 1, np.int64)
        active = g.n_docs
        for t in range(int(length[0]) if length.size else 0):
            while active and length[active - 1] <= t:
                active -= 1
            tok = g.tok[begin[:active] + t]
            live, st = np.arange(active), state[:active].copy()
            while live.size:
                at_root = st == 0
                key = st << 32 | tok[live]
                at = np.minimum(np.searchsorted(self.keys, key), max(self.keys.size - 1, 0))
                hit = (self.keys[at] == key) & ~at_root if self.keys.size else np.zeros(live.size, bool)
                x = live[hit]
                score[x] += self.weight[at[hit]]
                state[x] = self.target[at[hit]]
                x = live[at_root]
                score[x] += self.root[tok[x]]
                state[x] = self.root_next[tok[x]]
                miss = ~hit & ~at_root
                score[live[miss]] += self.bow[st[miss]]
                live, st = live[miss], self.fail[st[miss]]
        out = np.zeros(g.n_docs)
        out[long_first] = score
        return out


_OUT = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def score(docs: DataFrame, order: int = ORDER, mu: float = MU, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, held_out, n_tokens, n_known,
    train_tokens, base_score, score``."""
    if not 1 <= order <= 7:
        raise ValueError("order must be 1 to 7")
    bounded_batches(docs.sparkSession)
    n_chunks = chunk_count(docs, chunk_bytes)
    shards = 1 << max(0, (2 * n_chunks - 1).bit_length())
    chunks = _chunked(docs, n_chunks)
    answers = stored(_answers(_requests(chunks, order, shards)), "lm-answers")
    n, v = answers.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("v"), F.lit(0))).first()
    # training documents: the training count of the end mark, counted by ids
    n_train = int(docs.select(F.sum(F.when(F.crc32(F.coalesce(F.col("doc_id").cast("long").cast("string"), F.lit("null")).cast("binary")) % 5 != 1, 1)
                                    .otherwise(0))).first()[0] or 0)

    def run(key, left, right):
        if not left.num_rows:
            return pa.table({k: pa.array([], t) for k, t in zip(
                ("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"),
                (pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64()))})
        ids = left.column("doc_id")
        g = Grams(ids.to_pylist(), left.column("text").combine_chunks(), order)
        parts = sorted(zip(right.column("shard").to_pylist(), right.column("totals").to_pylist()))
        totals = np.empty(g.keys.size, np.int64)
        totals[g.sort] = np.concatenate([_unplanes(b) for _, b in parts]).astype(np.int64)
        auto = Automaton(g, totals, n, v, n_train, mu)
        who = np.repeat(np.arange(g.n_docs), g.length)
        known = np.bincount(who, weights=auto.count[g.tok] > 0, minlength=g.n_docs).astype(np.int64)
        base = np.bincount(who, weights=auto.root[g.tok], minlength=g.n_docs)
        return pa.table({"doc_id": ids, "held_out": pa.array(g.held), "n_tokens": pa.array(g.length.astype(np.int64)), "n_known": pa.array(known),
                         "train_tokens": pa.array([n] * g.n_docs, pa.int64()), "base_score": pa.array(base), "score": pa.array(auto.traverse())})

    return chunks.groupBy("chunk").cogroup(answers.select("chunk", "shard", "totals").groupBy("chunk")).applyInArrow(run, _OUT)
