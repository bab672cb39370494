"""Spelling variants: words that differ by one inserted, deleted or replaced
code point, grouped under their frequent forms.

One edit changes the letter counts of a word by one letter more, one letter
less, or both: the L1 distance of the count vectors is at most two.  Words are
points of k-d trees over their counts, one per length, and two range searches
find all candidates: (length, same length) with at most one letter more and one
less, (length, next length) with one letter more and none less.

1. The top of each length's tree is fitted on a sample of about ``SAMPLE``
   words (by their hashes) and cuts the space into cells of about ``CELL`` words; every
   word is then dealt to its cell.  The sample only places the cuts.
2. A word visits each other cell whose box its range meets (of a pair of cells
   of one length only the later one is visited).  Cells that turn out large
   are dealt over chunks, which a visitor meets one by one.
3. In its cell a k-d tree with tight boxes prunes the range search, and the
   letter order of each candidate is verified.  Every near pair is found once,
   counted at both ends, and aggregated per word.
4. Roots follow the forms by pointer doubling: forms are at least ``RATIO``
   times as frequent, so chains are short.

Defined results: null texts have no words; a null id reads ``null`` in the
checksum; repeated rows count again; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm import kdtree
from tessera.llm.common import as_column, bounded_batches, byte_view, encode_spans, owner, release_memory, stored

MIN_LETTERS = 7
MIN_COUNT = 2
RATIO = 10
EVERY = 31
SAMPLE = 1 << 17
CELL = 1 << 14
_LEAF = 16
_HELD = 1 << 17          # distinct words a task gathers before it hands them on
_PAIRS = 1 << 17
_CODES = 1 << 21
_ASKED = 1 << 12
_WORDS = 10_000          # words of one Arrow batch


# ------------------------------------------------------------------- words

def _spans(raw: np.ndarray, off: np.ndarray):
    """Start, end and code points of every maximal run of letters a-z and
    U+00C0-U+00FF (in UTF-8: 0xC3 and the byte after it)."""
    if not raw.size:
        e = np.zeros(0, np.int64)
        return e, e, e
    lead = raw == 0xC3
    inside = ((raw >= 97) & (raw <= 122)) | lead
    inside[1:] |= lead[:-1]
    edge = np.zeros(raw.size + 1, bool)
    edge[off] = True
    start = inside.copy()
    start[1:] &= ~inside[:-1] | edge[1:-1]
    end = inside.copy()
    end[:-1] &= ~inside[1:] | edge[1:-1]
    a, b = np.flatnonzero(start), np.flatnonzero(end) + 1
    leads = np.flatnonzero(lead)
    return a, b, b - a - (np.searchsorted(leads, b) - np.searchsorted(leads, a))


def _batch_words(ids: list, text, min_letters: int, every: int) -> dict[str, int]:
    """Words of a batch of texts with their numbers; a run whose checksum
    ``every`` divides loses one code point."""
    raw, off = byte_view(pc.ascii_lower(text.cast(pa.large_string())))
    a, b, size = _spans(raw, off)
    long = size >= min_letters
    a, b, size = a[long], b[long], size[long]
    doc = owner(a, off)
    code, names = encode_spans(raw, a, b)
    names = names.to_pylist()
    both, times = np.unique(doc * max(len(names), 1) + code, return_counts=True)
    who, what = np.divmod(both, max(len(names), 1))
    head = [zlib.crc32(b"%s:" % ("null" if i is None else str(i)).encode()) for i in ids]
    crc = zlib.crc32
    check = np.fromiter((crc(names[w], head[d]) for w, d in zip(what.tolist(), who.tolist())), np.int64, both.size)
    cut = check % every == 0
    plain = np.bincount(what[~cut], weights=times[~cut], minlength=len(names)).astype(np.int64)
    out = {names[k].decode(): n for k, n in enumerate(plain.tolist()) if n}
    for w, h, n in zip(what[cut].tolist(), check[cut].tolist(), times[cut].tolist()):
        word = names[w].decode()
        at = h % len(word)
        word = word[:at] + word[at + 1:]
        if len(word) >= min_letters:
            out[word] = out.get(word, 0) + n
    return out


def words(docs: DataFrame, min_letters: int = MIN_LETTERS, min_count: int = MIN_COUNT, every: int = EVERY) -> DataFrame:
    """``word, n`` over all documents."""
    bounded_batches(docs.sparkSession)

    def run(batches):
        held: dict[str, int] = {}

        def rows():
            return pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], names=["word", "n"])
        for b in batches:
            for word, n in _batch_words(as_column(b, "doc_id").to_pylist(), as_column(b, "text"), min_letters, every).items():
                held[word] = held.get(word, 0) + n
            if len(held) >= _HELD:
                yield rows()
                held.clear()
        yield rows()
        held.clear()
        release_memory()

    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    return src.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


# ------------------------------------------------------------------- cells

class Cells:
    """The tops of the trees: where a word lives and which cells it visits.
    A cell is ``length << 20 | leaf``; lengths without a tree are one cell."""

    def __init__(self, sample: list[str], total: int, cell: int):
        self.trees = {}
        # a leaf holds at least 32 words of the sample: at most SAMPLE / 32 cells
        leaf = max(32, cell * len(sample) // max(total, 1))
        by_length: dict[int, list] = {}
        for w in sample:
            by_length.setdefault(len(w), []).append(w)
        for length, some in by_length.items():
            if len(some) > leaf:
                counts = kdtree.letter_counts(kdtree.letters(sorted(some)))
                bits = kdtree.layout(counts)
                self.trees[length] = bits, kdtree.Tree(kdtree.unary(counts, bits), leaf, tight=False)

    def _visit(self, counts: np.ndarray, length: int, gain: int, loss: int):
        if length not in self.trees:
            return np.arange(len(counts)), np.full(len(counts), length << 20, np.int64)
        bits, tree = self.trees[length]
        who, node = tree.reach(kdtree.unary(counts, bits), gain, loss)
        return who, (length << 20) + tree.number[node]

    def deal(self, some: list[str]):
        """For words of one length: (word, own cell), (word, other cell of the
        length), (word, cell of the next length)."""
        length, counts = len(some[0]), kdtree.letter_counts(kdtree.letters(some))
        who, cell = self._visit(counts, length, 0, 0)
        own = np.empty(len(some), np.int64)
        own[who] = cell
        who, cell = self._visit(counts, length, 1, 1)
        later = cell > own[who]
        return own, (who[later], cell[later]), self._visit(counts, length + 1, 1, 0)


_RESIDENT, _SAME, _SHORTER = 0, 1, 2


def _by_length(some: list[str]) -> dict[int, list[int]]:
    groups: dict[int, list[int]] = {}
    for k, w in enumerate(some):
        groups.setdefault(len(w), []).append(k)
    return groups


def _dealt(table: DataFrame, cells: Cells, chunks: dict[int, int]) -> DataFrame:
    """Rows ``cell, chunk, kind, word, n``: residents and visitors."""
    def run(batches):
        for b in batches:
            names, numbers = as_column(b, "word").to_pylist(), as_column(b, "n").to_numpy()
            for at in _by_length(names).values():
                some = [names[k] for k in at]
                n = numbers[at]
                own, same, longer = cells.deal(some)
                mine = np.fromiter((zlib.crc32(w.encode()) for w in some), np.int64, len(some)) % [chunks.get(c, 1) for c in own.tolist()]
                who, cell, chunk, kind = [np.arange(len(some))], [own], [mine], [np.full(len(some), _RESIDENT)]
                for w, c, k in ((*same, _SAME), (*longer, _SHORTER)):
                    parts = np.array([chunks.get(x, 1) for x in c.tolist()], np.int64)
                    who.append(np.repeat(w, parts))
                    cell.append(np.repeat(c, parts))
                    chunk.append(np.arange(int(parts.sum())) - np.repeat(np.cumsum(parts) - parts, parts))
                    kind.append(np.full(chunk[-1].size, k))
                # later chunks of the own cell
                for k, (c, m) in enumerate(zip(own.tolist(), mine.tolist())):
                    rest = np.arange(m + 1, chunks.get(c, 1))
                    if rest.size:
                        who.append(np.full(rest.size, k))
                        cell.append(np.full(rest.size, c))
                        chunk.append(rest)
                        kind.append(np.full(rest.size, _SAME))
                who, cell, chunk, kind = (np.concatenate(x) for x in (who, cell, chunk, kind))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cell, pa.int64()), pa.array(chunk.astype(np.int32)), pa.array(kind.astype(np.int8)),
                     pa.array(some, pa.string()).take(pa.array(who)), pa.array(n[who], pa.int64())],
                    names=["cell", "chunk", "kind", "word", "n"])

    return table.mapInArrow(run, "cell long, chunk int, kind byte, word string, n long")


# ------------------------------------------------------------------- search

def _replaced(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a != b).sum(1) == 1


def _inserted(short: np.ndarray, long: np.ndarray) -> np.ndarray:
    """The longer word is the shorter with one more code point."""
    size = short.shape[1]
    front, back = short == long[:, :-1], short == long[:, 1:]
    same_front = np.where(front.all(1), size, front.argmin(1))
    same_back = np.where(back.all(1), size, back[:, ::-1].argmin(1))
    return same_front + same_back >= size


def near_pairs(residents: list[str], visitors: list[str], shorter: list[str]):
    """Near pairs (row, resident) by a k-d tree over the residents, which are
    of one length: rows number residents, visitors of that length and shorter
    visitors one after the other."""
    codes = kdtree.letters(residents)
    counts = kdtree.letter_counts(codes)
    bits = kdtree.layout(counts)
    points = kdtree.unary(counts, bits)
    tree = kdtree.Tree(points, _LEAF)
    rows, near = [], []
    first = 0
    for kind, some in ((_RESIDENT, residents), (_SAME, visitors), (_SHORTER, shorter)):
        for at in range(0, len(some), _ASKED):
            part = some[at:at + _ASKED]
            mine = kdtree.letters(part)
            q = kdtree.unary(kdtree.letter_counts(mine), bits)
            loss = 0 if kind == _SHORTER else 1
            limit = max(1, min(_PAIRS, _CODES // codes.shape[1]))
            for who, point in tree.members(*tree.reach(q, 1, loss), limit):
                if kind == _RESIDENT:
                    later = point > who + at
                    who, point = who[later], point[later]
                gain, less = kdtree.off_box(q[who], points[point], points[point])
                use = (gain <= 1) & (less <= loss)
                who, point = who[use], point[use]
                use = (_inserted if kind == _SHORTER else _replaced)(mine[who], codes[point])
                rows.append(who[use] + at + first)
                near.append(point[use])
        first += len(some)
    return (np.concatenate(rows), np.concatenate(near)) if rows else (np.zeros(0, np.int64),) * 2


_FOUND = "word string, n_near long, near_n long, near string"


def _search(table):
    kind = table.column("kind").to_numpy()
    name, n = table.column("word").to_pylist(), table.column("n").to_numpy()
    at = [np.flatnonzero(kind == k) for k in (_RESIDENT, _SAME, _SHORTER)]
    every = np.concatenate(at)
    if not at[0].size:
        return pa.table({"word": pa.array([], pa.string()), "n_near": pa.array([], pa.int64()), "near_n": pa.array([], pa.int64()), "near": pa.array([], pa.string())})
    row, near = near_pairs(*([name[k] for k in part] for part in at))
    a, b = np.concatenate([every[row], at[0][near]]), np.concatenate([at[0][near], every[row]])
    # rank: largest n first, then code-point order
    order = sorted(range(len(name)), key=lambda k: (-n[k], name[k]))
    rank = np.empty(len(name), np.int64)
    rank[order] = np.arange(len(name))
    best = np.full(len(name), len(name))
    np.minimum.at(best, a, rank[b])
    count = np.bincount(a, minlength=len(name))
    use = np.flatnonzero(count)
    form = np.asarray(order, np.int64)[best[use]]
    release_memory()
    return pa.table({"word": pa.array([name[k] for k in use], pa.string()), "n_near": pa.array(count[use], pa.int64()),
                     "near_n": pa.array(n[form], pa.int64()), "near": pa.array([name[k] for k in form], pa.string())})


def near_words(table: DataFrame, cell: int = CELL, sample: int = SAMPLE) -> DataFrame:
    """``word, n`` (a stored table) -> ``word, n_near, near_n, near`` of the
    words that have near words; ``near`` is the most frequent one."""
    total = table.count()
    # some ``sample`` words by their hashes: the same ones under any partitioning
    share = F.pmod(F.xxhash64("word"), F.lit(1 << 30)) < int((1 << 30) * min(1.0, sample / max(total, 1)))
    cells = Cells(table.where(share).select("word").toArrow().column("word").to_pylist(), total, cell)

    def count(batches):
        for b in batches:
            names = as_column(b, "word").to_pylist()
            own = [cells.deal([names[k] for k in at])[0] for at in _by_length(names).values()]
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(own) if own else [], pa.int64())], names=["cell"])

    # the cells that need several chunks: at most one per 4 * cell words
    large = table.select("word").mapInArrow(count, "cell long").groupBy("cell").count().where(F.col("count") > 4 * cell).toArrow()
    chunks = {c: -(-n // (2 * cell)) for c, n in zip(large.column("cell").to_pylist(), large.column("count").to_pylist())}
    found = _dealt(table, cells, chunks).groupBy("cell", "chunk").applyInArrow(_search, _FOUND)
    best = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("near"))).alias("b")
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best).select(
        "word", "n_near", (-F.col("b.less")).alias("near_n"), F.col("b.near").alias("near"))


def _roots(links: DataFrame) -> DataFrame:
    """``word, form`` -> ``word, root``: every round follows the forms found
    so far, so chains halve."""
    cur = stored(links.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        up = cur.select(F.col("word").alias("u_word"), F.col("root").alias("up"))
        step = stored(cur.join(up, cur["root"] == F.col("u_word"), "left").select("word", F.coalesce("up", "root").alias("root"),
                                                                                 F.col("up").isNotNull().alias("moved")), "spelling-roots")
        cur = step.select("word", "root")
        if step.where("moved").isEmpty():
            return cur


def variants(table: DataFrame, ratio: int = RATIO, **options) -> DataFrame:
    """``word, n`` -> ``word, form, root, n, n_near, form_n``."""
    table = stored(table.select("word", "n"), "spelling-words")
    bounded_batches(table.sparkSession, _WORDS)
    near = stored(near_words(table, **options).withColumnRenamed("word", "v_word"), "spelling-near")
    out = table.join(near, F.col("word") == F.col("v_word"), "left")
    use = F.col("near_n") >= ratio * F.col("n")
    out = stored(out.select("word", F.when(use, F.col("near")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                            F.when(use, F.col("near_n")).alias("form_n")), "spelling-forms")
    roots = _roots(out.where("form is not null")).withColumnRenamed("word", "r_word")
    return out.join(roots, F.col("word") == F.col("r_word"), "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def grouped(docs: DataFrame, **options) -> DataFrame:
    """Spelling variants among the words of all documents."""
    return variants(words(docs), **options)
