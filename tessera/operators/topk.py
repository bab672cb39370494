"""Exact best-k masters per name without a score threshold.

The combined score is 0.4 * character score + 0.6 * word Jaccard, plus a bonus
for an equal conference, capped at 1.  Without a threshold a pair counts even
if the two names share no word, so no join key finds all pairs.  Here names
leave in rounds, each with a lower bound on what can still matter:

1. ``SURE``: the prefix-filtered join of ``match.fuzzy_candidates`` finds every
   pair of at least that score.  A name whose k-th score reaches it is done.
   Names whose words stand in more than ``PAIRS`` masters skip this round: a
   tile is cheaper for them than their pairs.
2. The masters lie in tiles (ranges of conference and name).  In a tile, masters
   that share a rare word with the name are bound one by one.  All others share
   frequent words only, so masters of one length, word count, set of frequent
   words, conference and attribute (a kind) have one word Jaccard with it, and
   the k-th score says how long a common subsequence must be.  The names of a
   kind are a tree of prefixes: names walk down it together, the common
   subsequence of a prefix is kept as bits of a number, and a branch is left
   when what is left of both names cannot make it long enough.  What remains is
   scored exactly from its greatest bound down, once for each distinct master
   name, and the search ends when the next bound is below the name's k-th score
   (or equal to it, and a later row).  A name first asks the tile that shares
   most words with it; masters next to it in name order give its first k-th score.
3. With the k-th score found there, it asks the other tiles, unless the tile's
   bound (words shared with the tile as a whole, its conferences) is below it.

Of masters that agree in name, conference and attribute the first ``k`` rows are
in the tiles: no others can be among the best ``k``.
Every result is final; nothing is left ``incomplete``, and the pairs of a
conference or of a frequent word are never listed.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort
from collections.abc import Callable
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.similarity import BONUS, JAC_WEIGHT, SEQ_WEIGHT, seq_ratio_py
from tessera.functions.text import word_tokens
from tessera.operators import match
from tessera.sources.sinks import cut_lineage

SURE = 0.75
PAIRS = 128               # masters that hold a name's words, for the first round
TILE_ROWS = 100_000
BLOCK = 20_000            # names that one task asks a tile about, at most
LEAST_BLOCK, GROUPS = 1024, 48      # fewer names of a task, for this many tasks
RARE = 128                # masters of a tile that hold a word, to be bound one by one
BATCH = 256               # names that walk down a tile together
WIDE, LEAVES = 1 << 20, 1 << 22     # steps taken at once; pairs kept until they are scored
_EPS = 1e-9
_LOW = np.array([(1 << n) - 1 for n in range(65)], np.uint64)       # the n lowest bits


def _longest(a: str, b: str) -> tuple[int, int, int]:
    """(place in ``a``, place in ``b``, length) of the longest common piece,
    of several the first in ``a``, then the first in ``b``."""
    most = min(len(a), len(b))
    least = next((n for n in range(most) if a[n] != b[n]), most)      # both begin alike so far
    found, n = (0, 0, least), least + 1
    while least < most:
        size = len(a) + 1 - n
        for i in range(size):
            j = b.find(a[i:i + n])
            if j >= 0:
                found, least = (i, j, n), n
                break
        else:
            most = n - 1
        n = (least + most + 1) // 2
    return found


def ratio_py(a: str, b: str) -> float:
    """``seq_ratio_py``: the same number, found faster on short names."""
    a, b = (a or "").lower(), (b or "").lower()
    if len(b) >= 200:                   # difflib has rules of its own there
        return seq_ratio_py(a, b)
    if not a and not b:
        return 1.0
    same, left = 0, [(a, b)]
    while left:
        x, y = left.pop()
        i, j, n = _longest(x, y)
        if n:
            same += n
            if i and j:
                left.append((x[:i], y[:j]))
            if i + n < len(x) and j + n < len(y):
                left.append((x[i + n:], y[j + n:]))
    return 2.0 * same / (len(a) + len(b))


def edit_ratio_py(a: str, b: str) -> float:
    """``similarity.edit_ratio`` of two strings."""
    a, b = (a or "").lower(), (b or "").lower()
    if not a or not b:
        return 1.0 if a == b else 0.0
    # the distance column by column, a column's differences as bits of two numbers
    full, top = (1 << len(a)) - 1, 1 << (len(a) - 1)
    held: dict[str, int] = {}
    for i, x in enumerate(a):
        held[x] = held.get(x, 0) | 1 << i
    plus, minus, dist = full, 0, len(a)
    for y in b:
        eq = held.get(y, 0)
        down = eq | minus
        across = (((eq & plus) + plus) ^ plus) | eq
        more, less = minus | ~(across | plus) & full, plus & across
        dist += bool(more & top) - bool(less & top)
        more, less = more << 1 | 1, less << 1
        plus, minus = (less | ~(down | more)) & full, more & down & full
    return 1 - dist / max(len(a), len(b))


class _Tile:
    """Masters of one tile: letters, words, kinds, and the tree of their names."""

    def __init__(self, names, tokens, confs, attrs, row_ids):
        self.names, low = names, [n.lower() for n in names]
        attrs = [a.lower() for a in attrs]
        order = sorted(range(len(row_ids)), key=lambda k: row_ids[k])
        self.ids = [row_ids[k] for k in order]
        self.rank = np.empty(len(names), np.int64)       # row order, for ties
        self.rank[order] = np.arange(len(names))
        self.letter = {c: k for k, c in enumerate(sorted(set().union(*low)))}
        self.length = np.array([len(n) for n in low], np.int64)
        # the letters of all names one after the other
        self.spelled = np.array([self.letter[x] for n in low for x in n], np.int32)
        self.starts = np.cumsum(self.length) - self.length
        self.n_words = np.array([len(t) for t in tokens], np.int64)
        words: dict[str, list] = {}
        for k, t in enumerate(tokens):
            for w in t:
                words.setdefault(w, []).append(k)
        self.rare = {w: k for w, k in words.items() if len(k) <= RARE}
        often = {w: n for n, w in enumerate(w for w in words if w not in self.rare)}
        kinds: dict[tuple, int] = {}
        kind = [kinds.setdefault((len(n), len(t), c, x, tuple(sorted(often[w] for w in t if w in often))), len(kinds))
                for n, t, c, x in zip(low, tokens, confs, attrs)]
        self.kind = np.array(kind, np.int64)
        self.k_length, self.k_words = (np.array([x[n] for x in kinds], np.int64) for n in (0, 1))
        self.k_conf, self.k_attr = (np.array([x[n] for x in kinds], object) for n in (2, 3))
        held: list[list] = [[] for _ in often]
        for n, x in enumerate(kinds):
            for w in x[4]:
                held[w].append(n)
        self.often = {w: np.array(held[n], np.int64) for w, n in often.items()}
        # names at once: their kinds are bounded too
        self.batch = max(1, min(BATCH, WIDE // max(1, len(kinds))))
        self.views: dict[tuple, tuple] = {}
        self._grow(low, kind)

    def _grow(self, low: list[str], kind: list[int]) -> None:
        """The tree: ``leaf``, the distinct names of the kinds in order, and
        per depth the prefixes of that many letters: their first leaf, last
        letter, kind, and the first of the prefixes that go on from each."""
        # masters by kind, name and row
        self.by_name = sorted(range(len(low)), key=lambda m: (kind[m], low[m], self.rank[m]))
        at = np.array(self.by_name, np.int64)
        new = np.array([n == 0 or kind[m] != kind[o] or low[m] != low[o]
                        for n, (m, o) in enumerate(zip(self.by_name, [-1, *self.by_name]))], bool)
        self.leaf_from = np.append(np.flatnonzero(new), len(low)).astype(np.int64)      # leaf -> places in ``by_name``
        self.by_name = at
        leaf = at[self.leaf_from[:-1]]
        self.leaf = [(kind[m], low[m]) for m in leaf.tolist()]
        k, size, first = self.kind[leaf], self.length[leaf], self.starts[leaf]
        # letters that a leaf shares with the leaf before it, -1 at the first of a kind
        shared = np.full(leaf.size, -1, np.int64)
        on = np.flatnonzero(k[1:] == k[:-1]) + 1
        shared[on] = 0
        j = 0
        while on.size:
            on = on[size[on] > j]
            on = on[self.spelled[first[on] + j] == self.spelled[first[on - 1] + j]]
            j += 1
            shared[on] = j
        self.levels, live, j = [], np.arange(leaf.size), 0
        while live.size:
            live = live[size[live] >= j]
            node = live[shared[live] < j]
            letter = self.spelled[first[node] + j - 1] if j else np.zeros(node.size, np.int32)
            self.levels.append([node, letter, k[node], None])
            j += 1
        for up, down in zip(self.levels, self.levels[1:]):
            up[3] = np.append(np.searchsorted(down[0], up[0]), down[0].size)

    def common(self, low: str, at: np.ndarray) -> np.ndarray:
        """For the masters ``at``, a number no smaller than the length of the
        longest common subsequence with ``low``: exact up to 64 letters, else
        the sum over pieces of 64.  A master's column of the length table is
        one number, its bits the places of the piece."""
        at = at[np.argsort(-self.length[at], kind="stable")]
        size, first = self.length[at], self.starts[at]
        most = np.zeros(len(self.names), np.int64)
        for a in range(0, len(low), 64):
            piece = low[a:a + 64]
            place = np.zeros(len(self.letter) + 1, np.uint64)
            for i, x in enumerate(piece):
                if x in self.letter:
                    place[self.letter[x]] |= np.uint64(1 << i)
            left = np.full(at.size, np.uint64((1 << 64) - 1))
            live = at.size
            for j in range(int(size[0]) if at.size else 0):
                live = int(np.searchsorted(-size[:live], -j, side="left"))      # names longer than j
                v = left[:live]
                u = v & place[self.spelled[first[:live] + j]]
                left[:live] = (v + u) | (v - u)
            full = np.uint64((1 << len(piece)) - 1)
            most[at] += np.bitwise_count(~left & full).astype(np.int64)
        return most

    def _view(self, tokens, pref, attr, bonus):
        """Per kind: the Jaccard of masters that share no rare word with the
        name, the bonus, whether the attribute allows the pair, and the score
        without the letters."""
        words = tuple(sorted(w for w in tokens if w in self.often))
        key = words, len(tokens), pref, attr, bonus
        if key not in self.views:
            if len(self.views) >= self.batch:
                self.views.clear()
            shared = np.zeros(self.k_length.size, np.int64)
            for w in words:
                shared[self.often[w]] += 1
            jac = np.divide(shared, len(tokens) + self.k_words - shared, out=np.zeros(shared.size), where=shared > 0)
            more = np.where((self.k_conf == pref) & (pref != ""), bonus, 0.0)
            use = (self.k_attr == "") | (self.k_attr == attr.lower()) if attr else np.ones(shared.size, bool)
            self.views[key] = jac, more, use, np.where(use, more + JAC_WEIGHT * jac, -9.0)
        return self.views[key]

    def best(self, name, tokens, pref, attr, floor, k, score, bonus):
        """(rank order, score, row) of the first ``k`` masters not below ``floor``."""
        return self.search([(name, tokens, pref, attr, floor, None)], k, score, bonus)[0]

    def _need(self, names: list) -> np.ndarray:
        """Per name and kind, the least common subsequence that reaches the floor."""
        seq = (np.array([[n.floor - _EPS] for n in names]) - np.array([n.base for n in names])) / SEQ_WEIGHT
        total = np.array([[len(n.low)] for n in names]) + self.k_length
        return np.where(seq > 1 + 1e-6, 1 << 40, np.maximum(np.ceil(seq * total / 2 - 1e-6), 0)).astype(np.int64)

    def search(self, asked: list[tuple], k: int, score, bonus: float, tight: bool = False) -> list[list[tuple]]:
        """``best`` of several names at once: (name, tokens, conference,
        attribute, floor, row of the floor).  With ``tight`` a score that
        reaches its bound is the same number, so a master whose bound equals
        the floor and whose row comes after the floor's is not scored."""
        names = [_Name(self, *x, k, score, bonus, tight) for x in asked] if self.names else []
        for n in names:
            n.near()
        wide = [n for n in names if len(n.low) > 64]
        for n in wide:
            need = self._need([n])[0]
            m = np.flatnonzero((need <= np.minimum(len(n.low), self.k_length))[self.kind])
            lcs = np.minimum(self.common(n.low, m)[m], self.length[m])
            n.take(m[lcs >= need[self.kind[m]]], lcs[lcs >= need[self.kind[m]]])
        self._walk([n for n in names if len(n.low) <= 64])
        return [n.top for n in names] if names else [[] for _ in asked]

    def _walk(self, names: list) -> None:
        """All names down the tree; what they reach is scored."""
        if not names:
            return
        place = np.zeros((len(names), len(self.letter)), np.uint64)
        for q, n in enumerate(names):
            for i, x in enumerate(n.low):
                if x in self.letter:
                    place[q, self.letter[x]] |= np.uint64(1 << i)
        size = np.array([len(n.low) for n in names], np.int64)
        need = self._need(names)
        node, _, kind, _ = self.levels[0]
        q, at = np.nonzero(need[:, kind] <= np.minimum(size[:, None], self.k_length[kind]))
        todo = [(0, q, at, np.full(q.size, np.uint64((1 << 64) - 1)))]
        found, held = [], 0
        while todo:
            depth, q, at, bits = todo.pop()
            node, _, kind, down = self.levels[depth]
            end = self.k_length[kind[at]] == depth
            if end.any():
                lcs = np.bitwise_count(~bits[end] & _LOW[size[q[end]]]).astype(np.int64)
                found.append((q[end], node[at[end]], lcs))
                held += lcs.size
                if held > LEAVES:
                    self._take(names, found)
                    found, held = [], 0
                    need = self._need(names)
                q, at, bits = q[~end], at[~end], bits[~end]
            if not q.size:
                continue
            count = down[at + 1] - down[at]
            upto = np.cumsum(count)
            if upto[-1] > WIDE and q.size > 1:
                cut = min(max(1, int(np.searchsorted(upto, WIDE))), q.size - 1)
                todo += (depth, q[cut:], at[cut:], bits[cut:]), (depth, q[:cut], at[:cut], bits[:cut])
                continue
            of = np.repeat(np.arange(q.size), count)
            to = np.arange(upto[-1]) - (upto - count - down[at])[of]
            _, letter, kind, _ = self.levels[depth + 1]
            q, v, kind = q[of], bits[of], kind[to]
            u = v & place[q, letter[to]]
            bits = (v + u) | (v - u)
            # the longest common subsequence that this prefix may come to
            left, mine = self.k_length[kind] - depth - 1, size[q]
            most = np.bitwise_count(~bits & _LOW[np.maximum(mine - left, 0)]).astype(np.int64) + np.minimum(left, mine)
            keep = most >= need[q, kind]
            if keep.any():
                todo.append((depth + 1, q[keep], to[keep], bits[keep]))
        self._take(names, found)

    def _take(self, names: list, found: list[tuple]) -> None:
        if not found:
            return
        q, leaf, lcs = (np.concatenate(x) for x in zip(*found))
        order = np.argsort(q, kind="stable")
        q, leaf, lcs = q[order], leaf[order], lcs[order]
        count = self.leaf_from[leaf + 1] - self.leaf_from[leaf]
        of = np.repeat(np.arange(q.size), count)
        m = self.by_name[np.arange(of.size) - (np.cumsum(count) - count - self.leaf_from[leaf])[of]]
        q, lcs = q[of], lcs[of]
        cuts = np.flatnonzero(np.diff(q, prepend=-1))
        for a, b in zip(cuts.tolist(), [*cuts[1:].tolist(), q.size]):
            names[q[a]].take(m[a:b], lcs[a:b])


class _Name:
    """A name that asks a tile, and the best masters found so far."""

    def __init__(self, tile: _Tile, name, tokens, pref, attr, floor, row, k, score, bonus, tight):
        self.tile, self.name, self.low, self.tokens = tile, name, name.lower(), tokens
        self.k, self.score, self.tight = k, score, tight
        self.jac, self.more, self.use, self.base = tile._view(tokens, pref, attr, bonus)
        # masters of rows before this place stand before the floor's row
        self.floor, self.until = floor, len(tile.ids) if row is None else bisect_right(tile.ids, row)
        self.top: list[tuple] = []
        self.known: dict[str, float] = {}
        self.seen: set[int] = set()

    def near(self) -> None:
        """Masters that share a rare word, and when no floor is known those
        next to the name in the order of the likeliest kinds."""
        tile, low = self.tile, self.low
        posts = [tile.rare[w] for w in self.tokens if w in tile.rare]
        if posts:
            m, rare = np.unique(np.concatenate(posts).astype(np.int64), return_counts=True)
            kind = tile.kind[m]
            both = np.zeros(tile.k_length.size, np.int64)
            for w in self.tokens:
                if w in tile.often:
                    both[tile.often[w]] += 1
            shared = rare + both[kind]
            jac = shared / (len(self.tokens) + tile.n_words[m] - shared)
            self.seen.update(m.tolist())
            ok = self.use[kind]
            m, jac = m[ok], jac[ok]
            lcs = np.minimum(len(low), tile.length[m])
            if m.size > 2 * self.k:
                lcs = np.minimum(tile.common(low, m)[m], lcs)
            self._best(m, lcs, jac)
        if self.floor <= 0:
            likely = np.where(self.use, self.jac * JAC_WEIGHT + self.more, -1.0)
            for kind in np.argsort(-likely, kind="stable")[:4].tolist():
                if likely[kind] < 0:
                    break
                at = bisect_left(tile.leaf, (kind, low))
                leaf = [x for x in range(max(0, at - self.k), min(len(tile.leaf), at + self.k + 1)) if tile.leaf[x][0] == kind]
                m = np.array([m for x in leaf for m in tile.by_name[tile.leaf_from[x]:tile.leaf_from[x + 1]][:self.k].tolist()], np.int64)
                self.take(m, np.minimum(len(low), tile.length[m]), True)

    def take(self, m: np.ndarray, lcs: np.ndarray, all_: bool = False) -> None:
        """Masters without a rare word of the name, with a bound of the longest
        common subsequence; with ``all_`` also those that are not the best."""
        if self.seen:
            new = np.array([x not in self.seen for x in m.tolist()], bool)
            m, lcs = m[new], lcs[new]
        if all_:
            self.seen.update(m.tolist())
        self._best(m, lcs, self.jac[self.tile.kind[m]])

    def _best(self, m: np.ndarray, lcs: np.ndarray, jac: np.ndarray) -> None:
        tile, more = self.tile, self.more[self.tile.kind[m]]
        total = len(self.low) + tile.length[m]
        seq = np.where(total > 0, 2 * lcs / np.maximum(total, 1), 1.0)
        most = np.minimum(1.0, SEQ_WEIGHT * seq + JAC_WEIGHT * jac + more)
        ok = np.flatnonzero((most > 0) & (most + _EPS >= self.floor))
        ok = ok[np.lexsort((tile.rank[m[ok]], -most[ok]))]
        top, k = self.top, self.k
        for x, r, b, j, e in zip(m[ok].tolist(), tile.rank[m[ok]].tolist(), most[ok].tolist(), jac[ok].tolist(), more[ok].tolist()):
            if b + _EPS < self.floor:
                break
            if self.tight and (b < self.floor or b == self.floor and r >= self.until):
                continue
            other = tile.names[x]
            if other not in self.known:
                self.known[other] = self.score(self.name, other)
            s = min(1.0, SEQ_WEIGHT * self.known[other] + JAC_WEIGHT * j + e)
            if s <= 0 or s + _EPS < self.floor:
                continue
            insort(top, (-s, r, x))
            if len(top) >= k:
                del top[k:]
                if -top[-1][0] > self.floor:
                    self.floor, self.until = -top[-1][0], top[-1][1]
                elif -top[-1][0] == self.floor:
                    self.until = min(self.until, top[-1][1])


_FOUND = "q_id long, row_id long, master_name string, score double"


def _searcher(k: int, score, bonus: float, tight: bool):
    def run(key, left, right):
        out = [[], [], [], []]
        if left.num_rows and right.num_rows:
            ids, names = right.column("row_id").to_pylist(), right.column("master_name").to_pylist()
            tile = _Tile(names, *(right.column(c).to_pylist() for c in ("m_tokens", "m_conf", "m_attr")), ids)
            for at in range(0, left.num_rows, tile.batch):
                some = left.slice(at, tile.batch)
                asked = list(zip(*(some.column(c).to_pylist() for c in ("q_name", "q_tokens", "q_pref", "q_attr", "floor", "floor_row"))))
                for q, top in zip(some.column("q_id").to_pylist(), tile.search(asked, k, score, bonus, tight)):
                    for s, _, m in top:
                        for c, v in zip(out, (q, ids[m], names[m], -s)):
                            c.append(v)
        return pa.table({n: pa.array(v, t) for n, v, t in zip(("q_id", "row_id", "master_name", "score"), out,
                                                              (pa.int64(), pa.int64(), pa.string(), pa.float64()))})
    return run


def _first(found: DataFrame, k: int) -> DataFrame:
    """The ``k`` first of each name: at most ``k`` of each tile come in."""
    w = Window.partitionBy("q_id").orderBy(F.desc("score"), "row_id")
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def exact_topk(left: DataFrame, master: DataFrame, k: int = 10, *, name: str = "name", master_id: str = "row_id",
               master_name: str = "master_name", pref: str | None = None, master_conf: str | None = None,
               left_attr: str | None = None, master_attr: str | None = None, bonus: float = BONUS,
               seq=match.seq_ratio, seq_py: Callable[[str, str], float] = seq_ratio_py,
               tile_rows: int = TILE_ROWS, block: int = BLOCK, sure: float = SURE, pairs: int = PAIRS) -> DataFrame:
    """The ``k`` best masters of every row of ``left`` by the combined score
    (only positive scores), ties by master row: exactly the result of scoring
    every pair.  ``seq`` and ``seq_py`` are the same character score as a
    column and on two strings; it must not exceed 2 * longest common
    subsequence / all letters.  Adds ``rank, row_id, master_name, score``; a
    row without any positive score, or with a null name, keeps nulls there.
    Master names may be null (they match nothing) and repeat."""
    blank = lambda c, df: F.coalesce(F.col(c).cast("string"), F.lit("")) if c else F.lit("")
    q = left.select(F.col(name).alias("q_name"), blank(pref, left).alias("q_pref"), blank(left_attr, left).alias("q_attr"))
    q = q.where("q_name is not null").distinct()
    q = cut_lineage(q.select(F.monotonically_increasing_id().alias("q_id"), "*", word_tokens(F.col("q_name")).alias("q_tokens")))
    conf = master_conf if pref else None
    attr = master_attr if left_attr else None
    m = master.select(F.col(master_id).cast("long").alias("row_id"), F.col(master_name).alias("master_name"),
                      blank(conf, master).alias("m_conf"), blank(attr, master).alias("m_attr")).where("master_name is not null")
    m = cut_lineage(m.withColumn("m_tokens", word_tokens(F.col("master_name"))))
    room = bonus if conf else 0.0

    # 1. names that have k pairs at or above SURE
    df = m.select(F.explode_outer("m_tokens").alias("w")).where("w is not null").groupBy("w").agg(F.count(F.lit(1)).alias("df"))
    many = q.select("q_id", F.explode_outer("q_tokens").alias("w")).where("w is not null").join(df, "w") \
        .groupBy("q_id").agg(F.sum("df").alias("df")).where(F.col("df") > pairs)
    few = cut_lineage(q.join(many, "q_id", "left_anti"))
    sure_pairs = match.fuzzy_candidates(few, m, name="q_name", master_id="row_id", master_name="master_name", pref="q_pref" if conf else None,
                                        master_conf="m_conf" if conf else None, bonus=bonus, left_attr="q_attr" if attr else None,
                                        master_attr="m_attr" if attr else None, min_score=max(sure, SEQ_WEIGHT + room + 0.01), seq=seq)
    sure_pairs = sure_pairs.where(F.col("score") >= sure).join(few.select("q_id", "q_name", F.col("q_pref").alias("p"), F.col("q_attr").alias("a")),
                                                               "q_name")
    same = (F.col("a") == F.col("q_attr")) if attr else F.lit(True)
    if conf:
        same = same & (F.col("p") == F.col("q_pref"))
    done = cut_lineage(_first(sure_pairs.where(same).select("q_id", "row_id", "master_name", "score"), k))
    full = done.where(F.col("rank") == k).select("q_id")
    rest = cut_lineage(q.join(full, "q_id", "left_anti"))

    # 2. the tile that shares most words, 3. all others that still matter
    alike = Window.partitionBy("master_name", "m_conf", "m_attr").orderBy("row_id")
    m = cut_lineage(m.withColumn("nth", F.row_number().over(alike)).where(F.col("nth") <= k).drop("nth"))
    tiles = max(1, -(-m.count() // tile_rows))
    m = cut_lineage(m.repartitionByRange(tiles, "m_conf", "master_name", "row_id").withColumn("tile", F.spark_partition_id()))
    words = cut_lineage(m.select("tile", F.explode_outer("m_tokens").alias("w")).where("w is not null").distinct())
    met = cut_lineage(rest.select("q_id", F.size("q_tokens").alias("n"), F.explode_outer("q_tokens").alias("w")).where("w is not null")
                          .join(words, "w").groupBy("q_id", "tile").agg((F.count(F.lit(1)) / F.first("n")).alias("jac")))
    home = met.groupBy("q_id").agg(F.max_by("tile", F.struct("jac", -F.col("tile"))).alias("home"))
    rest = cut_lineage(rest.join(home, "q_id", "left").withColumn("home", F.coalesce("home", F.pmod("q_id", F.lit(tiles)).cast("int"))))
    score, tight = (ratio_py, True) if seq_py is seq_ratio_py else (seq_py, False)

    def ask(names: DataFrame) -> DataFrame:
        # a tile's names in blocks; tasks by their number, as the rows are few bytes
        counts = names.groupBy("tile").count().toArrow()     # one row per tile
        size = min(block, max(LEAST_BLOCK, (total := sum(counts.column("count").to_pylist())) // GROUPS))
        blocks = {t: -(-n // size) for t, n in zip(*(counts.column(c).to_pylist() for c in ("tile", "count")))}
        if not blocks:
            return m.sparkSession.createDataFrame([], _FOUND)
        first = dict(zip(blocks, accumulate(blocks.values(), initial=0)))
        tasks = min(sum(blocks.values()), 1 + total // 256, 10_000)
        of, at = (F.create_map(*[F.lit(x) for kv in held.items() for x in kv])[F.col("tile")] for held in (blocks, first))
        asked = names.withColumn("block", (at + F.pmod(F.xxhash64("q_id"), of)).cast("int"))
        held = m.withColumn("block", F.explode(F.sequence(at, at + of - 1)))
        asked, held = (x.repartitionById(tasks, F.col("block")).groupBy("block") for x in (asked, held))
        return asked.cogroup(held).applyInArrow(_searcher(k, score, bonus, tight), _FOUND)

    no_row = F.lit(None).cast("long")
    near = cut_lineage(ask(rest.withColumns({"tile": F.col("home"), "floor": F.lit(0.0), "floor_row": no_row})))
    if tiles > 1:
        kth = near.groupBy("q_id").agg(F.count(F.lit(1)).alias("n"), F.max(F.struct((-F.col("score")).alias("less"), "row_id")).alias("s")).where(F.col("n") >= k)
        kth = kth.select("q_id", (-F.col("s.less")).alias("floor"), F.col("s.row_id").alias("floor_row"))
        other = rest.join(kth, "q_id", "left").withColumn("floor", F.coalesce("floor", F.lit(0.0)))
        other = other.withColumn("tile", F.explode(F.sequence(F.lit(0), F.lit(tiles - 1)))).where("tile <> home")
        other = other.join(met, ["q_id", "tile"], "left")
        most = SEQ_WEIGHT + JAC_WEIGHT * F.coalesce("jac", F.lit(0.0))
        if conf:
            there = m.where("m_conf <> ''").select("tile", F.col("m_conf").alias("q_pref"), F.lit(bonus).alias("more")).distinct()
            other = other.join(there, ["tile", "q_pref"], "left")
            most = most + F.coalesce("more", F.lit(0.0))
        other = cut_lineage(other.where(most + _EPS >= F.col("floor")).select(*rest.columns, "tile", "floor", "floor_row"))
        near = near.unionByName(ask(other))
    top = done.join(full, "q_id", "left_semi").unionByName(_first(near, k))
    top = top.join(q.select("q_id", "q_name", "q_pref", "q_attr"), "q_id").drop("q_id")
    rows = left.withColumns({"q_name": F.col(name), "q_pref": blank(pref, left), "q_attr": blank(left_attr, left)})
    return rows.join(top, ["q_name", "q_pref", "q_attr"], "left").drop("q_name", "q_pref", "q_attr")
