"""STR-packed R-trees over integer vectors, and best-first search by inner
product, with numpy.

Packing sorts the rows by the coordinate that spreads most, cuts them into
slabs, and goes on inside each slab with the next coordinate; leaves hold
``LEAF`` neighbours, nodes ``FAN`` leaves.  A box bounds the inner product of
an anchor with each of its rows coordinate by coordinate: a positive component
meets the box's greatest value at most, a negative one its least.
"""

from __future__ import annotations

import heapq

import numpy as np

LEAF = 256
FAN = 8
AXES = 8           # coordinates that packing sorts by, at most
_ANCHORS = 512     # anchors whose box bounds are held at a time


def packed_order(vectors: np.ndarray, leaf: int = LEAF, axes: int = AXES) -> np.ndarray:
    """Rows in sort-tile-recursive order."""
    n = vectors.shape[0]
    spread = vectors.var(0, dtype=np.float64) if n else np.zeros(vectors.shape[1])
    best = np.argsort(-spread, kind="stable")[:axes]
    best = best[spread[best] > 0]
    return _tiled(vectors, np.arange(n), best.tolist(), leaf)


def _tiled(vectors, rows, axes, leaf):
    leaves = -(-rows.size // leaf)
    if leaves <= 1 or not axes:
        return rows
    rows = rows[np.argsort(vectors[rows, axes[0]], kind="stable")]
    if len(axes) == 1:
        return rows
    slabs = max(2, round(leaves ** (1 / len(axes))))
    size = -(-leaves // slabs) * leaf
    return np.concatenate([_tiled(vectors, rows[a:a + size], axes[1:], leaf) for a in range(0, rows.size, size)])


def boxes(vectors: np.ndarray, group: int) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest values of each ``group`` consecutive rows."""
    at = np.arange(0, vectors.shape[0], group)
    return np.minimum.reduceat(vectors, at, axis=0), np.maximum.reduceat(vectors, at, axis=0)


def intervals(anchors: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(least, greatest) inner product of every anchor with every box."""
    up, down = np.maximum(anchors, 0), np.minimum(anchors, 0)
    return up @ lo.T + down @ hi.T, up @ hi.T + down @ lo.T


class Tree:
    """Rows in packed order (float64, integer values) with two levels of boxes."""

    def __init__(self, vectors: np.ndarray, leaf: int = LEAF, fan: int = FAN):
        self.vectors = vectors.astype(np.float64)
        self.leaf, self.fan = leaf, fan
        self.leaf_lo, self.leaf_hi = boxes(self.vectors, leaf)
        self.node_lo, _ = boxes(self.leaf_lo, fan)
        _, self.node_hi = boxes(self.leaf_hi, fan)

    def search(self, anchors, low, high, floor, k, allowed, rank):
        """For each anchor and each of its windows the ``k`` first rows with a
        score in [low, high] and not below ``floor``: higher scores first, then
        lower ``rank``.  ``allowed(anchor, rows)`` tells which rows count.
        Yields (anchor, window, scores, rows); boxes outside all windows or
        strictly below the k-th score are not opened."""
        for at in range(0, anchors.shape[0], _ANCHORS):
            part = anchors[at:at + _ANCHORS]
            node = intervals(part, self.node_lo, self.node_hi)
            leaf = intervals(part, self.leaf_lo, self.leaf_hi)
            for i in range(part.shape[0]):
                yield from self._best_first(at + i, part[i], low[at + i], high[at + i], floor[at + i], k, allowed, rank,
                                            [x[i].tolist() for x in node], [x[i].tolist() for x in leaf])

    def _best_first(self, who, anchor, low, high, floor, k, allowed, rank, node, leaf):
        windows = range(len(low))
        need = [max(a, b) for a, b in zip(low, floor)]
        top = [(np.zeros(0), np.zeros(0, np.int64))] * len(low)
        n_nodes = len(node[0])

        def open_(least, most):
            return any(most >= need[j] and least <= high[j] for j in windows)

        queue = [(-node[1][x], x) for x in range(n_nodes) if open_(node[0][x], node[1][x])]
        heapq.heapify(queue)
        while queue:
            most, x = heapq.heappop(queue)
            if -most < min(need):
                break                 # and so are all boxes that are left
            if x < n_nodes:
                for c in range(x * self.fan, min((x + 1) * self.fan, len(leaf[0]))):
                    if open_(leaf[0][c], leaf[1][c]):
                        heapq.heappush(queue, (-leaf[1][c], n_nodes + c))
                continue
            x -= n_nodes
            if not open_(leaf[0][x], leaf[1][x]):
                continue
            a = x * self.leaf
            score = self.vectors[a:a + self.leaf] @ anchor
            row = np.flatnonzero((score >= min(need)) & (score <= max(high)))
            if not row.size:
                continue
            score, row = score[row], row + a
            use = allowed(who, row)
            score, row = score[use], row[use]
            for j in windows:
                use = (score >= need[j]) & (score <= high[j])
                if not use.any():
                    continue
                s, r = np.concatenate([top[j][0], score[use]]), np.concatenate([top[j][1], row[use]])
                first = np.lexsort((rank[r], -s))[:k]
                top[j] = s[first], r[first]
                if first.size == k:
                    need[j] = max(need[j], float(s[first[-1]]))
        for j in windows:
            if top[j][0].size:
                yield who, j, top[j][0], top[j][1]
