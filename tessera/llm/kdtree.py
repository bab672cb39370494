"""K-d trees over letter-count vectors, built and searched with numpy.

A vector is kept in unary: bit (letter, level) is set if the word holds the
letter at least ``level`` times.  A split on a bit is a split of the letter's
axis; the box of a node is the pair (least, greatest) of its vectors, the
bitwise and / or of their codes.  How far a box lies above and below a query
(their sum is the L1 distance) is a count of bits.  Letters are code points
modulo 192, which keeps a-z and U+00C0-U+00FF apart; levels end at 3, and only
the ``BITS`` best divided bits are kept: dropping some only lets more through.
"""

from __future__ import annotations

import numpy as np

AXES = 192
LEVELS = 3
BITS = 128
_BLOCK = 4096


def letters(words: list[str]) -> np.ndarray:
    """Words of one length as a matrix of code points."""
    return np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).reshape(len(words), -1)


def letter_counts(codes: np.ndarray) -> np.ndarray:
    n = codes.shape[0]
    flat = (np.arange(n)[:, None] * AXES + codes % AXES).ravel()
    return np.bincount(flat, minlength=n * AXES).reshape(n, AXES)


def layout(counts: np.ndarray) -> np.ndarray:
    """The (letter, level) pairs, as one number each, that divide the words best."""
    share = np.concatenate([(counts >= k).mean(0) for k in range(1, LEVELS + 1)]) if len(counts) else np.zeros(AXES * LEVELS)
    worth = share * (1 - share)
    best = np.argsort(-worth, kind="stable")[:BITS]
    return best[worth[best] > 0]


def unary(counts: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """Codes (rows of uint64) of the count vectors in a layout."""
    out = np.zeros((counts.shape[0], BITS), np.uint8)
    out[:, :bits.size] = counts[:, bits % AXES] > bits // AXES
    return np.packbits(out, axis=1, bitorder="little").view(np.uint64)


def off_box(q: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How much every vector of the box has more, and less, than the query."""
    gain = np.bitwise_count(lo & ~q).sum(1, dtype=np.int16)
    loss = np.bitwise_count(q & ~hi).sum(1, dtype=np.int16)
    return gain, loss


class Tree:
    """``order`` lists the vectors by leaf; node arrays hold box and children.
    With ``tight`` the boxes are those of the vectors, else of the half-spaces
    (for vectors that were not there when the tree was built)."""

    def __init__(self, codes: np.ndarray, leaf: int, tight: bool = True):
        width = BITS // 64
        lo, hi, self.left, self.right, self.first, self.last = [], [], [], [], [], []
        self.order = np.arange(codes.shape[0])
        full = np.full(width, 2**64 - 1, np.uint64)
        stack = [(0, codes.shape[0], np.zeros(width, np.uint64), full, -1)]
        while stack:
            a, b, least, most, parent = stack.pop()
            node = len(lo)
            if parent >= 0:
                (self.left if self.left[parent] == -1 else self.right)[parent] = node
            rows = self.order[a:b]
            part = codes[rows]
            if tight and b > a:
                least, most = np.bitwise_and.reduce(part, 0), np.bitwise_or.reduce(part, 0)
            lo.append(least)
            hi.append(most)
            self.first.append(a)
            self.last.append(b)
            self.left.append(-2)
            self.right.append(-2)
            if b - a <= leaf:
                continue
            held = np.unpackbits(part.view(np.uint8), axis=1, bitorder="little").sum(0, dtype=np.int64)
            bit = int(np.argmin(np.abs(2 * held - (b - a))))
            if held[bit] in (0, b - a):
                continue       # all vectors are the same
            mask = np.zeros(width, np.uint64)
            mask[bit // 64] = np.uint64(1) << np.uint64(bit % 64)
            with_bit = (part & mask).any(1)
            self.order[a:b] = np.concatenate([rows[~with_bit], rows[with_bit]])
            mid = b - int(with_bit.sum())
            self.left[node] = self.right[node] = -1
            # the left child is taken from the stack first
            stack.append((mid, b, least | mask, most, node))
            stack.append((a, mid, least, most & ~mask, node))
        self.lo, self.hi = np.array(lo), np.array(hi)
        self.left, self.right, self.first, self.last = (np.array(x) for x in (self.left, self.right, self.first, self.last))
        self.leaves = np.flatnonzero(self.left < 0)
        self.number = np.cumsum(self.left < 0) - 1       # of a leaf

    def reach(self, q: np.ndarray, gain: int, loss: int) -> tuple[np.ndarray, np.ndarray]:
        """(query, leaf node) wherever a leaf's box holds vectors with at most
        ``gain`` letters more and ``loss`` letters less than the query."""
        found = []
        for at in range(0, q.shape[0], _BLOCK):
            who = np.arange(at, min(at + _BLOCK, q.shape[0]))
            node = np.zeros(who.size, np.int64)
            while who.size:
                more, less = off_box(q[who], self.lo[node], self.hi[node])
                near = (more <= gain) & (less <= loss)
                who, node = who[near], node[near]
                end = self.left[node] < 0
                found.append((who[end], node[end]))
                who, node = who[~end], node[~end]
                who, node = np.concatenate([who, who]), np.concatenate([self.left[node], self.right[node]])
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])

    def members(self, who: np.ndarray, node: np.ndarray, limit: int):
        """(query, vector) of all members of the reached leaves, some
        ``limit`` pairs at a time."""
        size = self.last[node] - self.first[node]
        at = 0
        total = np.concatenate([[0], np.cumsum(size)])
        while at < who.size:
            to = max(at + 1, int(np.searchsorted(total, total[at] + limit, side="right")) - 1)
            s = size[at:to]
            start = np.repeat(self.first[node[at:to]] - (total[at:to] - total[at]), s)
            yield np.repeat(who[at:to], s), self.order[start + np.arange(start.size)]
            at = to
