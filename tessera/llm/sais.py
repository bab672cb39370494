"""Suffix arrays by induced sorting, and permuted common prefixes.

Suffixes are classified as S (smaller than the next) or L; the leftmost S
positions (LMS) are sorted by their substrings, recursively if two substrings are equal;
two linear sweeps induce the whole order.  The sweeps go bucket by bucket
over arrays while the alphabet is small, and entry by entry on the reduced
strings, whose alphabets are large.
"""

from __future__ import annotations

import numpy as np

_SMALL = 1 << 12       # largest alphabet swept bucket by bucket


def _types(s: np.ndarray) -> np.ndarray:
    """True for S-type positions; the last (the sentinel) is S."""
    n = s.size
    up = np.empty(n, bool)
    up[-1] = True
    if n > 1:
        differs = s[1:] != s[:-1]
        # the next position at which the text changes decides
        at = np.where(differs, np.arange(n - 1), n)
        nxt = np.minimum.accumulate(at[::-1])[::-1]
        ok = nxt < n
        safe = np.minimum(nxt, n - 2)
        up[:-1] = ok & (s[safe] < s[safe + 1])
    return up


def _bounds(s: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    size = np.bincount(s, minlength=k)
    end = np.cumsum(size)
    return end - size, end


def _spread(sa, front, ch, who, step):
    """Put ``who`` in order at its buckets' moving fronts."""
    order = np.argsort(ch, kind="stable")
    c, w = ch[order], who[order]
    first = np.flatnonzero(np.concatenate([[True], c[1:] != c[:-1]]))
    count = np.diff(np.append(first, c.size))
    rank = np.arange(c.size) - np.repeat(first, count)
    if step > 0:
        sa[front[c] + rank] = w
    else:
        sa[front[c] - 1 - rank] = w
    front[c[first]] += step * count


def _lone(s, start, end, present):
    """How many of the greatest codes occur once each and stand next to none
    of their kind, as the codes that end pieces do.  Their suffixes are L
    and induce no L suffix, and no S suffix among themselves."""
    many = np.flatnonzero(end[present] - start[present] > 1)
    first = int(many[-1]) + 1 if many.size else 0
    if first == 0 or first == present.size:
        return 0
    top = s >= present[first]
    return 0 if (top[1:] & top[:-1]).any() else present.size - first


def _sweep_buckets(s, up, sa, lms, start, end, present, lone):
    """Induce L, then S types from LMS entries given in ``lms`` order; the last
    ``lone`` buckets are swept at once."""
    k = start.size
    low = s.astype(np.uint16) if k <= 1 << 16 else s
    # LMS suffixes by bucket, in the given order
    by = np.argsort(low[lms], kind="stable")
    placed = lms[by]
    edge = np.searchsorted(s[placed], np.arange(k + 1))
    head = start.copy()

    def push_l(block):
        j = block - 1
        j = j[(block > 0)]
        j = j[~up[j]]
        if j.size:
            _spread(sa, head, low[j], j, 1)

    for c in present[:present.size - lone]:
        lo = start[c]
        while lo < head[c]:
            hi = head[c]
            push_l(sa[lo:hi].copy())
            lo = hi
        if edge[c] < edge[c + 1]:
            push_l(placed[edge[c]:edge[c + 1]])
    tail = end.copy()

    def push_s(block):
        j = block - 1
        j = j[block > 0]
        j = j[up[j]]
        if j.size:
            _spread(sa, tail, low[j], j, -1)

    # the sentinel is the only suffix that nothing induces
    sa[0] = s.size - 1
    tail[0] = 0
    if lone:
        push_s(sa[start[present[-lone:]]][::-1])
    for c in present[:present.size - lone][::-1]:
        hi = end[c]
        while hi > tail[c]:
            lo = tail[c]
            push_s(sa[lo:hi][::-1].copy())
            hi = lo
        if start[c] < head[c]:
            push_s(sa[start[c]:head[c]][::-1].copy())


def _sweep_entries(s, up, sa, lms, start, end):
    """The same sweeps entry by entry."""
    n = len(s)
    text, kind = s.tolist(), up.tolist()
    out = [-1] * n
    tail = end.tolist()
    for p in lms[::-1].tolist():
        c = text[p]
        tail[c] -= 1
        out[tail[c]] = p
    head = start.tolist()
    for i in range(n):
        j = out[i] - 1
        if j >= 0 and not kind[j]:
            c = text[j]
            out[head[c]] = j
            head[c] += 1
    tail = end.tolist()
    for i in range(n - 1, -1, -1):
        j = out[i] - 1
        if j >= 0 and kind[j]:
            c = text[j]
            tail[c] -= 1
            out[tail[c]] = j
    out[0] = n - 1
    sa[:] = out


def _induce(s, up, lms, k):
    sa = np.full(s.size, -1, np.int64)
    start, end = _bounds(s, k)
    present = np.flatnonzero(end > start)
    lone = _lone(s, start, end, present)
    if present.size - lone <= _SMALL:
        _sweep_buckets(s, up, sa, lms, start, end, present, lone)
    else:
        _sweep_entries(s, up, sa, lms, start, end)
    return sa


def _names(s, lms, order):
    """Names of the LMS substrings, equal ones equal, in text order."""
    stop = np.append(lms[1:], s.size - 1)
    length = np.zeros(s.size, np.int64)
    length[lms] = stop - lms
    a, b = order[:-1], order[1:]
    same = length[a] == length[b]
    live = np.flatnonzero(same)
    step = 0
    while live.size:
        differ = s[a[live] + step] != s[b[live] + step]
        same[live[differ]] = False
        step += 1
        live = live[~differ]
        live = live[length[a[live]] >= step]
    name = np.zeros(s.size, np.int64)
    name[order] = np.concatenate([[0], np.cumsum(~same)])
    return name[lms]


def _sorted(s: np.ndarray, k: int) -> np.ndarray:
    """Suffix array of ``s`` over ``0 .. k-1``; its last entry is its only 0."""
    if s.size == 1:
        return np.zeros(1, np.int64)
    up = _types(s)
    lms = np.flatnonzero(up[1:] & ~up[:-1]) + 1
    sa = _induce(s, up, lms, k)
    is_lms = np.zeros(s.size, bool)
    is_lms[lms] = True
    order = sa[is_lms[sa]]
    names = _names(s, lms, order)
    top = int(names.max()) + 1
    if top < lms.size:
        order = lms[_sorted(names, top)]
    return _induce(s, up, order, k)


def suffix_array(codes: np.ndarray) -> np.ndarray:
    """Suffix array of non-negative codes (no sentinel needed)."""
    if not codes.size:
        return np.zeros(0, np.int64)
    s = np.append(np.asarray(codes, np.int64) + 1, 0)
    # only codes that occur form buckets
    seen = np.zeros(int(s.max()) + 1, np.int64)
    seen[s] = 1
    rank = np.cumsum(seen) - 1
    return _sorted(rank[s], int(rank[-1]) + 1)[1:]


_BLOCK = 16
_SLICE = 1 << 14        # positions compared at a time


def permuted_lcp(codes: np.ndarray, sa: np.ndarray) -> np.ndarray:
    """``plcp[i]``: common prefix of suffix ``i`` and the one before it in
    order.  A value is compared only where the preceding codes differ (or at
    0); all others are one less than their left neighbour's."""
    n = codes.size
    plcp = np.zeros(n, np.int64)
    if n < 2:
        return plcp
    before = np.full(n, -1, np.int64)
    before[sa[1:]] = sa[:-1]
    i = np.arange(n)
    has = before >= 0
    own = ~has | (i == 0) | (before == 0)
    rest = ~own
    own[rest] = codes[i[rest] - 1] != codes[before[rest] - 1]
    at = np.flatnonzero(own & has)
    # behind the end stands a code that no other position has
    padded = np.concatenate([codes.astype(np.int64), -np.arange(1, _BLOCK + 1)])
    value = np.zeros(n, np.int64)
    found = np.zeros(at.size, np.int64)
    lane = np.arange(_BLOCK)
    for lo in range(0, at.size, _SLICE):
        live, where = at[lo:lo + _SLICE], np.arange(lo, min(lo + _SLICE, at.size))
        done = np.zeros(live.size, np.int64)
        while live.size:
            x = np.minimum((live + done)[:, None] + lane, n + _BLOCK - 1)
            y = np.minimum((before[live] + done)[:, None] + lane, n + _BLOCK - 1)
            eq = (padded[x] == padded[y]) & (x < n) & (y < n)
            run = np.where(eq.all(axis=1), _BLOCK, np.argmin(eq, axis=1))
            done = done + run
            more = run == _BLOCK
            found[where[~more]] = done[~more]
            live, done, where = live[more], done[more], where[more]
    value[at] = found
    # value[j] - (i - j) for the last own position j <= i
    last = np.maximum.accumulate(np.where(own, i, -1))
    return np.maximum(value[last] - (i - last), 0)
