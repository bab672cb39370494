"""Static binary-fuse filters over 64-bit keys, built and asked with numpy.

A key owns one slot in each of three neighbouring segments; its 8-bit mark is
the exclusive-or of the three.  Slots are given out by peeling: keys that are
alone in a slot are taken off in rounds and filled in reverse order.  A filter
never misses one of its keys; other keys pass with chance 1/256.
"""

from __future__ import annotations

import struct

import numpy as np

from tessera.llm.common import mixed

_HEAD = struct.Struct("<QIII")   # seed, segment length, segments, slots


def _layout(n: int) -> tuple[int, int]:
    """(segment length, segments): a power of two that grows slowly with the
    keys, and some 13 to 25 % more slots than keys (more for few keys)."""
    if n <= 1:
        return 4, 3
    size = 1 << max(2, min(18, int(np.floor(np.log(n) / np.log(3.33) + 2.25))))
    factor = max(1.125, 0.875 + 0.25 * np.log(1e6) / np.log(n))
    return size, max(3, -(-int(n * factor) // size) + 2)


def _slots(keys: np.ndarray, seed: int, size: int, segments: int):
    """The three slots (rows of 3) and the mark of every key."""
    with np.errstate(over="ignore"):
        h = mixed(keys + np.uint64(seed) * np.uint64(0x9E3779B97F4A7C15))
    # the first segment by the high half, the places inside by the low half
    first = ((h >> np.uint64(32)) * np.uint64(segments - 2) >> np.uint64(32)).astype(np.int64)
    mask = np.uint64(size - 1)
    g = mixed(h)
    at = np.stack([(g >> np.uint64(s) & mask).astype(np.int64) for s in (0, 18, 36)], 1)
    return (first[:, None] + np.arange(3)) * size + at, (g >> np.uint64(56)).astype(np.uint8)


def build(keys: np.ndarray) -> bytes:
    """A filter of the distinct uint64 ``keys``."""
    keys = np.unique(np.asarray(keys, np.uint64))
    size, segments = _layout(keys.size)
    for seed in range(1, 1000):
        at, mark = _slots(keys, seed, size, segments)
        order = _peel(at, size * segments)
        if order is not None:
            break
        if seed % 8 == 0:      # an unlucky size: more room
            segments += max(1, segments // 8)
    else:
        raise ValueError("no seed peels these keys")
    table = np.zeros(size * segments, np.uint8)
    for who, col in reversed(order):
        rows = at[who]
        rest = mark[who].copy()
        for c in range(3):
            rest ^= np.where(col == c, 0, table[rows[:, c]]).astype(np.uint8)
        table[rows[np.arange(who.size), col]] = rest
    return _HEAD.pack(seed, size, segments, table.size) + table.tobytes()


def _peel(at: np.ndarray, slots: int):
    """Rounds of (keys, own slot of the three); None if keys remain."""
    n = at.shape[0]
    count = np.bincount(at.ravel(), minlength=slots)
    held = np.zeros(slots, np.int64)            # exclusive-or of a slot's keys
    np.bitwise_xor.at(held, at.ravel(), np.repeat(np.arange(n), 3))
    left, order = n, []
    alone = np.flatnonzero(count == 1)
    while alone.size:
        who, pick = np.unique(held[alone], return_index=True)
        own = alone[pick]
        order.append((who, (at[who] == own[:, None]).argmax(1)))
        left -= who.size
        touched = at[who].ravel()
        np.subtract.at(count, touched, 1)
        np.bitwise_xor.at(held, touched, np.repeat(who, 3))
        alone = np.unique(touched)
        alone = alone[count[alone] == 1]
    return order if left == 0 else None


def passes(blob: bytes, keys: np.ndarray) -> np.ndarray:
    """Which uint64 keys the filter lets through."""
    seed, size, segments, slots = _HEAD.unpack_from(blob)
    table = np.frombuffer(blob, np.uint8, count=slots, offset=_HEAD.size)
    at, mark = _slots(np.asarray(keys, np.uint64), seed, size, segments)
    return (table[at[:, 0]] ^ table[at[:, 1]] ^ table[at[:, 2]]) == mark
