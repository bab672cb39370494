"""Cutting texts into pre-tokens with array code.

The patterns of the public tokenizers are runs of letters, numbers, spaces and other
characters with a few exceptions, so the cuts of a whole batch of texts follow from the
classes of neighbouring code points; no regular expression runs per match.
Letters and numbers are Unicode categories L* and N* of the Python in use.
"""

from __future__ import annotations

import functools
import sys
import unicodedata

import numpy as np

LETTER, NUMBER, OTHER, SPACE, MARK = 0, 1, 2, 3, 4
# Unicode White_Space (fixed values)
_WHITE = [*range(9, 14), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]


@functools.lru_cache(1)
def classes() -> np.ndarray:
    """Class of every code point; one more entry for marks."""
    out = np.full(sys.maxunicode + 2, OTHER, np.uint8)
    cat = np.array([ord(unicodedata.category(chr(c))[0]) for c in range(sys.maxunicode + 1)], np.uint8)
    out[:-1][cat == ord("L")] = LETTER
    out[:-1][cat == ord("N")] = NUMBER
    out[_WHITE] = SPACE
    out[-1] = MARK
    return out


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def byte_offsets(cps: np.ndarray) -> np.ndarray:
    """UTF-8 offset of every code point, and the end."""
    if not cps.size or cps.max() < 0x80:
        return np.arange(cps.size + 1)
    width = np.ones(cps.size, np.uint8)
    for step in (0x80, 0x800, 0x10000):
        width += cps >= step
    return np.concatenate([[0], np.cumsum(width, dtype=np.int64)])


def _contractions(cps, cls, start, edge):
    """Move cuts for 's 't 'm 'd 're 've 'll behind a cut apostrophe."""
    n = cps.size
    at = np.flatnonzero((cps == 0x27) & start & (cls != MARK))
    at = at[at + 1 < n]
    at = at[(cls[at + 1] == LETTER) & ~edge[at + 1]]
    if not at.size:
        return
    one = np.isin(cps[at + 1], [ord(c) for c in "stmd"])
    in2 = at + 2 < n
    nxt = np.minimum(at + 2, n - 1)
    a, b = cps[at + 1], cps[nxt]
    two = ~one & in2 & (cls[nxt] == LETTER) & ~edge[nxt] & (
        ((a == ord("r")) & (b == ord("e"))) | ((a == ord("v")) & (b == ord("e"))) | ((a == ord("l")) & (b == ord("l"))))
    for hit, size in ((one, 2), (two, 3)):
        p = at[hit]
        start[p + 1] = False
        end = p + size
        end = end[end < n]
        start[end] = True


def cut(cps: np.ndarray, cls: np.ndarray, edge: np.ndarray, spaced: bool) -> np.ndarray:
    """Boolean starts of pre-tokens.  ``edge`` marks the first code point of
    every piece of text, which no pre-token crosses.

    ``spaced`` False: letters run, every number is single, spaces are cut off
    from both sides (the caller drops them).  True: numbers run, and a blank
    joins the run behind it; of longer white space only its last character
    stands before that run.
    """
    n = cps.size
    start = np.zeros(n, bool)
    if not n:
        return start
    start[0] = True
    start[1:] = cls[1:] != cls[:-1]
    start |= edge | (cls == MARK)
    if not spaced:
        start |= cls == NUMBER
        _contractions(cps, cls, start, edge)
        return start
    # last space of a run that is followed by a non-space of the same piece
    last = np.flatnonzero((cls[:-1] == SPACE) & (cls[1:] != SPACE) & (cls[1:] != MARK) & ~edge[1:])
    start[last] = True
    start[last[cps[last] == 0x20] + 1] = False
    _contractions(cps, cls, start, edge)
    return start
