"""An adaptive context-mixing range coder for token ids.

Ids are coded in blocks of ``BLOCK`` ids that start from a reset model and
carry a checksum, so each can be read alone.  Many blocks are coded in step, one array lane each.

Per id:
1. The order-2 table predicts an id from the two ids before, the order-1
   table from the one before.  One of three symbols is coded: the order-2 prediction is
   right, else the order-1 prediction is right, else neither; its frequencies depend on how
   often the two predictions were right so far.
2. If neither is right, the id's class (its leading bits) is coded with a mix
   of the order-0 and the order-1 class frequencies; the mixing weight follows
   the model that gave the better probability.  The bits below the class are uniform.

Block: ``TMX1``, number of ids, payload bytes and crc32 of the ids (as
little-endian unsigned 32-bit integers) and then the payload; payload.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

BLOCK = 1024           # short: a segment fills as many lanes as pay for the steps
MAGIC = b"TMX1"
HEADER = struct.Struct("<4sIII")
_CLASSES = 32
_T1, _T2 = 1 << 9, 1 << 11
_TOP, _BOT, _WORD = 1 << 24, 1 << 16, (1 << 32) - 1
_SCALE = np.float32(1 << 14)
_BYTES = 8             # room per id; an id takes 43 bits at worst


def crc(ids: np.ndarray, payload: bytes) -> int:
    return zlib.crc32(payload, zlib.crc32(np.ascontiguousarray(ids, "<u4").tobytes()))


def _classes(ids: np.ndarray):
    """(class, number of lower bits, lower bits) of ids below 2^16."""
    top = np.frexp(np.maximum(ids, 1).astype(np.float64))[1] - 1
    low = np.maximum(top - 1, 0)
    cls = np.where(top > 0, 2 * top + (ids >> low & 1), ids)
    return cls, low, ids & ((1 << low) - 1)


class _Model:
    """The state of every lane's predictors."""

    def __init__(self, lanes: int):
        self.lane = np.arange(lanes)
        self.p1, self.c1 = np.zeros((lanes, _T1), np.int32), np.zeros((lanes, _T1), np.uint8)
        self.p2, self.c2 = np.zeros((lanes, _T2), np.int32), np.zeros((lanes, _T2), np.uint8)
        self.flag = np.tile(np.array([4, 2, 24], np.int64), (lanes, 32, 1))
        self.order0 = np.ones((lanes, _CLASSES), np.float32)
        self.order1 = np.full((lanes, _CLASSES, _CLASSES), 0.05, np.float32)
        self.weight = np.full(lanes, 0.5, np.float32)
        self.prev1 = self.prev2 = np.zeros(lanes, np.int64)
        self.prev_class = np.zeros(lanes, np.int64)

    def predict(self, k: int):
        """Predictions of the first ``k`` lanes and the flag frequencies."""
        n = self.lane[:k]
        self.h1 = (self.prev1[:k] * 40503 >> 4) % _T1
        self.h2 = (self.prev1[:k] * 40503 + self.prev2[:k] * 25173 >> 3) % _T2
        self.g1, self.g2 = self.p1[n, self.h1], self.p2[n, self.h2]
        self.s1, self.s2 = self.c1[n, self.h1], self.c2[n, self.h2]
        self.ctx = self.s2.astype(np.int64) * 8 + self.s1 * 2 + (self.g1 == self.g2)
        return self.flag[n, self.ctx]

    def class_freq(self, rows: np.ndarray):
        """Integer class frequencies of ``rows`` and the two parts of the mix."""
        a = self.order0[rows]
        b = self.order1[rows, self.prev_class[rows]]
        a = a * (_SCALE / a.sum(axis=1, dtype=np.float32))[:, None]
        b = b * (_SCALE / b.sum(axis=1, dtype=np.float32))[:, None]
        w = self.weight[rows][:, None]
        return (w * a + (np.float32(1) - w) * b).astype(np.int64) + 1, a, b

    def learn_class(self, rows, cls, a, b):
        pick = np.arange(rows.size)
        better = a[pick, cls] > b[pick, cls]
        w = self.weight[rows] + np.where(better, np.float32(0.02), np.float32(-0.02))
        self.weight[rows] = np.clip(w, np.float32(0.05), np.float32(0.95))
        self.order0[rows, cls] += np.float32(1)
        self.order1[rows, self.prev_class[rows], cls] += np.float32(1)

    def learn(self, k: int, ids: np.ndarray, sym: np.ndarray):
        n = self.lane[:k]
        self.flag[n, self.ctx, sym] += 24
        row = self.flag[n, self.ctx]
        big = row.sum(axis=1) > 1 << 13
        if big.any():
            self.flag[n[big], self.ctx[big]] = (row[big] + 1) >> 1
        for pred, conf, h, g, s in ((self.p1, self.c1, self.h1, self.g1, self.s1), (self.p2, self.c2, self.h2, self.g2, self.s2)):
            right = g == ids
            drop = ~right & (s == 0)
            pred[n, h] = np.where(drop, ids, g)
            conf[n, h] = np.where(right, np.minimum(s + 1, 3), np.where(drop, 0, s - (s > 0)))
        self.prev2 = self.prev1.copy()
        self.prev1 = self.prev1.copy()
        self.prev1[:k] = ids
        self.prev_class = self.prev_class.copy()
        self.prev_class[:k] = _classes(ids)[0]


class _Encoder:
    def __init__(self, lanes: int, room: int):
        self.low, self.range = np.zeros(lanes, np.int64), np.full(lanes, _WORD, np.int64)
        self.out, self.at = np.zeros((lanes, room), np.uint8), np.zeros(lanes, np.int64)

    def put(self, rows, cum, freq, total):
        r = self.range[rows] // total
        low = (self.low[rows] + cum * r) & _WORD
        rng = r * freq
        live = np.arange(rows.size)
        while True:
            lo, ra = low[live], rng[live]
            same = (lo ^ (lo + ra)) < _TOP
            small = ~same & (ra < _BOT)
            go = same | small
            if not go.any():
                break
            ra = np.where(small, -lo & (_BOT - 1), ra)
            live, lo, ra = live[go], lo[go], ra[go]
            x = rows[live]
            self.out[x, self.at[x]] = lo >> 24
            self.at[x] += 1
            low[live], rng[live] = (lo << 8) & _WORD, (ra << 8) & _WORD
        self.low[rows], self.range[rows] = low, rng

    def finish(self) -> list[bytes]:
        n = np.arange(self.low.size)
        for _ in range(4):
            self.out[n, self.at] = self.low >> 24
            self.at += 1
            self.low = (self.low << 8) & _WORD
        return [self.out[k, :self.at[k]].tobytes() for k in n]


class _Decoder:
    def __init__(self, payloads: list[bytes]):
        size = max(map(len, payloads), default=0) + 8
        self.data = np.zeros((len(payloads), size), np.int64)
        for k, p in enumerate(payloads):
            self.data[k, :len(p)] = np.frombuffer(p, np.uint8)
        self.low, self.range = np.zeros(len(payloads), np.int64), np.full(len(payloads), _WORD, np.int64)
        self.code = self.data[:, 0] << 24 | self.data[:, 1] << 16 | self.data[:, 2] << 8 | self.data[:, 3]
        self.at = np.full(len(payloads), 4, np.int64)

    def peek(self, rows, total):
        self.step = self.range[rows] // total
        return np.minimum(((self.code[rows] - self.low[rows]) & _WORD) // self.step, total - 1)

    def take(self, rows, cum, freq):
        low = (self.low[rows] + cum * self.step) & _WORD
        rng = self.step * freq
        live = np.arange(rows.size)
        while True:
            lo, ra = low[live], rng[live]
            same = (lo ^ (lo + ra)) < _TOP
            small = ~same & (ra < _BOT)
            go = same | small
            if not go.any():
                break
            ra = np.where(small, -lo & (_BOT - 1), ra)
            live, lo, ra = live[go], lo[go], ra[go]
            x = rows[live]
            self.code[x] = (self.code[x] << 8 & _WORD) | self.data[x, np.minimum(self.at[x], self.data.shape[1] - 1)]
            self.at[x] += 1
            low[live], rng[live] = (lo << 8) & _WORD, (ra << 8) & _WORD
        self.low[rows], self.range[rows] = low, rng


def encode(ids: np.ndarray, block: int = BLOCK) -> list[bytes]:
    """Blocks of ids (0 to 65535), each with its header."""
    ids = np.asarray(ids, np.int64)
    if ids.size and (ids.min() < 0 or ids.max() > 0xFFFF):
        raise ValueError("ids must be 0 to 65535")
    if not ids.size:
        return []
    cuts = np.arange(0, ids.size, block)
    size = np.diff(np.append(cuts, ids.size))
    lanes = cuts.size
    model, coder = _Model(lanes), _Encoder(lanes, _BYTES * int(size.max()) + 16)
    for t in range(int(size[0])):
        k = lanes if t < size[-1] else lanes - 1     # only the last block is shorter
        rows = model.lane[:k]
        now = ids[cuts[:k] + t]
        freq = model.predict(k)
        sym = np.where(model.g2 == now, 0, np.where(model.g1 == now, 1, 2))
        f0, f1 = freq[:, 0], freq[:, 1]
        coder.put(rows, np.where(sym == 0, 0, np.where(sym == 1, f0, f0 + f1)), freq[rows, sym], freq.sum(axis=1))
        x = np.flatnonzero(sym == 2)
        if x.size:
            cls, low, rest = _classes(now[x])
            f, a, b = model.class_freq(x)
            cum = np.cumsum(f, axis=1)
            pick = np.arange(x.size)
            coder.put(x, cum[pick, cls] - f[pick, cls], f[pick, cls], cum[:, -1])
            coder.put(x, rest, np.ones(x.size, np.int64), 1 << low)
            model.learn_class(x, cls, a, b)
        model.learn(k, now, sym)
    return [HEADER.pack(MAGIC, int(n), len(p), crc(ids[c:c + n], p)) + p for p, c, n in zip(coder.finish(), cuts, size)]


def decode(blocks: list[bytes]) -> np.ndarray:
    """The ids of the blocks, in order; a damaged block raises ValueError."""
    if not blocks:
        return np.zeros(0, np.int64)
    sizes, sums, payloads = [], [], []
    for b in blocks:
        magic, n, length, check = HEADER.unpack_from(b)
        if magic != MAGIC or len(b) != HEADER.size + length:
            raise ValueError("not a block")
        sizes.append(n)
        sums.append(check)
        payloads.append(b[HEADER.size:])
    # longest first, so that the lanes still running come first
    order = np.argsort([-n for n in sizes], kind="stable")
    size = np.array(sizes)[order]
    model, coder = _Model(len(blocks)), _Decoder([payloads[k] for k in order])
    out = np.zeros((len(blocks), int(size[0])), np.int64)
    for t in range(int(size[0])):
        k = int(np.searchsorted(-size, -t, side="left"))
        rows = model.lane[:k]
        freq = model.predict(k)
        f0, f1, total = freq[:, 0], freq[:, 1], freq.sum(axis=1)
        v = coder.peek(rows, total)
        sym = (v >= f0).astype(np.int64) + (v >= f0 + f1)
        coder.take(rows, np.where(sym == 0, 0, np.where(sym == 1, f0, f0 + f1)), freq[rows, sym])
        now = np.where(sym == 0, model.g2, model.g1).astype(np.int64)
        x = np.flatnonzero(sym == 2)
        if x.size:
            f, a, b = model.class_freq(x)
            cum = np.cumsum(f, axis=1)
            pick = np.arange(x.size)
            cls = (cum <= coder.peek(x, cum[:, -1])[:, None]).sum(axis=1)
            coder.take(x, cum[pick, cls] - f[pick, cls], f[pick, cls])
            low = np.maximum(cls // 2 - 1, 0)
            rest = coder.peek(x, 1 << low)
            coder.take(x, rest, np.ones(x.size, np.int64))
            now[x] = np.where(cls < 2, cls, ((2 + cls % 2) << low) | rest)
            model.learn_class(x, cls, a, b)
        model.learn(k, now, sym)
        out[:k, t] = now
    back = np.empty(len(blocks), np.int64)
    back[order] = np.arange(len(blocks))
    parts = [out[back[k], :sizes[k]] for k in range(len(blocks))]
    for p, payload, check in zip(parts, payloads, sums):
        if crc(p, payload) != check:
            raise ValueError("checksum")
    return np.concatenate(parts)
