"""Word-level BPE with an end-of-word mark: exact token counts at every
prefix by dynamic programming.

A sequence of tokens is a BPE encoding if and only if each neighbouring pair
is the encoding of its own concatenation.  So the encoding of a prefix is the encoding of a shorter
prefix plus one token whose pair with that prefix's last token holds, and the
table ``prefix -> (count, last token)`` fills from left to right.  Prefixes
are shared between words, as in a trie.
"""

from __future__ import annotations

import functools
import json
import re
import unicodedata

import numpy as np
import pyarrow as pa

from tessera.llm.common import encode_spans
from tessera.llm.pretokens import MARK, SPACE, byte_offsets, classes, code_points, cut

_MEMO = 1_000_000      # entries of a table kept in a worker, then it is emptied


def _byte_alphabet() -> dict[str, int]:
    """Byte-level alphabet: printable bytes stand for themselves, the others
    follow from 256 on, in order."""
    keep = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(keep)]
    return {chr(b): b for b in keep} | {chr(256 + k): b for k, b in enumerate(rest)}


class WordBpe:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, alphabet, end = spec["model"], _byte_alphabet(), spec["model"]["end_of_word_suffix"]
        self.specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self._special_re = re.compile("(" + "|".join(map(re.escape, self.specials)) + ")") if self.specials else None
        vocab = model["vocab"]
        self.plain, self.final, self.symbols = {}, {}, {}
        for tok, i in vocab.items():
            closing = tok.endswith(end) and len(tok) > len(end)
            raw = bytes(alphabet[c] for c in (tok[:-len(end)] if closing else tok))
            (self.final if closing else self.plain)[raw] = i
            self.symbols[i] = raw
        self.merges = {}
        for rank, m in enumerate(model["merges"]):
            a, b = m if isinstance(m, list) else m.split(" ")
            self.merges[(vocab[a], vocab[b])] = (rank, vocab[a + b])
        self.longest = max(map(len, [*self.plain, *self.final]))
        # the merge that makes a token: (rank, left part, right part)
        self._made = {new: (rank, a, b) for (a, b), (rank, new) in self.merges.items()}
        self._closed = set(self.final.values())
        self._pairs: dict[int, bool] = {}
        self._self: dict[int, bool] = {}
        self._prefix: dict[bytes, int] = {b"": 0}
        self._counts: dict[bytes, int] = {}
        self._words: dict[bytes, tuple[int, ...]] = {}

    # ---- plain merge loop, used to judge single tokens
    def _merge(self, ids: list[int]) -> list[int]:
        while len(ids) > 1:
            best = min(((self.merges[p][0], k) for k, p in enumerate(zip(ids, ids[1:])) if p in self.merges), default=None)
            if best is None:
                break
            k = best[1]
            ids[k:k + 2] = [self.merges[ids[k], ids[k + 1]][1]]
        return ids

    def _start(self, raw: bytes, closing: bool) -> list[int]:
        out = [self.plain[raw[k:k + 1]] for k in range(len(raw))]
        if closing:
            out[-1] = self.final[raw[-1:]]
        return out

    def _own(self, t: int) -> bool:
        """The token is the encoding of its own bytes."""
        got = self._self.get(t)
        if got is None:
            got = self._self[t] = self._merge(self._start(self.symbols[t], t in self._closed)) == [t]
        return got

    def _fits(self, a: int, b: int) -> bool:
        """``a, b`` is the encoding of its concatenation (``a`` -1: nothing).

        Going back in time from the two tokens, the later of the two merges
        that made the symbols beside the boundary is undone; no merge across
        the boundary may have come before it.  Of equal merges the left one
        comes first.
        """
        if a < 0:
            return self._own(b)
        key = a << 20 | b
        got = self._pairs.get(key)
        if got is None:
            got = self._own(a) and self._own(b) and (a, b) not in self.merges
            x, y, made = a, b, self._made
            while got:
                mx, my = made.get(x), made.get(y)
                if mx is None and my is None:
                    break
                if my is None or (mx is not None and mx[0] > my[0]):
                    limit, x = mx[0], mx[2]
                else:
                    limit, y = my[0] + 1, my[1]
                across = self.merges.get((x, y))
                got = across is None or across[0] >= limit
            if len(self._pairs) > 2 * _MEMO:
                self._pairs.clear()
            self._pairs[key] = got
        return got

    # a state is packed in one number: count, length and id of the last token
    def _state(self, prefix: bytes) -> int:
        """State of an open prefix."""
        memo = self._prefix
        got = memo.get(prefix)
        if got is not None:
            return got
        n = len(prefix)
        known = n - 1
        while prefix[:known] not in memo:
            known -= 1
        if len(memo) > _MEMO // 2:
            memo.clear()
            memo[b""] = 0
            known = 0
        plain, pairs, fits, longest = self.plain, self._pairs, self._fits, self.longest
        for i in range(known + 1, n + 1):
            for k in range(max(0, i - longest), i):
                t = plain.get(prefix[k:i])
                if t is not None:
                    prev = memo[prefix[:k]]
                    if k:
                        ok = pairs.get((prev & 0xFFFFF) << 20 | t)
                        if ok is None:
                            ok = fits(prev & 0xFFFFF, t)
                    else:
                        ok = fits(-1, t)
                    if ok:
                        memo[prefix[:i]] = ((prev >> 28) + 1) << 28 | (i - k) << 20 | t
                        break
        return memo[prefix]

    def _closing(self, word: bytes) -> int:
        """State of a whole word."""
        n = len(word)
        if n > 1:
            self._state(word[:-1])
        for k in range(max(0, n - self.longest), n):
            t = self.final.get(word[k:])
            if t is not None:
                prev = self._state(word[:k])
                if self._fits(prev & 0xFFFFF if k else -1, t):
                    return ((prev >> 28) + 1) << 28 | (n - k) << 20 | t
        raise ValueError(word)

    def count(self, word: bytes) -> int:
        got = self._counts.get(word)
        if got is None:
            got = self._closing(word) >> 28
            if len(self._counts) > _MEMO:
                self._counts.clear()
            self._counts[word] = got
        return got

    def counts(self, word: str) -> list[int]:
        """Token count of every prefix of a pre-token, each a word of its own."""
        return [self.count(word[:k].encode()) for k in range(1, len(word) + 1)]

    def ids(self, word: bytes) -> tuple[int, ...]:
        got = self._words.get(word)
        if got is None:
            at = len(word)
            state = self._closing(word)
            out = []
            while True:
                out.append(state & 0xFFFFF)
                at -= state >> 20 & 0xFF
                if not at:
                    break
                state = self._state(word[:at])
            got = tuple(reversed(out))
            if len(self._words) > _MEMO:
                self._words.clear()
            self._words[word] = got
        return got

    # ---- texts
    def _pieces(self, text: str) -> list[tuple[str, int | None]]:
        if self._special_re is None or "<|" not in text:
            return [(text, None)]
        return [(p, self.specials.get(p)) for p in self._special_re.split(text) if p]

    @staticmethod
    def normalised(text: str) -> str:
        if text.isascii():
            return text.lower()
        # lower-casing is by character, so the final sigma rule does not apply
        return unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()

    def pretokens(self, texts: list[str]):
        """(codes, distinct words, document of each pre-token, start and end
        code point in the document's normalised text).  Codes of special
        strings are ``len(distinct words) + k`` for the k-th special."""
        flat, edges, marks, first = [], [], [], [0]
        names = list(self.specials)
        at = 0
        for text in texts:
            for piece, special in self._pieces(text):
                if special is not None:
                    marks.append((at, names.index(piece)))
                    flat.append("\x00")
                    edges.append(at)
                    at += 1
                else:
                    p = self.normalised(piece)
                    if p:
                        edges.append(at)
                        flat.append(p)
                        at += len(p)
            first.append(at)
        joined = "".join(flat)
        cps = code_points(joined)
        cls = classes()[cps]
        for pos, _ in marks:
            if pos == 0 or cls.flags.writeable:
                cls[pos] = MARK
        edge = np.zeros(cps.size, bool)
        edge[edges] = True
        start = cut(cps, cls, edge, False)
        head = np.flatnonzero(start)
        tail = np.append(head[1:], cps.size)
        keep = cls[head] != SPACE if head.size else np.zeros(0, bool)
        head, tail = head[keep], tail[keep]
        boff = byte_offsets(cps)
        raw = np.frombuffer(joined.encode("utf-8", "surrogatepass"), np.uint8)
        codes, words = encode_spans(raw, boff[head], boff[tail])
        for pos, k in marks:
            codes[np.searchsorted(head, pos)] = len(words) + k
        first = np.array(first)
        doc = np.searchsorted(first, head, side="right") - 1
        return codes, words.to_pylist(), doc, head - first[doc], tail - first[doc]

    def token_counts(self, texts: list[str]):
        """Per pre-token: document, end (code points), running token count in
        the document; the table that answers prefix questions."""
        codes, words, doc, head, tail = self.pretokens(texts)
        size = np.array([self.count(w) for w in words] + [1] * len(self.specials), np.int64)
        each = size[codes] if codes.size else np.zeros(0, np.int64)
        run = np.cumsum(each)
        per_doc = np.bincount(doc, weights=each, minlength=len(texts)).astype(np.int64)
        before = np.concatenate([[0], np.cumsum(per_doc)[:-1]])
        return doc, head, tail, run - before[doc] if doc.size else run, per_doc

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, ids per text)."""
        codes, words, doc, _, _ = self.pretokens(texts)
        table = [self.ids(w) for w in words] + [(i,) for i in self.specials.values()]
        size = np.array([len(t) for t in table], np.int64)
        flat = np.fromiter((i for t in table for i in t), np.int64, int(size.sum()))
        base = np.concatenate([[0], np.cumsum(size)[:-1]])
        n = size[codes] if codes.size else np.zeros(0, np.int64)
        out = flat[_ranges(base[codes], n)] if codes.size else np.zeros(0, np.int64)
        return out, np.bincount(doc, weights=n, minlength=len(texts)).astype(np.int64)


def _ranges(first: np.ndarray, length: np.ndarray) -> np.ndarray:
    base = np.repeat(first - np.concatenate([[0], np.cumsum(length)[:-1]]), length)
    return base + np.arange(int(length.sum()))


@functools.lru_cache(2)
def tokenizer(path: str) -> WordBpe:
    """One per worker and vocabulary file."""
    return WordBpe(path)
