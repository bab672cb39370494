import hashlib
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tests_llm_helpers import corpus, edge_rows, got, make, package  # noqa: F401
from tessera.llm import bytebpe, idcoder, tokencounts, tokenfiles
from tessera.llm.queries import vocabulary
from tessera.llm.wordbpe import tokenizer

WORD, BYTE = vocabulary("word_bpe_49k.json"), vocabulary("byte_bpe_multi_50k.tiktoken")
TRICKY = [(100, "don't DON'T we'll'm '' 's 12 ½²á é x'rex !'s  ''s", "en", "s", 1), (101, "a<|endoftext|>b <|startoftext|>", "en", "s", 1),
          (102, "İstanbul ΑΣ Σ  \x85 \xa0  tab\t\t\nnew \n\n x   ", "en", "s", 1), (103, "日本語 テスト १२ 👍🏽 \x1c", "en", "s", 1), (104, "   ", "en", "s", 1)]


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(WORD)


def rows_():
    return corpus(7, 40) + edge_rows() + TRICKY


def test_counts_equal_the_library(make, library):
    rows = rows_()
    res = sorted((str(r["doc_id"]), r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in got(tokencounts.counts(make(rows), WORD, limit=50)))
    want = []
    for r in rows:
        n = len(library.encode(r[1] or "", add_special_tokens=False).ids)
        want.append((str(r[0]), len((r[1] or "").encode()), n, n > 50))
    assert res == sorted(want)
    assert got(tokencounts.counts(make([]), WORD)) == []


def test_every_prefix_and_budget(library):
    bpe = tokenizer(WORD)
    for r in [x for x in rows_() if x[1] and len(x[1]) < 400 and "<|" not in x[1]][:25]:
        t = tokencounts.PrefixTable(bpe, r[1])
        n = [len(library.encode(t.text[:k], add_special_tokens=False).ids) for k in range(len(t.text) + 1)]
        assert [t.at(k) for k in range(len(t.text) + 1)] == n
        for budget in (0, 1, 7, 10 ** 6):
            best = t.longest_within(budget)
            assert t.at(best) <= budget
            assert best == max(k for k in range(len(n)) if n[k] <= budget)


def test_files_round_trip(make, library):
    rows = rows_()
    res = got(tokenfiles.round_trip(make(rows), WORD))
    at, want = 0, []
    for r in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, (r[1] or "").encode())):
        ids = [*library.encode(r[1] or "", add_special_tokens=False).ids, 2]
        want.append((r[0], at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    assert sorted([tuple(r.values()) for r in res], key=lambda r: r[1]) == want
    assert got(tokenfiles.round_trip(make([]), WORD)) == []


def test_coder(spark):
    rng = np.random.default_rng(0)
    for n, high, block in ((0, 5, 7), (1, 2, 7), (50, 1, 7), (500, 65536, 64), (3000, 40, 100)):
        ids = rng.integers(0, high, n)
        blocks = idcoder.encode(ids, block)
        assert (idcoder.decode(blocks) == ids).all()
        # blocks are independent, and damage is found
        if len(blocks) > 2:
            assert (idcoder.decode(blocks[1:2]) == ids[block:2 * block]).all()
            bad = bytearray(blocks[1])
            bad[20] ^= 0x55
            with pytest.raises(ValueError):
                idcoder.decode([bytes(bad)])
    same = idcoder.encode(np.tile(np.arange(20), 200))
    assert sum(map(len, same)) < 2000           # repeats are learned


def test_byte_bpe_equals_the_library(make):
    import public_tokenizers
    import tiktoken
    enc = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bytebpe.ranks(BYTE), special_tokens={})
    rows = rows_()
    want = []
    for r in rows:
        t = r[1] or ""
        ids = enc.encode_ordinary(t)
        want.append((str(r[0]), len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(t.encode()).hexdigest()))
    for size in (bytebpe.BLOCK_BYTES, 3000):
        df = bytebpe.decode(bytebpe.encode(make(rows), BYTE, size), BYTE)
        df = df.select("doc_id", (F.length("ids") / 4).cast("long"), F.sha2("ids", 256), F.sha2("decoded", 256))
        assert sorted((str(r[0]), *r[1:]) for r in map(tuple, df.collect())) == sorted(want)
    assert got(bytebpe.digests(make([]), BYTE)) == []
