import numpy as np
import pyarrow as pa
import pytest
from tests_llm_helpers import make, package  # noqa: F401
from tessera.llm import bytebpe
from tessera.llm.queries import vocabulary

BYTE = vocabulary("byte_bpe_multi_50k.tiktoken")


def test_words_of_a_block_share_one_dictionary():
    parts = [["the cat", "", "the the"], [""], ["日本 the", " cat\n\ncat"]]
    cut = [bytebpe._words(texts) for texts in parts]
    assert [n.tolist() for _, n in cut] == [[2, 0, 2], [0], [2, 4]]
    assert all(isinstance(words, pa.DictionaryArray) for words, _ in cut)
    codes, words = bytebpe._united([words for words, _ in cut])
    words = words.to_pylist()
    assert len(words) == len(set(words))
    assert [words[c].decode() for c in np.frombuffer(codes, "<i4")] == ["the", " cat", "the", " the", "日本", " the", " cat", "\n", "\n", "cat"]
    codes, words = bytebpe._united([bytebpe._words(["", ""])[0]])
    assert codes == b"" and len(words) == 0


def test_pieces_are_taken_by_id_and_joined():
    pieces = pa.array([b"a", None, "日".encode(), b""], pa.large_binary())
    got = bytebpe._decoded(np.array([0, 2, 3, 0, 0], "<u4"), np.array([0, 0, 3, 3, 5]), pieces)
    assert got.to_pylist() == [b"", "a日".encode(), b"", b"aa"]
    assert bytebpe._decoded(np.zeros(0, "<u4"), np.zeros(3, np.int64), pieces).to_pylist() == [b"", b""]
    with pytest.raises(ValueError):
        bytebpe._decoded(np.array([0, 1], "<u4"), np.array([0, 2]), pieces)


def test_odd_rows_decode_to_themselves(make):
    rows = [(1, "the cat", "en", "s", 7), (1, "the cat", "en", "s", 7), (None, None, None, None, None), (2, "", "en", "s", 0),
            (3, "x\x00é日本" * 50, "en", "s", 1), (4, "<|endoftext|> 12", "en", "s", 1)]
    for size in (bytebpe.BLOCK_BYTES, 1):
        res = bytebpe.encode(make(rows), BYTE, size, decoded=True).collect()
        assert sorted((str(r["doc_id"]), bytes(r["decoded"])) for r in res) == sorted((str(r[0]), (r[1] or "").encode()) for r in rows)
