import numpy as np
import pytest
from tessera.llm import bytebpe, sais
from tessera.llm import suffixdedup as sd
from tessera.llm.queries import vocabulary


def groups(seed, length, gram, word):
    """(anchors, pieces, copies) of groups with several spans, as shards get them."""
    rng = np.random.default_rng(seed)
    parts = [rng.integers(97, 97 + word, int(n)).astype(np.uint8) for n in rng.integers(length // 2, 3 * length, 12)]
    found = {}
    for _ in range(30):
        raw = np.concatenate([parts[k][rng.integers(0, 9):] for k in rng.integers(0, len(parts), 4)])
        for a, n, h, s in zip(*sd.spans(raw, length, gram)):
            e = found.setdefault(int(np.uint64(h).view(np.int64)), {}).setdefault(int(s), [0, raw[a:a + n].tobytes()])
            e[0] += 1
    rows = [(h, p, c) for h, kinds in found.items() if len(kinds) > 1 for c, p in kinds.values()]
    return [list(c) for c in zip(*rows)]


@pytest.mark.parametrize("length, gram, word", [(400, 128, 26), (40, 12, 26), (41, 12, 2), (240, 96, 4)])
def test_only_what_may_be_shared_is_sorted(length, gram, word, monkeypatch):
    anchors, pieces, copies = groups(length, length, gram, word)
    every = sd.repeated_starts(pieces, copies, length)
    assert sum(f.any() for f in every) > 5
    sorted_bytes, plain = [], sd.repeated_starts
    monkeypatch.setattr(sd, "repeated_starts", lambda p, c, n: sorted_bytes.append(sum(map(len, p))) or plain(p, c, n))
    got = sd.piece_flags(anchors, pieces, copies, length, gram)
    assert all((a == b).all() for a, b in zip(got, every))
    assert sum(sorted_bytes) < sum(map(len, pieces))
    # nothing in common but the anchor: nothing is sorted
    one = [k for k in range(len(anchors)) if anchors.index(anchors[k]) == k]
    sorted_bytes.clear()
    got = sd.piece_flags([anchors[k] for k in one], [pieces[k] for k in one], [1] * len(one), length, gram)
    assert not sorted_bytes and not any(f.any() for f in got)


def test_codes_that_end_pieces_are_swept_at_once(monkeypatch):
    rng = np.random.default_rng(4)
    codes = rng.integers(0, 5, 3000)
    codes[9::10] = 256 + np.arange(300)
    lone, plain = [], sais._sweep_buckets
    monkeypatch.setattr(sais, "_sweep_buckets", lambda *a: lone.append(a[7]) or plain(*a))
    assert sais.suffix_array(codes).tolist() == sorted(range(codes.size), key=lambda i: codes[i:].tolist())
    assert lone[0] == 300
    # ends beside each other, and greatest codes that occur twice
    for more in ([300, 301], [1, 301, 300], [300, 0, 300]):
        x = np.concatenate([codes[:50], more])
        assert sais.suffix_array(x).tolist() == sorted(range(x.size), key=lambda i: x[i:].tolist())


def test_the_rank_literal_is_short():
    place, table = bytebpe._literal(vocabulary("byte_bpe_multi_50k.tiktoken"))
    # plans and their descriptions repeat it in the driver
    assert len(place) + len(table) < 4_000_000


def test_rows_of_token_zero(tmp_path, spark):
    import base64
    from pyspark.sql import functions as F
    names = [bytes([k]) for k in range(256)]
    pieces = names + [b"\0\0", b"\0a", b"a\0", b"\1\0", b"\0\0\0\0"]
    path = tmp_path / "ranks"
    path.write_text("".join(f"{base64.b64encode(p).decode()} {k}\n" for k, p in enumerate(pieces)))
    rows = [(k, list(w)) for k, w in enumerate([b"\0\0\0\0\0", b"\1\0a", b"a\0\0", b"\0\1\2", b"\2\3", b"bc\0"])]
    got = spark.createDataFrame(rows, "k int, w array<bigint>").select("k", bytebpe.fold(F.col("w"), str(path)).alias("w")).collect()
    assert {r["k"]: r["w"] for r in got} == {0: [260, 0], 1: [1, 257], 2: [97, 256], 3: [0, 1, 2], 4: [2, 3], 5: [98, 99, 0]}
