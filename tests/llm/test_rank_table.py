import json

import numpy as np
from pyspark.sql import functions as F
from tests_llm_helpers import make, package  # noqa: F401
from tessera.llm import bytebpe
from tessera.llm.queries import vocabulary

BYTE = vocabulary("byte_bpe_multi_50k.tiktoken")


def test_one_index_finds_a_pair_and_no_other(spark):
    place, table = (np.array(json.loads(x), np.int64) for x in bytebpe._literal(BYTE))
    pairs = np.array(bytebpe.merge_pairs(bytebpe.ranks(BYTE)), np.int64)

    def entry(a, b):
        return table[place[a] + b] ^ a << bytebpe._LEFT

    assert (entry(pairs[:, 0], pairs[:, 1]) == pairs[:, 2] << bytebpe._MERGED).all()
    a, b = np.random.default_rng(1).integers(0, place.size, (2, 200_000))
    known = set(map(tuple, pairs[:, :2].tolist()))
    other = np.array([p not in known for p in zip(a.tolist(), b.tolist())])
    assert (entry(a[other], b[other]) >= 1 << bytebpe._LEFT).all()
    # the fold looks a pair up by index, it searches no bucket
    plan = spark.range(1).select(F.array(F.col("id")).alias("w")).select(bytebpe.fold(F.col("w"), BYTE).alias("w"))
    assert "array_position" not in plan._jdf.queryExecution().analyzed().toString()


def test_fold_merges_by_rank_then_from_the_left(spark):
    ranks = bytebpe.ranks(BYTE)
    rng = np.random.default_rng(2)
    words = ["", "a", "aaaaaaa", "zq", "ééé", " oftionnten", "x" * 300]
    words += ["".join(rng.choice(list("abeinorst é日"), int(n))) for n in rng.integers(1, 30, 60)]

    def merged(word):
        out = [bytes([c]) for c in word.encode()]
        while True:
            best = min(((ranks[x + y], k) for k, (x, y) in enumerate(zip(out, out[1:])) if x + y in ranks), default=None)
            if best is None:
                return [ranks[t] for t in out]
            out[best[1]:best[1] + 2] = [b"".join(out[best[1]:best[1] + 2])]

    rows = [(k, [ranks[bytes([c])] for c in w.encode()]) for k, w in enumerate(words)]
    got = spark.createDataFrame(rows, "k int, w array<bigint>").select("k", bytebpe.fold(F.col("w"), BYTE).alias("w")).collect()
    assert {r["k"]: r["w"] for r in got} == {k: merged(w) for k, w in enumerate(words)}
