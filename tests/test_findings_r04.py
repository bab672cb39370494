"""Cases of the fourth review."""

import random
import re

import pytest

from tessera.functions.similarity import combined_py, seq_ratio_py
from tessera.operators import topk


def words(name):
    return sorted(set(re.findall(r"\w+", name.lower())))


def test_like_names_reach_few_masters():
    ids = list(range(4000))
    names = [f"Supplier#{n:09d}" for n in ids]
    tile = topk._Tile(names, [words(n) for n in names], [""] * 4000, [""] * 4000, ids)
    scored, bound = [], []
    common = tile.common
    tile.common = lambda low, at: (bound.extend(at.tolist()), common(low, at))[1]
    asked = [(names[n], words(names[n]), "", "", 0.0, None) for n in range(0, 4000, 80)]
    found = tile.search(asked, 10, lambda a, b: (scored.append(b), topk.ratio_py(a, b))[1], 0.15, True)
    assert [top[0][2] for top in found] == list(range(0, 4000, 80)) and all(len(top) == 10 for top in found)
    assert len(scored) < 50 * 60 and not bound


def test_ratio_of_short_names_is_that_of_difflib():
    rng = random.Random(5)
    for n in range(3000):
        letters = rng.choice(["ab", "abcdé ", "0123456789"])
        a = [rng.choice(letters) for _ in range(rng.randint(0, 20))]
        b = [rng.choice(letters) if rng.random() < 0.2 else x for x in a] if n % 2 else [rng.choice(letters) for _ in range(rng.randint(0, 20))]
        a, b = "".join(a), "".join(b)
        assert topk.ratio_py(a, b) == seq_ratio_py(a, b)
    for b in ("ab" * 99, "ab" * 100, "ab" * 150):
        assert topk.ratio_py("xab" * 30, b) == seq_ratio_py("xab" * 30, b)


@pytest.mark.parametrize("tight", [True, False])
@pytest.mark.parametrize("limits", [{}, {"RARE": 2, "WIDE": 3, "LEAVES": 20}, {"RARE": 0, "WIDE": 50, "LEAVES": 1}])
def test_a_tile_gives_what_scoring_every_master_gives(monkeypatch, tight, limits):
    for key, value in limits.items():
        monkeypatch.setattr(topk, key, value)
    rng = random.Random(11)
    some = ["state", "university", "of", "ohio", "são", "a", "b", "St.", "İzmir", "x" * 70]

    def name():
        if rng.random() < 0.5:
            return f"Supplier#{rng.randint(0, 300):05d}"
        w = " ".join(rng.choice(some) for _ in range(rng.randint(0, 4)))
        at = rng.randrange(len(w) + 1)
        return w[:at] + rng.choice(["", "", "y"]) + w[at:]
    for k in (1, 3, 10):
        master = [(name(), rng.choice(["A", "B", ""]), rng.choice(["D1", "d1", "D2", ""])) for _ in range(60)]
        ids = rng.sample(range(1000), 60)
        tile = topk._Tile([m[0] for m in master], [words(m[0]) for m in master], [m[1] for m in master], [m[2] for m in master], ids)
        asked, want = [], []
        for n in range(20):
            q, pref, attr = (name() if n % 3 else rng.choice(master)[0]), rng.choice(["A", "B", ""]), rng.choice(["D1", "D2", ""])
            pairs = [(-min(1.0, combined_py(q, m) + (0.15 if pref and pref == c else 0)), i) for (m, c, a), i in zip(master, ids)
                     if not (attr and a) or attr.lower() == a.lower()]
            pairs = sorted(p for p in pairs if p[0] < 0)
            floor, row = 0.0, None
            if n % 2 == 0 and pairs:
                less, row = rng.choice(pairs)           # what stands before this pair is asked for
                floor, pairs = -less, [p for p in pairs if p < (less, row)]
            asked.append((q, words(q), pref, attr, floor, row))
            want.append([(round(s, 9), i) for s, i in pairs[:k]])
        found = tile.search(asked, k, topk.ratio_py if tight else seq_ratio_py, 0.15, tight)
        for (*_, floor, row), top, w in zip(asked, found, want):
            got = [(round(s, 9), ids[m]) for s, _, m in top]
            assert [x for x in got if row is None or x < (round(-floor, 9), row)] == w


def test_like_names_over_many_tiles_and_names_that_stand_often(spark):
    left = [f"Supplier#{n:04d}" for n in range(0, 90, 9)] + ["Supplier#0007x"]
    master = [f"Supplier#{n:04d}" for n in range(90)] + ["Supplier#0009"] * 6 + ["supplier#0009"] * 2
    M = spark.createDataFrame([(1000 - j, m) for j, m in enumerate(master)], "row_id long, master_name string").repartition(3)
    L = spark.createDataFrame([(n,) for n in left], "name string")
    got = {}
    for r in topk.exact_topk(L, M, 4, tile_rows=16, block=3, pairs=20).collect():
        got.setdefault(r["name"], []).append((r["rank"], r["row_id"], round(r["score"], 9)))
    for n in left:
        want = sorted((-combined_py(n, m), 1000 - j) for j, m in enumerate(master))[:4]
        assert sorted(got[n]) == [(k + 1, i, round(-s, 9)) for k, (s, i) in enumerate(want)]
