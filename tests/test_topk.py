"""Exact top-k against scoring every pair."""
import random

import pytest

from tessera.functions.similarity import combined_py, edit_ratio, round_score  # noqa: F401
from tessera.operators import topk

WORDS = ["state", "university", "college", "of", "north", "south", "tech", "ohio", "são", "paulo", "a", "b", "St.", "İzmir"]


def names(rng, n):
    out = []
    for _ in range(n):
        w = " ".join(rng.choice(WORDS) for _ in range(rng.randint(0, 4)))
        if rng.random() < 0.3 and w:
            i = rng.randrange(len(w))
            w = w[:i] + rng.choice("xyz ") + w[i + 1:]
        out.append(w)
    return out


def edit_combined(a, b):
    import re
    ta, tb = set(re.findall(r"\w+", a.lower())), set(re.findall(r"\w+", b.lower()))
    jac = len(ta & tb) / len(ta | tb) if ta and tb else 0.0
    return 0.4 * topk.edit_ratio_py(a, b) + 0.6 * jac


def brute(left, master, k, score, conf=True, attr=False):
    out = {}
    for i, (a, pref, div) in enumerate(left):
        if a is None:
            out[i] = []
            continue
        s = []
        for j, (b, c, d) in enumerate(master):
            if b is None or (attr and div and d and div.lower() != d.lower()):
                continue
            x = score(a, b) + (0.15 if conf and pref and pref == c else 0.0)
            if x > 0:
                s.append((-min(1.0, x), j))
        out[i] = [(j, round(-x, 9)) for x, j in sorted(s)[:k]]
    return out


@pytest.mark.parametrize("seed,k,options", [(1, 3, {}), (2, 10, {"tile_rows": 7}), (3, 5, {"tile_rows": 3, "block": 4}), (4, 1, {"tile_rows": 11, "sure": 0.9})])
def test_equals_scoring_every_pair(spark, seed, k, options):
    rng = random.Random(seed)
    confs, divs = ["A", "B", "", None], ["D1", "d1", "D2", "", None]
    left = [(n, rng.choice(confs), rng.choice(divs)) for n in names(rng, 40)] + [(None, "A", "D1"), ("zzz qqq", "B", None)]
    master = [(n, rng.choice(confs), rng.choice(divs)) for n in names(rng, 50)] + [(None, "A", "D1"), ("ohio state", "A", "D1"), ("ohio state", "A", "D1")]
    L = spark.createDataFrame([(i, *r) for i, r in enumerate(left)], "id long, name string, pref string, division string").repartition(3)
    M = spark.createDataFrame([(j, *r) for j, r in enumerate(master)], "row_id long, master_name string, conference string, m_div string")
    cases = [(dict(pref="pref", master_conf="conference"), True, False), ({}, False, False),
             (dict(pref="pref", master_conf="conference", left_attr="division", master_attr="m_div"), True, True)]
    for args, conf, attr in cases:
        got = {}
        for r in topk.exact_topk(L, M, k, name="name", **args, **options).collect():
            got.setdefault(r["id"], [])
            if r["rank"] is not None:
                got[r["id"]].append((r["rank"], r["row_id"], round(r["score"], 9)))
        want = brute(left, master, k, combined_py, conf, attr)
        assert {i: [x[1:] for x in sorted(v)] for i, v in got.items()} == want


def test_another_character_score(spark):
    rng = random.Random(9)
    left, master = [(n, "A", None) for n in names(rng, 30)], [(n, rng.choice("AB"), None) for n in names(rng, 40)]
    L = spark.createDataFrame([(i, *r) for i, r in enumerate(left)], "id long, name string, pref string, division string")
    M = spark.createDataFrame([(j, *r) for j, r in enumerate(master)], "row_id long, master_name string, conference string, m_div string")
    out = topk.exact_topk(L, M, 4, name="name", pref="pref", master_conf="conference", seq=edit_ratio, seq_py=topk.edit_ratio_py, tile_rows=9)
    got = {}
    for r in out.collect():
        got.setdefault(r["id"], []).append((r["rank"], r["row_id"], round(r["score"], 9)))
    assert {i: [x[1:] for x in sorted(v)] for i, v in got.items()} == brute(left, master, 4, edit_combined)


def test_empty_sides(spark):
    L = spark.createDataFrame([(1, "ohio state")], "id long, name string")
    M = spark.createDataFrame([], "row_id long, master_name string")
    assert [r["rank"] for r in topk.exact_topk(L, M).collect()] == [None]
    assert topk.exact_topk(L.limit(0), M).collect() == []


def test_edit_ratio_of_strings(spark):
    from pyspark.sql import functions as F
    rng = random.Random(6)
    pairs = [("".join(rng.choice("abcß") for _ in range(rng.randint(0, 70))), "".join(rng.choice("abcß") for _ in range(rng.randint(0, 70)))) for _ in range(150)]
    df = spark.createDataFrame(pairs, "a string, b string").select("a", "b", edit_ratio(F.col("a"), F.col("b")).alias("s"))
    assert all(topk.edit_ratio_py(r["a"], r["b"]) == pytest.approx(r["s"]) for r in df.collect())


def test_few_pairs_are_scored():
    """The bounds end a tile's search early."""
    rng = random.Random(3)
    pool = ["".join(rng.choice("abcdefghijklmnop") for _ in range(9)) for _ in range(900)]
    tile = topk._Tile([f"{w} university" for w in pool], [[w, "university"] for w in pool], [""] * 900, [""] * 900, list(range(900)))
    scored = []

    def score(a, b):
        scored.append(b)
        return combined_py(a, b)
    top = tile.best(pool[5] + " university", [pool[5], "university"], "", "", 0.0, 3, lambda a, b: (scored.append(b), topk.seq_ratio_py(a, b))[1], 0.15)
    assert top[0][2] == 5 and len(scored) < 450


@pytest.mark.parametrize("k", [2, None])
def test_scored_substrings_equal_scanning_every_pair(spark, k):
    from tessera.operators.match import substring_candidates
    rng = random.Random(12)
    master = names(rng, 120) + [None, "", "aaa" * 90, "Ohio " * 60]
    left = ["ohio", "a", "th t", "OHIO state", "ão", "zzq", "", "  ", None, "aaaa", "te", "."] + [m[2:6] for m in master if m and len(m) > 8][:20]
    L = spark.createDataFrame([(t,) for t in left], "name string").repartition(2)
    M = spark.createDataFrame(list(enumerate(master)), "row_id long, master_name string").repartition(3)
    out = substring_candidates(L, M, name="name", k=k).collect()
    got = {}
    for r in out:
        got.setdefault(r["name"], []).append((r["rank"] if k else 0, r["row_id"], round(r["score"], 9)))
    want = {}
    for t in set(left):
        if t and t.strip():
            s = sorted((-combined_py(t, m), j) for j, m in enumerate(master) if m is not None and t.lower() in m.lower())
            if s:
                want[t] = [(j, round(-x, 9)) for x, j in (s[:k] if k else s)]
    assert {t: sorted(x[1:] for x in v) for t, v in got.items()} == {t: sorted(v) for t, v in want.items()}
    if k:
        assert {t: [x[1:] for x in sorted(v)] for t, v in got.items()} == want
