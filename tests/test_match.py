import random

import pytest
from pyspark.sql import functions as F

from tessera.functions.similarity import combined_py
from tessera.operators import match as mt

WORDS = ["state", "university", "college", "of", "north", "south", "tech", "ohio", "são", "paulo", "a", "b"]


def _names(rng, n):
    out = []
    for _ in range(n):
        k = rng.randint(0, 4)
        out.append(" ".join(rng.choice(WORDS) for _ in range(k)))
    return out


def _jac(a, b):
    import re
    ta, tb = set(re.findall(r"\w+", a.lower())), set(re.findall(r"\w+", b.lower()))
    return 0.0 if not ta or not tb else len(ta & tb) / len(ta | tb)


def test_jaccard_top1_equals_nested_loop(spark):
    rng = random.Random(7)
    left = _names(rng, 60)
    master = _names(rng, 40)
    L = spark.createDataFrame([(i, n) for i, n in enumerate(left)], "id long, name string")
    M = spark.createDataFrame([(i, n) for i, n in enumerate(master)], "row_id long, master_name string")
    got = {r["id"]: (r["match_row_id"], r["similarity_score"]) for r in
           mt.best_match(L, M, name="name", scorer="jaccard").collect()}   # shuffle path
    for i, a in enumerate(left):
        best, bid = 0.0, None
        for j, b in enumerate(master):
            s = _jac(a, b)
            if s > best:
                best, bid = s, j
        assert got[i] == (bid, round(best, 3)), (a, got[i], bid, best)


def test_combined_topk_equals_nested_loop_when_complete(spark):
    rng = random.Random(11)
    left = _names(rng, 40)
    master = _names(rng, 30)
    confs = ["A", "B", "C"]
    L = spark.createDataFrame([(i, n, confs[i % 3]) for i, n in enumerate(left)], "id long, name string, pref string")
    M = spark.createDataFrame([(j, n, confs[j % 3]) for j, n in enumerate(master)],
                              "row_id long, master_name string, conference string")
    k = 3
    out = mt.fuzzy_topk(L, M, k=k, name="name", pref="pref", master_conf="conference").collect()
    by = {}
    for r in out:
        if r["rank"] is not None:
            by.setdefault(r["id"], []).append((r["rank"], r["row_id"], r["score"], r["complete"]))
    n_complete = 0
    for i, a in enumerate(left):
        scores = []
        for j, b in enumerate(master):
            s = combined_py(a, b)
            if confs[i % 3] == confs[j % 3]:
                s = min(1.0, s + 0.15)
            scores.append((-s, j))
        brute = [(j, -s) for s, j in sorted(scores) if -s > 0][:k]
        mine = sorted(by.get(i, []))
        if mine and mine[0][3]:
            n_complete += 1
            assert [m[1] for m in mine] == [b[0] for b in brute]
            assert [m[2] for m in mine] == pytest.approx([b[1] for b in brute])
        # every returned candidate is a true pair with its true score
        for _, j, s, _ in mine:
            exp = combined_py(a, master[j]) + (0.15 if confs[i % 3] == confs[j % 3] else 0)
            assert s == pytest.approx(min(1.0, exp))
    assert n_complete > 0


def test_plan_has_no_nested_loop(spark):
    L = spark.createDataFrame([(1, "ohio state")], "id long, name string")
    M = spark.createDataFrame([(1, "ohio state university")], "row_id long, master_name string")
    plan = mt.fuzzy_topk(L, M, k=2, name="name")._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_set_similarity_join_brute(spark):
    rng = random.Random(3)
    a = _names(rng, 50)
    b = _names(rng, 20)
    A = spark.createDataFrame(list(enumerate(a)), "i long, t string")
    B = spark.createDataFrame(list(enumerate(b)), "j long, t string")
    got = {(r["i"], r["j"]): r["jaccard"] for r in mt.set_similarity_join(A, B, "i", "j", "t", "t", 0.5).collect()}
    exp = {(i, j): _jac(x, y) for i, x in enumerate(a) for j, y in enumerate(b) if _jac(x, y) >= 0.5}
    assert set(got) == set(exp)
    for k, v in exp.items():
        assert got[k] == pytest.approx(v)


def test_substring_exact_alias_resolve(spark):
    M = spark.createDataFrame([(1, "Ohio State University"), (2, "State Tech"), (3, "Ohio State University")],
                              "row_id long, master_name string")
    L = spark.createDataFrame([("state",), ("io",), ("zz",)], "name string")
    got = sorted((r["name"], r["row_id"]) for r in mt.substring_candidates(L, M, name="name").collect())
    assert got == [("io", 1), ("io", 3), ("state", 1), ("state", 2), ("state", 3)]
    E = spark.createDataFrame([(" ohio STATE university ",), ("x",)], "name string")
    assert sorted((r["name"], r["match_row_id"]) for r in mt.exact_lookup(E, M).collect()) == \
        [(" ohio STATE university ", 1), ("x", None)]
    al = spark.createDataFrame([("OSU", "Ohio State University")], "alias string, canonical string")
    Q = spark.createDataFrame([("OSU",), ("Ohio State University!",), ("nothing",)], "name string")
    r = {x["name"]: (x["matched_name"], x["match_source"]) for x in mt.alias_then_fuzzy(Q, al, M, name="name").collect()}
    assert r == {"OSU": ("Ohio State University", "alias"), "Ohio State University!": ("Ohio State University", "fuzzy"),
                 "nothing": (None, "none")}
    cands = spark.createDataFrame([("a", 1, 10, "X", 0.95), ("b", 1, 11, "Y", 0.5), ("c", 1, 12, "Z", 0.5),
                                   ("d", 1, 13, "W", 0.4)], "k string, rank int, row_id long, master_name string, score double")
    dec = spark.createDataFrame([("b", "pick", 99), ("c", "skip", None)], "left_key string, action string, pick_row_id long")
    acc, rev = mt.resolve_matches(cands, dec, key="k", accept_at=0.9)
    assert sorted((r["k"], r["chosen_row_id"], r["how"]) for r in acc.collect()) == [("a", 10, "auto"), ("b", 99, "pick")]
    assert [r["k"] for r in rev.collect()] == ["d"]


def test_prefix_filtered_topk_equals_nested_loop_above_min_score(spark):
    rng = random.Random(21)
    left = _names(rng, 50)
    master = _names(rng, 40)
    confs = ["A", "B", "C"]
    L = spark.createDataFrame([(i, n, confs[i % 3]) for i, n in enumerate(left)], "id long, name string, pref string")
    M = spark.createDataFrame([(j, n, confs[j % 3]) for j, n in enumerate(master)],
                              "row_id long, master_name string, conference string")
    k = 3
    for scorer, min_score, bonus in (("jaccard", 0.5, False), ("combined", 0.6, True)):
        for limit in ("-1", "100m"):                     # shuffle path and broadcast path
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
            kw = dict(pref="pref", master_conf="conference") if bonus else {}
            out = mt.fuzzy_topk(L, M, k=k, name="name", scorer=scorer, min_score=min_score, **kw).collect()
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
            by = {}
            for r in out:
                if r["rank"] is not None:
                    by.setdefault(r["id"], []).append((r["rank"], r["row_id"], r["score"]))
                    assert r["complete"] is True
            for i, a in enumerate(left):
                scores = []
                for j, b in enumerate(master):
                    s = _jac(a, b) if scorer == "jaccard" else combined_py(a, b)
                    if bonus and confs[i % 3] == confs[j % 3]:
                        s = min(1.0, s + 0.15)
                    if s > 0 and s >= min_score - 1e-12:
                        scores.append((-s, j))
                brute = [(j, -s) for s, j in sorted(scores)][:k]
                mine = sorted(by.get(i, []))
                assert [m[1] for m in mine] == [b[0] for b in brute], (scorer, limit, a)
                assert [m[2] for m in mine] == pytest.approx([b[1] for b in brute])


def test_set_similarity_join_equals_brute_force(spark):
    rng = random.Random(8)
    words = [f"w{k}" for k in range(30)] + ["the"] * 10
    A = [(i, " ".join(rng.choice(words) for _ in range(rng.randint(0, 14)))) for i in range(120)]
    B = [(j, " ".join(rng.choice(words[:20] + ["the"]) for _ in range(rng.randint(0, 10)))) for j in range(60)]
    a, b = spark.createDataFrame(A, "i long, t string"), spark.createDataFrame(B, "j long, t string")
    for t in (0.25, 0.5, 1.0):
        want = set()
        for i, x in A:
            for j, y in B:
                p, q = set(x.split()), set(y.split())
                if p and q and len(p & q) / len(p | q) >= t:
                    want.add((i, j, len(p & q)))
        for limit in ("-1", "100m"):                     # shuffled and broadcast
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
            got = {(r["i"], r["j"], r["shared"]) for r in mt.set_similarity_join(a, b, "i", "j", "t", "t", t).collect()}
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
            assert got == want
