"""Simhash, quality rules and mixing against plain code."""
import collections
import math
import random
import re

import duckdb
import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F
from tests_llm_helpers import corpus, edge_rows, got, make, package, sentence  # noqa: F401
from tessera.llm import graph, mixing, quality, queries, simhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOW = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def plain_fp(text):
    w = WORD.findall((text or "").translate(LOW))
    sh = [" ".join(w[i:i + 4]) for i in range(len(w) - 3)] or ([" ".join(w)] if w else [])
    count = [0] * 64
    for s in sh:
        h = xxhash.xxh64_intdigest(s.encode(), 42)
        for k in range(64):
            count[k] += h >> k & 1
    return sum(1 << k for k in range(64) if 2 * count[k] > len(sh))


def plain_components(nodes, linked):
    par = {n: n for n in nodes}

    def find(x):
        while par[x] != x:
            x = par[x]
        return x
    for a in nodes:
        for b in nodes:
            if a < b and linked(a, b):
                par[find(a)] = find(b)
    return {n: find(n) for n in nodes}


def test_simhash_matches_brute_force(make):
    rows = corpus(11) + edge_rows()
    fps = [plain_fp(r[1]) for r in rows]
    root = plain_components(sorted(set(fps)), lambda a, b: (a ^ b).bit_count() <= 4)
    low = {}
    for r, f in zip(rows, fps):
        if r[0] is not None:
            low[root[f]] = min(low.get(root[f], r[0]), r[0])
    want = sorted([(r[0], f"{f:016x}", low.get(root[f])) for r, f in zip(rows, fps)], key=str)
    res = got(simhash.groups(make(rows)).select("doc_id", "fingerprint", "component_id"))
    assert sorted([tuple(r.values()) for r in res], key=str) == want
    assert got(simhash.groups(make([]))) == []


@pytest.mark.parametrize("max_bits", [1, 3, 4])
def test_links_of_dense_and_random_fingerprints(spark, max_bits):
    rng = random.Random(4)
    fps = {rng.getrandbits(64) for _ in range(150)}
    for centre in list(fps)[:6]:      # balls of near copies, chains between them
        x = centre
        for _ in range(60):
            y = centre
            for _ in range(rng.randint(1, 6)):
                y ^= 1 << rng.randrange(64)
            fps.add(y)
            x ^= 1 << rng.randrange(64) | 1 << rng.randrange(64)
            fps.add(x)
    signed = [x - 2 ** 64 if x >= 2 ** 63 else x for x in fps]
    df = spark.createDataFrame([(x,) for x in signed], "fp long")
    edges = simhash.links(df, max_bits)
    comp = {r["node"]: r["component"] for r in graph.components(edges).collect()}
    want = plain_components(sorted(signed), lambda a, b: ((a ^ b) & (2 ** 64 - 1)).bit_count() <= max_bits)
    mine = collections.defaultdict(set)
    other = collections.defaultdict(set)
    for x in signed:
        mine[comp.get(x, x)].add(x)
        other[want[x]].add(x)
    assert sorted(map(sorted, mine.values())) == sorted(map(sorted, other.values()))


def test_components(spark):
    rng = random.Random(2)
    edges = [(a, a + 1) for a in range(0, 400)] + [(rng.randrange(1000, 1500), rng.randrange(1000, 1500)) for _ in range(300)] + [(5, 5), (7, None)]
    df = spark.createDataFrame(edges, "a long, b long")
    comp = {r["node"]: r["component"] for r in graph.components(df).collect()}
    nodes = sorted({x for e in edges if None not in e and e[0] != e[1] for x in e})
    pairs = {tuple(sorted(e)) for e in edges if None not in e}
    root = plain_components(nodes, lambda a, b: (a, b) in pairs)
    low = {}
    for n in nodes:
        low[root[n]] = min(low.get(root[n], n), n)
    assert comp == {n: low[root[n]] for n in nodes}


def plain_stats(text):
    text = text or ""
    w = WORD.findall(text)
    tri = collections.Counter(zip(w, w[1:], w[2:]))
    cov = set()
    for i in range(len(w) - 2):
        if tri[tuple(w[i:i + 3])] >= 2:
            cov |= {i, i + 1, i + 2}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), sum(text.count(c) for c in "#*$%&|<>"), dup, len(cov)


def test_statistics_match_plain_code(make):
    rows = corpus(13) + edge_rows() + [(800, "a b\na b\n\n a b\na b\n<|>|", "en", "s1", 1), (801, "\n\n", "en", "s1", 1), (802, "x\n\nx", None, None, 1)]
    res = got(quality.judge(make(rows)))
    cols = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    want = []
    for r in rows:
        s = plain_stats(r[1])
        want.append((r[0], *s, s[0] < 50 or 100 * s[4] > 50 * s[0]))
    assert sorted([tuple(r[c] for c in cols) for r in res], key=str) == sorted(want, key=str)
    assert all(not (r["kept"] and r["base_failed"]) for r in res)
    assert got(quality.judge(make([]))) == []


def test_outliers_found_and_clean_kept(make):
    rng = random.Random(5)
    rows = []
    for i in range(700):
        text = ".\n".join(sentence(rng, rng.randint(20, 60)) for _ in range(4))
        if i % 20 == 0:      # symbols glued to every word
            text = " ".join(w + "%%%" for w in text.split())
        rows.append((i, text, "en" if i % 3 else "de", "hot" if i % 2 else f"s{i % 5}", 1))
    res = {r["doc_id"]: r["kept"] for r in got(quality.judge(make(rows)))}
    assert not any(res[i] for i in range(0, 700, 20))
    assert sum(res[i] for i in res if i % 20) / sum(1 for i in res if i % 20) > 0.99


def test_mcd_resists_contamination(spark):
    rng = np.random.default_rng(0)
    good = rng.normal([1, 2, 3, 4], [0.5, 1, 1.5, 2], (4000, 4))
    bad = rng.normal([9, 9, 9, 9], 0.1, (800, 4))
    df = spark.createDataFrame([(*map(float, x), "a", "b") for x in np.vstack([good, bad])], [*quality.FEATURES, "lang", "source"])
    est = quality.mcd(df, ["lang", "source"]).first()
    assert np.allclose(est["mu"], [1, 2, 3, 4], atol=0.4)
    ratio = np.linalg.inv(np.array(est["inv"]).reshape(4, 4)).diagonal() / np.square([0.5, 1, 1.5, 2])
    assert (ratio > 0.4).all() and (ratio < 3).all()


def test_mixing_matches_sql_and_rules(make):
    rows = [r for r in corpus(17) + edge_rows() if r[0] is not None]
    rows = list({r[0]: r for r in rows}.values())        # the SQL below orders by id alone
    labels = [(r[0], i % 2, 0) for i, r in enumerate(rows) if i % 3]
    spark = make([]).sparkSession
    lab = spark.createDataFrame(labels + [(labels[0][0], 1, 1), (None, 1, 1)], "doc_id long, quality int, toxic int")
    res = got(mixing.mix(make(rows), mixing.quality_weights(lab)).drop("source", "text_hash"))
    con = duckdb.connect()
    import pandas as pd
    con.register("documents", pd.DataFrame(rows, columns=["doc_id", "text", "lang", "source", "n_chars"]))
    con.register("labels", lab.toPandas())
    cur = con.execute(queries.ORACLE["op10_mixing"])
    names = [d[0] for d in cur.description]
    want = sorted(tuple(dict(zip(names, r))[c] for c in res[0]) for r in cur.fetchall())
    mine = sorted(tuple(r.values()) for r in res)
    assert [r[:3] + r[4:] for r in mine] == [r[:3] + r[4:] for r in want]
    assert [r[3] for r in mine] == pytest.approx([r[3] for r in want])


def test_mixing_edges(make):
    rows = corpus(17) + edge_rows()
    res = got(mixing.mix(make(rows)))
    assert len(res) == len(rows)
    assert sorted(res, key=str) == sorted(got(mixing.mix(make(rows))), key=str)
    by = collections.defaultdict(list)
    for r in res:
        by[r["source"]].append(r)
        assert 0 <= r["taken"] <= 3 * r["size"]
    total = sum(r["size"] for r in res)
    assert math.isclose(sum(v[0]["target"] for v in by.values()), total, rel_tol=1e-9)
    for v in by.values():
        biggest = max(r["size"] for r in v)
        assert abs(sum(r["taken"] for r in v) - v[0]["target"]) <= biggest
    assert got(mixing.mix(make([]))) == []
    plan = mixing.mix(make(rows))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_targets(spark):
    sizes = [("a", 10), ("b", 1000), ("c", 500), (None, 1)]
    t = {r["source"]: r["target"] for r in mixing.source_targets(spark.createDataFrame(sizes, "source string, source_size long")).collect()}
    assert t["a"] == 30 and t[None] == 3
    assert t["b"] == pytest.approx((1511 - 33) * 2 / 3) and t["c"] == pytest.approx((1511 - 33) / 3)
