"""Texts just past, and just before, the cut of each quality statistic."""
from tests_llm_helpers import got, make, package  # noqa: F401
from tessera.llm import quality


def text(doc, n=200, size=6, width=10):
    """``n`` words of ``size`` characters, none twice in all documents."""
    ws = [f"{doc:03d}{i:03d}".ljust(size, "x") for i in range(n)]
    return "\n".join(" ".join(ws[i:i + width]) for i in range(0, n, width))


def symbols(doc, k):
    ws = text(doc, width=200).split()
    return " ".join(["%" + w[1:] for w in ws[:k]] + ws[k:])


def repeats(doc, k):
    ws = text(doc, n=200 - k // 2, width=200).split()
    return " ".join(ws + ws[:k // 2])


def lines(doc, per_unit):
    units = text(doc, n=64, width=8).split("\n")
    return "\n".join("\n".join(["one"] * per_unit + [u]) for u in units)


def test_each_statistic_rejects_just_past_its_cut(make):
    rows = [(i, text(i), "en", "s", 1) for i in range(300)]
    past = {300: text(300, size=10, width=10), 301: symbols(301, 18), 302: repeats(302, 70), 303: lines(303, 2)}
    before = {310: text(310, size=8), 311: symbols(311, 13), 312: repeats(312, 54), 313: "\n".join(lines(313, 1).split("\n")[:12] + text(314).split("\n"))}
    rows += [(k, v, "en", "s", 1) for k, v in (past | before).items()]
    res = {r["doc_id"]: r for r in got(quality.judge(make(rows)))}
    assert not any(r["base_failed"] for r in res.values())
    assert not [k for k in past if res[k]["kept"]], [res[k]["distance"] for k in past]
    assert not [k for k in res if k not in past and not res[k]["kept"]]


def test_wide_scatter_is_not_widened_by_the_floor(spark):
    """A group whose spread is far above the floors is judged by its own."""
    import numpy as np
    rng = np.random.default_rng(1)
    sd = [1.0, 2.0, 2.5, 3.0]
    rows = rng.normal([1, 2, 3, 4], sd, (4000, 4))
    df = spark.createDataFrame([(*map(float, x), "a", "b") for x in rows], [*quality.FEATURES, "lang", "source"])
    inv = np.array(quality.mcd(df, ["lang", "source"]).first()["inv"]).reshape(4, 4)
    assert np.allclose(np.sqrt(np.diag(np.linalg.inv(inv))), sd, rtol=0.08)


def plain_verdicts(rows):
    """Distances by the same definition on plain arrays, group by group."""
    import collections
    import math

    import numpy as np
    q8 = quality
    s = q8.SCALE
    good = [r for r in rows if not r["failed"]]
    x = {id(r): np.array([int(math.floor(v * s + 0.5)) for v in r["x"]]) for r in good}

    def floored(cov):
        m = cov / np.outer(q8.FLOORS, q8.FLOORS)
        w, v = np.linalg.eigh((m + m.T) / 2)
        w = np.maximum(w, 1.0)
        return (v / w) @ v.T / np.outer(q8.FLOORS, q8.FLOORS), float(np.log(w).sum())

    def moments(a, factor):
        mu = a.mean(0)
        return mu / s, (a.T @ a / len(a) - np.outer(mu, mu)) * factor / s**2

    def low_median(v):
        return np.sort(v)[(len(v) + 1) // 2 - 1]

    def concentrated(members):
        a = np.array([x[id(r)] for r in members], float)
        med = np.array([low_median(a[:, i]) for i in range(4)])
        mad = np.array([low_median(np.abs(a[:, i] - med[i])) for i in range(4)]) * 1.4826
        unit = np.maximum(mad, np.array(q8.FLOORS) * s)
        bent = np.floor(np.tanh((a - med) / unit) * s + 0.5)
        u = unit / s
        starts = [(med / s, np.diag((mad / s) ** 2)), moments(a, 1.0), (med / s, moments(bent, 1.0)[1] * np.outer(u, u))]
        best = None
        for k, (mu, cov) in enumerate(starts):
            inv, before = floored(cov)[0], math.inf
            while True:
                d = a / s - mu
                bins = np.floor(np.log2(1 + np.einsum("ij,jk,ik->i", d, inv, d)) * q8.BINS)
                cut = np.sort(bins)[math.ceil(len(bins) * q8.H_SHARE) - 1]
                m2, c2 = moments(a[bins <= cut], q8.CONSISTENCY)
                i2, det = floored(c2)
                if not det < before - 1e-9:
                    if det <= before:
                        mu, cov, before = m2, c2, det
                    break
                mu, cov, inv, before = m2, c2, i2, det
            if best is None or (before, k) < best[0]:
                best = ((before, k), mu, cov)
        return len(a), best[1], best[2]

    groups = [collections.defaultdict(list) for _ in range(3)]
    for r in good:
        for level, key in enumerate([(), (r["lang"],), (r["lang"], r["source"])]):
            groups[level][key].append(r)
    est = [{k: concentrated(v) for k, v in g.items()} for g in groups]
    out = []
    for r in rows:
        if r["failed"]:
            out.append((r["id"], None, False))
            continue
        _, mu, cov = est[0][()]
        for level, key in ((1, (r["lang"],)), (2, (r["lang"], r["source"]))):
            n, m, c = est[level][key]
            w = n / (n + q8.SHRINK)
            mu, cov = m * w + mu * (1 - w), c * w + cov * (1 - w)
        d = x[id(r)] / s - mu
        d2 = float(d @ floored(cov)[0] @ d)
        out.append((r["id"], d2, d2 <= q8.CUTOFF))
    return out


def mixed_rows():
    import random
    from tests_llm_helpers import corpus, edge_rows, sentence
    rng = random.Random(7)
    rows = []
    for i in range(420):
        t = ".\n".join(sentence(rng, rng.randint(15, 60)) for _ in range(4))
        if i % 17 == 0:
            t = " ".join(w + "%#" * rng.randint(0, 2) for w in t.split())
        if i % 23 == 0:
            t += "\nmore of it" * rng.randint(1, 9)
        rows.append((i, t, rng.choice(["en", "en", "de", None]), rng.choice(["hot", "hot", "s1", None]), 1))
    return rows + [(1000 + k, *r[1:]) for k, r in enumerate(corpus(3, 30) + edge_rows())]


def test_verdicts_match_plain_arrays(make):
    import math

    import pytest
    rows = mixed_rows()
    src = quality.statistics(make(rows)).withColumn("failed", quality.base_failed()).select("doc_id", "lang", "source", "failed", *quality._vector())
    stats = [dict(id=r["doc_id"], lang=r["lang"], source=r["source"], failed=r["failed"], x=[r[f] for f in quality.FEATURES]) for r in got(src)]
    want = {i: (d, k) for i, d, k in plain_verdicts(stats)}
    res = {r["doc_id"]: (r["distance"], r["kept"]) for r in got(quality.judge(make(rows)))}
    assert len(want) == len(rows) and {i: k for i, (_, k) in res.items()} == {i: k for i, (_, k) in want.items()}
    for i, (d, _) in want.items():
        assert res[i][0] == (d if d is None else pytest.approx(d, rel=1e-6, abs=1e-9))
    assert 0 < sum(not k for _, k in want.values()) and math.isfinite(sum(d for d, _ in want.values() if d is not None))


def test_distances_do_not_depend_on_partitions(make):
    rows = mixed_rows()
    seen = [sorted(((r["doc_id"], r["distance"], r["kept"]) for r in got(quality.judge(make(rows).repartition(n)))), key=str) for n in (1, 7)]
    assert seen[0] == seen[1]


def test_groups_below_the_floors_have_one_estimate(spark):
    """Where every spread is below its floor all determinants are equal: the
    estimate is the last step's, under any partitioning."""
    import numpy as np
    rng = np.random.default_rng(2)
    rows = [(*map(float, x), "a", f"s{k % 5}") for k, x in enumerate(rng.normal([1.5, 0.3, 0.2, 0.4], [0.03, 0.1, 0.2, 0.1], (900, 4)))]
    df = spark.createDataFrame(rows, [*quality.FEATURES, "lang", "source"])
    seen = [sorted((r["source"], tuple(r["mu"]), tuple(r["inv"])) for r in quality.mcd(df.repartition(n), ["lang", "source"]).collect()) for n in (1, 6)]
    assert seen[0] == seen[1] and len(seen[0]) == 5
    stats = [dict(id=k, lang=r[4], source=r[5], failed=False, x=r[:4]) for k, r in enumerate(rows)]
    want = plain_verdicts(stats)
    est = {(r["lang"], r["source"]): r for r in quality.shrunk(df).collect()}
    for r, (_, d2, _) in zip(rows, want):
        e = est[r[4], r[5]]
        d = np.floor(np.array(r[:4]) * quality.SCALE + 0.5) / quality.SCALE - np.array(e["mu"])
        assert abs(float(d @ np.array(e["inv"]).reshape(4, 4) @ d) - d2) < 1e-6
