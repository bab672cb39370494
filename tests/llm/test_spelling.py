"""Spelling variants against plain code."""
import collections
import random
import re
import zlib

import numpy as np
import pytest
from tests_llm_helpers import corpus, edge_rows, got, make, package  # noqa: F401

from tessera.llm import kdtree, queries, spelling

LOW = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def plain_words(rows, every=31):
    n = collections.Counter()
    for r in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", r[1] or ""):
            w = run.translate(LOW)
            h = zlib.crc32(f"{'null' if r[0] is None else r[0]}:{w}".encode())
            if h % every == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            n[w] += 1
    return {w: c for w, c in n.items() if len(w) >= 7 and c >= 2}


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) - len(a) == 1 and any(b[:k] + b[k + 1:] == a for k in range(len(b)))


def plain_variants(n, ratio=10):
    form, out = {}, {}
    near = {a: [b for b in n if b != a and one_edit(a, b)] for a in n}
    for a in n:
        best = min(near[a], key=lambda b: (-n[b], b), default=None)
        form[a] = best if best is not None and n[best] >= ratio * n[a] else None
    for a in n:
        root = a
        while form[root] is not None:
            root = form[root]
        out[a] = (form[a], root, n[a], len(near[a]), n[form[a]] if form[a] else None)
    return out


def as_dict(df):
    return {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in got(df)}


def invented(rng, alphabet, count, lengths):
    words = {"".join(rng.choice(alphabet) for _ in range(rng.choice(lengths))) for _ in range(count)}
    for w in list(words):       # misspellings, and misspellings of those
        for _ in range(rng.randint(0, 3)):
            k, c = rng.randrange(len(w)), rng.choice(alphabet)
            w = rng.choice([w[:k] + c + w[k + 1:], w[:k] + w[k + 1:], w[:k] + c + w[k:], w[1:2] + w[:1] + w[2:]])
            words.add(w)
    return {w: int(10 ** rng.uniform(0.3, 5)) for w in words if len(w) >= 3}


@pytest.mark.parametrize("alphabet,options", [
    ("abc", {}), ("abcdefghiáñÿ×", {"cell": 8, "sample": 4000}), ("ab", {"cell": 4, "sample": 40}), ("etaoinshrdlu", {"cell": 16, "sample": 300})])
def test_variants_match_all_pairs(spark, alphabet, options):
    rng = random.Random(len(alphabet))
    n = invented(rng, alphabet, 250, [5, 6, 7, 7, 8])
    df = spark.createDataFrame(list(n.items()), "word string, n long").repartition(3)
    assert as_dict(spelling.variants(df, **options)) == plain_variants(n)


def test_long_chains_and_hubs(spark):
    n = {"a" * k: 12 ** (k - 5) for k in range(6, 16)}               # a chain of forms
    n |= {"center" + chr(97 + k): 1 for k in range(26)} | {"center": 5000}    # many near words of one
    n |= {"x" * 40_000: 3, "x" * 39_999 + "y": 40}
    df = spark.createDataFrame(list(n.items()), "word string, n long")
    assert as_dict(spelling.variants(df)) == plain_variants(n)


def test_documents(make):
    rng = random.Random(8)
    rows = corpus(9, 60) + edge_rows()
    text = ["Thanedble ciónción onharent, pathetic-Pathetique résumés7résumés ÀÉÎõüÿß"] * 40 + ["thanedbel cioncion onharrent pathetic"] * 2
    rows += [(100 + k, " ".join(rng.sample(t.split(), 3)) + " " + t, "en", "s", 1) for k, t in enumerate(text)] + [(None, text[0], None, None, None)] * 2
    rows += [(7000, "Abcdefghij" * 3000, "en", "s", 1)] * 2
    want = plain_variants(plain_words(rows))
    assert any(v[0] for v in want.values())
    assert as_dict(spelling.grouped(make(rows))) == want
    assert got(spelling.grouped(make([]))) == []
    assert got(spelling.grouped(make([(1, None, None, None, None), (2, "", None, None, 0)]))) == []


def test_deleted_code_points(make):
    rows = [(k, "wonderful überraschung", "en", "s", 1) for k in range(200)]
    assert {r["word"]: r["n"] for r in got(spelling.words(make(rows), every=3))} == plain_words(rows, 3)


def test_tree_reaches_every_vector_in_range():
    rng = random.Random(5)
    words = ["".join(rng.choice("aabbbcdé") for _ in range(7)) for _ in range(400)]
    counts = kdtree.letter_counts(kdtree.letters(words))
    bits = kdtree.layout(counts)
    codes = kdtree.unary(counts, bits)
    for tight in (True, False):
        tree = kdtree.Tree(codes, 6, tight)
        assert sorted(tree.order.tolist()) == list(range(400)) and len(tree.leaves) > 30
        hit = {(a, b) for w, p in [tree.reach(codes, 1, 1)] for q, v in tree.members(w, p, 100) for a, b in zip(q.tolist(), v.tolist())}
        for a in range(0, 400, 7):
            diff = counts - counts[a]
            want = np.flatnonzero((np.maximum(diff, 0).sum(1) <= 1) & (np.maximum(-diff, 0).sum(1) <= 1))
            assert {(a, int(b)) for b in want} <= hit
        assert len(hit) < 400 * 400 / 2      # and prunes


def test_query_columns(spark):
    df = queries.QUERIES["op11_spelling_variants"](spark, "/root/testdata/sf0.001")
    assert df.columns[:6] == ["word", "form", "root", "n", "n_near", "form_n"]
