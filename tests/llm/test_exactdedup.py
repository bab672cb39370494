"""Exact dedup and its filters against plain code."""
import collections
import hashlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tests_llm_helpers import corpus, edge_rows, got, make, package  # noqa: F401

from tessera.llm import exactdedup as ed
from tessera.llm import fuse, queries


def normal(text):
    return (text or "").translate({c: None for c in (9, 10, 11, 12, 13, 32)})


def plain(rows):
    """doc_id, keep_id, group_size, text_sha256 per row, and the number of
    kept rows per group."""
    groups = collections.defaultdict(list)
    for r in rows:
        groups[normal(r[1])].append(r)
    out = []
    for body, members in groups.items():
        best = min(members, key=lambda r: (-len(r[1] or ""), r[0] is None, r[0] or 0))
        out += [(r[0], best[0], len(members), hashlib.sha256(body.encode()).hexdigest()) for r in members]
    return sorted(out, key=str), groups


def check(rows, df):
    res = got(df)
    want, groups = plain(rows)
    assert sorted([(r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in res], key=str) == want
    kept = [r for r in res if r["kept"]]
    assert len(kept) == len(groups) and len({r["text_sha256"] for r in kept}) == len(groups)
    assert all(r["doc_id"] == r["keep_id"] for r in kept)


def spaced(rows):
    """Copies that differ in blanks only; longer ones are preferred."""
    more = [(1000 + k, "  \t".join((r[1] or "").split(" ")) + "\r\n" * (k % 3), r[2], r[3], 0) for k, r in enumerate(rows[::3])]
    return rows + more + [(2000 + k, " the hot\ttext ", "en", "s1", 1) for k in range(150)] + [(3000, "\x0b\x0c the hot text", "en", "s1", 1)]


@pytest.mark.parametrize("options", [{}, {"batches": 1}, {"batches": 4, "shard_keys": 8}, {"key_bits": 3, "shard_keys": 4}, {"key_bits": 1, "batches": 2}])
def test_matches_plain_groups(make, options):
    rows = spaced(corpus(3, 60) + edge_rows())
    check(rows, ed.deduplicated(make(rows), **options))


def test_empty_and_one_row(make):
    assert got(ed.deduplicated(make([]))) == []
    check([(5, None, None, None, None)], ed.deduplicated(make([(5, None, None, None, None)])))


def test_batches_meet_only_what_they_must(make):
    """A later batch is screened, verified and frozen; what is known is not
    frozen again."""
    first, second = [(k, f"text {k}", "en", "s", 1) for k in range(50)], [(100 + k, f"te xt{k}", "en", "s", 1) for k in range(40, 70)]
    index = ed.Index(shard_keys=16)
    index.add(make(first))
    entry = index.add(make(second))
    assert entry.where("origin = 0").count() == 10 and entry.where("origin = 1").count() == 20
    assert index.snapshots[1].known.count() == 20 and index.snapshots[0].shards == 4
    hits = ed.screen(ed.classes(index.batches[1]), index.snapshots[0], 16)
    known = {r["digest"] for r in index.snapshots[0].known.collect()}
    assert {r["digest"] for r in hits.collect()} >= known & {r["digest"] for r in entry.collect()}
    check(first + second, index.groups())


def test_a_hot_text_needs_few_rows(make):
    df = make([(k, "same text" if k % 3 else f"t{k}", "en", "s", 1) for k in range(1200)]).coalesce(2)
    hot = ed.packets(df).where(F.size("members") > 1)
    assert hot.count() <= 8 and hot.select(F.sum(F.size("members"))).first()[0] == 800


def test_query_columns(spark):
    df = queries.QUERIES["op12_exact_dedup"](spark, "/root/testdata/sf0.001")
    assert df.columns[:5] == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]


@settings(max_examples=40, deadline=None)
@given(st.sets(st.integers(0, 2**64 - 1), max_size=300))
def test_filter_never_misses_a_key(keys):
    arr = np.array(sorted(keys), np.uint64)
    assert fuse.passes(fuse.build(arr), arr).all()


def test_filter_rejects_strangers():
    rng = np.random.default_rng(4)
    keys, other = (rng.integers(0, 2**63, n).astype(np.uint64) for n in (30_000, 200_000))
    blob = fuse.build(np.concatenate([keys, keys[:5]]))
    assert fuse.passes(blob, keys).all() and fuse.passes(blob, other).mean() < 0.006 and len(blob) < 1.5 * 30_000
