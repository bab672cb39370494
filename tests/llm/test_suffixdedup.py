import collections
import hashlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tests_llm_helpers import corpus, edge_rows, got, make, package  # noqa: F401
from tessera.llm import sais, suffixdedup as sd


def plain(rows, length):
    texts = [(r[1] or "").encode() for r in rows]
    count = collections.Counter(t[i:i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for r, t in zip(rows, texts):
        cov = np.zeros(len(t), bool)
        for i in range(len(t) - length + 1):
            if count[t[i:i + length]] > 1:
                cov[i:i + length] = True
        left = bytes(np.frombuffer(t, np.uint8)[~cov])
        runs = int(cov[:1].sum() + (cov[1:] & ~cov[:-1]).sum())
        out.append((r[0], len(t), int(cov.sum()), runs, hashlib.sha256(left).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("options", [{}, {"hot": 1}, {"shard_bytes": 300}, {"length": 40, "gram": 12}, {"length": 40, "gram": 12, "hot": 2}])
def test_matches_brute_force(make, options):
    rows = corpus(5, 48) + edge_rows()[:8] + [(900, "ab" * 700, "en", "s1", 1), (901, "c" * 399, "en", "s1", 1), (902, "c" * 401, "en", "s1", 1)]
    res = got(sd.deduplicated(make(rows), **options).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"))
    assert sorted([tuple(r.values()) for r in res], key=str) == plain(rows, options.get("length", 400))


def test_very_long_and_empty(make):
    long = [r for r in edge_rows() if r[0] in (5, 6)]
    res = {r["doc_id"]: r for r in got(sd.deduplicated(make(long)))}
    assert res[5]["n_removed"] == res[5]["n_bytes"] and res[6]["n_spans"] == 1
    assert got(sd.deduplicated(make([]))) == []


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=80), st.sampled_from([1 << 12, 2]))
def test_suffix_array_and_prefixes(codes, small):
    old, sais._SMALL = sais._SMALL, small      # both ways of sweeping
    try:
        sa = sais.suffix_array(np.array(codes, np.int64))
        assert sa.tolist() == sorted(range(len(codes)), key=lambda i: codes[i:])
        plcp = sais.permuted_lcp(np.array(codes, np.int64), sa)
        for a, b in zip(sa[1:].tolist(), sa[:-1].tolist()):
            k = 0
            while max(a, b) + k < len(codes) and codes[a + k] == codes[b + k]:
                k += 1
            assert plcp[a] == k
    finally:
        sais._SMALL = old
