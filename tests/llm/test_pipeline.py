"""Every pipeline stage on rows with nulls, ties, repeated rows and extra
columns, against plain code on the stage's own input."""
import collections
import os
import random

import pytest
from pyspark.sql import functions as F
from test_groups import plain_components, plain_fp
from test_suffixdedup import plain
from tests_llm_helpers import corpus, edge_rows, got, make, package, sentence  # noqa: F401

import corpus_pipeline as cp
from tessera.llm import mixing
from tessera.llm.common import stored

COLS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture()
def sf(spark, tmp_path, make):
    rows = corpus(23, 40) + edge_rows()
    make(rows).write.parquet(os.path.join(tmp_path, "documents.parquet"))
    spark.createDataFrame([(r[0], i % 2, 0) for i, r in enumerate(rows[:20])], "doc_id long, quality int, toxic int").write.parquet(
        os.path.join(tmp_path, "labels.parquet"))
    return str(tmp_path)


def test_stage_list():
    assert [n for n, _ in cp.STAGES] == ["quality_rules", "simhash_near_dedup", "suffix_array_dedup", "mixing", "byte_bpe"]


def test_run_and_empty(spark, sf, make):
    assert cp.run(spark, sf).count() > 0
    docs = make([])
    for _, stage in cp.STAGES:
        assert got(stage(spark, docs, sf)) == []


def test_near_duplicates_keep_one_of_each_group(spark, sf, make):
    rows = corpus(29) + edge_rows()
    out = got(cp.near_duplicates(spark, make(rows), sf))
    assert list(out[0]) == make(rows).columns
    fps = [plain_fp(r[1]) for r in rows]
    root = plain_components(sorted(set(fps)), lambda a, b: (a ^ b).bit_count() <= 4)
    groups = collections.defaultdict(list)
    for r, f in zip(rows, fps):
        groups[root[f]].append(r[0])
    kept = collections.Counter(root[plain_fp(r["text"])] for r in out)
    assert kept == {g: 1 for g in groups}
    for r in out:
        ids = [i for i in groups[root[plain_fp(r["text"])]] if i is not None]
        assert r["doc_id"] == (min(ids) if ids else None)


def test_repeated_strings_are_cut(spark, sf, make):
    rows = corpus(31) + edge_rows()[:8]
    out = got(cp.repeated_strings(spark, make(rows), sf))
    want = collections.Counter((r[0], r[1], r[2]) for r in plain(rows, cp.PASSAGE_BYTES))
    assert len(out) == len(rows) and list(out[0]) == make(rows).columns
    removed = {(r[0], r[1]): r[2] for r in plain(rows, cp.PASSAGE_BYTES)}
    assert sum(want.values()) == len(rows)
    by_id = {r[0]: r for r in rows}
    for r in out:
        if r["doc_id"] not in (4, None) and r["doc_id"] in by_id:
            old = by_id[r["doc_id"]]
            n = removed[r["doc_id"], len((old[1] or "").encode())]
            if not n:
                assert r["text"] == old[1] and r["n_chars"] == old[4]
            else:
                assert r["n_chars"] == len(r["text"])
                assert 0 <= len(old[1].encode()) - n - len(r["text"].encode()) <= 6    # cut characters


def test_passages_of_fifty_words_go(spark, sf, make):
    rng = random.Random(41)

    def prose(n):
        return " ".join("".join(rng.choice("etaoinshrdlu") for _ in range(rng.randint(2, 8))) for _ in range(n))
    passages = [prose(rng.randint(52, 70)) for _ in range(6)]
    rows = [(i, f"{prose(80)}\n{passages[i % 6]}\n{prose(80)}", "en", "s1", 1) for i in range(24)]
    clean = [(100 + i, prose(200), "en", "s1", 1) for i in range(10)]
    out = {r["doc_id"]: r["text"] for r in got(cp.repeated_strings(spark, make(rows + clean), sf))}
    for i, text, *_ in rows:
        assert passages[i % 6] not in out[i] and len(out[i]) >= len(text) - len(passages[i % 6]) - 2 - 12
    assert all(out[r[0]] == r[1] for r in clean)


def test_near_duplicates_same_row_under_any_partitioning(spark, sf, make):
    rows = [(1, "one and the same text here", "en", s, 1) for s in ("b", "a", None, "c")] * 3
    seen = {tuple(got(cp.near_duplicates(spark, make(rows).repartition(n), sf))[0].values()) for n in (1, 4, 7)}
    assert len(seen) == 1


def test_mix_takes_effect(spark, sf, make):
    rows = corpus(37) + edge_rows()
    out = collections.Counter((r["doc_id"], r["text"], r["source"]) for r in got(cp.source_mix(spark, make(rows), sf)))
    weights = mixing.quality_weights(spark.read.parquet(os.path.join(sf, "labels.parquet")))
    texts = {(r[0], r[3], h): r[1] for r, h in zip(rows, [x[0] for x in spark.createDataFrame(
        [(r[1],) for r in rows], "t string").select(F.xxhash64("t")).collect()])}
    want = collections.Counter()
    for r in got(mixing.mix(make(rows), weights)):
        if r["taken"]:
            want[r["doc_id"], texts[r["doc_id"], r["source"], r["text_hash"]], r["source"]] += r["taken"] // r["size"]
    assert out == want


def test_quality_stage_keeps_columns_and_clean_rows(spark, sf, make):
    rng = random.Random(3)
    rows = [(i, ".\n".join(sentence(rng, 40) for _ in range(3)), "en", "s", 1) for i in range(30)] + edge_rows()
    df = make(rows)
    out = got(cp.quality_rules(spark, df, sf))
    assert list(out[0]) == df.columns and {r["doc_id"] for r in out} >= set(range(8, 30))
    assert not [r for r in out if not (r["text"] or "").strip()]
