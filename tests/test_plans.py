"""Plan guards: the shapes the design promises."""

import os
import re

SF = "/root/testdata/sf0.001"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_page_queries_are_map_only(spark):
    from tessera.plans import catalog as c
    for q in ("page_paragraphs", "page_links", "page_text", "url_remove_segment"):
        plan = _plan(c.QUERIES[q](spark, SF))
        assert "Exchange" not in plan, q


def test_scans_prune_columns(spark):
    from tessera.plans import catalog as c
    plan = c.QUERIES["page_paragraphs"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "url" not in re.findall(r"ReadSchema: (struct<[^>]*>)", plan)[0] if "ReadSchema" in plan else True
    text = c.QUERIES["title_normalize"](spark, SF)._jdf.queryExecution().simpleString()
    assert "lang" not in text.split("ReadSchema:")[-1].split("\n")[0]


def test_no_driver_collect_in_library():
    root = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tessera")
    for dirpath, _, files in os.walk(root):
        for f in files:
            if f.endswith(".py"):
                src = open(os.path.join(dirpath, f)).read()
                assert ".collect()" not in src and "toPandas()" not in src, f


def test_fuzzy_plan_has_no_nested_loop(spark):
    from tessera.plans import catalog as c
    for q in ("fuzzy_jaccard_top1", "fuzzy_threshold_topk", "doc_benchmark_overlap", "substring_search"):
        plan = _plan(c.QUERIES[q](spark, SF))
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, q


def test_single_pass_plans(spark):
    from tessera.plans import catalog as c
    plan = _plan(c.QUERIES["page_title_h1"](spark, SF))
    assert plan.count("MapInArrow") + plan.count("PythonMapInArrow") >= 1 and len(re.findall(r"(?m)^.*MapInArrow ", plan)) <= 1
    # the rows and the first failure per group: two readings of the writes
    assert _plan(c.QUERIES["pending_split"](spark, SF)).count("FileScan parquet") <= 2
