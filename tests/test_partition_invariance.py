"""SURVEY 5.2 (3): repartitioning the inputs must not change any result."""

import datetime
import random

from pyspark.sql import functions as F

from conftest import rows
from tessera.operators import aggregate as ag
from tessera.operators import match as mt


def test_results_do_not_depend_on_partitioning(spark):
    rng = random.Random(4)
    words = ["north", "south", "state", "tech", "college", "of", "a"]
    names = [" ".join(rng.choice(words) for _ in range(rng.randint(1, 3))) for _ in range(80)]
    L = spark.createDataFrame(list(enumerate(names)), "id long, name string")
    M = spark.createDataFrame([(j, n) for j, n in enumerate(names[:30])], "row_id long, master_name string")
    t0 = datetime.datetime(2024, 1, 1)
    ev = spark.createDataFrame([(i, rng.randint(0, 3), t0 + datetime.timedelta(seconds=rng.randint(0, 900)), rng.random())
                                for i in range(600)], "id long, k long, ts timestamp, v double")
    results = []
    for layout in (lambda d: d.coalesce(1), lambda d: d.repartition(7), lambda d: d.repartition(3, d.columns[0])):
        l2, m2, e2 = layout(L), layout(M), layout(ev)
        results.append((
            rows(mt.best_match(l2, m2, name="name", scorer="jaccard"), "id", "match_row_id", "similarity_score"),
            rows(mt.fuzzy_topk(l2, m2, k=3, name="name"), "id", "rank", "row_id"),
            rows(ag.rank_in_group(e2, ["k"], "v", "id"), "id", "rank"),
            rows(ag.keep_first(e2, ["k"], ["ts", "id"]), "k", "id"),
        ))
    assert results[0] == results[1] == results[2]
