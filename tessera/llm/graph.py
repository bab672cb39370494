"""Connected components of an edge table, as DataFrame jobs.

Alternating large-star and small-star steps: every step is one grouped
minimum and one join, rows shuffle by node, and the number of steps grows
with the logarithm of a component's diameter.  Each step's edges are written
to the shared folder, so nothing is collected and no lineage builds up.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import stored


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """``u, v`` edges -> edges from the neighbours of ``u`` to the smallest
    node among ``u`` and its neighbours."""
    if large:
        near = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        near = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = near.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    linked = near.join(low, "u")
    if large:
        out = linked.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        # the node itself keeps its link to the minimum
        out = out.unionByName(low.where("m < u").select("u", F.col("m").alias("v")))
    else:
        out = linked.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        out = out.unionByName(low.select("u", F.col("m").alias("v")))
    return out.where("u <> v").distinct()


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, component`` (the smallest node reachable) for every node that
    has an edge to another node.  Nulls are not nodes."""
    cur = stored(edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u is not null and v is not null and u <> v").distinct(), "edges")
    seen = None
    while True:
        cur = stored(_star(_star(cur, True), False), "star")
        # a fixed point: the same edges come out (count and hash sum)
        mark = cur.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == seen:
            break
        seen = mark
    return cur.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        cur.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
