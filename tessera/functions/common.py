"""Small Column helpers shared by the modules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def at(c, i) -> Column:
    """1-based array element (negative counts from the end) or map value;
    null when out of range / missing.  Spark 4 runs ANSI mode, where
    ``element_at`` raises instead."""
    c = F.col(c) if isinstance(c, str) else c
    return F.try_element_at(c, i if isinstance(i, Column) else F.lit(i))


def keep_computed(df, name: str = "_barrier"):
    """Add a nondeterministic marker column so that later filters are not
    pushed below ``df``'s projection: Spark pushes a filter through a
    projection by re-inlining the projected expression, which repeats an
    expensive one (tokenising a whole text) once per predicate.  The filter
    must reference the marker (``F.col(name) >= 0``) or it is pruned first;
    drop it after the filter."""
    return df.withColumn(name, F.spark_partition_id())


def bound(value: Column, use) -> Column:
    """``use(value)`` with the value computed once per row, however often
    ``use`` names it."""
    return F.transform(F.array(value), use)[0]
