"""T3 + T4 resumable runs, U7 gap-free appends: on committed tables.

A run works through units (a conference, a page, a file).  Its state lives in
four tables of one ``Tables`` folder: the target cells, the writes still
pending, the manifest of units, and the units completed.  Every call is one
commit, so a call that dies leaves the state of the call before it, and a
repeated call finds nothing left to do twice.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators.reconcile import skip_completed
from tessera.sources.sinks import cut_lineage
from tessera.streaming import keyed
from tessera.streaming.incremental import split_pending
from tessera.streaming.tables import Tables

COMPLETED, PENDING, MANIFEST = "completed_units", "pending_writes", "unit_manifest"


def todo(tables: Tables, units: DataFrame, keys: list[str], force: bool = False) -> DataFrame:
    """T4: the units that no committed call has completed."""
    state = tables.state()
    return skip_completed(units, tables.read(COMPLETED, state=state), keys, force) if tables.has(COMPLETED, state) else units


def run_units(tables: Tables, units: DataFrame, keys: list[str], work: Callable[[DataFrame], DataFrame],
              attempt: Callable[[DataFrame], DataFrame], target: str, *, force: bool = False) -> dict:
    """One call of a resumable run: T4 skip, T3 retry, U3 writes, one commit.

    ``work(units)`` gives the cell writes of units: the key columns, ``seq``
    (order inside the unit), ``row_id, column, value``.  Writes that an earlier
    call left pending come first, in their order.  ``attempt(writes)`` adds
    ``failed`` (boolean): what the target did not take.  From the first failed
    write of a unit on, the rest of that unit stays pending; the writes before
    it go to ``target`` (one row per ``row_id`` and ``column``; the later
    write wins) and a unit without pending writes is completed.  A unit with
    pending writes is not worked on again until they are through.

    Returns the counts of this call (units, applied, pending) and its commit;
    a call that finds nothing to do commits nothing."""
    state = tables.state()
    call = state["version"] + 1
    late = tables.read(PENDING, state=state) if tables.has(PENDING, state) else None
    open_ = todo(tables, units, keys, force)
    if late is not None:
        open_ = open_.join(late.select(*keys).distinct(), keys, "left_anti")
    open_ = cut_lineage(open_.select(*units.columns).dropDuplicates(keys))
    if open_.isEmpty() and (late is None or late.isEmpty()):
        return {"version": state["version"], "units": 0, "applied": 0, "pending": 0}
    writes = late
    if late is None or not open_.isEmpty():
        new = work(open_).select(*keys, F.lit(call).cast("long").alias("call"), F.col("seq").cast("long").alias("seq"),
                                 F.col("row_id").cast("long").alias("row_id"), "column", F.col("value").cast("string").alias("value"))
        writes = cut_lineage(new if late is None else late.unionByName(new))
    tried = writes.withColumn("unit", F.struct(*keys)).withColumn("at", F.struct("call", "seq"))
    done = cut_lineage(split_pending(attempt(tried), "unit", "at", "failed"))
    applied, pending = done.where("state = 'applied'"), done.where("state = 'pending'").select(*writes.columns)
    # a unit without any write is done as well; so is one without a whole key
    states, whole = ["applied", "pending"], F.lit(True)
    for k in keys:
        whole = whole & F.col(k).isNotNull()
    each = done.select(*keys, *[(whole & (F.col("state") == x)).cast("long").alias(x) for x in states])
    none = open_.select(*keys, *[F.lit(0).cast("long").alias(x) for x in states])
    per = cut_lineage(none.unionByName(each).groupBy(*keys).agg(*[F.sum(x).alias(x) for x in states]).select(
        *keys, F.lit(call).cast("long").alias("call"), *states))
    order = F.struct("call", "seq")
    changes = {
        target: keyed.upsert_change(tables, state, target, applied.select("row_id", "column", "value", "call", "seq"), ["row_id", "column"], order),
        PENDING: (pending.schema, tables.write(PENDING, pending, keys), True),
        MANIFEST: tables.append(state, MANIFEST, per, keys),
        COMPLETED: tables.append(state, COMPLETED, per.where("pending = 0").select(*keys), keys)}
    version = tables.commit(state, changes)
    n = per.agg(F.count(F.lit(1)), F.sum("applied"), F.sum("pending")).first()
    return {"version": version, "units": n[0], "applied": n[1] or 0, "pending": n[2] or 0}


def cells(tables: Tables, target: str) -> DataFrame:
    """The target's cells ``row_id, column, value, seq`` for
    ``reconcile.apply_cell_writes``."""
    return keyed.snapshot(tables, target).select("row_id", "column", "value", F.struct("call", "seq").alias("seq"))


# ------------------------------------------------------------------ U7

ROW = "row_number"


def numbered(rows: DataFrame, order: list, first: int, name: str = ROW) -> DataFrame:
    """Rows numbered from ``first`` without gaps, in ``order``, in parallel:
    range partitions are sorted and stored, and each starts after the rows of
    those before it.  The numbers depend on the order alone; rows that agree
    in it fall to their values."""
    tie = F.xxhash64(F.to_json(F.struct(*rows.columns)))
    x = rows.withColumn("_tie", tie)
    keys = [F.asc_nulls_first(c) if isinstance(c, str) else c for c in order]
    x = x.repartitionByRange(*keys, "_tie").sortWithinPartitions(*keys, "_tie")
    # partition and place inside it, fixed by the stored table
    x = cut_lineage(x.withColumn("_at", F.monotonically_increasing_id()))
    x = x.withColumns({"_part": F.shiftright("_at", 33), "_nth": F.col("_at").bitwiseAND((1 << 33) - 1)})
    counts = x.groupBy("_part").agg(F.count(F.lit(1)).alias("n")).orderBy("_part").toArrow()     # one row per partition
    start, at = {}, first
    for p, n in zip(counts.column("_part").to_pylist(), counts.column("n").to_pylist()):
        start[p] = at
        at += n
    if not start:
        return x.drop("_tie", "_at", "_part", "_nth").withColumn(name, F.lit(0).cast("long"))
    of = F.create_map(*[F.lit(v).cast("long") for kv in start.items() for v in kv])
    return x.withColumn(name, of[F.col("_part")] + F.col("_nth")).drop("_tie", "_at", "_part", "_nth")


def append_rows(tables: Tables, table: str, rows: DataFrame, key: list[str], order: list[str], *, stream: str = "batch",
                batch_id: int | None = None, first: int = 2) -> int:
    """Append the rows whose key the table does not hold, below its last
    row: ``row_number`` continues from the committed high mark (``first`` for
    an empty table; row 1 is the header).  Of several rows of one key the
    first in ``order`` counts; null key parts are values.  A batch that comes
    again changes nothing, and one that died before its commit gets the same
    numbers again."""
    state = tables.state()
    if batch_id is not None and stream in state["batches"] and batch_id <= state["batches"][stream]:
        return state["version"]
    kept = [c for c in rows.columns]
    k = [F.coalesce(F.to_json(F.struct(c)), F.lit("")).alias(f"_k{i}") for i, c in enumerate(key)]
    names = [f"_k{i}" for i in range(len(key))]
    x = rows.select("*", *k)
    tie = F.to_json(F.struct(*kept))
    x = cut_lineage(x.groupBy(*names).agg(F.min_by(F.struct(*kept), F.struct(*order, tie.alias("_t"))).alias("_r")).select("_r.*", *names))
    if tables.has(table, state):
        known = tables.read(table, tables.touched(x, names), state=state).select(*names)
        x = x.join(known, names, "left_anti")
    mark = state["facts"].get(f"{table}.last", first - 1)
    new = cut_lineage(numbered(x.select(*kept, *names), order, mark + 1))
    change = tables.append(state, table, new, names)
    return tables.commit(state, {table: change}, stream if batch_id is not None else None, batch_id, {f"{table}.last": mark + new.count()})


def appended(tables: Tables, table: str, version: int | None = None) -> DataFrame:
    """The rows of an appended table with their numbers."""
    rows = tables.read(table, version=version)
    return rows.drop(*[c for c in rows.columns if c.startswith("_k")])
