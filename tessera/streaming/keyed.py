"""T5 keyed upsert and T1 / U9 processed keys, on committed tables.

Both run as ``foreachBatch`` writers or on single batches.  The state store of
a stream catches repeats inside the watermark; the tables catch them beyond it
and across restarts.  Only the buckets of a batch's keys are read and written.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.sources.sinks import cut_lineage
from tessera.streaming.tables import Tables, with_schema

ORDER, GONE, ENDED, AT = "_order", "_gone", "_ended", "_at_"      # hidden columns
ROWS_PER_TASK = 2_000_000


def _latest(rows: DataFrame, keys: list[str], values: list[str], merge: str) -> DataFrame:
    """One row per key: the values of the greatest order (``row``), or each
    column's last value that is not null since the last deletion (``cells``;
    the order of every cell is kept beside it).  ``_rank`` breaks ties: rows
    of the batch come after the table's."""
    at = F.struct(F.col(ORDER), F.col("_rank"))
    if merge == "row":
        last = rows.groupBy(*keys).agg(F.max_by(F.struct(ORDER, GONE, *values), at).alias("_r"))
        return last.select(*keys, "_r.*")
    cells = [F.max_by(F.struct(F.col(c).alias("v"), F.col(AT + c).alias("at")), F.when(F.col(AT + c).isNotNull(), F.struct(AT + c, "_rank"))).alias(c)
             for c in values]
    last = rows.groupBy(*keys).agg(F.max(ORDER).alias(ORDER), F.max_by(GONE, at).alias(GONE), F.max(ENDED).alias(ENDED), *cells)
    for c in values:
        live = F.col(ENDED).isNull() | (F.col(c)["at"] > F.col(ENDED))
        last = last.withColumn(AT + c, F.when(live, F.col(c)["at"])).withColumn(c, F.when(live, F.col(c)["v"]))
    return last


def upsert_change(tables: Tables, state: dict, table: str, batch: DataFrame, keys: list[str], order, *, deleted=None, merge: str = "row"):
    """The change of one upsert, for a commit that may hold others too."""
    if merge not in ("row", "cells"):
        raise ValueError("merge must be 'row' or 'cells'")
    gone = F.coalesce(deleted, F.lit(False)) if deleted is not None else F.lit(False)
    names = [c for c in batch.columns if c not in keys]
    new = batch.select(*keys, order.alias(ORDER), gone.alias(GONE), *names)
    if merge == "cells":
        new = new.withColumns({ENDED: F.when(F.col(GONE), F.col(ORDER)),
                               **{AT + c: F.when(~F.col(GONE) & F.col(c).isNotNull(), F.col(ORDER)) for c in names}})
    # a batch is read for its buckets and for the merge: fixed first
    new = cut_lineage(new)
    buckets = tables.touched(new, keys)
    values = F.xxhash64(F.to_json(F.struct(*names))) if names else F.lit(0).cast("long")
    first = new.withColumn("_rank", F.struct(F.lit(1).alias("of"), values.alias("values")))
    schema = new.schema
    # stored rows are counted, not the merge, which would run twice
    most = new.count()
    if tables.has(table, state):
        old = tables.read(table, buckets, state=state)
        most += old.count()
        schema = with_schema(new, old.schema)[1]
        first = with_schema(first, schema)[0].select(*schema.fieldNames(), "_rank")
        old = with_schema(old, schema)[0].withColumn("_rank", F.struct(F.lit(0).alias("of"), F.lit(0).cast("long").alias("values")))
        first = old.unionByName(first)
    held = [c for c in schema.fieldNames() if c not in (*keys, ORDER, GONE, ENDED) and not c.startswith(AT)]
    merged = _latest(first, keys, held, merge).select(*schema.fieldNames())
    return schema, tables.write(table, merged, keys, ROWS_PER_TASK, most), False


def upsert(tables: Tables, table: str, batch: DataFrame, keys: list[str], order, *, stream: str = "batch", batch_id: int | None = None,
           deleted=None, merge: str = "row") -> int:
    """T5: merge a batch into a key-bucketed table and commit.

    ``order`` (a column) decides among rows of one key, in the batch and
    against the table: a late row never replaces a newer one; equal orders
    fall to the later batch, and inside a batch to the greatest values.
    ``deleted`` (a condition) marks deletions; they stay as hidden rows so that
    late rows do not come back.  ``merge='cells'`` decides per column: the last
    value that is not null, if no deletion has the same or a later order.
    Keys may be null.  A batch id that is committed already changes nothing.
    Columns the table does not have are added."""
    state = tables.state()
    if batch_id is not None and stream in state["batches"] and batch_id <= state["batches"][stream]:
        return state["version"]
    change = upsert_change(tables, state, table, batch, keys, order, deleted=deleted, merge=merge)
    return tables.commit(state, {table: change}, stream if batch_id is not None else None, batch_id)


def snapshot(tables: Tables, table: str, version: int | None = None) -> DataFrame:
    """The live rows of an upserted table, now or as of a version."""
    rows = tables.read(table, version=version).where(~F.col(GONE))
    return rows.drop(ORDER, GONE, ENDED, *[c for c in rows.columns if c.startswith(AT)])


def stream_keyed_upsert(stream: DataFrame, tables: Tables, table: str, keys: list[str], order, checkpoint: str, *,
                        name: str | None = None, deleted=None, merge: str = "row", available_now: bool = True):
    """T5 on a stream: each micro-batch is one ``upsert``, skipped when its id
    is committed already (a restart between commit and checkpoint)."""
    def write(batch: DataFrame, batch_id: int):
        upsert(tables, table, batch, keys, order, stream=name or table, batch_id=batch_id, deleted=deleted, merge=merge)

    w = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")).start()


# ------------------------------------------------------------------ T1, U9

LOG = "processed_keys"


def process_once(tables: Tables, batch: DataFrame, keys: list[str], ts: str, handle: Callable[[DataFrame], DataFrame], out: str, *,
                 log: str = LOG, outcome: Callable[[DataFrame], DataFrame] | None = None, stream: str = "batch", batch_id: int | None = None) -> int:
    """T1 + U9: rows whose key the log does not hold go through ``handle``
    once; its rows are appended to the table ``out`` and the keys, with time,
    status and notes, to the log, in one commit.

    Of several rows of a key in a batch the earliest counts (by ``ts``, then
    by values).  Rows with a null in the key are handled every time: they have
    no identity.  ``outcome(fresh)`` gives ``keys, status, notes`` for the
    audit (status ``done`` without it).  Only the log folders of the batch's
    buckets are read.  A failing ``handle`` commits nothing."""
    state = tables.state()
    if batch_id is not None and stream in state["batches"] and batch_id <= state["batches"][stream]:
        return state["version"]
    whole = F.lit(True)
    for k in keys:
        whole = whole & F.col(k).isNotNull()
    rest = F.to_json(F.struct(*[c for c in batch.columns if c not in keys]))
    named = batch.where(whole).groupBy(*keys).agg(F.min_by(F.struct(*batch.columns), F.struct(F.col(ts), rest)).alias("_r")).select("_r.*")
    named = cut_lineage(named)
    if tables.has(log, state):
        known = tables.read(log, tables.touched(named, keys), state=state).select(*keys).distinct()
        named = named.join(known, keys, "left_anti").select(*batch.columns)
    fresh = cut_lineage(named.unionByName(batch.where(~whole)))
    done = fresh.where(whole).select(*keys, F.col(ts).alias("ts"))
    if outcome is not None:
        done = done.join(outcome(fresh).select(*keys, "status", "notes").dropDuplicates(keys), keys, "left")
    else:
        done = done.withColumns({"status": F.lit("done"), "notes": F.lit(None).cast("string")})
    done = done.withColumn("batch_id", F.lit(batch_id).cast("long"))
    rows = handle(fresh)
    placed = [k for k in keys if k in rows.columns] or rows.columns[:1]
    changes = {log: tables.append(state, log, done, keys), out: tables.append(state, out, rows, placed)}
    return tables.commit(state, changes, stream if batch_id is not None else None, batch_id)


def stream_once(stream: DataFrame, tables: Tables, keys: list[str], ts: str, handle: Callable[[DataFrame], DataFrame], out: str, checkpoint: str, *,
                delay: str = "1 day", name: str | None = None, log: str = LOG, outcome=None, available_now: bool = True):
    """T1 on a stream: the state store drops repeats inside the watermark, the
    key log those beyond it; rows and log entries share each batch's commit."""
    near = stream.withWatermark(ts, delay).dropDuplicatesWithinWatermark(keys)

    def write(batch: DataFrame, batch_id: int):
        process_once(tables, batch, keys, ts, handle, out, log=log, outcome=outcome, stream=name or out, batch_id=batch_id)

    w = near.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")).start()
