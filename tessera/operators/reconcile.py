"""Reconcile: lookups, anti-joins, change-log apply and upserts.

Upserts are expressed as long-form cell writes ``(row_id, column, value,
seq)`` reduced with ``max_by(value, seq)`` (a partial aggregate: the last
write per cell wins, hot rows are combined map-side), pivoted back to wide
form by conditional aggregation and merged onto the master with a left join
and ``coalesce``.  Parquet has no MERGE, so the result is a new table that
the caller writes to a new path.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from tessera.functions.common import at

from tessera.functions import status as st
from tessera.functions import text as tx
from tessera.functions.urls import canonical_url, clean_url


def last_wins_lookup(master: DataFrame, key: Column | str, row_id: str = "row_id") -> DataFrame:
    """E7 (master side): one master row per key, the **last** (max row_id)
    wins (``max_by`` over a struct of the row, partial aggregate)."""
    k = F.col(key) if isinstance(key, str) else key
    others = [c for c in master.columns]
    return (master.withColumn("_key", k).groupBy("_key")
            .agg(F.max_by(F.struct(*[F.col(c) for c in others]), F.col(row_id)).alias("_r"))
            .select("_key", *[F.col("_r")[c].alias(c) for c in others]))


def canonical_join(results: DataFrame, master: DataFrame, result_url: str, master_url: str,
                   row_id: str = "row_id") -> DataFrame:
    """Result rows -> master rows on the canonical URL (S6), last master
    row winning among duplicates; unmatched results keep null ``row_id``."""
    m = last_wins_lookup(master.select(row_id, master_url), canonical_url(F.col(master_url)), row_id)
    r = results.withColumn("_key", canonical_url(F.col(result_url)))
    return r.join(m.select("_key", row_id), "_key", "left").drop("_key")


def title_link_key(title: Column, link: Column) -> Column:
    """``(normalize_title(title), lower(clean_url(link)))``."""
    return F.struct(tx.normalize_title(title).alias("t"), F.lower(clean_url(link)).alias("l"))


def anti_known(new: DataFrame, known: DataFrame, new_key: Column, known_key: Column,
               order: list | None = None) -> DataFrame:
    """Drop rows whose key is already known (left anti-join) and
    keep one row per key inside the batch (the first in ``order``).
    Rows with a blank key component are kept out of the known set."""
    k = known.select(known_key.alias("_k")).filter(F.col("_k").isNotNull()).distinct()
    x = new.withColumn("_k", new_key).join(k, "_k", "left_anti")
    if order:
        from tessera.operators.aggregate import keep_first
        x = keep_first(x, ["_k"], order)
    else:
        x = x.dropDuplicates(["_k"])
    return x.drop("_k")


def skip_completed(units: DataFrame, completed: DataFrame, keys: list[str], force: bool = False) -> DataFrame:
    """Units not yet completed (all units when ``force``)."""
    if force:
        return units
    return units.join(completed.select(*keys).distinct(), keys, "left_anti")


def geocode(df: DataFrame, address: Column, gazetteer: DataFrame,
            out=("latitude", "longitude", "city")) -> DataFrame:
    """Look addresses up in a gazetteer ``(address_norm, lat, lng,
    city)``: distinct normalised addresses first, one equi-join, then a left
    join back; misses stay null."""
    norm = F.lower(tx.clean_text(address))
    x = df.withColumn("_addr", norm)
    g = gazetteer.groupBy("address_norm").agg(F.min(F.struct("lat", "lng", "city")).alias("_g")) \
        .select("address_norm", F.col("_g.lat").alias("_lat"), F.col("_g.lng").alias("_lng"),
                F.col("_g.city").alias("_city"))
    d = x.select("_addr").distinct().join(g, F.col("_addr") == F.col("address_norm"), "inner").drop("address_norm")
    y = x.join(d, "_addr", "left")
    return (y.withColumnRenamed("_lat", out[0]).withColumnRenamed("_lng", out[1])
            .withColumnRenamed("_city", out[2]).drop("_addr"))


def config_lookup(units: DataFrame, config: DataFrame, keys=("gender", "division")) -> DataFrame:
    """The flattened conference config for the requested gender/division."""
    return config.join(units.select(*keys).distinct(), list(keys), "left_semi")


# ------------------------------------------------------------------ cell writes

def last_write_per_cell(writes: DataFrame, row_id: str = "row_id", column: str = "column",
                        value: str = "value", seq: str = "seq") -> DataFrame:
    """U1 core: the last write (max ``seq``) per (row, column)."""
    return (writes.groupBy(row_id, column)
            .agg(F.max_by(F.col(value), F.col(seq)).alias(value)))


def apply_cell_writes(master: DataFrame, writes: DataFrame, columns: list[str], row_id: str = "row_id") -> DataFrame:
    """U1-U5 merge: long-form cell writes onto the wide master.  New columns
    are added (schema evolution); untouched cells keep their value."""
    last = last_write_per_cell(writes, row_id)
    wide = last.groupBy(row_id).agg(*[F.max(F.when(F.col("column") == c, F.col("value"))).alias(f"_new_{c}")
                                      for c in columns])
    m = master.join(wide, row_id, "left")
    for c in columns:
        if c in master.columns:
            m = m.withColumn(c, F.coalesce(F.col(f"_new_{c}"), F.col(c).cast("string")))
        else:
            m = m.withColumn(c, F.col(f"_new_{c}"))
    return m.drop(*[f"_new_{c}" for c in columns])


def change_log_writes(changes: DataFrame, gender_cols: dict, row_id: str = "row_id",
                      seq: str = "seq") -> DataFrame:
    """Filtered change rows (C1, C2) resolved to ``row_id`` -> long-form
    writes via S37; ``gender_cols`` maps ``name``/``email``/``url`` to the
    master columns of the gender (``men_coach_name`` ...)."""
    c = changes.filter(st.is_head_coach(F.col("position")) & st.is_actionable_change(F.col("change")))
    c = c.withColumn("_code", st.change_code(F.col("change")))
    c = c.withColumn("_name", tx.full_name(F.col("first_name"), F.col("last_name")))
    cells = c.select(row_id, seq, F.explode(st.change_columns(F.col("_code"), F.col("_name"), F.col("email_address")))
                     .alias("w"))
    m = F.create_map(*[F.lit(x) for kv in gender_cols.items() for x in kv])
    return cells.select(row_id, seq, at(m, F.col("w.field")).alias("column"), F.col("w.value").alias("value"))


def keyed_upsert(master: DataFrame, results: DataFrame, key_master: Column, key_result: Column,
                 mapping: dict, order: str) -> DataFrame:
    """Result rows joined to the master on a canonical key; among several
    results per key the last in ``order`` wins (E7); ``mapping`` result
    column -> master column is copied where the result has a value, absent
    master columns are added; ``dup_count``/``duplicate`` flag master rows
    whose key occurs more than once among results (F4, decision D17).
    Both reductions are partial aggregates."""
    r = results.withColumn("_k", key_result)
    last = r.groupBy("_k").agg(F.max_by(F.struct(*[F.col(c) for c in mapping]), F.col(order)).alias("_r"),
                              F.count(F.lit(1)).alias("dup_count"))
    m = master.withColumn("_k", key_master).join(last, "_k", "left")
    for src, dst in mapping.items():
        newv = F.col("_r")[src]
        if dst in master.columns:
            m = m.withColumn(dst, F.coalesce(newv.cast(master.schema[dst].dataType), F.col(dst)))
        else:
            m = m.withColumn(dst, newv)
    return (m.withColumn("dup_count", F.coalesce(F.col("dup_count"), F.lit(0)))
            .withColumn("duplicate", F.when(F.col("dup_count") > 1, F.lit("Duplicate")).otherwise(F.lit("")))
            .drop("_k", "_r"))


def link_status(rows: DataFrame, captures: DataFrame, url: str = "url") -> DataFrame:
    """Status text per row by its URL: distinct URLs joined to the capture
    table ``(url, status, error)`` (last capture per URL wins), S39.  A URL
    the crawler has not captured yet is ``Not captured`` (no fetch happens
    inside the plan)."""
    cap = captures.groupBy("url").agg(F.max_by(F.struct("status", "error"), F.col("page_id")).alias("_c"))
    x = rows.join(cap.withColumnRenamed("url", "_u"), F.col(url) == F.col("_u"), "left")
    txt = F.when(F.col("_u").isNull() & (F.coalesce(F.col(url), F.lit("")) != ""), F.lit("Not captured")).otherwise(
        st.status_text(F.col(url), F.col("_c.status"), F.col("_c.error")))
    return x.withColumn("status_text", txt).drop("_u", "_c")


def camp_append(existing: DataFrame, new: DataFrame,
                key=("organiser", "url", "event_details", "start_date")) -> DataFrame:
    """New camp rows whose 4-part key is not already present, in base
    order (``pos``, ``sub_pos``); returns the rows to append."""
    k = list(key)
    return new.join(existing.select(*k).distinct(), k, "left_anti")


def split_errors(df: DataFrame, status_col: str = "page_load") -> tuple[DataFrame, DataFrame]:
    """Rows whose page loaded, and the error rows."""
    ok = F.coalesce(F.col(status_col) == "OK", F.lit(False))
    return df.filter(ok), df.filter(~ok)


def union_sources(sources: dict, tag: str = "source") -> DataFrame:
    """H1: rows of several sources (camps from several sites, genders) in one
    table: columns matched by name, absent ones null, each row tagged with
    its source name."""
    out = None
    for name, df in sources.items():
        d = df.withColumn(tag, F.lit(name))
        out = d if out is None else out.unionByName(d, allowMissingColumns=True)
    return out
