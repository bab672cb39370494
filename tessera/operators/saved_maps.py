"""Saved column maps (C7, C15-C17): versions per site, joined to captures as of
their time, checked against the header, with the keyword map (C5) behind them.

A map version holds the site's key columns, ``valid_from``, and what is known:
``by_index`` (field -> position), ``by_name`` (normalised header text ->
fields, in order of appearance) and ``th_td`` (positions count a leading ``th``
as 0 and the n-th ``td`` as n).  Versions are kept in a committed table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.common import at
from tessera.functions.text import normalize_header
from tessera.operators.columns import map_by_keyword, th_td_index
from tessera.streaming.tables import Tables

TABLE = "column_maps"
REQUIRED = ("school", "conf_record", "overall_record")
MAP_SCHEMA = "valid_from timestamp, by_index map<string,int>, by_name map<string,array<string>>, th_td boolean"


def as_of(captures: DataFrame, maps: DataFrame, keys: list[str], ts: str) -> DataFrame:
    """Each capture with ``saved``: the newest version of its site that was
    valid at its time (null without any).  A site's versions come as one array
    (a version is saved when a site's layout changes), so a capture stays one
    row however many versions there are.  Null keys match null keys."""
    names = [f"m_{k}" for k in keys]
    held = maps.groupBy(*[F.col(k).alias(n) for k, n in zip(keys, names)]).agg(
        F.collect_list(F.struct("valid_from", "by_index", "by_name", "th_td")).alias("versions"))
    cond = F.lit(True)
    for k, n in zip(keys, names):
        cond = cond & captures[k].eqNullSafe(held[n])
    x = captures.join(held, cond, "left").drop(*names)
    ok = F.filter("versions", lambda v: v["valid_from"] <= F.col(ts))
    last = F.array_max(F.transform(ok, lambda v: v["valid_from"]))
    return x.withColumn("_last", last).withColumn(
        "saved", at(F.filter("versions", lambda v: v["valid_from"] == F.col("_last")), 1)).drop("versions", "_last")


def _index_map(saved: Column, tags: Column, width: Column, required) -> Column:
    """C15 + C17: the positions of a version on this header; null unless every
    required field has one inside it."""
    idx = F.transform_values(saved["by_index"], lambda f, v: F.when(F.coalesce(saved["th_td"], F.lit(False)), th_td_index(tags, v)).otherwise(v))
    inside = F.map_filter(idx, lambda f, v: v.isNotNull() & (v >= 0) & (v < width))
    ok = F.lit(True)
    for f in required:
        ok = ok & F.map_contains_key(inside, f)
    return F.when(F.coalesce(ok, F.lit(False)), inside)


def _name_map(saved: Column, header: Column, visible: Column) -> tuple[Column, Column]:
    """C7 + C16: (field -> first visible position, fields named by several
    headers though their name stands for one).  The k-th header of one name
    takes the k-th field of the name, the last field after that."""
    shown = F.transform(visible, lambda i: F.struct(i.alias("i"), normalize_header(at(header, i + 1)).alias("name")))
    fields = F.transform(shown, lambda s: F.struct(s["i"].alias("i"), s["name"].alias("name"), at(saved["by_name"], s["name"]).alias("fields"), (
        F.size(F.filter(shown, lambda o: (o["name"] == s["name"]) & (o["i"] < s["i"])))).alias("nth")))
    placed = F.filter(F.transform(fields, lambda s: F.struct(s["i"].alias("i"), at(s["fields"], F.least(s["nth"] + 1, F.size(s["fields"]))).alias("f"))),
                      lambda s: s["f"].isNotNull())
    names = F.array_distinct(F.transform(placed, lambda s: s["f"]))
    out = F.map_from_arrays(names, F.transform(names, lambda f: F.array_min(F.transform(F.filter(placed, lambda s: s["f"] == f), lambda s: s["i"]))))
    twice = F.array_distinct(F.transform(F.filter(fields, lambda s: (F.size(s["fields"]) == 1) & (s["nth"] > 0)), lambda s: at(s["fields"], 1)))
    return F.when(F.size(names) > 0, out), F.coalesce(twice, F.array().cast("array<string>"))


def resolve(headers: DataFrame, maps: DataFrame, keys: list[str], ts: str, required=REQUIRED) -> DataFrame:
    """``headers`` (page_id, table_id, header, header_tags, visible, the site's
    key columns and the capture time ``ts``) with ``field_idx``, ``map_source``
    (index, name or keyword), ``accepted`` and ``review`` (fields whose header
    name occurs several times, for a person to decide).

    Saved positions count only if all required fields lie inside the header;
    saved names only if they place the school and one field more; else the
    keyword map.  Tables without a header keep an empty map."""
    header = F.coalesce("header", F.array().cast("array<string>"))
    x = as_of(headers.withColumn("header", header), maps, keys, ts)
    words = map_by_keyword(x.select("page_id", "table_id", "header", "visible")).select(
        "page_id", "table_id", F.col("field_idx").alias("word_idx"), F.col("accepted").alias("word_ok"))
    by_name, twice = _name_map(F.col("saved"), F.col("header"), F.col("visible"))
    tags = F.coalesce("header_tags", F.array().cast("array<string>"))
    x = x.withColumns({"idx": _index_map(F.col("saved"), tags, F.size("header"), required), "named": by_name, "review": twice})
    enough = F.map_contains_key("named", "school") & (F.size("named") > 1)
    source = F.when(F.col("idx").isNotNull(), "index").when(F.coalesce(enough, F.lit(False)), "name").otherwise("keyword")
    x = x.withColumn("map_source", source).join(words, ["page_id", "table_id"], "left")
    return x.select(*[c for c in headers.columns if c != "header"], "header",
                    F.when(F.col("map_source") == "index", F.col("idx")).when(F.col("map_source") == "name", F.col("named")).otherwise(F.col("word_idx")).alias("field_idx"),
                    "map_source", ((F.col("map_source") != "keyword") | F.coalesce("word_ok", F.lit(False))).alias("accepted"),
                    F.when(F.col("map_source") == "index", F.array().cast("array<string>")).otherwise(F.col("review")).alias("review"))


def learned(resolved: DataFrame, keys: list[str], ts: str, required=REQUIRED) -> DataFrame:
    """Map versions to save: for tables read by names or keywords without open
    questions, the positions and (C15) the header names of their fields.  The
    first capture of a site counts."""
    ok = F.col("accepted") & (F.col("map_source") != "index") & (F.size("review") == 0) & (F.size("field_idx") > 0)
    for f in required:
        ok = ok & F.map_contains_key("field_idx", f)
    x = resolved.where(F.coalesce(ok, F.lit(False)))
    entries = F.map_entries("field_idx")
    heads = F.transform(entries, lambda e: F.struct(normalize_header(at(F.col("header"), e["value"] + 1)).alias("h"), e["value"].alias("i"), e["key"].alias("f")))
    names = F.array_distinct(F.transform(heads, lambda e: e["h"]))
    by_name = F.map_from_arrays(names, F.transform(names, lambda h: F.transform(F.array_sort(F.transform(
        F.filter(heads, lambda e: e["h"] == h), lambda e: F.struct(e["i"].alias("i"), e["f"].alias("f")))), lambda e: e["f"])))
    x = x.select(*keys, F.col(ts).cast("timestamp").alias("valid_from"), F.col("field_idx").alias("by_index"), by_name.alias("by_name"), F.lit(False).alias("th_td"))
    first = x.groupBy(*keys).agg(F.min_by(F.struct("valid_from", "by_index", "by_name", "th_td"), F.struct("valid_from", F.to_json("by_index"))).alias("v"))
    return first.select(*keys, "v.*")


def save(tables: Tables, maps: DataFrame, keys: list[str], *, stream: str = "maps", batch_id: int | None = None) -> int:
    """Append the versions that differ from what was valid at their time."""
    state = tables.state()
    if batch_id is not None and stream in state["batches"] and batch_id <= state["batches"][stream]:
        return state["version"]
    fields = ["valid_from", "by_index", "by_name", "th_td"]
    new = maps.select(*keys, *fields)
    if tables.has(TABLE, state):
        x = as_of(new, load(tables, keys), keys, "valid_from")
        same = lambda a, b: F.to_json(F.struct(*[F.array_sort(F.map_entries(a[f])).alias(f) for f in ("by_index", "by_name")])) == \
            F.to_json(F.struct(*[F.array_sort(F.map_entries(b[f])).alias(f) for f in ("by_index", "by_name")]))
        now = {f: F.col(f) for f in fields}
        old = {f: F.col("saved")[f] for f in fields}
        new = x.where(F.col("saved").isNull() | ~F.coalesce(same(now, old), F.lit(False))).select(*keys, *fields)
    return tables.commit(state, {TABLE: tables.append(state, TABLE, new, keys)}, stream if batch_id is not None else None, batch_id)


def load(tables: Tables, keys: list[str], version: int | None = None) -> DataFrame:
    return tables.read(TABLE, version=version)
