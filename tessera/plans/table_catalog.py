"""Queries of the operators that keep tables between runs (T1, T3-T5, U7, U9,
C7, C15-C17), of the parallel CSV scan (A3) and of exact matching (E3, E6).
Each writes its tables below the shared checkpoint folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.plans.catalog import _SQL_MATCH_INPUT, match_input, register, sql_jaccard, sql_tokens
from tessera.session import checkpoint_dir, read_table
from tessera.sources.csv_scan import csv_records
from tessera.streaming import keyed, runs
from tessera.streaming.tables import Tables


def _folder(spark: SparkSession, name: str) -> str:
    return f"{checkpoint_dir(spark, allow_local_default=True).rstrip('/')}/tessera-tables/{name}-{uuid.uuid4().hex}"


@register("keyed_event_upsert", """
SELECT user_id, event_id, event_type, value, props FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS nth FROM events)
WHERE nth = 1 AND event_type <> 'error'""")
def keyed_event_upsert(spark, sf_dir):
    """T5: all events arrive in four batches, out of order, and upsert the
    last event of each user; an ``error`` deletes the user's row.  One batch
    arrives twice and counts once."""
    ev = read_table(spark, sf_dir, "events")
    tables = Tables(spark, _folder(spark, "upsert"))
    order = F.struct("ts", "event_id")
    for n in (0, 1, 1, 2, 3):
        keyed.upsert(tables, "users", ev.where(F.pmod("event_id", F.lit(4)) == n), ["user_id"], order, stream="events", batch_id=n,
                     deleted=F.col("event_type") == "error")
    return keyed.snapshot(tables, "users").select("user_id", "event_id", "event_type", "value", "props")


@register("processed_once", """
SELECT user_id, event_type, event_id, value * 2 AS doubled, CAST(event_id % 3 AS BIGINT) AS batch_id,
  CASE WHEN value > 50 THEN 'large' ELSE 'done' END AS status
FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id % 3, ts, event_id) AS nth FROM events)
WHERE nth = 1""")
def processed_once(spark, sf_dir):
    """T1 + U9: events arrive in three batches; the first event of each user
    and type is handled, and its key logged with a status, in one commit."""
    ev = read_table(spark, sf_dir, "events")
    tables = Tables(spark, _folder(spark, "once"))
    keys = ["user_id", "event_type"]

    def handle(fresh: DataFrame) -> DataFrame:
        return fresh.select(*keys, "event_id", (F.col("value") * 2).alias("doubled"))

    def outcome(fresh: DataFrame) -> DataFrame:
        return fresh.select(*keys, F.when(F.col("value") > 50, "large").otherwise("done").alias("status"), F.lit(None).cast("string").alias("notes"))
    for n in (0, 1, 2, 2):
        keyed.process_once(tables, ev.where(F.pmod("event_id", F.lit(3)) == n), keys, "ts", handle, "handled", stream="events", batch_id=n, outcome=outcome)
    log = tables.read(keyed.LOG).select(*keys, "status", "batch_id")
    return tables.read("handled").join(log, keys)


@register("fuzzy_exact_topk", f"""
WITH {_SQL_MATCH_INPUT},
c AS (SELECT m.row_id, m.master_name, p.p_brand AS conference FROM m JOIN part p ON p.p_partkey = m.row_id),
q AS (SELECT DISTINCT l.name, p.p_brand AS pref FROM l JOIN part p USING (p_partkey)),
qt AS (SELECT name, pref, {sql_tokens("name")} AS t FROM q),
ct AS (SELECT row_id, master_name, conference, {sql_tokens("master_name")} AS t FROM c),
s AS (SELECT name, pref, row_id, master_name,
        least(1.0, 0.4 * (1 - levenshtein(lower(name), lower(master_name)) / greatest(length(name), length(master_name)))
          + 0.6 * {sql_jaccard("qt.t", "ct.t")} + CASE WHEN pref = conference THEN 0.15 ELSE 0 END) AS score FROM qt, ct),
r AS (SELECT *, row_number() OVER (PARTITION BY name, pref ORDER BY score DESC, row_id) AS rank FROM s WHERE score > 0)
SELECT l.p_partkey, l.name, CAST(r.rank AS INTEGER) AS rank, r.row_id, r.master_name, round(r.score, 6) AS score
FROM l JOIN part p USING (p_partkey) LEFT JOIN r ON r.name = l.name AND r.pref = p.p_brand AND r.rank <= 10""")
def fuzzy_exact_topk(spark, sf_dir):
    """E3 + G3 + S29: the ten best masters of every name by the combined score
    with the conference bonus, without any threshold."""
    from tessera.functions.similarity import edit_ratio
    from tessera.operators.topk import edit_ratio_py, exact_topk
    left, master = match_input(spark, sf_dir)
    out = exact_topk(left, master, 10, name="name", pref="pref", master_conf="conference", seq=edit_ratio, seq_py=edit_ratio_py)
    return out.select("p_partkey", "name", "rank", "row_id", "master_name", F.round("score", 6).alias("score"))


@register("csv_scan", """
SELECT o_orderkey, o_orderpriority || chr(10) || '"' || o_orderstatus || '", ' || chr(10) || o_custkey AS note,
  CAST(CAST(floor(o_totalprice * 100) AS BIGINT) AS VARCHAR) AS cents FROM orders""")
def csv_scan(spark, sf_dir):
    """A3: orders written as CSV files whose quoted cells hold line breaks,
    quotes and commas, cut back into records block by block."""
    o = read_table(spark, sf_dir, "orders")
    quote = lambda c: F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"'))
    note = F.concat("o_orderpriority", F.lit('\n"'), "o_orderstatus", F.lit('", \n'), F.col("o_custkey").cast("string"))
    folder = _folder(spark, "csv")
    o.select(F.concat_ws(",", F.col("o_orderkey").cast("string"), quote(note), F.floor(F.col("o_totalprice") * 100).cast("string"))).write.text(folder)
    rec = csv_records(spark, folder)
    return rec.select(F.col("cells")[0].cast("long").alias("o_orderkey"), F.col("cells")[1].alias("note"), F.col("cells")[2].alias("cents"))


@register("free_dates", """
SELECT o_orderkey,
  CASE WHEN o_orderkey % 8 < 6 THEN CAST(epoch(CAST(o_orderdate AS DATE)) AS BIGINT)
    + CASE WHEN o_orderkey % 8 = 1 THEN (o_orderkey % 12) * 3600 + 43200 + 5 * 60 WHEN o_orderkey % 8 = 4 THEN 9 * 3600 + 30 * 60 + 4 * 3600 ELSE 0 END
  ELSE 0 END AS epoch,
  CASE o_orderkey % 8 WHEN 6 THEN 'no day' WHEN 7 THEN 'unknown word' END AS reason
FROM orders""")
def free_dates(spark, sf_dir):
    """Order dates written in eight ways, read back with a reason where
    there is no date."""
    from tessera.functions.events import parse_date, to_unix
    d, k = F.col("o_orderdate"), F.col("o_orderkey") % 8
    f = lambda p: F.date_format(d, p)
    hour = F.pmod("o_orderkey", F.lit(12))
    text = (F.when(k == 0, f("yyyy-MM-dd")).when(k == 1, F.concat(f("EEEE, MMMM d, yyyy"), F.lit(" at "), F.when(hour == 0, 12).otherwise(hour).cast("string"), F.lit(":05 PM")))
            .when(k == 2, f("M/d/yyyy")).when(k == 3, F.concat(F.lit("the "), f("d"), F.lit("th of "), f("MMM yyyy")))
            .when(k == 4, F.concat(f("yyyyMMdd"), F.lit(" 09:30 EDT"))).when(k == 5, f("dd-MMM-yyyy")).when(k == 6, f("MMMM yyyy")).otherwise(F.concat(f("yyyy-MM-dd"), F.lit(" tbd"))))
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", text.alias("t"))
    return o.select("o_orderkey", to_unix("t").alias("epoch"), parse_date("t")["reason"].alias("reason"))


def _site_pages(spark, sf_dir) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Pages of 50 suppliers of a nation with headers that no keyword names,
    the maps saved for their sites, and when the pages were captured.  By
    nation: positions; positions in an old and a new layout; names of which
    one stands twice; positions that count ``td`` cells; a map that does not
    fit any more (keywords take its place)."""
    s = read_table(spark, sf_dir, "supplier")
    k, kind = F.col("s_suppkey"), F.col("s_nationkey") % 5
    page = (F.col("s_nationkey").cast("long") * 1_000_000_000 + F.floor(k / 50)).alias("page_id")
    old = (kind == 1) & (F.floor(k / 50) % 2 == 0)
    conf, total = F.concat((k % 7).cast("string"), F.lit("-"), (k % 5).cast("string")), F.concat((k % 11).cast("string"), F.lit("-"), (k % 3).cast("string"))
    td = lambda *c: F.concat(F.lit("<tr><td>"), F.concat_ws("</td><td>", *c), F.lit("</td></tr>"))
    row = F.when(old, td(total, conf, F.col("s_name"))).when(kind == 3, F.concat(F.lit("<tr><th>"), F.col("s_name"), F.lit("</th><td>"), conf, F.lit("</td><td>"), total,
                                                                                 F.lit("</td></tr>"))).otherwise(td(F.col("s_name"), conf, total))
    head = (F.when(kind == 2, "<tr><th>Squad</th><th>Form</th><th>Form</th></tr>").when(kind == 3, "<tr><th>p</th><td>q</td><td>r</td></tr>")
            .when(kind == 4, "<tr><th>Team</th><th>Conf</th><th>Overall</th></tr>").otherwise("<tr><th>p</th><th>q</th><th>r</th></tr>"))
    rows = s.select(page, "s_nationkey", k.alias("k"), row.alias("row"), head.alias("head"), old.alias("old"))
    g = rows.groupBy("page_id", "s_nationkey", "head", "old").agg(F.array_sort(F.collect_list(F.struct("k", "row"))).alias("l"))
    body = F.array_join(F.transform("l", lambda x: x["row"]), "")
    pages = g.select("page_id", F.concat(F.lit("<main><table>"), "head", body, F.lit("</table></main>")).alias("html"))
    when = F.when(F.col("old"), F.lit("2024-01-05")).otherwise(F.lit("2024-02-05")).cast("timestamp")
    sites = g.select("page_id", F.col("s_nationkey").alias("site"), when.alias("captured_at"))
    n = read_table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("site"), (F.col("n_nationkey") % 5).alias("kind"))
    pos = lambda a, b, c: F.create_map(F.lit("school"), F.lit(a), F.lit("conf_record"), F.lit(b), F.lit("overall_record"), F.lit(c))
    none_i, none_n = F.lit(None).cast("map<string,int>"), F.lit(None).cast("map<string,array<string>>")
    named = F.create_map(F.lit("squad"), F.array(F.lit("school")), F.lit("form"), F.array(F.lit("conf_record"), F.lit("overall_record")))
    maps = n.select("site", F.lit("2024-02-01").cast("timestamp").alias("valid_from"),
                    F.when(F.col("kind") == 2, none_i).when(F.col("kind") == 4, pos(0, 1, 7)).otherwise(pos(0, 1, 2)).alias("by_index"),
                    F.when(F.col("kind") == 2, named).otherwise(none_n).alias("by_name"), (F.col("kind") == 3).alias("th_td"))
    first = n.where("kind = 1").select("site", F.lit("2024-01-01").cast("timestamp").alias("valid_from"), pos(2, 1, 0).alias("by_index"),
                                       none_n.alias("by_name"), F.lit(False).alias("th_td"))
    return pages, sites, first.unionByName(maps)


@register("saved_map_standings", """
SELECT CAST(s_nationkey AS BIGINT) * 1000000000 + s_suppkey // 50 AS page_id, s_name AS school,
  (s_suppkey % 7) || '-' || (s_suppkey % 5) AS conf_record, (s_suppkey % 11) || '-' || (s_suppkey % 3) AS overall_record,
  CASE s_nationkey % 5 WHEN 2 THEN 'name' WHEN 4 THEN 'keyword' ELSE 'index' END AS map_source
FROM supplier""")
def saved_map_standings(spark, sf_dir):
    """C7 + C15 + C16 + C17 + B1, B4-B9: standings read by the column map that
    was saved for the site at the time of the capture."""
    from tessera.operators import saved_maps as sm
    from tessera.plans import jobs
    pages, sites, maps = _site_pages(spark, sf_dir)
    tables = Tables(spark, _folder(spark, "maps"))
    sm.save(tables, maps.where("valid_from < '2024-01-15'"), ["site"], batch_id=0)
    sm.save(tables, maps.where("valid_from >= '2024-01-15'"), ["site"], batch_id=1)
    ent, resolved = jobs.mapped_entries(pages, sm.load(tables, ["site"]), sites, ("site",))
    return ent.join(resolved.select("page_id", "table_id", "map_source"), ["page_id", "table_id"]).select(
        "page_id", "school", "conf_record", "overall_record", "map_source")


@register("resumable_run", """
SELECT l_orderkey * 10 AS row_id, 'c' || (l_linenumber % 3) AS column, CAST(l_partkey AS VARCHAR) AS value FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber % 3 ORDER BY l_linenumber DESC, l_partkey DESC) AS nth
  FROM (SELECT DISTINCT l_orderkey, l_linenumber, max(l_partkey) OVER (PARTITION BY l_orderkey, l_linenumber) AS l_partkey FROM lineitem))
WHERE nth = 1""")
def resumable_run(spark, sf_dir):
    """T3 + T4: orders are the units, their lines the writes.  A first
    call fails on returned lines, so the rest of those orders stays pending;
    a second one continues; a third finds nothing to do."""
    li = read_table(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.max("l_partkey").alias("part"), F.max("l_returnflag").alias("flag"))
    tables = Tables(spark, _folder(spark, "run"))
    units = read_table(spark, sf_dir, "lineitem").select("l_orderkey").distinct()
    flag = li.select(F.col("l_orderkey").alias("o"), F.col("l_linenumber").alias("n"), "flag")

    def work(open_: DataFrame) -> DataFrame:
        return li.join(open_, "l_orderkey", "left_semi").select(
            "l_orderkey", F.col("l_linenumber").alias("seq"), (F.col("l_orderkey") * 10).alias("row_id"),
            F.concat(F.lit("c"), (F.col("l_linenumber") % 3).cast("string")).alias("column"), F.col("part").cast("string").alias("value"))

    def refused(w: DataFrame) -> DataFrame:
        return w.join(flag, (F.col("l_orderkey") == F.col("o")) & (F.col("seq") == F.col("n")), "left").withColumn(
            "failed", F.coalesce(F.col("flag") == "R", F.lit(False))).drop("o", "n", "flag")

    runs.run_units(tables, units, ["l_orderkey"], work, refused, "cells")
    for _ in range(2):
        runs.run_units(tables, units, ["l_orderkey"], work, lambda w: w.withColumn("failed", F.lit(False)), "cells")
    return runs.cells(tables, "cells").select("row_id", "column", "value")


@register("append_numbered", """
WITH b AS (SELECT *, event_id % 2 AS batch FROM events),
f AS (SELECT * FROM b QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY batch, ts, event_id) = 1)
SELECT user_id, event_type, event_id, CAST(1 + row_number() OVER (ORDER BY batch, ts, event_id) AS BIGINT) AS row_number FROM f""")
def append_numbered(spark, sf_dir):
    """Two batches of events append below the last row; known keys are
    left out, row numbers go on without gaps, a repeated batch adds nothing."""
    ev = read_table(spark, sf_dir, "events").select("user_id", "event_type", "ts", "event_id")
    tables = Tables(spark, _folder(spark, "append"))
    for n in (0, 0, 1):
        runs.append_rows(tables, "log", ev.where(F.pmod("event_id", F.lit(2)) == n), ["user_id", "event_type"], ["ts", "event_id"], batch_id=n)
    return runs.appended(tables, "log").select("user_id", "event_type", "event_id", "row_number")


@register("substring_scored", f"""
WITH q AS (SELECT DISTINCT lower(n_name) AS name FROM nation UNION SELECT DISTINCT substr(p_type, 1, 5) FROM part UNION SELECT DISTINCT substr(p_name, 1, 2) FROM part),
m AS (SELECT p_partkey AS row_id, p_name || ' ' || p_type AS master_name FROM part),
qt AS (SELECT name, {sql_tokens("name")} AS t FROM q), mt AS (SELECT row_id, master_name, {sql_tokens("master_name")} AS t FROM m),
s AS (SELECT name, row_id, master_name, 0.4 * (2.0 * length(name) / (length(name) + length(master_name))) + 0.6 * {sql_jaccard("qt.t", "mt.t")} AS score
      FROM qt JOIN mt ON contains(lower(master_name), lower(name)))
SELECT name, CAST(rank AS INTEGER) AS rank, row_id, master_name, round(score, 6) AS score FROM (
  SELECT *, row_number() OVER (PARTITION BY name ORDER BY score DESC, row_id) AS rank FROM s) WHERE rank <= 10""")
def substring_scored(spark, sf_dir):
    """The ten best masters that contain a text, by the rarest gram of it."""
    from tessera.operators.match import substring_candidates
    part = read_table(spark, sf_dir, "part")
    left = read_table(spark, sf_dir, "nation").select(F.lower("n_name").alias("name")).unionByName(
        part.select(F.substring("p_type", 1, 5).alias("name"))).unionByName(part.select(F.substring("p_name", 1, 2).alias("name"))).distinct()
    master = part.select(F.col("p_partkey").alias("row_id"), F.concat_ws(" ", "p_name", "p_type").alias("master_name"))
    out = substring_candidates(left, master, k=10)
    return out.select("name", "rank", "row_id", "master_name", F.round("score", 6).alias("score"))
