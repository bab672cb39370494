"""Queries of the page operators over pages rendered from the test tables.

The captured test pages hold no table, roster, JSON-LD or labelled facts.  A
small builder per query renders rows of a test table as the HTML that such
sites serve; parsing and everything after it is the library's work.  Each SQL
oracle starts from the table's rows, not from the HTML.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators import aggregate as ag
from tessera.operators import extract as ex
from tessera.operators import html as hx
from tessera.plans import jobs
from tessera.plans.catalog import register
from tessera.session import read_table, spread
from tessera.sources.sinks import cut_lineage


def _joined(rows: DataFrame, key: str, order: str, piece, out: str) -> DataFrame:
    """The pieces of a key's rows in order, as one text."""
    g = rows.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), piece.alias("p")))).alias("l"))
    return g.select(key, F.array_join(F.transform("l", lambda x: x["p"]), "").alias(out))


_PAGE = 1_000_000_000


def _paged(rows: DataFrame, nation: str, key: str) -> DataFrame:
    """``rows`` with ``page``: a page per nation and 50 keys, so that pages stay
    small and their number grows with the table."""
    return rows.withColumn("page", F.col(nation).cast("long") * _PAGE + F.floor(F.col(key) / 50))


def _cell(*parts) -> Column:
    return F.concat(F.lit("<td>"), *parts, F.lit("</td>"))


def standings_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One page per nation: a table outside ``main`` that must be ignored, a
    heading, and a standings table of its suppliers.  Nations with even keys
    show points."""
    s = read_table(spark, sf_dir, "supplier")
    k = F.col("s_suppkey")
    points = (F.col("s_nationkey") % 2 == 0)
    row = F.concat(F.lit("<tr>"), _cell(F.col("s_name"), F.lit(" [x] (y)*")),
                   _cell((k % 7).cast("string"), F.lit("-"), (k % 5).cast("string")),
                   _cell((k % 11).cast("string"), F.lit(" – "), (k % 3).cast("string")),
                   F.when(points, _cell((k % 13).cast("string"), F.lit(" pts"))).otherwise(F.lit("")), F.lit("</tr>"))
    body = _joined(s, "s_nationkey", "s_suppkey", row, "rows")
    html = F.concat(F.lit("<html><title>t</title><body><table><tr><th>School</th><th>Conf</th></tr><tr><td>Nav</td><td>1-1</td></tr></table><main><h2>Group "),
                    F.col("s_nationkey").cast("string"), F.lit("</h2><table><tr><th>Team</th><th>Conf</th><th>Overall</th>"),
                    F.when(F.col("s_nationkey") % 2 == 0, F.lit("<th>Pts</th>")).otherwise(F.lit("")), F.lit("</tr>"), F.col("rows"),
                    F.lit("</table></main></body></html>"))
    return body.select(F.col("s_nationkey").cast("long").alias("page_id"), html.alias("html"))


@register("standings_tables", """
SELECT CAST(s_nationkey AS BIGINT) AS page_id, 'Group ' || s_nationkey AS conference, s_name AS school,
  (s_suppkey % 7) || '-' || (s_suppkey % 5) AS conf_record, (s_suppkey % 11) || ' – ' || (s_suppkey % 3) AS overall_record,
  CASE WHEN s_nationkey % 2 = 0 THEN CAST(s_suppkey % 13 AS DOUBLE) END AS pts,
  CAST(CASE WHEN s_nationkey % 2 = 0 THEN row_number() OVER (PARTITION BY s_nationkey ORDER BY s_suppkey % 13 DESC, s_suppkey)
       ELSE row_number() OVER (PARTITION BY s_nationkey ORDER BY s_suppkey) END AS VARCHAR) AS standing
FROM supplier""")
def standings_tables(spark, sf_dir):
    """B1 + B4-B10 + C5, C6, C8 + S31 + F7 + G1, G2: rendered standings pages ->
    tables of the best tier -> header -> keyword map -> rows -> standing."""
    ent = cut_lineage(jobs.standing_entries(standings_pages(spark, sf_dir)))
    out = ag.points_standing(ent, group=["page_id", "table_id"], pos="pos", pts="pts")
    return out.select("page_id", "conference", "school", "conf_record", "overall_record", "pts", "standing")


def ranking_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One page per 20 parts, its ranks 1 to 20 listed backwards and the first
    name twice, as a table, text lines, elements or links by turns."""
    p = read_table(spark, sf_dir, "part").withColumn("page_id", F.floor(F.col("p_partkey") / 20).cast("long"))
    rank, name, kind = (F.col("p_partkey") % 20 + 1).cast("string"), F.col("p_name"), F.col("page_id") % 4
    row = (F.when(kind == 0, F.concat(F.lit("<tr><td>"), rank, F.lit("</td><td>"), name, F.lit("</td></tr>")))
           .when(kind == 1, F.concat(F.lit("<div>"), rank, F.lit(") "), name, F.lit("</div>")))
           .when(kind == 2, F.concat(F.lit("<li>"), rank, F.lit(" <b>"), name, F.lit("</b></li>")))
           .otherwise(F.concat(F.lit("<a>#"), rank, F.lit(" - "), name, F.lit("</a> "))))
    row = F.when(F.col("p_partkey") % 20 == 0, F.concat(row, row)).otherwise(row)
    body = _joined(p.withColumn("back", -F.col("p_partkey")), "page_id", "back", row, "rows")
    kind = F.col("page_id") % 4
    html = (F.when(kind == 0, F.concat(F.lit("<body><table>"), F.col("rows"), F.lit("</table></body>")))
            .when(kind == 2, F.concat(F.lit("<body><span class='team-name'>x</span><ul>"), F.col("rows"), F.lit("</ul></body>")))
            .otherwise(F.concat(F.lit("<body>"), F.col("rows"), F.lit("</body>"))))
    return body.select("page_id", html.alias("html"))


@register("rankings_pages", """
SELECT p_partkey // 20 AS page_id, CAST(p_partkey % 20 + 1 AS INTEGER) AS rank, p_name AS name,
  CAST((p_partkey // 20) % 4 AS INTEGER) AS strategy FROM part""")
def rankings_pages(spark, sf_dir):
    """Rendered ranking pages by all four strategies; doubled rows
    once."""
    return jobs.ranking_entries(ranking_pages(spark, sf_dir)).select("page_id", "rank", F.trim("name").alias("name"), "strategy")


_POSITIONS, _YEARS = ["GK", "Defender", "Mid", "Forward", "D/M"], ["Fr.", "So.", "Jr.", "Sr.", "Graduate"]


def _pick(values: list[str], n) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (n + 1).cast("int"))


def roster_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Roster pages of 50 keys of a nation's customers: Sidearm cards for even
    nations, a data-field table for odd ones."""
    c = _paged(read_table(spark, sf_dir, "customer"), "c_nationkey", "c_custkey")
    pos, yr = _pick(_POSITIONS, F.col("c_custkey") % 5), _pick(_YEARS, F.floor(F.col("c_custkey") / 5) % 5)
    card = F.concat(F.lit("<li class='sidearm-roster-player'><span class='sidearm-roster-player-position'>"), pos,
                    F.lit("</span><span class='sidearm-roster-player-academic-year'>"), yr, F.lit("</span></li>"))
    tr = F.concat(F.lit("<tr><td data-field='position'>"), F.lower(pos), F.lit("</td><td data-field='year'>"), yr, F.lit("</td></tr>"))
    rows = _joined(c, "page", "c_custkey", F.when(F.col("c_nationkey") % 2 == 0, card).otherwise(tr), "rows")
    rows = rows.withColumn("c_nationkey", F.floor(F.col("page") / _PAGE))
    html = F.when(F.col("c_nationkey") % 2 == 0, F.concat(F.lit("<html><head><meta name='generator' content='Sidearm Sports'></head><body><ul>"), F.col("rows"), F.lit("</ul></body></html>"))) \
        .otherwise(F.concat(F.lit("<body><table class='roster-data'>"), F.col("rows"), F.lit("</table></body>")))
    return rows.select(F.col("page").alias("page_id"), html.alias("html"))


@register("roster_pages", """
WITH p AS (SELECT CAST(c_nationkey AS BIGINT) * 1000000000 + c_custkey // 50 AS page, c_custkey % 5 AS p, (c_custkey // 5) % 5 AS y FROM customer)
SELECT page AS page_id,
  count(*) FILTER (WHERE p IN (1, 4)) AS defenders, count(*) FILTER (WHERE p = 3) AS forwards,
  count(*) FILTER (WHERE p IN (2, 4)) AS midfielders, count(*) FILTER (WHERE p = 0) AS goalkeepers,
  count(*) FILTER (WHERE y = 0) AS freshman, count(*) FILTER (WHERE y = 1) AS sophomore, count(*) FILTER (WHERE y = 2) AS junior,
  count(*) FILTER (WHERE y = 3) AS senior, count(*) FILTER (WHERE y = 4) AS graduate_student
FROM p GROUP BY page""")
def roster_counts_pages(spark, sf_dir):
    """B16-B19 + V1 + S14, S16, S43 + F1: rendered rosters -> extractor by
    page kind -> normalised players -> counts per page."""
    from tessera.functions import roster as ro
    players = ex.roster_players(hx.html_nodes(roster_pages(spark, sf_dir), text_tags={"li", "span", "tr", "td", "div", "p"}))
    return ag.roster_counts(ro.normalize_players(players), ["page_id"])


@register("jsonld_events", """
SELECT event_id AS page_id, CAST(0 AS INTEGER) AS i, 'Camp ages 8-' || (user_id % 10 + 9) AS name, 'Org ' || event_type AS organizer,
  strftime(ts, '%Y-%m-%d') AS start_date, CAST(epoch(date_trunc('day', ts)) AS BIGINT) AS start_unix,
  CAST(user_id AS DOUBLE) AS lat, CAST(round(value, 2) AS VARCHAR) AS price, '8-' || (user_id % 10 + 9) AS ages
FROM events WHERE event_type <> 'error'""")
def jsonld_events(spark, sf_dir):
    """B15 + S23, S24: every event as a JSON-LD page (array and object forms,
    other types and broken JSON beside it) -> event rows."""
    e = spread(read_table(spark, sf_dir, "events"), "event_id")
    body = F.to_json(F.struct(
        F.when(F.col("event_type") == "error", F.lit("Thing")).otherwise(F.lit("SportsEvent")).alias("@type"),
        F.concat(F.lit("Camp ages 8-"), (F.col("user_id") % 10 + 9).cast("string")).alias("name"),
        F.struct(F.concat(F.lit("Org "), "event_type").alias("name")).alias("organizer"),
        F.date_format("ts", "yyyy-MM-dd").alias("startDate"),
        F.struct(F.struct(F.col("user_id").cast("double").alias("latitude")).alias("geo")).alias("location"),
        F.struct(F.round("value", 2).cast("string").alias("price")).alias("offers")))
    body = F.when(F.col("event_id") % 2 == 0, F.concat(F.lit("["), body, F.lit("]"))).otherwise(body)
    pages = e.select(F.col("event_id").alias("page_id"), F.concat(
        F.lit('<script type="application/ld+json">'), body, F.lit('</script><script type="application/ld+json">{broken</script>')).alias("html"))
    ev = ex.jsonld_events(hx.html_nodes(pages, tags={"script"}, text_tags=set()))
    return ev.select("page_id", "i", "name", "organizer", "start_date", "start_unix", "lat", "price", "ages")


@register("facts_pages", """
SELECT s_suppkey AS page_id, CAST(CASE WHEN s_suppkey % 3 = 0 THEN 10000 + s_suppkey ELSE 20000 + s_suppkey END AS BIGINT) AS in_state_tuition,
  CAST(CASE WHEN s_suppkey % 3 = 0 THEN 30000 + s_suppkey ELSE 20000 + s_suppkey END AS BIGINT) AS out_state_tuition,
  round(2 + (s_suppkey % 20) / 10.0, 2) AS avg_gpa, CAST(1000 + s_suppkey AS BIGINT) AS undergraduates FROM supplier""")
def facts_pages(spark, sf_dir):
    """B3 + B20 + S2-S5: labelled value boxes (label before, after, or above the
    value) -> tuition, grade average and undergraduates per page."""
    s = spread(read_table(spark, sf_dir, "supplier"), "s_suppkey")
    k = F.col("s_suppkey")
    money = lambda n: F.concat(F.lit("$"), F.format_number(n, 0))
    title = lambda t: F.lit(f"<div class='t'>{t}</div>")
    value = lambda v: F.concat(F.lit("<div class='v'>"), v, F.lit("</div>"))
    box = lambda *x: F.concat(F.lit("<div>"), *x, F.lit("</div>"))
    tuition = F.when(k % 3 == 0, F.concat(box(title("Tuition"), value(F.concat(money(10000 + k), F.lit(" in-state")))),
                                          box(value(F.concat(money(30000 + k), F.lit(" out-of-state"))), title("Tuition")))) \
        .otherwise(box(title("Tuition and fees"), box(value(money(20000 + k)))))
    html = F.concat(F.lit("<body><div class='ug'>"), F.format_number(1000 + k, 0), F.lit(" students</div>"),
                    box(title("Cost of Attendance"), value(money(90000 + k))), tuition,
                    box(title("Average GPA"), value(F.format_string("%.2f", 2 + (k % 20) / 10))), F.lit("</body>"))
    nodes = hx.html_nodes(s.select(k.alias("page_id"), html.alias("html")), text_tags={"div"}, tags={"div", "body"})
    out = ex.academic_facts(ex.labelled_values(nodes, "v", "t"), nodes, "ug")
    return out.select("page_id", "in_state_tuition", "out_state_tuition", "avg_gpa", "undergraduates")


@register("camp_pages", """
SELECT c_custkey AS page_id, CASE WHEN c_custkey % 5 = 0 THEN 'Unknown Camp Name' ELSE 'Girls Camp ' || c_name END AS camp_name,
  'City' || c_nationkey AS city, 'TX' AS state, '8-' || (c_custkey % 9 + 9) AS ages, 'June ' || (c_custkey % 20 + 1) AS start_date,
  'June ' || (c_custkey % 20 + 4) AS end_date, 'Cost $' || (c_custkey % 300) AS cost,
  CASE WHEN c_custkey % 5 = 0 THEN 'Coed' ELSE 'Girls' END AS gender FROM customer""")
def camp_pages(spark, sf_dir):
    """B21 + S22, S25, S26: rendered camp pages -> title, place, ages, date
    range, cost and gender (one aggregate over the node table)."""
    c = spread(read_table(spark, sf_dir, "customer"), "c_custkey")
    k = F.col("c_custkey")
    html = F.concat(F.when(k % 5 == 0, F.lit("<body>")).otherwise(F.concat(F.lit("<body><h1> Girls Camp "), "c_name", F.lit(" </h1>"))),
                    F.lit("<div class='location'>City"), F.col("c_nationkey").cast("string"), F.lit(", TX</div><p>Ages: 8-"),
                    (k % 9 + 9).cast("string"), F.lit("</p><p>Dates: June "), (k % 20 + 1).cast("string"), F.lit(" to June "),
                    (k % 20 + 4).cast("string"), F.lit("</p><p>Cost $"), (k % 300).cast("string"), F.lit("</p></body>"))
    pages = c.select(k.alias("page_id"), F.lit("u").alias("url"), html.alias("html"))
    out = ex.camp_page_fields(hx.html_nodes(pages, text_tags={"h1", "div"}), pages)
    return out.select("page_id", "camp_name", "city", "state", "ages", "start_date", "end_date", "cost", "gender")


def block_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages of 50 suppliers of a nation: a heading in a header box, a nested
    block with a title of its own around a layout table, and rows after it."""
    s = read_table(spark, sf_dir, "supplier").withColumn("page", F.col("s_nationkey").cast("long") * 1_000_000_000 + F.floor(F.col("s_suppkey") / 50))
    k = F.col("s_suppkey")
    row = F.concat(F.lit("<tr>"), _cell((k % 9).cast("string")), _cell(F.lit("<a href='/t'>"), F.col("s_name"), F.lit("</a>")),
                   _cell((k % 7).cast("string"), F.lit("-"), (k % 5).cast("string")),
                   F.when(k % 4 > 0, _cell((k % 11).cast("string"), F.lit("-"), (k % 3).cast("string"))).otherwise(F.lit("")), F.lit("</tr>"))
    part = lambda n: _joined(s.where((k % 3 == 0) if n else (k % 3 > 0)), "page", "s_suppkey", row, f"rows{n}")
    keys = s.groupBy("page").agg(F.min("s_nationkey").alias("nation"))
    g = keys.join(part(0), "page", "left").join(part(1), "page", "left")
    nation = F.col("nation").cast("string")
    title = F.when(F.col("nation") % 3 == 0, F.concat(F.lit("<div class=head><h2>Group "), nation, F.lit("</h2></div>"))) \
        .when(F.col("nation") % 3 == 1, F.concat(F.lit("<a href='/g'> Link "), nation, F.lit("</a>"))) \
        .otherwise(F.concat(F.lit("<div class='block-title'>Box "), nation, F.lit("</div>")))
    inner = F.concat(F.lit("<div><table><tr><td><h3>Inner "), nation, F.lit("</h3><table>"), "rows1", F.lit("</table></td></tr></table></div>"))
    html = F.concat(F.lit("<main><p>intro</p><section>"), title, F.coalesce(inner, F.lit("")), F.lit("<table><tr><th>x</th><th>y</th></tr>"),
                    F.coalesce("rows0", F.lit("")), F.lit("</table></section></main>"))
    return g.select(F.col("page").cast("long").alias("page_id"), html.alias("html"))


@register("standings_blocks", """
SELECT CAST(s_nationkey AS BIGINT) * 1000000000 + s_suppkey // 50 AS page_id,
  CASE WHEN s_suppkey % 3 = 0 THEN 'Inner ' WHEN s_nationkey % 3 = 0 THEN 'Group ' WHEN s_nationkey % 3 = 1 THEN 'Link ' ELSE 'Box ' END
    || s_nationkey AS conference,
  CAST(s_suppkey % 9 AS VARCHAR) AS standing, s_name AS school, (s_suppkey % 7) || '-' || (s_suppkey % 5) AS conf_record,
  CASE WHEN s_suppkey % 4 > 0 THEN (s_suppkey % 11) || '-' || (s_suppkey % 3) ELSE '' END AS overall_record
FROM supplier""")
def standings_blocks(spark, sf_dir):
    """B1 + B10: rows read by position under the title that is open at them."""
    out = jobs.block_entries(block_pages(spark, sf_dir))
    return out.select("page_id", "conference", "standing", "school", "conf_record", "overall_record")


@register("repaired_pages", """
SELECT s_suppkey AS page_id, s_name || ' two' AS bold_in_p, ' plain' AS own_p, 'stray ' || s_nationkey AS before_table,
  CASE WHEN s_suppkey % 5 = 0 THEN true ELSE false END AS broken
FROM supplier""")
def repaired_pages(spark, sf_dir):
    """B1 (misnested pages): formatting closed across a block, text misplaced
    in a table, and an error row for pages that break the tokenizer."""
    s = spread(read_table(spark, sf_dir, "supplier"), "s_suppkey")
    html = F.concat(F.lit("<main><b>one<p>"), "s_name", F.lit(" two</b> plain</p><div><table>stray <tr>"), F.col("s_nationkey").cast("string"),
                    F.lit("<td><i>cell<td>next</table></div></main>"), F.when(F.col("s_suppkey") % 5 == 0, F.lit("<![broken[")).otherwise(F.lit("")))
    nodes = cut_lineage(hx.html_nodes(s.select(F.col("s_suppkey").alias("page_id"), html.alias("html")), text_tags={"b"}, repair=True))
    p = nodes.filter("tag = 'p'").select("page_id", F.col("node_id").alias("p_id"), F.col("own_text").alias("own_p"))
    bold = nodes.filter("tag = 'b'").select("page_id", F.col("parent_id").alias("p_id"), F.col("text").alias("bold_in_p"))
    div = nodes.filter("tag = 'div'").select("page_id", F.col("own_text").alias("before_table"))
    bad = hx.page_errors(nodes).select("page_id", F.lit(True).alias("broken"))
    return (p.join(bold, ["page_id", "p_id"]).join(div, "page_id").join(bad, "page_id", "left")
            .select("page_id", "bold_in_p", "own_p", "before_table", F.coalesce("broken", F.lit(False)).alias("broken")))
