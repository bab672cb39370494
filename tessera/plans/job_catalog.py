"""Queries of whole jobs and of operators that no other query calls, over
rows of the test tables put into the shapes they read (``*_input`` builders
only format columns).  Each SQL oracle starts from the table's rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions import events as ev
from tessera.functions import status as st
from tessera.functions import text as tx
from tessera.functions import urls as ul
from tessera.operators import aggregate as ag
from tessera.operators import answers as an
from tessera.operators import columns as co
from tessera.operators import extract as ex
from tessera.operators import html as hx
from tessera.operators import match as mt
from tessera.operators import reconcile as rc
from tessera.plans import jobs
from tessera.plans.catalog import register
from tessera.plans.page_catalog import _POSITIONS, _YEARS, _joined, _pick
from tessera.plans.table_catalog import _folder
from tessera.session import read_table, spread
from tessera.sources import files, sinks


def season_input(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """Roster URLs of 2019 and captures of 2025: a team per nation, gender and
    50 customers.  By block: a range; a year whose form without the year was
    captured; a year whose form without it was not; a range of which only the
    form without the year yields players."""
    c = read_table(spark, sf_dir, "customer")
    block = F.floor(F.col("c_custkey") / 50)
    c = c.select((F.col("c_nationkey").cast("long") * 1_000_000 + block).alias("team"), (block % 4).alias("kind"), "c_custkey",
                 F.when(F.col("c_custkey") % 2 == 0, "men").otherwise("women").alias("gender"))
    pos, yr = _pick(_POSITIONS, F.col("c_custkey") % 5), _pick(_YEARS, F.floor(F.col("c_custkey") / 5) % 5)
    card = F.concat(F.lit("<li class='sidearm-roster-player'><span class='sidearm-roster-player-position'>"), pos,
                    F.lit("</span><span class='sidearm-roster-player-academic-year'>"), yr, F.lit("</span></li>"))
    key = F.concat_ws("/", F.col("team").cast("string"), "gender").alias("key")
    teams = c.select("team", "kind", "gender", key).distinct()
    url = lambda seg: F.concat(F.lit("https://t"), F.col("team").cast("string"), F.lit(".edu/"), "gender", F.lit(seg), F.lit("/roster"))
    rosters = teams.select(F.concat(F.lit("U"), F.col("team").cast("string")).alias("university"), "gender",
                           F.when(F.col("kind").isin(0, 3), url("/2019-20")).otherwise(url("/2019")).alias("url"))
    page = teams.join(_joined(c.withColumn("key", key), "key", "c_custkey", card, "cards"), "key")
    html = F.concat(F.lit("<html><meta name='generator' content='Sidearm'><ul>"), F.col("cards"), F.lit("</ul></html>"))
    id_ = F.xxhash64("key")
    cap = page.select(id_.alias("page_id"), F.when(F.col("kind") == 0, url("/2025-26")).when(F.col("kind") == 2, url("/2025")).otherwise(url("")).alias("url"),
                      F.lit(200).alias("status"), html.alias("html"))
    empty = page.where("kind = 3").select((id_ + 1).alias("page_id"), url("/2025-26").alias("url"), F.lit(200).alias("status"), F.lit("<p>soon</p>").alias("html"))
    return rosters, cap.unionByName(empty)


@register("season_rosters", """
WITH c AS (SELECT CAST(c_nationkey AS BIGINT) * 1000000 + c_custkey // 50 AS team, (c_custkey // 50) % 4 AS kind, c_custkey % 2 AS g,
             c_custkey % 5 AS p, (c_custkey // 5) % 5 AS y FROM customer),
n AS (SELECT team, kind, g, CASE WHEN kind = 1 THEN 0 ELSE 1 END AS ok, count(*) FILTER (WHERE p IN (1, 4)) AS defenders, count(*) FILTER (WHERE p = 0) AS goalkeepers,
        count(*) FILTER (WHERE y = 0) AS freshman, count(*) FILTER (WHERE y = 4) AS graduates FROM c GROUP BY team, kind, g),
u AS (SELECT *, 'https://t' || team || '.edu/' || CASE g WHEN 0 THEN 'men' ELSE 'women' END AS base FROM n)
SELECT 'U' || team AS university, max(defenders * ok) FILTER (WHERE g = 0) AS men_defenders, max(goalkeepers * ok) FILTER (WHERE g = 0) AS men_goalkeepers,
  max(freshman * ok) FILTER (WHERE g = 1) AS women_freshman, max(graduates * ok) FILTER (WHERE g = 1) AS women_graduates,
  max(base || CASE WHEN kind IN (0, 3) THEN '/2025-26' WHEN kind = 2 THEN '/2025' ELSE '' END || '/roster') FILTER (WHERE g = 0) AS men_updated_url,
  max(CASE WHEN kind <> 1 THEN base || CASE WHEN kind = 0 THEN '/2025-26' WHEN kind = 2 THEN '/2025' ELSE '' END || '/roster' END) FILTER (WHERE g = 0) AS men_read_url
FROM u GROUP BY team""")
def season_rosters(spark, sf_dir):
    """S10-S13 and C10 by the season, A9, B16-B19, S43, F1, F2."""
    rosters, captures = season_input(spark, sf_dir)
    out = jobs.roster_counts(rosters, captures, 2025, 2025)
    return out.select("university", "men_defenders", "men_goalkeepers", "women_freshman", F.col("women_graduate_student").alias("women_graduates"),
                      "men_updated_url", F.col("men_candidate_url").alias("men_read_url"))


@register("forwarded_mail", """
SELECT doc_id AS id, CASE doc_id % 3 WHEN 0 THEN 'Kept ' || doc_id || chr(10) || regexp_replace(coalesce(lang, ''), '[0-9]', '', 'g')
  WHEN 1 THEN 'Short body ' || doc_id || chr(10) || '• one & two' ELSE 'A plain body that is longer than fifty characters, number ' || doc_id END AS body
FROM documents""")
def forwarded_mail(spark, sf_dir):
    """A10 + A11 + B27 + B28: forwarded mail loses its header lines, short
    plain text gives way to the HTML part."""
    from tessera.sources.pages import mail_body, mail_html
    d = read_table(spark, sf_dir, "documents")
    n = F.col("doc_id").cast("string")
    lang = F.regexp_replace(F.coalesce("lang", F.lit("")), "[0-9]", "")
    plain = (F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit("See below, this is what came in yesterday.\n---- Begin Forwarded Message:\nFrom: a@b.c\nDate: x\nSubject: old one\nKept "), n, F.lit("\n"), lang))
             .when(F.col("doc_id") % 3 == 1, F.lit("see html")).otherwise(F.concat(F.lit("A plain body that is longer than fifty characters, number "), n)))
    html = F.concat(F.lit("<div>Short body "), n, F.lit("</div><li>one &amp; two</li><br><br/>"))
    parts = F.array(F.struct(F.lit("text/html").alias("mimeType"), F.translate(F.base64(F.encode(html, "UTF-8")), "+/", "-_").alias("data")))
    return d.select(F.col("doc_id").alias("id"), mail_body(plain, mail_html(parts)).alias("body"))


@register("mail_listing", """
WITH l AS (SELECT doc_id, lang FROM documents WHERE doc_id % 4 <> 0 AND doc_id % 7 <> 0 ORDER BY doc_id DESC LIMIT 100),
s AS (SELECT doc_id FROM l ORDER BY doc_id DESC LIMIT 9 OFFSET 1),
p AS (SELECT doc_id, unnest([1, 2, 3, 4]) AS i FROM s)
SELECT CAST(doc_id AS VARCHAR) AS msg_id, CAST((i - 1) // 3 AS INTEGER) AS chunk_idx,
  'Items: ' || string_agg('<p>' || doc_id || ' item ' || i || '</p>', chr(10) ORDER BY i) AS prompt FROM p GROUP BY doc_id, (i - 1) // 3""")
def mail_listing(spark, sf_dir):
    """J14, mail half: C18 + G6 + A10 + B25, B26 + M1."""
    d = read_table(spark, sf_dir, "documents").where("doc_id is not null")
    n = F.col("doc_id").cast("string")
    html = F.concat(*[F.concat(F.lit("<p>"), n, F.lit(f" item {i}</p><span>x</span>")) for i in range(1, 5)])
    mail = d.select(n.alias("id"), (F.lit("2024-01-01").cast("timestamp") + F.make_dt_interval(secs=F.col("doc_id").cast("decimal(18,6)"))).alias("ts"),
                    F.when(F.col("doc_id") % 7 == 0, " ").otherwise("s").alias("subject"), F.array(F.when(F.col("doc_id") % 4 == 0, "x").otherwise("aid")).alias("labels"),
                    F.array(F.struct(F.lit("text/html").alias("mimeType"), F.translate(F.base64(F.encode(html, "UTF-8")), "+/", "-_").alias("data"))).alias("parts"))
    return jobs.scholarship_run(mail, "Items: {snippet}", "aid", "2024-06-01")


_LINKS = [("a/b", "'/dir/' || k || '/a/b'"), ("../up", "'/dir/up'"), ("?q=1", "'/dir/' || k || '/page.html?q=1'"), ("#f", "'/dir/' || k || '/page.html#f'"),
          ("./here", "'/dir/' || k || '/here'"), ("/x/../root", "'/root'"), ("../../../over", "'/over'"), ("//other.org/z", None), ("mailto:a@b.c", None)]


@register("relative_links", "SELECT p_partkey AS page_id, v.* FROM (SELECT p_partkey, 'h' || p_size || '.org' AS h, p_partkey % 10 AS k FROM part), LATERAL (VALUES "
          + ", ".join(f"({i}, " + (f"'http://' || h || {sql}" if sql else ("'http:' || " if t.startswith("//") else "") + f"'{t}'") + ")" for i, (t, sql) in enumerate(_LINKS))
          + ") v(link, url)")
def relative_links(spark, sf_dir):
    """Links relative to the page, with dot segments, queries and
    fragments, of other hosts and schemes."""
    p = spread(read_table(spark, sf_dir, "part"), "p_partkey")
    url = F.concat(F.lit("http://h"), F.col("p_size").cast("string"), F.lit(".org/dir/"), (F.col("p_partkey") % 10).cast("string"), F.lit("/page.html"))
    html = F.lit("<body>" + "".join(f"<a href='{t}'>x</a>" for t, _ in _LINKS) + "</body>")
    nodes = hx.html_nodes(p.select(F.col("p_partkey").alias("page_id"), url.alias("url"), html.alias("html")), tags={"a"}, text_tags=set(), carry=["url"])
    return nodes.select("page_id", F.col("tag_idx").alias("link"), ul.url_join(F.col("url"), F.col("attrs")["href"]).alias("url"))


@register("year_urls", """
WITH u AS (SELECT o_orderkey, year(o_orderdate) AS y, o_orderkey % 4 AS k FROM orders)
SELECT o_orderkey, k IN (0, 1) AS has_year,
  CASE k WHEN 0 THEN 'https://s.edu/msoc/2025-26/roster' WHEN 1 THEN 'https://s.edu/msoc/' || y || '/roster?x=1' WHEN 2 THEN 'https://s.edu/msoc/roster' ELSE '' END AS ranged,
  CASE k WHEN 0 THEN 'https://s.edu/msoc/2025/roster' WHEN 1 THEN 'https://s.edu/msoc/2025/roster?x=1' WHEN 2 THEN 'https://s.edu/msoc/roster' ELSE '' END AS replaced,
  CASE k WHEN 0 THEN 'https://s.edu/msoc/roster' WHEN 1 THEN 'https://s.edu/msoc/roster?x=1' WHEN 2 THEN 'https://s.edu/msoc/roster' ELSE '' END AS yearless
FROM u""")
def year_urls(spark, sf_dir):
    """S10 + S11 + S13 + C10 on URLs with a range, a year, neither, and none."""
    o = read_table(spark, sf_dir, "orders")
    y, k = F.year("o_orderdate"), F.col("o_orderkey") % 4
    rng = F.concat(y.cast("string"), F.lit("-"), F.substring((y + 1).cast("string"), 3, 2))
    url = (F.when(k == 0, F.concat(F.lit("https://s.edu/msoc/"), rng, F.lit("/roster"))).when(k == 1, F.concat(F.lit("https://s.edu/msoc/"), y.cast("string"), F.lit("/roster?x=1")))
           .when(k == 2, "https://s.edu/msoc/roster").otherwise(""))
    x = o.select("o_orderkey", url.alias("u"))
    return x.select("o_orderkey", ul.has_year_token("u").alias("has_year"), ul.update_year_range("u", 2025).alias("ranged"), ul.replace_year("u", 2025).alias("replaced"),
                    ul.remove_year_segment("u").alias("yearless"))


@register("file_round_trip", """
SELECT c_custkey AS row_id, c_name || ', "q"' AS name, CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE c_mktsegment END AS segment, CAST(NULL AS VARCHAR) AS error FROM customer
WHERE c_custkey BETWEEN 10 AND 100000000
UNION ALL SELECT s_suppkey, s_name, CAST(s_nationkey AS VARCHAR), NULL FROM supplier""")
def file_round_trip(spark, sf_dir):
    """A5 + A6 + A12 + A13 + A15 + A17: fixed-column CSV written and read with
    a declared schema, required columns, a row range; rows appended."""
    c = read_table(spark, sf_dir, "customer")
    folder = _folder(spark, "csv-sink")
    rows = c.select(F.col("c_custkey").alias("row_id"), F.concat("c_name", F.lit(', "q"')).alias("name"), F.when(F.col("c_custkey") % 3 > 0, F.col("c_mktsegment")).alias("segment"))
    sinks.write_csv(rows.withColumn("name", F.replace("name", F.lit('"'), F.lit("''"))), folder, ["row_id", "name", "segment", "error"])
    back = files.read_csv(spark, folder, "row_id long, name string, segment string, error string", required=["row_id", "name", "error"])
    back = files.row_range(back.withColumn("name", F.replace("name", F.lit("''"), F.lit('"'))), 10, 100_000_000)
    out = _folder(spark, "append")
    sinks.append_parquet(sinks.ensure_columns(back, ["row_id", "name", "segment", "error"]), out)
    s = read_table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("row_id"), F.col("s_name").alias("name"), F.col("s_nationkey").cast("string").alias("segment"))
    sinks.append_parquet(sinks.ensure_columns(s, ["row_id", "name", "segment", "error"]), out)
    return spark.read.parquet(out)


@register("text_forms", """
WITH s AS (SELECT p_partkey, p_name AS n, p_partkey % 6 AS k FROM part)
SELECT p_partkey, lower(n) || ' w-l' AS header, CASE WHEN k % 2 = 0 THEN n ELSE n || ' Campus' END AS camp,
  [lower(n), replace(lower(n), ' ', '-'), replace(lower(n), ' ', '_'), replace(lower(n), ' ', '')] AS keys,
  'https://site-' || p_partkey || '.org/a' AS link,
  CASE k WHEN 0 THEN 'NAIA' WHEN 1 THEN 'D2' WHEN 2 THEN 'D3' WHEN 3 THEN 'D1' WHEN 4 THEN 'D2' ELSE '' END AS division,
  CASE k WHEN 0 THEN 'DII' WHEN 1 THEN 'NAIA' WHEN 2 THEN 'DIII' WHEN 3 THEN 'DI' END AS file_division,
  CASE WHEN k % 3 = 0 THEN 'women' WHEN k % 3 = 1 THEN 'men' END AS gender,
  CASE k WHEN 0 THEN 'roster' WHEN 1 THEN 'staff' WHEN 2 THEN 'general' WHEN 3 THEN 'general' END AS mode,
  CASE k WHEN 0 THEN 'https://x.edu/msoc/roster' WHEN 1 THEN 'https://x.edu/staff-directory' WHEN 2 THEN 'https://x.edu/m/coaches' WHEN 3 THEN 'https://x.edu/' END AS base,
  k = 5 AS error_page
FROM s""")
def text_forms(spark, sf_dir):
    """S8 + S19 + S20 + S22 + S33 + S34 + S35 + S38 + S40 on strings made of
    part names."""
    p = read_table(spark, sf_dir, "part")
    k, n = F.col("p_partkey") % 6, F.col("p_name")
    pick = lambda *v: _pick(list(v), k)
    id_ = F.col("p_partkey").cast("string")
    base = st.profile_base(pick("https://x.edu/msoc/roster/coaches/a/1", "https://x.edu/staff-directory/b", "https://x.edu/m/coaches/c", "https://x.edu/", "", ""))
    return p.select(
        "p_partkey", tx.normalize_header(F.concat(F.lit(" "), n, F.lit(" [x]  W-L (2024) "))).alias("header"),
        tx.strip_camp_suffix(F.when(k % 2 == 0, F.concat(n, F.lit("  Camp"))).otherwise(F.concat(n, F.lit(" Campus ")))).alias("camp"),
        tx.person_name_keys(F.concat(F.lit("  "), F.replace(n, F.lit(" "), F.lit("   ")), F.lit(" "))).alias("keys"),
        ul.clean_url(F.concat(F.lit(" <site-"), id_, F.when(k % 2 == 0, ".org/a> - Open in new window ").otherwise(".org/a.),"))).alias("link"),
        ev.extract_division(pick("an NAIA camp", "Division II", "division iii team", "Division I", "the d2 league", "divisional")).alias("division"),
        ev.division_from_filename(pick("/a/men_DII.csv", "x naia.csv", "DIII-list", "women DI 2024.csv", "Indiana.csv", "/DI/none.csv")).alias("file_division"),
        ev.gender_from_name(_pick(["Womens.csv", "men.csv", "all.csv"], F.col("p_partkey") % 3)).alias("gender"),
        base["mode"].alias("mode"), base["base"].alias("base"), st.is_error_page(F.when(k == 5, F.concat(n, F.lit(" Access Denied"))).otherwise(n)).alias("error_page"))


@register("fences", """
WITH e AS (SELECT event_id, '[{"a": "' || user_id || '"}]' AS j, event_id % 4 AS k FROM events)
SELECT event_id, CASE WHEN k <> 3 THEN j END AS camp, CASE k WHEN 3 THEN 'no list' ELSE j END AS js, event_id % 4 <> 3 AS parsed FROM e""")
def fences(spark, sf_dir):
    """M3 + M5: fenced and bare model answers, and one without a list."""
    e = read_table(spark, sf_dir, "events")
    j = F.concat(F.lit('[{"a": "'), F.col("user_id").cast("string"), F.lit('"}]'))
    k = F.col("event_id") % 4
    c = F.when(k == 0, j).when(k == 1, F.concat(F.lit("```json\n"), j, F.lit("\n```"))).when(k == 2, F.concat(F.lit("```\n"), j, F.lit("```"))).otherwise("no list")
    x = e.select("event_id", an.strip_fence_camp(c).alias("camp"), an.strip_fence_js(c).alias("js"))
    return an.with_json_array(x, F.col("camp"), "arr").select("event_id", "camp", "js", F.col("arr").isNotNull().alias("parsed"))


@register("review_decisions", """
WITH c AS (SELECT s_suppkey AS k, 1.0 - (s_suppkey % 5) * 0.05 AS top FROM supplier)
SELECT 's' || k AS left_key, CASE k % 7 WHEN 0 THEN k WHEN 1 THEN k * 10 + 3 WHEN 2 THEN NULL ELSE CASE WHEN top >= 0.9 THEN k * 10 + 1 END END AS chosen_row_id,
  CASE k % 7 WHEN 0 THEN 'pick' WHEN 1 THEN 'pick' WHEN 2 THEN 'skip' ELSE CASE WHEN top >= 0.9 THEN 'auto' ELSE 'review' END END AS how
FROM c""")
def review_decisions(spark, sf_dir):
    """Candidates accepted by their score, by a person's pick, skipped, or
    kept for review."""
    s = read_table(spark, sf_dir, "supplier")
    key = F.concat(F.lit("s"), F.col("s_suppkey").cast("string"))
    cands = s.select(key.alias("left_key"), "s_suppkey", F.explode(F.sequence(F.lit(1), F.lit(3))).alias("rank"))
    cands = cands.select("left_key", "rank", (F.col("s_suppkey") * 10 + F.col("rank")).alias("row_id"), F.lit("m").alias("master_name"),
                         (F.lit(1.0) - (F.col("s_suppkey") % 5) * 0.05 - (F.col("rank") - 1) * 0.3).alias("score"))
    k = F.col("s_suppkey") % 7
    decisions = s.where(k < 3).select(key.alias("left_key"), F.when(k < 2, "pick").otherwise("skip").alias("action"),
                                      F.when(k == 0, F.col("s_suppkey")).when(k == 1, F.col("s_suppkey") * 10 + 3).alias("pick_row_id"))
    accepted, review = mt.resolve_matches(cands, decisions, key="left_key", accept_at=0.9)
    out = accepted.select("left_key", "chosen_row_id", "how")
    none = F.lit(None).cast("long")
    out = out.unionByName(review.select("left_key", none.alias("chosen_row_id"), F.lit("review").alias("how")).distinct())
    return out.unionByName(decisions.where("action = 'skip'").select("left_key", none.alias("chosen_row_id"), F.lit("skip").alias("how")))


@register("resolved_columns", """
SELECT c_custkey AS id, c_name AS name, c_mktsegment AS segment, c_acctbal AS balance, CAST(NULL AS VARCHAR) AS phone FROM customer""")
def resolved_columns(spark, sf_dir):
    """C3 + C4: columns by header variants, by a fallback position, and absent."""
    c = read_table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("Cust Key "), F.col("c_name").alias("University NAME"), "c_nationkey", "c_acctbal", "c_mktsegment")
    out = co.resolve_columns(c, {"id": ["cust key"], "balance": ["balance"], "phone": ["phone"]}, positions={"balance": 3, "phone": 9})
    held = co.resolve_columns(c, {"id": ["cust"], "name": ["name of", "university"], "segment": ["mktseg"]}, mode="contains")
    return out.join(held, "id").select("id", "name", "segment", "balance", "phone")


@register("config_runs", """
WITH c AS (SELECT n_regionkey AS g, n_nationkey AS seq, n_name AS conference, CASE WHEN n_nationkey % 4 > 0 THEN 'u' END AS url, CASE WHEN n_nationkey % 3 > 0 THEN 'x' ELSE ' ' END AS xpath FROM nation),
f AS (SELECT g, seq AS first FROM c WHERE conference = 'NATION_12' OR conference = 'Nation_12' OR conference LIKE '%12')
SELECT c.g AS gender, c.conference, CASE WHEN url IS NOT NULL AND trim(xpath) <> '' THEN 'ready' ELSE
  concat_ws(', ', CASE WHEN url IS NULL THEN 'url' END, CASE WHEN trim(xpath) = '' THEN 'xpath' END) END AS state
FROM c LEFT JOIN f ON c.g = f.g WHERE f.first IS NULL OR c.seq >= f.first""")
def config_runs(spark, sf_dir):
    """C12 + C13 + E15: ready conferences from a named one on, and what the
    others lack."""
    n = read_table(spark, sf_dir, "nation")
    c = n.select(F.col("n_regionkey").alias("gender"), F.lit("d").alias("division"), F.col("n_nationkey").alias("seq"), F.col("n_name").alias("conference"),
                 F.when(F.col("n_nationkey") % 4 > 0, "u").alias("url"), F.when(F.col("n_nationkey") % 3 > 0, "x").otherwise(" ").alias("xpath"))
    named = n.where(F.col("n_name").endswith("12")).select("n_name").first()[0]
    c = co.start_at(rc.config_lookup(c.select("gender", "division"), c), named)
    ready, rest = co.config_report(c)
    return ready.select("gender", "conference", F.lit("ready").alias("state")).unionByName(rest.select("gender", "conference", F.col("missing").alias("state")))


@register("run_report", """
WITH r AS (SELECT 'rows' AS name, count(*) AS n FROM lineitem UNION ALL SELECT 'returned', count(*) FILTER (WHERE l_returnflag = 'R') FROM lineitem
  UNION ALL SELECT 'large', count(*) FILTER (WHERE l_quantity > 40) FROM lineitem),
v AS (SELECT 'order ' || l_orderkey AS name, arg_min(l_partkey, l_linenumber * 100000000 + l_partkey) * 1000000000 + arg_max(l_partkey, l_linenumber * 100000000 + l_partkey) AS n FROM lineitem GROUP BY l_orderkey)
SELECT name, CAST(n AS BIGINT) AS n FROM r UNION ALL SELECT name, CAST(n AS BIGINT) FROM v
UNION ALL SELECT 'head', o_orderkey FROM (SELECT o_orderkey FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 5)
UNION ALL SELECT 'slice', o_orderkey FROM (SELECT o_orderkey FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 9 OFFSET 1)""")
def run_report(spark, sf_dir):
    """F6 + G5 + G6 + G7: run counters, first and last value per group, head
    and slice."""
    li = read_table(spark, sf_dir, "lineitem").withColumn("at", F.col("l_linenumber").cast("long") * 100000000 + F.col("l_partkey"))
    counters = ag.run_counters(li, returned=F.col("l_returnflag") == "R", large=F.col("l_quantity") > 40)
    out = counters.select(F.explode(F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).cast("long").alias("n")) for c in ("rows", "returned", "large")])).alias("c")).select("c.*")
    both = ag.first_value(li, ["l_orderkey"], "l_partkey", "at", "a").join(ag.last_value(li, ["l_orderkey"], "l_partkey", "at", "b"), "l_orderkey")
    out = out.unionByName(both.select(F.concat(F.lit("order "), F.col("l_orderkey").cast("string")).alias("name"), (F.col("a").cast("long") * 1000000000 + F.col("b")).alias("n")))
    o = read_table(spark, sf_dir, "orders")
    order = [F.desc("o_totalprice"), F.col("o_orderkey")]
    for name, part in (("head", ag.head_n(o, order, 5)), ("slice", ag.slice_rows(o, order, 1, 9))):
        out = out.unionByName(part.select(F.lit(name).alias("name"), F.col("o_orderkey").cast("long").alias("n")))
    return out


@register("link_states", """
SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN 'No URL Provided' WHEN 1 THEN 'Loaded Successfully' WHEN 2 THEN 'Error 404' WHEN 3 THEN 'Failed to load. Error: timeout'
  ELSE 'Not captured' END AS status_text FROM orders""")
def link_states(spark, sf_dir):
    """J16 / U6 + S39: link status of every row by its URL; of several captures
    of a URL the last counts."""
    o = read_table(spark, sf_dir, "orders")
    k = F.col("o_orderkey") % 5
    url = F.when(k == 0, "").otherwise(F.concat(F.lit("https://x.org/"), F.col("o_orderkey").cast("string")))
    rows = o.select("o_orderkey", url.alias("url"))
    cap = o.where(k.between(1, 3)).select(F.col("o_orderkey").alias("page_id"), url.alias("url"), F.when(k == 2, 404).otherwise(200).alias("status"), F.when(k == 3, "timeout").alias("error"))
    old = cap.select((F.col("page_id") - 1_000_000_000).alias("page_id"), "url", F.lit(500).alias("status"), F.lit("old").alias("error"))
    return jobs.link_status(rows, cap.unionByName(old)).select("o_orderkey", "status_text")


@register("camp_lists", """
SELECT CAST(s_nationkey AS BIGINT) * 1000000000 + s_suppkey // 50 AS page_id, 'St' || (s_suppkey % 50) AS state, s_name AS organiser,
  CASE WHEN s_suppkey % 2 = 0 THEN '/c/' || s_suppkey ELSE '' END AS camp_info_url, CASE WHEN s_nationkey % 2 = 0 THEN 'Women' ELSE 'Men' END AS gender
FROM supplier WHERE s_suppkey % 5 > 0""")
def camp_lists(spark, sf_dir):
    """J6, seed: B1 + B4 + B23 over camp-list pages of 50 suppliers."""
    s = read_table(spark, sf_dir, "supplier")
    k = F.col("s_suppkey")
    name = F.when(k % 2 == 0, F.concat(F.lit("<a href='/c/"), k.cast("string"), F.lit("'>"), "s_name", F.lit(" Camp</a>"))).otherwise(F.col("s_name"))
    row = F.concat(F.lit("<tr><td>St"), (k % 50).cast("string"), F.lit("</td><td>"), name, F.lit("</td>"), F.when(k % 5 == 0, "<td>third</td>").otherwise(""), F.lit("</tr>"))
    x = s.withColumn("page_id", F.col("s_nationkey").cast("long") * 1_000_000_000 + F.floor(k / 50))
    body = _joined(x, "page_id", "s_suppkey", row, "rows").join(x.groupBy("page_id").agg(F.min("s_nationkey").alias("n")), "page_id")
    url = F.when(F.col("n") % 2 == 0, "https://l.org/womens-camps").otherwise("https://l.org/mens-camps")
    pages = body.select("page_id", url.alias("url"), F.concat(F.lit("<table><tr><th>State</th><th>Host</th></tr>"), "rows", F.lit("</table>")).alias("html"))
    return jobs.camp_list(pages).select("page_id", "state", "organiser", "camp_info_url", "gender")


@register("event_fields", """
SELECT p_partkey AS page_id, 'https://e.org/' || p_partkey AS url, CASE WHEN p_partkey % 3 > 0 THEN p_name ELSE '' END AS location,
  CASE WHEN p_partkey % 4 > 0 THEN '$' || p_size ELSE '' END AS price FROM part""")
def event_fields(spark, sf_dir):
    """B2 + B32 / J10: fields of event pages by selectors; misses keep a row."""
    p = read_table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    html = F.concat(F.lit("<main>"), F.when(k % 3 > 0, F.concat(F.lit("<div class='row event-row'> <a>"), "p_name", F.lit("</a></div><div class='event-row'>second</div>"))).otherwise(""),
                    F.when(k % 4 > 0, F.concat(F.lit("<p class='price'>$"), F.col("p_size").cast("string"), F.lit("</p>"))).otherwise("<p>free</p>"), F.lit("</main>"))
    pages = p.select(k.alias("page_id"), F.concat(F.lit("https://e.org/"), k.cast("string")).alias("url"), html.alias("html"))
    return jobs.showcase_pages(pages, {"location": ("div", "event-row"), "price": ("p", "price")})


@register("coach_links", """
SELECT s_suppkey AS change_id, CASE s_suppkey % 3 WHEN 0 THEN 'https://u' || s_nationkey || '.edu/m/roster/coaches/first-s' || s_suppkey || '/9'
  WHEN 1 THEN 'https://u' || s_nationkey || '.edu/staff-directory/s' || s_suppkey ELSE 'https://u' || s_nationkey || '.edu/people/first-s' || s_suppkey END AS profile_url
FROM supplier WHERE s_suppkey % 10 < 9""")
def coach_links(spark, sf_dir):
    """B29 + B30 + S35: the profile link of each new coach on listing pages."""
    s = read_table(spark, sf_dir, "supplier")
    k, kind = F.col("s_suppkey"), F.col("s_suppkey") % 3
    id_ = k.cast("string")
    link = (F.when(kind == 0, F.concat(F.lit("<a href='/m/roster/coaches/first-s"), id_, F.lit("/9'>photo</a>")))
            .when(kind == 1, F.concat(F.lit("<a href='/staff-directory/s"), id_, F.lit("'>First  S"), id_, F.lit("</a>")))
            .otherwise(F.concat(F.lit("<a href='/people/first-s"), id_, F.lit("'>x</a>"))))
    x = s.withColumn("page_id", F.col("s_nationkey").cast("long") * 1_000_000_000 + F.floor(k / 50)).where(k % 10 < 9)
    body = _joined(x, "page_id", "s_suppkey", link, "links").join(x.groupBy("page_id").agg(F.min("s_nationkey").alias("n")), "page_id")
    pages = body.select("page_id", F.concat(F.lit("https://u"), F.col("n").cast("string"), F.lit(".edu/list")).alias("url"), F.col("links").alias("html"))
    changes = s.withColumn("page_id", F.col("s_nationkey").cast("long") * 1_000_000_000 + F.floor(k / 50)).select(
        k.alias("change_id"), "page_id", _pick(["roster", "staff", "general"], kind).alias("mode"), F.concat(F.lit(" First S"), id_).alias("name"))
    return ex.coach_profile_links(changes, hx.html_nodes(pages, text_tags={"a"}, tags={"a"}), pages)


# ------------------------------------------------------------------ whole jobs against a master table

def _master(spark, sf_dir) -> DataFrame:
    """Suppliers as the master table."""
    s = read_table(spark, sf_dir, "supplier")
    return s.select(F.col("s_suppkey").alias("row_id"), F.concat(F.lit(" "), "s_name", F.lit(" ")).alias("university_name"), F.lit("").alias("men_conference"),
                    _pick(["D1", "D2", ""], F.col("s_suppkey") % 3).alias("men_ncaa_division"), F.lit("old").alias("men_coach_name"),
                    F.lit(None).cast("string").alias("men_coach_email"), F.lit(None).cast("string").alias("men_coach_url"))


@register("standings_job", """
WITH s AS (SELECT *, row_number() OVER (PARTITION BY s_nationkey, s_suppkey // 50 ORDER BY s_suppkey) AS nth FROM supplier)
SELECT s_suppkey AS row_id, 'men_conference_record' AS column, (s_suppkey % 7) || '-' || (s_suppkey % 5) AS value FROM s
UNION ALL SELECT s_suppkey, 'men_overall_record', (s_suppkey % 11) || '-' || (s_suppkey % 3) FROM s
UNION ALL SELECT s_suppkey, 'men_conference_standing', CAST(nth AS VARCHAR) FROM s""")
def standings_job(spark, sf_dir):
    """A1 + A2 + B4-B9 + C5-C8 + C15-C17 + G1 + G2 + E3 + E8 + U3 + T3 + T4: one
    resumable run over all sites; the first call fails on some cells, the
    second finishes, the third has nothing to do."""
    from tessera.operators import saved_maps as sm
    from tessera.plans.table_catalog import _site_pages
    from tessera.streaming import runs
    from tessera.streaming.tables import Tables
    pages, sites, maps = _site_pages(spark, sf_dir)
    pages, sites = sinks.cut_lineage(pages), sinks.cut_lineage(sites)
    tables = Tables(spark, _folder(spark, "standings"))
    sm.save(tables, maps, ["site"])
    fails = lambda w: w.withColumn("failed", (F.col("row_id") % 7 == 0) & (F.col("column") == "men_overall_record"))
    for attempt in (fails, None, None):
        jobs.standings_run(tables, pages, sites, _master(spark, sf_dir), "men", attempt=attempt, keys=("site",))
    return runs.cells(tables, "standings").select("row_id", "column", "value")


@register("rankings_job", """
WITH m AS (SELECT p_name AS name, min(p_partkey) AS row_id FROM part GROUP BY p_name)
SELECT name AS left_key, row_id AS chosen_row_id, 'auto' AS how FROM m WHERE row_id % 3 <> 0""")
def rankings_job(spark, sf_dir):
    """B11-B14 + A1 + A2 + C11 + E3 + E8: ranking pages matched to masters of
    a compatible division; what is accepted."""
    from tessera.plans.page_catalog import ranking_pages
    p = read_table(spark, sf_dir, "part").groupBy("p_name").agg(F.min("p_partkey").alias("row_id"))
    master = p.select("row_id", F.col("p_name").alias("university_name"), _pick(["D1", "d2", ""], F.col("row_id") % 3).alias("men_ncaa_division"))
    out = jobs.rankings(ranking_pages(spark, sf_dir), master, "men", "D2", k=3)
    return out["accepted"].select(F.trim("left_key").alias("left_key"), "chosen_row_id", "how")


@register("coach_change_job", """
SELECT s_suppkey AS row_id, CASE WHEN s_suppkey % 4 = 1 THEN 'First' || s_suppkey || ' Last' ELSE 'old' END AS men_coach_name,
  CASE WHEN s_suppkey % 4 < 2 THEN 'c' || s_suppkey || '@x.edu' END AS men_coach_email FROM supplier""")
def coach_change_job(spark, sf_dir):
    """C1 + C2 + E4 + S36 + S37 + U1: change rows by school name or alias
    become cells of the master."""
    s = read_table(spark, sf_dir, "supplier")
    k = F.col("s_suppkey")
    id_ = k.cast("string")
    school = F.when(k % 3 == 0, F.concat(F.lit("Alias "), id_)).otherwise(F.concat(F.lit(" "), "s_name", F.lit(" ")))
    logs = s.select(F.lit("men_DI.csv").alias("file_name"), k.cast("int").alias("pos"), F.lit("").alias("conference"), school.alias("school"),
                    F.when(k % 4 == 3, "Assistant").otherwise("Head Coach").alias("position"), F.concat(F.lit("First"), id_).alias("first_name"), F.lit("Last").alias("last_name"),
                    _pick(["e", "J X", "#", "j"], k % 4).alias("change"), F.concat(F.lit("c"), id_, F.lit("@x.edu")).alias("email_address"), F.lit("men").alias("gender"))
    aliases = s.select(F.concat(F.lit("Alias "), id_).alias("alias"), F.concat(F.lit(" "), "s_name", F.lit(" ")).alias("canonical"))
    return jobs.coach_changes(logs, aliases, _master(spark, sf_dir), "men")["master"].select("row_id", "men_coach_name", "men_coach_email")


@register("academic_job", """
SELECT s_suppkey AS row_id, CASE WHEN s_suppkey % 5 > 0 THEN CAST(1000 + s_suppkey AS INTEGER) ELSE 7 END AS undergraduates,
  CASE WHEN s_suppkey % 5 > 0 THEN CAST(20000 + s_suppkey AS INTEGER) END AS in_state_tuition, CASE WHEN s_suppkey % 5 > 0 AND s_suppkey % 2 = 0 THEN 'Duplicate' ELSE '' END AS duplicate
FROM supplier""")
def academic_job(spark, sf_dir):
    """B3 + B20 + S6 + S7 + E7 + U2 + F4: facts pages joined to the master on
    the canonical URL, the last page of a URL counts."""
    s = read_table(spark, sf_dir, "supplier")
    k = F.col("s_suppkey")
    html = lambda n: F.concat(F.lit("<div class='ug'>"), F.format_number(n + k, 0), F.lit(" students</div><div><div class='t'>Tuition</div><div class='v'>$"),
                              F.format_number(19000 + n + k, 0), F.lit("</div></div>"))
    url = F.concat(F.lit("https://www.facts.org/u/"), k.cast("string"))
    pages = s.where(k % 5 > 0).select((k * 2 + 1).alias("page_id"), F.concat(url, F.lit("/")).alias("url"), html(1000).alias("html"))
    pages = pages.unionByName(s.where((k % 5 > 0) & (k % 2 == 0)).select((k * 2).alias("page_id"), url.alias("url"), html(5).alias("html")))
    null = F.lit(None).cast("int")
    master = s.select(k.alias("row_id"), F.concat(F.lit("facts.org/u/"), k.cast("string")).alias("academic_info_url"), F.lit(7).alias("undergraduates"),
                      null.alias("in_state_tuition"), null.alias("out_of_state_tuition"), F.lit(None).cast("double").alias("avg_admission_gpa"))
    out = jobs.academic_facts(pages, master, "v", "t", "ug", "facts.org")["master"]
    return out.select("row_id", "undergraduates", "in_state_tuition", "duplicate")


@register("branded_camp_job", """
SELECT c_custkey AS page_id, 'Boys Camp ' || c_custkey AS camp_name, CASE c_custkey % 3 WHEN 0 THEN 'Elementary School' WHEN 1 THEN 'Middle School' ELSE 'High School' END AS grade_level,
  CASE WHEN c_custkey % 4 > 0 THEN CAST(c_custkey AS DOUBLE) END AS latitude FROM customer""")
def branded_camp_job(spark, sf_dir):
    """B21 + S21 + S22 + S26 + E14: camp pages, geocoded by title and place."""
    c = read_table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    html = F.concat(F.lit("<h1>Boys Camp "), k.cast("string"), F.lit("</h1><div class='x location'>Austin, TX</div><p>Ages: "), _pick(["9", "13", "16"], k % 3), F.lit("+</p>"))
    pages = c.select(k.alias("page_id"), F.lit("u").alias("url"), html.alias("html"))
    gz = c.where(k % 4 > 0).select(F.concat(F.lit("boys camp "), k.cast("string"), F.lit(", austin, tx")).alias("address_norm"), k.cast("double").alias("lat"),
                                   F.lit(1.0).alias("lng"), F.lit("Austin").alias("city"))
    return jobs.branded_camps(pages, gz).select("page_id", "camp_name", "grade_level", "latitude")


@register("yearless_job", """
SELECT s_suppkey AS row_id, 'men_roster_url' AS column, 'https://t' || s_suppkey || '.edu/msoc/roster' AS value FROM supplier WHERE s_suppkey % 3 = 0 AND s_suppkey % 4 > 0
UNION ALL SELECT s_suppkey, 'men_goalkeepers', CAST(s_suppkey % 2 + 1 AS VARCHAR) FROM supplier WHERE s_suppkey % 3 = 0 AND s_suppkey % 4 > 0""")
def yearless_job(spark, sf_dir):
    """C9 + C10 + S13 + A9 + B16-B19 + F1: rosters that no longer exist are
    looked up without their year."""
    s = read_table(spark, sf_dir, "supplier")
    k = F.col("s_suppkey")
    base = F.concat(F.lit("https://t"), k.cast("string"), F.lit(".edu/msoc/"))
    master = s.select(k.alias("row_id"), F.when(k % 3 == 0, "Page No Longer Exists").otherwise("12").alias("men_freshman"), F.lit("").alias("women_freshman"),
                      F.concat(base, F.lit("2023-24/roster")).alias("men_roster_url"), F.lit("").alias("women_roster_url"))
    card = "<li class='sidearm-roster-player'><span class='sidearm-roster-player-position'>GK</span><span class='sidearm-roster-player-academic-year'>Fr.</span></li>"
    html = F.concat(F.lit("<meta name='generator' content='Sidearm'><ul>" + card), F.when(k % 2 == 1, card).otherwise(""), F.lit("</ul>"))
    caps = s.where(k % 4 > 0).select(k.alias("page_id"), F.concat(base, F.lit("roster")).alias("url"), F.lit(200).alias("status"), html.alias("html"))
    out = jobs.yearless_roster(master, caps)["writes"]
    return out.where(F.col("column").isin("men_roster_url", "men_goalkeepers")).select("row_id", "column", "value")


@register("scholarship_import_job", """
WITH a AS (SELECT event_id, user_id, event_id % 2 AS batch FROM events WHERE event_id % 5 > 0)
SELECT 'Award ' || user_id AS title, '2024-0' || (user_id % 9 + 1) AS closing_date, 'https://aid.org/' || user_id AS link, CAST(min(batch) AS BIGINT) AS imported
FROM a GROUP BY user_id""")
def scholarship_import_job(spark, sf_dir):
    """M2 + M5 + M8 + E10 + T1 + U9: answers of two batches, one of them twice;
    an item of a message is imported once."""
    from tessera.streaming.tables import Tables
    e = read_table(spark, sf_dir, "events")
    u = F.col("user_id").cast("string")
    item = F.to_json(F.array(F.struct(F.concat(F.lit("Award "), u).alias("title"), F.lit("").alias("closing_date"),
                                      F.concat(F.lit("2024-0"), (F.col("user_id") % 9 + 1).cast("string")).alias("deadline"), F.concat(F.lit("<aid.org/"), u, F.lit(">")).alias("link"))))
    content = F.when(F.col("event_id") % 5 == 0, "no items").otherwise(F.concat(F.lit("```JSON\n"), item, F.lit("\n```")))
    env = F.to_json(F.struct(F.array(F.struct(F.struct(content.alias("content")).alias("message"))).alias("choices")))
    answers = e.select(F.concat(F.lit("m"), u).alias("msg_id"), (F.col("event_id") % 2).alias("batch"), env.alias("response"))
    tables = Tables(spark, _folder(spark, "import"))
    for n in (0, 0, 1):
        jobs.scholarships_import(tables, answers.where(F.col("batch") == n).select("msg_id", "response"), batch_id=n)
    return tables.read("scholarships").select("title", "closing_date", "link", "imported")


@register("camp_directory_job", """
SELECT s_name AS camp_school_name, 'https://d.org/c/' || s_suppkey AS camp_url, s_suppkey AS match_row_id, 1.0 AS similarity_score FROM supplier WHERE s_suppkey % 5 > 0""")
def camp_directory_job(spark, sf_dir):
    """B1 + B4 + B22 + B31 + E1: directory tables of 50 suppliers, each camp
    matched to its best master school."""
    s = read_table(spark, sf_dir, "supplier")
    k = F.col("s_suppkey")
    row = F.concat(F.lit("<tr><td>x</td><td>"), F.when(k % 5 > 0, F.concat(F.lit("<a href='/c/"), k.cast("string"), F.lit("'>"), "s_name", F.lit(" Camp</a>"))).otherwise(F.col("s_name")),
                   F.lit("</td></tr>"))
    x = s.withColumn("page_id", F.col("s_nationkey").cast("long") * 1_000_000_000 + F.floor(k / 50))
    pages = _joined(x, "page_id", "s_suppkey", row, "rows").select("page_id", F.lit("https://d.org/list").alias("url"), F.concat(F.lit("<table>"), "rows", F.lit("</table>")).alias("html"))
    master = s.select(k.alias("row_id"), F.col("s_name").alias("university_name"))
    return jobs.camp_directory(pages, master)["camps"].select("camp_school_name", "camp_url", "match_row_id", "similarity_score")


@register("camp_enrichment_job", """
WITH s AS (SELECT s_suppkey, s_suppkey % 4 AS k, unnest(CASE WHEN s_suppkey % 2 = 0 THEN [0, 1] ELSE [0] END) AS sub FROM supplier)
SELECT s_suppkey AS camp_id, CASE k WHEN 2 THEN 'HTTP 404' WHEN 3 THEN 'Not captured' ELSE 'OK' END AS page_load, CASE WHEN k < 2 THEN 'Camp ' || sub END AS event_details,
  CASE WHEN k < 2 THEN CAST(s_suppkey AS DOUBLE) END AS lat FROM s WHERE k < 2 OR sub = 0""")
def camp_enrichment_job(spark, sf_dir):
    """U8: S39 + C19 + E13 + M3 + M6: camp rows by page status, place and model
    answer; further camps of an answer are copies; rows without a page apart."""
    import json
    s = read_table(spark, sf_dir, "supplier")
    k = F.col("s_suppkey")
    url = F.concat(F.lit("https://c.org/"), k.cast("string"))
    blank = {c: F.lit("") for c in ("camp_found", "event_details", "start_date", "end_date", "ages_grade_level", "cost")}
    camps = s.select(k.alias("camp_id"), F.concat(F.lit("Org  "), k.cast("string")).alias("organiser"), url.alias("camp_info_url")).withColumns(blank)
    caps = s.where(k % 4 < 3).select(k.alias("page_id"), url.alias("url"), F.when(k % 4 == 2, 404).otherwise(200).alias("status"), F.lit(None).cast("string").alias("error"))
    gz = s.select(F.concat(F.lit("org "), k.cast("string")).alias("address_norm"), k.cast("double").alias("lat"), F.lit(0.0).alias("lng"), F.lit("c").alias("city"))
    two, one = (json.dumps({"choices": [{"message": {"content": json.dumps([{"event_name": f"Camp {i}"} for i in range(n)])}}]}) for n in (2, 1))
    answers = s.select(k.alias("camp_id"), F.when(k % 2 == 0, two).otherwise(one).alias("response"))
    out = jobs.camp_enrichment(camps, caps, gz, answers)
    found = out["camps"].select("camp_id", "page_load", "event_details", "lat")
    return found.unionByName(out["errors"].select("camp_id", "page_load", F.lit(None).cast("string").alias("event_details"), F.lit(None).cast("double").alias("lat")))


@register("geocode_job", """
SELECT c_custkey AS row_id, c_nationkey % 3 = 0 AS found, CASE WHEN c_nationkey % 3 = 0 THEN 'City ' || c_nationkey END AS city FROM customer""")
def geocode_job(spark, sf_dir):
    """A6 + E13 + E14: a table with an address column, geocoded once per
    distinct address."""
    c = read_table(spark, sf_dir, "customer")
    n = read_table(spark, sf_dir, "nation").where("n_nationkey % 3 = 0")
    gz = n.select(F.concat(F.lit("1 main st, "), F.col("n_nationkey").cast("string")).alias("address_norm"), F.lit(1.0).alias("lat"), F.lit(2.0).alias("lng"),
                  F.concat(F.lit("City "), F.col("n_nationkey").cast("string")).alias("city"))
    rows = c.select(F.col("c_custkey").alias("row_id"), F.concat(F.lit("1  Main St, "), F.col("c_nationkey").cast("string")).alias("address"))
    out = jobs.geocode_file(rows, gz)
    return out.select("row_id", F.col("latitude").isNotNull().alias("found"), "city")
