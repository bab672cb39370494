"""Queries over the driver's test tables, one per operator group, each with an
SQL oracle where SQL can express it (SURVEY 7.4).

Every query reads whole tables.  Where the test tables lack a shape the
operator needs (a camp page, a change log, a model answer), a small
``*_input`` builder maps rows of a test table onto that shape; the builder
only renames and formats columns, and all of the operator's work runs in the
library code it then calls.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tessera.functions.common import at

from tessera.functions import text as tx
from tessera.functions import urls as ul
from tessera.operators import html as hx
from tessera.session import read_table

QUERIES: dict = {}
ORACLE: dict = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


# ------------------------------------------------------------------ SQL bits
# (the oracle side only; kept as text so each oracle reads as one statement)

SQL_WS = tx.WS
SQL_CLEAN_HTML = ("regexp_replace(html, '(?s)<script.*?</script>|<style.*?</style>|<!--.*?-->', '', 'g')")


def sql_strip(x: str) -> str:
    return f"regexp_replace({x}, '^{SQL_WS}+|{SQL_WS}+$', '', 'g')"


def sql_decode(x: str) -> str:
    # the entities that occur in the test pages; &amp; last
    for ent, ch in (("&quot;", '"'), ("&#39;", "''"), ("&copy;", "©"), ("&middot;", "·"),
                    ("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&amp;", "&")):
        x = f"replace({x}, '{ent}', '{ch}')"
    return x


def sql_strip_tags(x: str) -> str:
    return f"regexp_replace({x}, '<[^>]*>', '', 'g')"


def _pages(spark, sf_dir) -> DataFrame:
    return read_table(spark, sf_dir, "pages")


# ------------------------------------------------------------------ pages

@register("page_url_canonical", f"""
SELECT page_id, url,
  regexp_replace(regexp_replace(regexp_replace(lower(regexp_replace({sql_strip("coalesce(url, '')")},
    '^https?://', '')), '^waf\\.', ''), '^www\\.', ''), '/$', '') AS canonical_url
FROM pages""")
def page_url_canonical(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S6 canonical URL of every captured page."""
    return _pages(spark, sf_dir).select("page_id", "url", ul.canonical_url("url").alias("canonical_url"))


@register("page_duplicate_urls", f"""
WITH c AS (
  SELECT page_id,
    regexp_replace(regexp_replace(regexp_replace(lower(regexp_replace({sql_strip("coalesce(url, '')")},
      '^https?://', '')), '^waf\\.', ''), '^www\\.', ''), '/$', '') AS canonical_url
  FROM pages)
SELECT page_id, canonical_url, count(*) OVER (PARTITION BY canonical_url) AS dup_count,
  CASE WHEN count(*) OVER (PARTITION BY canonical_url) > 1 THEN 'Duplicate' ELSE '' END AS duplicate
FROM c""")
def page_duplicate_urls(spark, sf_dir):
    """S6 + F4: rows per canonical URL and the duplicate flag."""
    from tessera.operators.aggregate import duplicate_count
    df = _pages(spark, sf_dir).select("page_id", ul.canonical_url("url").alias("canonical_url"))
    return duplicate_count(df, ["canonical_url"]).select("page_id", "canonical_url", "dup_count", "duplicate")


_P_BLOCK = ("address|article|aside|blockquote|details|dialog|div|dl|fieldset|figcaption|figure|footer|form|"
            "h[1-6]|header|hgroup|hr|main|menu|nav|ol|pre|section|table|ul")
_P_CONTAINER_END = "article|aside|blockquote|body|div|footer|form|header|html|li|main|nav|section|td|th|dd|dt"


@register("page_paragraphs", f"""
WITH c AS (SELECT page_id, {SQL_CLEAN_HTML} AS h FROM pages),
s AS (SELECT page_id, string_split(regexp_replace(h, '<p([\\s>])', chr(1) || '<p\\1', 'g'), chr(1)) AS parts FROM c),
u AS (SELECT page_id, unnest(parts[2:]) AS piece, generate_subscripts(parts[2:], 1) - 1 AS p_idx FROM s),
m AS (SELECT page_id, p_idx,
        regexp_extract(piece, '(?s)^(<p.*?)(</p>|<(?:{_P_BLOCK})[\\s/>]|</(?:{_P_CONTAINER_END})>|$)',
                       ['body', 'term']) AS x FROM u)
SELECT page_id, CAST(p_idx AS INTEGER) AS p_idx,
  x.body || CASE WHEN x.term = '</p>' THEN '</p>' ELSE '' END AS outer_html,
  {sql_decode(sql_strip_tags("x.body"))} AS text
FROM m""")
def page_paragraphs(spark, sf_dir):
    """B1 + B2 + B25: every ``<p>`` of every page with its source and text."""
    nodes = hx.html_nodes(_pages(spark, sf_dir), text_tags={"p"}, outer_tags={"p"}, tags={"p"})
    return hx.paragraphs(nodes).select("page_id", "p_idx", "outer_html", "text")


@register("page_links", f"""
WITH c AS (SELECT page_id, url, {SQL_CLEAN_HTML} AS h FROM pages),
l AS (SELECT page_id, url,
        regexp_extract_all(h, '<a\\s[^>]*?href="([^"]*)"[^>]*>(?s:(.*?))</a>', 1) AS hrefs,
        regexp_extract_all(h, '<a\\s[^>]*?href="([^"]*)"[^>]*>(?s:(.*?))</a>', 2) AS texts FROM c),
u AS (SELECT page_id, url, unnest(hrefs) AS href, unnest(texts) AS t,
        generate_subscripts(hrefs, 1) - 1 AS a_idx FROM l)
SELECT page_id, CAST(a_idx AS INTEGER) AS a_idx, {sql_decode("href")} AS href,
  CASE WHEN {sql_decode("href")} LIKE '/%' AND {sql_decode("href")} NOT LIKE '//%'
       THEN regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)', 1) || {sql_decode("href")}
       ELSE {sql_decode("href")} END AS abs_url,
  {sql_decode(sql_strip_tags("t"))} AS text
FROM u""")
def page_links(spark, sf_dir):
    """B1 + B2 + B31: every link with its absolute URL and text."""
    nodes = hx.html_nodes(_pages(spark, sf_dir), text_tags={"a"}, tags={"a"}, carry=["url"])
    a = hx.select_nodes(nodes, tag="a", attr="href")
    return a.select("page_id", F.col("tag_idx").alias("a_idx"), F.col("attrs")["href"].alias("href"),
                    ul.url_join(F.col("url"), F.col("attrs")["href"]).alias("abs_url"), "text")


@register("page_title_h1", f"""
WITH c AS (SELECT page_id, {SQL_CLEAN_HTML} AS h FROM pages)
SELECT page_id,
  CASE WHEN regexp_matches(h, '<h1[\\s>]')
       THEN {sql_strip(sql_decode(sql_strip_tags("regexp_extract(h, '(?s)<h1[^>]*>(.*?)</h1>', 1)")))}
       ELSE 'Unknown Camp Name' END AS camp_name,
  {sql_strip(sql_decode(sql_strip_tags("regexp_extract(h, '(?s)<title[^>]*>(.*?)</title>', 1)")))} AS title
FROM c""")
def page_title_h1(spark, sf_dir):
    """B21 (title part): first ``h1`` text trimmed, else 'Unknown Camp Name'."""
    from tessera.operators.extract import first_texts
    pages = _pages(spark, sf_dir)
    nodes = hx.html_nodes(pages, text_tags={"h1", "title"}, tags={"h1", "title"})
    return (pages.select("page_id").join(first_texts(nodes, {"h1": "camp_name", "title": "title"}), "page_id", "left")
            .select("page_id", F.coalesce("camp_name", F.lit("Unknown Camp Name")).alias("camp_name"),
                    F.coalesce("title", F.lit("")).alias("title")))


@register("page_text", """
SELECT page_id,
  regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(
  regexp_replace(regexp_replace(regexp_replace(regexp_replace(coalesce(html, ''),
    '(?i)<br\\s*/?>', chr(10), 'g'), '(?i)</(p|div|li|h\\d)>', chr(10), 'g'), '(?i)<li>', '• ', 'g'),
    '&nbsp;', ' ', 'g'), '&amp;', '&', 'g'), '&lt;', '<', 'g'), '&gt;', '>', 'g'), '<[^>]+>', '', 'g'),
    '\\n{3,}', chr(10) || chr(10), 'g'), '^\\s+|\\s+$', '', 'g') AS body
FROM pages""")
def page_text(spark, sf_dir):
    """Mail-style HTML to text over every page."""
    return _pages(spark, sf_dir).select("page_id", hx.html_to_text(F.col("html")).alias("body"))


# ------------------------------------------------------------------ more SQL bits

def sql_map(d: dict) -> str:
    items = ", ".join(f"'{k}': '{v}'" for k, v in d.items())
    return "MAP {" + items + "}"


def sql_list(xs) -> str:
    return "[" + ", ".join("'" + x.replace("'", "''") + "'" for x in xs) + "]"


def sql_normalize_title(x: str) -> str:
    return (f"regexp_replace(regexp_replace(lower({sql_strip(f'coalesce({x}, {chr(39)}{chr(39)})')}), "
            f"'{SQL_WS}+', ' ', 'g'), '^[0-9]+\\.\\s*', '')")


def sql_clean_text(x: str) -> str:
    return sql_strip(f"regexp_replace({x}, '{SQL_WS}+', ' ', 'g')")


def sql_clean_url(x: str) -> str:
    s = sql_strip(f"coalesce({x}, '')")
    s = f"regexp_replace({s}, '(?i)\\s*[-–—]?\\s*open in new window.*$', '')"
    s = f"regexp_replace({s}, '^<|>$', '', 'g')"
    s = (f"CASE WHEN NOT regexp_matches({s}, '(?i)^https?://') AND regexp_matches({s}, "
         f"'(?i)\\b[a-z0-9-]+\\.[a-z]{{2,}}\\b') THEN 'https://' || {s} ELSE {s} END")
    punct = ul.TRAILING_PUNCT.replace("'", "''")
    return f"regexp_replace({s}, '{punct}', '')"


# ------------------------------------------------------------------ page text forms

@register("paragraph_chunks", f"""
WITH c AS (SELECT page_id, {SQL_CLEAN_HTML} AS h FROM pages),
s AS (SELECT page_id, string_split(regexp_replace(h, '<p([\\s>])', chr(1) || '<p\\1', 'g'), chr(1)) AS parts FROM c),
u AS (SELECT page_id, unnest(parts[2:]) AS piece, generate_subscripts(parts[2:], 1) - 1 AS p_idx FROM s),
m AS (SELECT page_id, p_idx,
        regexp_extract(piece, '(?s)^(<p.*?)(</p>|<(?:{_P_BLOCK})[\\s/>]|</(?:{_P_CONTAINER_END})>|$)',
                       ['body', 'term']) AS x FROM u),
p AS (SELECT page_id, p_idx, x.body || CASE WHEN x.term = '</p>' THEN '</p>' ELSE '' END AS outer_html FROM m)
SELECT page_id, CAST(p_idx // 3 AS INTEGER) AS chunk_idx,
  string_agg(outer_html, chr(10) ORDER BY p_idx) AS chunk, count(*) AS n_items
FROM p GROUP BY page_id, p_idx // 3""")
def paragraph_chunks(spark, sf_dir):
    """B25 + B26: each page's paragraphs in groups of three (one model request each)."""
    nodes = hx.html_nodes(_pages(spark, sf_dir), text_tags=set(), outer_tags={"p"}, tags={"p"})
    return hx.chunk_rows(hx.paragraphs(nodes), "page_id", "p_idx", "outer_html", 3, index="p_idx")


_URL_RX = "^(?:([A-Za-z][A-Za-z0-9+.-]*):)?(?://([^/?#]*))?([^?#]*)(?:\\?([^#]*))?(?:#(.*))?$"


@register("url_remove_segment", f"""
WITH p AS (SELECT page_id, url, regexp_extract(coalesce(url, ''), '{_URL_RX}',
             ['scheme', 'netloc', 'path', 'query', 'fragment']) AS u FROM pages)
SELECT page_id, url,
  CASE WHEN url IS NULL OR url = '' THEN url ELSE
    (CASE WHEN u.scheme = '' THEN 'https' ELSE u.scheme END) || '://' || u.netloc || '/' ||
    array_to_string(list_filter(string_split(u.path, '/'),
                    lambda s: s <> '' AND NOT regexp_full_match(s, '[0-9]{{4}}(-[0-9]{{2}})?')), '/') ||
    (CASE WHEN u.query <> '' THEN '?' || u.query ELSE '' END) ||
    (CASE WHEN u.fragment <> '' THEN '#' || u.fragment ELSE '' END) END AS yearless_url,
  regexp_matches(u.path, '/[0-9]{{4}}(-[0-9]{{2}})?(/|$)') AS has_year
FROM p""")
def url_remove_segment(spark, sf_dir):
    """S13 + C10: every page URL without year path segments, and the year test."""
    return _pages(spark, sf_dir).select("page_id", "url", ul.remove_year_segment("url").alias("yearless_url"),
                                        ul.has_year_token("url").alias("has_year"))


@register("url_rewrite_host", f"""
WITH p AS (SELECT page_id, url, {sql_strip("coalesce(url, '')")} AS s FROM pages),
q AS (SELECT page_id, url, s, lower(s) AS low,
        regexp_extract(s, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1) AS sh,
        regexp_extract(s, '^([^/?#]*)', 1) AS ph FROM p),
r AS (SELECT *, CASE WHEN sh <> '' THEN sh ELSE ph END AS host,
        CASE WHEN sh <> '' THEN regexp_replace(s, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*', '')
             ELSE regexp_replace(s, '^[^/?#]*', '') END AS after FROM q)
SELECT page_id, url,
  CASE WHEN starts_with(low, 'https://waf.') OR starts_with(low, 'http://waf.') OR starts_with(low, 'waf.') THEN s
       WHEN starts_with(low, 'example.com') THEN 'https://waf.' || s
       WHEN host <> '' AND ends_with(lower(host), 'example.com') THEN
         'https://' || (CASE WHEN starts_with(lower(host), 'waf.') THEN host
                             ELSE 'waf.' || regexp_replace(host, '(?i)^www\\.', '') END) || after
       ELSE s END AS rewritten
FROM r""")
def url_rewrite_host(spark, sf_dir):
    """Force ``https://waf.`` on hosts under example.com (the facts-site rule)."""
    return _pages(spark, sf_dir).select("page_id", "url", ul.rewrite_host("url", "example.com").alias("rewritten"))


# ------------------------------------------------------------------ documents

def _relevant_sql(l: str) -> str:
    conds = [f"regexp_matches(lower({l}), '[0-9]')"] + [
        f"contains(lower({l}), '{w}')" for w in ("camp", "date", "session", "ages", "$", "–", "to", "through")]
    return "(" + " OR ".join(conds) + ")"


@register("relevant_lines", f"""
WITH d AS (SELECT doc_id, list_filter(list_transform(string_split(coalesce(text, ''), chr(10)),
                  lambda l: {sql_strip("l")}), lambda l: l <> '' AND {_relevant_sql("l")}) AS keep FROM documents),
j AS (SELECT doc_id, len(keep) AS n, coalesce(array_to_string(keep, chr(10)), '') AS s FROM d),
c AS (SELECT *, unnest(range(0, greatest(CAST(ceil(length(s) / 5000.0) AS BIGINT), 1))) AS i FROM j)
SELECT doc_id, CAST(i AS INTEGER) AS chunk_idx, substring(s, CAST(i * 5000 + 1 AS BIGINT), 5000) AS snippet, CAST(n AS INTEGER) AS n_relevant
FROM c""")
def relevant_lines(spark, sf_dir):
    """B24 + S42: relevant lines of every whole document in pieces of at most
    5,000 characters (none is lost), and how many lines qualified."""
    from tessera.operators.extract import relevant_lines_text
    d = read_table(spark, sf_dir, "documents").select("doc_id", relevant_lines_text(F.col("text")).alias("keep"))
    return d.select("doc_id", F.size("keep").alias("n_relevant"),
                    F.posexplode(tx.text_chunks(F.array_join("keep", "\n"), 5000)).alias("chunk_idx", "snippet"))


@register("title_normalize", f"""
SELECT doc_id, {sql_clean_text("coalesce(text, '')")} AS clean, {sql_normalize_title("text")} AS title_norm
FROM documents""")
def title_normalize(spark, sf_dir):
    """S1 + S9 over every whole document."""
    d = read_table(spark, sf_dir, "documents")
    return d.select("doc_id", tx.clean_text(F.coalesce("text", F.lit(""))).alias("clean"),
                    tx.normalize_title("text").alias("title_norm"))


_RECORD = f"[0-9]+{SQL_WS}*[-–]{SQL_WS}*[0-9]+"


@register("record_parse", f"""
WITH m AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{_RECORD}') AS rs FROM documents),
u AS (SELECT doc_id, unnest(rs) AS record, generate_subscripts(rs, 1) - 1 AS m_idx FROM m)
SELECT doc_id, CAST(m_idx AS INTEGER) AS m_idx, record,
  CAST(regexp_extract(record, '^([0-9]+)', 1) AS INTEGER) AS w,
  CAST(regexp_extract(record, '([0-9]+)$', 1) AS INTEGER) AS l
FROM u""")
def record_parse(spark, sf_dir):
    """Every ``W-L`` record in every document, split into numbers."""
    d = read_table(spark, sf_dir, "documents")
    x = d.select("doc_id", F.posexplode_outer(F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(_RECORD), 0))
                 .alias("m_idx", "record")).filter(F.col("record").isNotNull())
    from tessera.functions.facts import record_struct
    return x.select("doc_id", "m_idx", "record", record_struct("record").alias("r")).select(
        "doc_id", "m_idx", "record", F.col("r.w").alias("w"), F.col("r.l").alias("l"))


# ------------------------------------------------------------------ events: JSON, answers, status

@register("props_json", """
SELECT event_id, event_type, TRY_CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events""")
def props_json(spark, sf_dir):
    """B15 access path: parse embedded JSON (variant) and read a field."""
    e = read_table(spark, sf_dir, "events")
    return e.select("event_id", "event_type", F.try_variant_get(F.try_parse_json("props"), "$.k", "int").alias("k"))


def answers_input(spark, sf_dir):
    """Camp rows and stored model answers in the shapes M6 reads, one per
    event: the answer's array has ``k % 4`` objects made from the event;
    error events carry a single-quoted (invalid) array, signup events with
    ``k % 5 = 0`` an envelope without ``choices``; view events are fenced."""
    e = read_table(spark, sf_dir, "events").withColumn(
        "k", F.try_variant_get(F.try_parse_json("props"), "$.k", "int"))
    base = e.select(F.col("event_id").alias("camp_id"),
                    F.concat(F.lit("https://camps.example.org/e/"), F.col("event_id").cast("string")).alias("camp_info_url"),
                    F.lit("").alias("camp_found"),
                    F.concat(F.lit("Event "), F.col("event_id").cast("string")).alias("event_details"),
                    F.lit("").alias("start_date"), F.lit("").alias("end_date"),
                    F.lit("").alias("ages_grade_level"), F.lit("").alias("cost"))
    n = F.col("k") % 4
    items = F.transform(F.filter(F.sequence(F.lit(0), n), lambda i: i > 0), lambda i: F.struct(
        F.concat(F.col("event_type"), F.lit(" session "), i.cast("string")).alias("event_name"),
        F.date_format(F.col("ts"), "yyyy-MM-dd").alias("start_date"),
        F.date_format(F.date_add(F.col("ts"), i), "yyyy-MM-dd").alias("end_date"),
        F.concat(F.lit("U"), (F.col("k") % 19).cast("string")).alias("ages"),
        F.concat(F.lit("$"), F.col("value").cast("string")).alias("cost")))
    arr = F.to_json(items)
    content = (F.when(F.col("event_type") == "error", F.lit("[{'event_name': 'x'}]"))
               .when(F.col("event_type") == "view", F.concat(F.lit("```json\n"), arr, F.lit("\n```")))
               .otherwise(F.concat(F.lit("Here you go: "), arr)))
    env = F.to_json(F.struct(F.array(F.struct(F.struct(content.alias("content")).alias("message"))).alias("choices")))
    env = F.when((F.col("event_type") == "signup") & (F.col("k") % 5 == 0), F.lit('{"error": "rate"}')).otherwise(env)
    return base, e.select(F.col("event_id").alias("camp_id"), env.alias("response"))


@register("answers_explode", """
WITH e AS (SELECT *, TRY_CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events),
a AS (SELECT event_id AS camp_id, event_type, ts, value, k,
        CASE WHEN event_type = 'error' THEN '[{''event_name'': ''x''}]'
             ELSE '[' || coalesce((SELECT string_agg('{"event_name":"' || event_type || ' session ' || i ||
                    '","start_date":"' || strftime(ts, '%Y-%m-%d') || '","end_date":"' ||
                    strftime(ts + to_days(CAST(i AS INTEGER)), '%Y-%m-%d') || '","ages":"U' || (k % 19) ||
                    '","cost":"$' || CAST(value AS VARCHAR) || '"}', ',' ORDER BY i)
                    FROM range(1, (k % 4) + 1) t(i)), '') || ']' END AS arr
      FROM e),
c AS (SELECT camp_id, k, event_type,
        CASE WHEN event_type = 'signup' AND k % 5 = 0 THEN NULL
             WHEN event_type = 'view' THEN '```json' || chr(10) || arr || chr(10) || '```'
             ELSE 'Here you go: ' || arr END AS content FROM a),
s AS (SELECT camp_id,
        CASE WHEN starts_with(content, '```') THEN trim(regexp_replace(content, '^`+|`+$', '', 'g'))
             ELSE content END AS c1 FROM c),
t AS (SELECT camp_id, CASE WHEN instr(c1, '[') > 0 THEN substring(c1, instr(c1, '[')) END AS snip FROM s),
v AS (SELECT camp_id, snip,
        CASE WHEN snip IS NULL OR NOT json_valid(snip) OR json_type(snip) <> 'ARRAY' THEN 'error'
             WHEN json_array_length(snip) = 0 THEN 'none'
             WHEN list_bool_or(list_transform(json_extract(snip, '$[*]'), lambda x: json_type(x) <> 'OBJECT')) THEN 'error'
             ELSE 'found' END AS state FROM t),
b AS (SELECT event_id AS camp_id, 'https://camps.example.org/e/' || event_id AS camp_info_url,
        'Event ' || event_id AS event_details FROM events),
f AS (SELECT v.camp_id, unnest(json_extract(snip, '$[*]')) AS el,
        generate_subscripts(json_extract(snip, '$[*]'), 1) - 1 AS sub_pos FROM v WHERE state = 'found')
SELECT b.camp_id, b.camp_info_url, 'Yes' AS camp_found,
  coalesce(json_extract_string(el, '$.event_name'), b.event_details) AS event_details,
  coalesce(json_extract_string(el, '$.start_date'), '') AS start_date,
  coalesce(json_extract_string(el, '$.end_date'), '') AS end_date,
  coalesce(json_extract_string(el, '$.ages'), '') AS ages_grade_level,
  coalesce(json_extract_string(el, '$.cost'), '') AS cost, CAST(sub_pos AS INTEGER) AS sub_pos
FROM f JOIN b USING (camp_id)
UNION ALL
SELECT b.camp_id, b.camp_info_url, CASE WHEN state = 'none' THEN 'No' ELSE '' END, b.event_details,
  CASE WHEN state = 'none' THEN '' ELSE 'LLM Error' END, CASE WHEN state = 'none' THEN '' ELSE 'LLM Error' END,
  CASE WHEN state = 'none' THEN '' ELSE 'LLM Error' END, CASE WHEN state = 'none' THEN '' ELSE 'LLM Error' END, 0
FROM v JOIN b USING (camp_id) WHERE state <> 'found'""")
def answers_explode(spark, sf_dir):
    """M2-M6: envelope, fence strip, strict JSON, explode into camp rows."""
    from tessera.operators.answers import explode_answers
    base, ans = answers_input(spark, sf_dir)
    return explode_answers(base, ans, "camp_id")


def captures_input(spark, sf_dir):
    """A capture table ``(page_id, url, status, error)`` from events: the
    event type stands for the HTTP outcome."""
    e = read_table(spark, sf_dir, "events")
    url = F.when(F.col("event_type") == "signup", F.lit("")).otherwise(
        F.concat(F.lit("https://x.example.com/e/"), F.col("event_id").cast("string")))
    status = (F.when(F.col("event_type").isin("view", "click"), F.lit(200))
              .when(F.col("event_type") == "purchase", F.lit(301)).otherwise(F.lit(500)))
    err = F.when((F.col("event_type") == "error") & (F.col("value") > 40), F.lit("timeout"))
    return e.select(F.col("event_id").alias("page_id"), url.alias("url"), status.alias("status"), err.alias("error"))


@register("status_text", """
WITH c AS (SELECT event_id AS page_id,
    CASE WHEN event_type = 'signup' THEN '' ELSE 'https://x.example.com/e/' || event_id END AS url,
    CASE WHEN event_type IN ('view', 'click') THEN 200 WHEN event_type = 'purchase' THEN 301 ELSE 500 END AS status,
    CASE WHEN event_type = 'error' AND value > 40 THEN 'timeout' END AS error FROM events)
SELECT page_id,
  CASE WHEN coalesce(url, '') = '' THEN 'No URL Provided'
       WHEN error IS NOT NULL AND error <> '' THEN 'Failed to load. Error: ' || error
       WHEN status = 200 THEN 'Loaded Successfully'
       ELSE 'Error ' || CAST(status AS VARCHAR) END AS status_text
FROM c""")
def status_text(spark, sf_dir):
    """Link status text for every capture."""
    from tessera.functions.status import status_text as stx
    c = captures_input(spark, sf_dir)
    return c.select("page_id", stx("url", "status", "error").alias("status_text"))


# ------------------------------------------------------------------ class years, positions, ages

# Builder values: class-year words placed on open orders (stand-in roster cells).
_YEAR_WORDS = ["Sr.", "jr", "So.", "Fr", "FY.", "graduate", "R-Fr.", "first-year"]


def season_input(spark, sf_dir):
    """Roster-like rows from orders: the order date is "now", the class cell
    is a graduation year ('Class of yyyy', finished orders) or a class-year
    word (open orders) chosen by the price digits; other orders get ''."""
    o = read_table(spark, sf_dir, "orders")
    p = F.floor("o_totalprice").cast("bigint")
    txt = (F.when(F.col("o_orderstatus") == "F", F.concat(F.lit("Class of "),
                                                            (F.year("o_orderdate") + p % 6 - 1).cast("string")))
           .when(F.col("o_orderstatus") == "O", at(F.array(*[F.lit(w) for w in _YEAR_WORDS]),
                                                                (p % len(_YEAR_WORDS) + 1).cast("int")))
           .otherwise(F.lit("")))
    return o.select("o_orderkey", "o_custkey", "o_orderdate", txt.alias("class_text"))


_SQL_SEASON_INPUT = f"""
SELECT o_orderkey, o_custkey, o_orderdate,
  CASE WHEN o_orderstatus = 'F' THEN 'Class of ' || CAST(year(o_orderdate) + CAST(floor(o_totalprice) AS BIGINT) % 6 - 1 AS VARCHAR)
       WHEN o_orderstatus = 'O' THEN {sql_list(_YEAR_WORDS)}[CAST(CAST(floor(o_totalprice) AS BIGINT) % {len(_YEAR_WORDS)} + 1 AS INTEGER)]
       ELSE '' END AS class_text
FROM orders"""


def _sql_level(text: str, now: str) -> str:
    from tessera.functions.roster import YEAR_MAP
    season = f"(CASE WHEN month({now}) >= 6 THEN year({now}) ELSE year({now}) - 1 END)"
    yr = f"regexp_extract(lower({text}), '\\b(20[0-9]{{2}})\\b', 1)"
    delta = f"(TRY_CAST({yr} AS INTEGER) - ({season} + 1))"
    clean = sql_strip(f"replace(lower({text}), '.', '')")
    return (f"CASE WHEN coalesce({text}, '') = '' THEN '' WHEN {yr} <> '' THEN "
            f"(CASE WHEN {delta} = 0 THEN 'senior' WHEN {delta} = 1 THEN 'junior' WHEN {delta} = 2 THEN 'sophomore' "
            f"WHEN {delta} = 3 THEN 'freshman' WHEN {delta} < 0 THEN 'graduate student' ELSE 'freshman' END) "
            f"ELSE coalesce({sql_map(YEAR_MAP)}[{clean}], {clean}) END")


@register("season_year", f"""
WITH s AS ({_SQL_SEASON_INPUT})
SELECT o_orderkey, CAST(CASE WHEN month(o_orderdate) >= 6 THEN year(o_orderdate) ELSE year(o_orderdate) - 1 END AS INTEGER) AS season_start,
  class_text, {_sql_level("class_text", "o_orderdate")} AS level
FROM s""")
def season_year(spark, sf_dir):
    """S17 + S18: season start year and academic level of every row."""
    from tessera.functions import roster as ro
    s = season_input(spark, sf_dir)
    return s.select("o_orderkey", ro.season_start_year("o_orderdate").alias("season_start"), "class_text",
                    ro.academic_level("class_text", F.col("o_orderdate")).alias("level"))


@register("class_level_counts", f"""
WITH s AS ({_SQL_SEASON_INPUT}), l AS (SELECT o_custkey, {_sql_level("class_text", "o_orderdate")} AS level FROM s)
SELECT o_custkey,
  count(*) FILTER (WHERE level = 'freshman') AS freshman, count(*) FILTER (WHERE level = 'sophomore') AS sophomore,
  count(*) FILTER (WHERE level = 'junior') AS junior, count(*) FILTER (WHERE level = 'senior') AS senior,
  count(*) FILTER (WHERE level = 'graduate student') AS graduate_student
FROM l GROUP BY o_custkey""")
def class_level_counts(spark, sf_dir):
    """S18 + F1 (year part): per customer ("team") counts of each level."""
    from tessera.functions import roster as ro
    s = season_input(spark, sf_dir).withColumn("level", ro.academic_level("class_text", F.col("o_orderdate")))
    return s.groupBy("o_custkey").agg(*[F.count_if(F.col("level") == y).alias(y.replace(" ", "_"))
                                        for y in ro.YEAR_BUCKETS])


# Builder values: position cells as rosters write them.
_POS_WORDS = ["D/M", "Goal Keeper", "GK", "Def.", "F, M", "Back", "CB\\RB", "Wing", "Striker", "M-F",
              "Keeper / D", "Utility", "fwd", "Mid & Def", "g"]
# Builder values: class-year cells as rosters write them.
_CLASS_WORDS = ["Fr.", "So", "jr.", "SR", "Graduate", "R-Fr.", "fy", "Senior ", "", "Junior"]


def roster_input(spark, sf_dir):
    """Player-like rows from parts: team = brand, position and class cells
    picked from roster spellings by size and price."""
    p = read_table(spark, sf_dir, "part")
    pos = at(F.array(*[F.lit(w) for w in _POS_WORDS]), (F.col("p_size") % len(_POS_WORDS) + 1).cast("int"))
    yr = at(F.array(*[F.lit(w) for w in _CLASS_WORDS]),
                      (F.floor("p_retailprice").cast("bigint") % len(_CLASS_WORDS) + 1).cast("int"))
    return p.select("p_partkey", F.col("p_brand").alias("team"), pos.alias("pos_text"), yr.alias("year_text"))


_SQL_ROSTER_INPUT = f"""
SELECT p_partkey, p_brand AS team,
  {sql_list(_POS_WORDS)}[CAST(p_size % {len(_POS_WORDS)} + 1 AS INTEGER)] AS pos_text,
  {sql_list(_CLASS_WORDS)}[CAST(CAST(floor(p_retailprice) AS BIGINT) % {len(_CLASS_WORDS)} + 1 AS INTEGER)] AS year_text
FROM part"""


def _sql_canon_pos(x: str) -> str:
    from tessera.functions.roster import POSITION_MAP
    s = f"replace(replace(lower({sql_strip(f'coalesce({x}, {chr(39)}{chr(39)})')}), '.', ''), chr(92), '/')"
    mapped = (f"list_filter(list_transform(string_split_regex({s}, '[/,\\-\\s]+'), lambda t: {sql_map(POSITION_MAP)}[t]), "
              f"lambda t: t IS NOT NULL)")
    return f"array_to_string(list_filter({mapped}, lambda v, i: list_position({mapped}, v) = i), '/')"


def _sql_class_year(x: str) -> str:
    from tessera.functions.roster import YEAR_MAP
    return f"coalesce({sql_map(YEAR_MAP)}[lower({sql_strip(x)})], {x})"


@register("alias_canonical", f"""
WITH r AS ({_SQL_ROSTER_INPUT})
SELECT p_partkey, pos_text, {_sql_canon_pos("pos_text")} AS position, year_text, {_sql_class_year("year_text")} AS class_year
FROM r""")
def alias_canonical(spark, sf_dir):
    """S14 + S16 (S43): canonical position codes and class years."""
    from tessera.functions import roster as ro
    r = roster_input(spark, sf_dir)
    return r.select("p_partkey", "pos_text", ro.canon_pos("pos_text").alias("position"), "year_text",
                    ro.class_year("year_text").alias("class_year"))


def _sql_position_classes(x: str) -> str:
    from tessera.functions.roster import POSITION_KEYWORDS, POSITION_MAP
    m = sql_map(POSITION_MAP)
    p = f"lower(coalesce({x}, ''))"
    parts = f"list_filter(list_transform(string_split_regex({p}, '\\s*[/&|,]\\s*'), lambda t: {sql_strip('t')}), lambda t: t <> '')"
    first = "upper(substring(t, 1, 1))"
    cls = (f"list_filter(list_transform({parts}, lambda t: coalesce({m}[t], CASE {first} WHEN 'D' THEN 'D' WHEN 'M' THEN 'M' "
           f"WHEN 'F' THEN 'F' WHEN 'G' THEN 'GK' END)), lambda c: c IS NOT NULL)")
    kw = "list_filter([" + ", ".join(f"CASE WHEN regexp_matches({p}, '{rx}') THEN '{code}' END"
                                     for code, rx in POSITION_KEYWORDS) + "], lambda c: c IS NOT NULL)"
    return f"CASE WHEN {m}[{p}] IS NOT NULL THEN [{m}[{p}]] WHEN len({cls}) > 0 THEN {cls} ELSE {kw} END"


@register("multi_label_counts", f"""
WITH r AS ({_SQL_ROSTER_INPUT}),
n AS (SELECT team, {_sql_canon_pos("pos_text")} AS position, {_sql_class_year("year_text")} AS year FROM r),
c AS (SELECT team, {_sql_position_classes("position")} AS cls, lower(coalesce(year, '')) AS yr FROM n)
SELECT team,
  CAST(sum(len(list_filter(cls, lambda c: c = 'D'))) AS BIGINT) AS defenders,
  CAST(sum(len(list_filter(cls, lambda c: c = 'F'))) AS BIGINT) AS forwards,
  CAST(sum(len(list_filter(cls, lambda c: c = 'M'))) AS BIGINT) AS midfielders,
  CAST(sum(len(list_filter(cls, lambda c: c = 'GK'))) AS BIGINT) AS goalkeepers,
  count(*) FILTER (WHERE yr = 'freshman') AS freshman, count(*) FILTER (WHERE yr = 'sophomore') AS sophomore,
  count(*) FILTER (WHERE yr = 'junior') AS junior, count(*) FILTER (WHERE yr = 'senior') AS senior,
  count(*) FILTER (WHERE yr = 'graduate student') AS graduate_student
FROM c GROUP BY team""")
def multi_label_counts(spark, sf_dir):
    """S43 + F1: normalise players, then per team position counts (a
    ``D/M`` player adds to two buckets) and class-year counts."""
    from tessera.functions import roster as ro
    from tessera.operators.aggregate import roster_counts
    r = roster_input(spark, sf_dir).select("team", F.col("pos_text").alias("position"),
                                           F.col("year_text").alias("year"))
    return roster_counts(ro.normalize_players(r), ["team"])


@register("age_bands", """
WITH a AS (SELECT p_partkey,
    CAST(p_size % 17 + 3 AS VARCHAR) || CASE WHEN p_size % 7 = 0 THEN '+' ELSE '–' || CAST(p_size % 17 + 3 + p_size % 5 AS VARCHAR) END AS ages
  FROM part),
n AS (SELECT p_partkey, ages, list_transform(list_filter(list_transform(string_split(replace(ages, '+', ''), '–'),
        lambda s: trim(s)), lambda s: regexp_full_match(s, '[0-9]+')), lambda s: CAST(s AS INTEGER)) AS nums FROM a)
SELECT p_partkey, ages,
  concat_ws(', ', CASE WHEN list_bool_or(list_transform(nums, lambda x: x BETWEEN 2 AND 12)) THEN 'Elementary School' END,
                  CASE WHEN list_bool_or(list_transform(nums, lambda x: x BETWEEN 13 AND 14)) THEN 'Middle School' END,
                  CASE WHEN list_bool_or(list_transform(nums, lambda x: x BETWEEN 15 AND 18)) THEN 'High School' END) AS grade_level
FROM n""")
def age_bands(spark, sf_dir):
    """Grade levels from an ages cell (``a–b`` or ``a+``) built from part sizes."""
    from tessera.functions.events import grade_levels
    p = read_table(spark, sf_dir, "part")
    lo = (F.col("p_size") % 17 + 3)
    ages = F.concat(lo.cast("string"), F.when(F.col("p_size") % 7 == 0, F.lit("+")).otherwise(
        F.concat(F.lit("–"), (lo + F.col("p_size") % 5).cast("string"))))
    return p.select("p_partkey", ages.alias("ages")).withColumn("grade_level", grade_levels("ages"))


# ------------------------------------------------------------------ standings, reports, dedup

def standings_input(spark, sf_dir):
    """Standings rows from suppliers: conference = nation, row order = key,
    points = account balance (no points at all in region 0's nations)."""
    s = read_table(spark, sf_dir, "supplier")
    n = read_table(spark, sf_dir, "nation")
    x = s.join(n, s.s_nationkey == n.n_nationkey)
    return x.select(F.col("s_nationkey").alias("conference"), F.col("s_suppkey").alias("pos"),
                    F.col("s_name").alias("school"),
                    F.when(F.col("n_regionkey") == 0, F.lit(None).cast("double")).otherwise(F.col("s_acctbal")).alias("pts"))


@register("points_standing", """
WITH x AS (SELECT s_nationkey AS conference, s_suppkey AS pos, s_name AS school,
             CASE WHEN n_regionkey = 0 THEN NULL ELSE s_acctbal END AS pts
           FROM supplier JOIN nation ON s_nationkey = n_nationkey)
SELECT conference, pos, school,
  CAST(CASE WHEN count(pts) OVER (PARTITION BY conference) > 0
            THEN row_number() OVER (PARTITION BY conference ORDER BY coalesce(pts, 0.0) DESC, pos)
            ELSE row_number() OVER (PARTITION BY conference ORDER BY pos) END AS VARCHAR) AS standing
FROM x""")
def points_standing(spark, sf_dir):
    """G1 + G2: standing by points (desc, ties in row order) where the
    conference has points, else the row number."""
    from tessera.operators.aggregate import points_standing as ps
    return ps(standings_input(spark, sf_dir)).select("conference", "pos", "school", "standing")


def camp_map_input(spark, sf_dir):
    """Camp/school map rows from suppliers: the score cell is text as the
    mapping file holds it (blank, 'n/a' or a number), the confirmed cell in
    several truthy/falsy spellings."""
    s = read_table(spark, sf_dir, "supplier")
    score = (F.when(F.col("s_acctbal") < 0, F.lit("n/a")).when(F.col("s_acctbal") < 1000, F.lit(""))
             .otherwise(F.format_number(F.col("s_acctbal") / 10000, 3)))
    conf = at(F.array(F.lit("yes"), F.lit("TRUE"), F.lit("0"), F.lit(None).cast("string")),
                        (F.col("s_nationkey") % 4 + 1).cast("int"))
    return s.select(F.col("s_suppkey").alias("pos"), F.col("s_name").alias("camp_school_name"),
                    score.alias("similarity_score"), conf.alias("manually_confirmed"))


@register("lowest_n", """
WITH m AS (SELECT s_suppkey AS pos, s_name AS camp_school_name,
    CASE WHEN s_acctbal < 0 THEN 'n/a' WHEN s_acctbal < 1000 THEN '' ELSE CAST(round(s_acctbal / 10000, 3) AS VARCHAR) END AS similarity_score,
    (['yes', 'TRUE', '0', NULL])[CAST(s_nationkey % 4 + 1 AS INTEGER)] AS manually_confirmed FROM supplier)
SELECT pos, camp_school_name, coalesce(TRY_CAST(trim(similarity_score) AS DOUBLE), 0.0) AS similarity_score
FROM m
WHERE NOT coalesce(lower(trim(manually_confirmed)) IN ('true', 'yes', '1')
                   OR coalesce(TRY_CAST(trim(manually_confirmed) AS DOUBLE) <> 0, false), false)
ORDER BY 3, 1 LIMIT 30""")
def lowest_n(spark, sf_dir):
    """C14 + G4: the 30 unconfirmed entries with the lowest score (a report)."""
    from tessera.functions.status import is_confirmed
    from tessera.operators.aggregate import lowest_n as ln
    m = camp_map_input(spark, sf_dir)
    return ln(m, "similarity_score", "pos", 30, confirmed=is_confirmed(F.col("manually_confirmed"))).select(
        "pos", "camp_school_name", "similarity_score")


@register("keep_first", """
SELECT user_id, event_type, event_id, ts, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS rn FROM events)
WHERE rn = 1""")
def keep_first(spark, sf_dir):
    """The first event per (user, type); ``min_by`` partial aggregate."""
    from tessera.operators.aggregate import keep_first as kf
    e = read_table(spark, sf_dir, "events").select("user_id", "event_type", "event_id", "ts", "value")
    return kf(e, ["user_id", "event_type"], ["ts", "event_id"])


# ------------------------------------------------------------------ matching

_TOK = "list_distinct(regexp_extract_all(lower(coalesce({x}, '')), '[\\p{{L}}\\p{{N}}_]+'))"


def sql_tokens(x: str) -> str:
    return _TOK.format(x=x)


def sql_jaccard(a: str, b: str) -> str:
    return (f"CASE WHEN len({a}) = 0 OR len({b}) = 0 THEN 0.0 ELSE "
            f"len(list_intersect({a}, {b})) / len(list_distinct(list_concat({a}, {b}))) END")


def match_input(spark, sf_dir):
    """Scraped names and a master from parts.  Master: one row per part name
    (row id = its smallest part key, conference = that part's brand).  Left:
    every part, named '<type> <name>' for even sizes and '<type> <noun>' for
    odd sizes, preferring its own brand."""
    p = read_table(spark, sf_dir, "part")
    master = (p.groupBy("p_name").agg(F.min_by(F.struct("p_partkey", "p_brand"), F.col("p_partkey")).alias("m"))
              .select(F.col("m.p_partkey").alias("row_id"), F.col("p_name").alias("master_name"),
                      F.col("m.p_brand").alias("conference")))
    name = F.when(F.col("p_size") % 2 == 0, F.concat_ws(" ", F.lower("p_type"), "p_name")).otherwise(
        F.concat_ws(" ", F.lower("p_type"), at(F.split("p_name", " "), -1)))
    left = p.select("p_partkey", name.alias("name"), F.col("p_brand").alias("pref"))
    return left, master


_SQL_MATCH_INPUT = """
m AS (SELECT min(p_partkey) AS row_id, p_name AS master_name FROM part GROUP BY p_name),
l AS (SELECT p_partkey, CASE WHEN p_size % 2 = 0 THEN lower(p_type) || ' ' || p_name
                             ELSE lower(p_type) || ' ' || split_part(p_name, ' ', -1) END AS name FROM part)"""


@register("fuzzy_jaccard_top1", f"""
WITH {_SQL_MATCH_INPUT},
lt AS (SELECT p_partkey, name, {sql_tokens("name")} AS t FROM l),
mt AS (SELECT row_id, master_name, {sql_tokens("master_name")} AS t FROM m),
s AS (SELECT p_partkey, name, row_id, master_name, {sql_jaccard("lt.t", "mt.t")} AS score FROM lt, mt),
b AS (SELECT p_partkey, arg_max(row_id, (score, -row_id)) AS match_row_id, arg_max(master_name, (score, -row_id)) AS match_name,
        max(score) AS best FROM s WHERE score > 0 GROUP BY p_partkey)
SELECT l.p_partkey, l.name, b.match_row_id, b.match_name, round_even(coalesce(b.best, 0.0), 3) AS similarity_score
FROM l LEFT JOIN b USING (p_partkey)""")
def fuzzy_jaccard_top1(spark, sf_dir):
    """S27 + E1: best master by word Jaccard for every scraped name (strict
    ``>`` from 0, earliest master on ties), via the token-blocked join."""
    from tessera.operators.match import best_match
    left, master = match_input(spark, sf_dir)
    out = best_match(left.select("p_partkey", "name"), master, name="name", scorer="jaccard")
    return out.select("p_partkey", "name", "match_row_id", "match_name", "similarity_score")


@register("fuzzy_combined_topk", f"""
WITH {_SQL_MATCH_INPUT},
c AS (SELECT m.row_id, m.master_name, p.p_brand AS conference FROM m JOIN part p ON p.p_partkey = m.row_id),
q AS (SELECT DISTINCT l.name, p.p_brand AS pref FROM l JOIN part p USING (p_partkey)),
qt AS (SELECT name, pref, {sql_tokens("name")} AS t FROM q),
ct AS (SELECT row_id, master_name, conference, {sql_tokens("master_name")} AS t FROM c),
s AS (SELECT name, pref, row_id, master_name,
        least(1.0, 0.4 * (1 - levenshtein(lower(name), lower(master_name)) / greatest(length(name), length(master_name)))
          + 0.6 * {sql_jaccard("qt.t", "ct.t")} + CASE WHEN pref = conference THEN 0.15 ELSE 0 END) AS score FROM qt, ct),
r AS (SELECT *, row_number() OVER (PARTITION BY name, pref ORDER BY score DESC, row_id) AS rank FROM s WHERE score >= 0.6)
SELECT l.p_partkey, l.name, CAST(r.rank AS INTEGER) AS rank, r.row_id, r.master_name, round(r.score, 6) AS score,
  CASE WHEN r.rank IS NOT NULL THEN true END AS complete
FROM l JOIN part p USING (p_partkey) LEFT JOIN r ON r.name = l.name AND r.pref = p.p_brand AND r.rank <= 10""")
def fuzzy_combined_topk(spark, sf_dir):
    """S29 + S30 + E2 + E3 + G3: top-10 masters of at least 0.6 by 0.4 * character score
    + 0.6 * Jaccard with the same-conference bonus; the character score is
    the scorer argument (V2), here the edit ratio, which both engines have."""
    from tessera.functions.similarity import edit_ratio
    from tessera.operators.match import fuzzy_topk
    left, master = match_input(spark, sf_dir)
    out = fuzzy_topk(left, master, k=10, name="name", pref="pref", master_conf="conference", min_score=0.6, seq=edit_ratio)
    return out.select("p_partkey", "name", "rank", "row_id", "master_name",
                      F.round("score", 6).alias("score"), "complete")


@register("doc_benchmark_overlap", f"""
WITH a AS (SELECT doc_id, {sql_tokens("text")} AS t FROM documents),
b AS (SELECT item_id, {sql_tokens("text")} AS t FROM benchmark),
p AS (SELECT doc_id, item_id, len(list_intersect(a.t, b.t)) AS shared, len(a.t) AS na, len(b.t) AS nb
      FROM a, b WHERE len(b.t) > 0 AND len(a.t) >= 0.25 * len(b.t) AND len(a.t) * 0.25 <= len(b.t))
SELECT doc_id, item_id, shared, round(shared / (na + nb - shared), 6) AS jaccard
FROM p WHERE shared / (na + nb - shared) >= 0.25""")
def doc_benchmark_overlap(spark, sf_dir):
    """S27 + E1 with threshold: documents whose word set overlaps a
    benchmark item with Jaccard >= 0.25 (whole texts, length-bounded
    token join)."""
    from tessera.operators.match import set_similarity_join
    d = read_table(spark, sf_dir, "documents")
    b = read_table(spark, sf_dir, "benchmark")
    out = set_similarity_join(d, b, "doc_id", "item_id", "text", "text", 0.25)
    return out.select("doc_id", "item_id", "shared", F.round("jaccard", 6).alias("jaccard"))


# Fixed input: the alias pairs of the alias-first match (user-maintained in the
# reference as a small hard-coded table).
_ALIASES = [("economy small ring", "red widget"), ("small bolt", "hot gear")]


@register("alias_then_fuzzy", f"""
WITH {_SQL_MATCH_INPUT},
al AS (SELECT * FROM (VALUES {", ".join(f"('{a}', '{c}')" for a, c in _ALIASES)}) t(alias, canonical)),
lt AS (SELECT p_partkey, name, {sql_tokens("name")} AS t FROM l),
mt AS (SELECT row_id, master_name, {sql_tokens("master_name")} AS t FROM m),
s AS (SELECT p_partkey, row_id, master_name, {sql_jaccard("lt.t", "mt.t")} AS score FROM lt, mt),
b AS (SELECT p_partkey, arg_max(master_name, (score, -row_id)) AS best_name, max(score) AS best
      FROM s WHERE score > 0 GROUP BY p_partkey),
f AS (SELECT l.p_partkey, al.canonical, CASE WHEN round_even(coalesce(b.best, 0.0), 3) >= 0.6 THEN b.best_name END AS fz
      FROM l LEFT JOIN al ON l.name = al.alias LEFT JOIN b USING (p_partkey))
SELECT p_partkey, coalesce(canonical, fz) AS matched_name,
  CASE WHEN canonical IS NOT NULL THEN 'alias' WHEN fz IS NOT NULL THEN 'fuzzy' ELSE 'none' END AS match_source
FROM f""")
def alias_then_fuzzy(spark, sf_dir):
    """Alias pairs first, then the best fuzzy master accepted at 0.6
    (Jaccard scorer; the scorer is a parameter, decision D9)."""
    from tessera.operators.match import alias_then_fuzzy as atf
    left, master = match_input(spark, sf_dir)
    aliases = spark.createDataFrame(_ALIASES, "alias string, canonical string")
    out = atf(left.select("p_partkey", "name"), aliases, master, name="name", scorer="jaccard", accept_at=0.6)
    return out.select("p_partkey", "matched_name", "match_source")


@register("exact_ci_lookup", """
WITH m AS (SELECT lower(trim(p_name)) AS k, min(p_partkey) AS match_row_id FROM part GROUP BY 1)
SELECT p.p_partkey, upper(p.p_name) AS name, m.match_row_id
FROM part p LEFT JOIN m ON lower(trim('  ' || upper(p.p_name) || ' ')) = m.k""")
def exact_ci_lookup(spark, sf_dir):
    """E5: first master row whose trimmed lower-case name equals the scraped one."""
    from tessera.operators.match import exact_lookup
    p = read_table(spark, sf_dir, "part")
    left = p.select("p_partkey", F.concat(F.lit("  "), F.upper("p_name"), F.lit(" ")).alias("q"),
                    F.upper("p_name").alias("name"))
    master = p.select(F.col("p_partkey").alias("row_id"), F.col("p_name").alias("master_name"))
    return exact_lookup(left, master, name="q").select("p_partkey", "name", "match_row_id")


# ------------------------------------------------------------------ reconcile

@register("last_wins_join", """
WITH m AS (SELECT user_id, arg_max(event_id, event_id) AS event_id, arg_max(event_type, event_id) AS event_type
           FROM events GROUP BY user_id)
SELECT c.c_custkey, m.event_id, m.event_type FROM customer c LEFT JOIN m ON c.c_custkey = m.user_id""")
def last_wins_join(spark, sf_dir):
    """Customers joined to the event table on the user key; among
    several events of a user the last (highest id) wins."""
    from tessera.operators.reconcile import last_wins_lookup
    e = read_table(spark, sf_dir, "events").select("event_id", "user_id", "event_type")
    m = last_wins_lookup(e, "user_id", row_id="event_id").drop("_key")
    c = read_table(spark, sf_dir, "customer").select("c_custkey")
    return c.join(m, c.c_custkey == m.user_id, "left").select("c_custkey", "event_id", "event_type")


def offers_input(spark, sf_dir):
    """Scholarship-like rows from events: a numbered title and a link as
    model answers write them; events before 2024-01-10 are the stored sheet."""
    e = read_table(spark, sf_dir, "events")
    title = F.concat(F.lit("1.  "), F.upper("event_type"), F.lit("  Offer "), F.col("user_id").cast("string"))
    link = F.when(F.col("value") > 25, F.concat(F.lit("www.offers.example.com/u/"), F.col("user_id").cast("string"),
                                                F.lit(" - open in new window"))).otherwise(
        F.concat(F.lit("https://www.offers.example.com/u/"), F.col("user_id").cast("string"), F.lit(".")))
    x = e.select("event_id", "ts", "user_id", "event_type", title.alias("title"), link.alias("link"))
    cut = F.lit("2024-01-10 00:00:00").cast("timestamp")
    return x.filter(F.col("ts") >= cut), x.filter(F.col("ts") < cut)


@register("anti_known", f"""
WITH x AS (SELECT event_id, ts, user_id, event_type,
    '1.  ' || upper(event_type) || '  Offer ' || CAST(user_id AS VARCHAR) AS title,
    CASE WHEN value > 25 THEN 'www.offers.example.com/u/' || CAST(user_id AS VARCHAR) || ' - open in new window'
         ELSE 'https://www.offers.example.com/u/' || CAST(user_id AS VARCHAR) || '.' END AS link FROM events),
k AS (SELECT *, {sql_normalize_title("title")} AS kt, lower({sql_clean_url("link")}) AS kl FROM x),
known AS (SELECT DISTINCT kt, kl FROM k WHERE ts < TIMESTAMP '2024-01-10 00:00:00'),
new AS (SELECT * FROM k WHERE ts >= TIMESTAMP '2024-01-10 00:00:00'
        AND NOT EXISTS (SELECT 1 FROM known WHERE known.kt = k.kt AND known.kl = k.kl))
SELECT user_id, event_type, event_id, title, link FROM (
  SELECT *, row_number() OVER (PARTITION BY kt, kl ORDER BY ts, event_id) AS rn FROM new) WHERE rn = 1""")
def anti_known(spark, sf_dir):
    """Drop rows already stored (normalised title + cleaned link)
    and keep the first of each key inside the batch."""
    from tessera.operators.reconcile import anti_known as ak, title_link_key
    new, known = offers_input(spark, sf_dir)
    out = ak(new, known, title_link_key(F.col("title"), F.col("link")), title_link_key(F.col("title"), F.col("link")),
             order=["ts", "event_id"])
    return out.select("user_id", "event_type", "event_id", "title", "link")


@register("completed_skip", """
WITH u AS (SELECT DISTINCT o_orderpriority AS division, o_orderstatus AS gender, CAST(year(o_orderdate) AS INTEGER) AS conference FROM orders),
c AS (SELECT DISTINCT o_orderpriority AS division, o_orderstatus AS gender, CAST(year(o_orderdate) AS INTEGER) AS conference
      FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01 00:00:00')
SELECT * FROM u WHERE NOT EXISTS (SELECT 1 FROM c WHERE c.division = u.division AND c.gender = u.gender AND c.conference = u.conference)""")
def completed_skip(spark, sf_dir):
    """Work units (priority, status, year) not yet completed; the
    completed table is what an earlier run finished (units of orders dated
    before 1998)."""
    from tessera.operators.reconcile import skip_completed
    o = read_table(spark, sf_dir, "orders")
    cols = [F.col("o_orderpriority").alias("division"), F.col("o_orderstatus").alias("gender"),
            F.year("o_orderdate").alias("conference")]
    units = o.select(*cols).distinct()
    done = o.filter(F.col("o_orderdate") < F.lit("1998-01-01 00:00:00").cast("timestamp_ntz")).select(*cols)
    return skip_completed(units, done, ["division", "gender", "conference"])


@register("gazetteer_lookup", f"""
WITH g AS (SELECT lower(n_name) AS address_norm, CAST(n_nationkey * 1.5 AS DOUBLE) AS lat,
                  CAST(n_regionkey * 2.25 - 100.0 AS DOUBLE) AS lng, r_name AS city
           FROM nation JOIN region ON n_regionkey = r_regionkey),
s AS (SELECT s_suppkey, n_name || CASE WHEN s_acctbal < 0 THEN ' city' ELSE '' END AS address
      FROM supplier JOIN nation ON s_nationkey = n_nationkey)
SELECT s_suppkey, address, g.lat AS latitude, g.lng AS longitude, g.city
FROM s LEFT JOIN g ON lower({sql_clean_text("address")}) = g.address_norm""")
def gazetteer_lookup(spark, sf_dir):
    """Geocode supplier addresses against a gazetteer built from
    nation and region; distinct addresses first, misses stay null."""
    from tessera.operators.reconcile import geocode
    n = read_table(spark, sf_dir, "nation")
    r = read_table(spark, sf_dir, "region")
    g = n.join(r, n.n_regionkey == r.r_regionkey).select(
        F.lower("n_name").alias("address_norm"), (F.col("n_nationkey") * 1.5).alias("lat"),
        (F.col("n_regionkey") * 2.25 - 100.0).alias("lng"), F.col("r_name").alias("city"))
    s = read_table(spark, sf_dir, "supplier").join(n, F.col("s_nationkey") == F.col("n_nationkey"))
    s = s.select("s_suppkey", F.concat(F.col("n_name"), F.when(F.col("s_acctbal") < 0, F.lit(" city"))
                                       .otherwise(F.lit(""))).alias("address"))
    return geocode(s, F.col("address"), g).select("s_suppkey", "address", "latitude", "longitude", "city")


def changes_input(spark, sf_dir):
    """A change log from events: school row = the user's customer key, order
    = event id, position and change code from the event."""
    e = read_table(spark, sf_dir, "events")
    code = (F.when(F.col("event_type") == "click", "e").when(F.col("event_type") == "view", "J X")
            .when(F.col("event_type") == "purchase", "x").when(F.col("event_type") == "signup", "#").otherwise("c"))
    pos = F.when(F.col("value") < 45, F.lit("Head Coach")).otherwise(F.lit("Assistant Coach"))
    email = F.when((F.col("event_type") == "view") & (F.col("value") > 30), F.lit(None).cast("string")).otherwise(
        F.concat(F.lit("c"), F.col("event_id").cast("string"), F.lit("@example.edu")))
    return e.select(F.col("user_id").alias("row_id"), F.col("event_id").alias("seq"), pos.alias("position"),
                    code.alias("change"), F.lit("Coach").alias("first_name"),
                    F.col("event_id").cast("string").alias("last_name"), email.alias("email_address"))


@register("change_log_apply", """
WITH c AS (SELECT user_id AS row_id, event_id AS seq,
    CASE WHEN value < 45 THEN 'Head Coach' ELSE 'Assistant Coach' END AS position,
    CASE event_type WHEN 'click' THEN 'e' WHEN 'view' THEN 'J X' WHEN 'purchase' THEN 'x' WHEN 'signup' THEN '#' ELSE 'c' END AS change,
    'Coach ' || CAST(event_id AS VARCHAR) AS name,
    CASE WHEN event_type = 'view' AND value > 30 THEN NULL ELSE 'c' || CAST(event_id AS VARCHAR) || '@example.edu' END AS email
  FROM events),
f AS (SELECT *, replace(lower(change), ' ', '') AS code FROM c WHERE position = 'Head Coach' AND change NOT IN ('#', 'c')),
w AS (SELECT row_id, seq, 'men_coach_email' AS col, email AS value FROM f WHERE code = 'e' AND email IS NOT NULL AND trim(email) <> ''
      UNION ALL SELECT row_id, seq, 'men_coach_name', name FROM f WHERE (contains(code, 'j') OR contains(code, 'x'))
      UNION ALL SELECT row_id, seq, 'men_coach_email', email FROM f WHERE (contains(code, 'j') OR contains(code, 'x')) AND email IS NOT NULL AND trim(email) <> ''),
l AS (SELECT row_id, col, arg_max(value, seq) AS value FROM w GROUP BY row_id, col)
SELECT c_custkey, max(value) FILTER (WHERE col = 'men_coach_name') AS men_coach_name,
  max(value) FILTER (WHERE col = 'men_coach_email') AS men_coach_email
FROM customer LEFT JOIN l ON c_custkey = row_id GROUP BY c_custkey""")
def change_log_apply(spark, sf_dir):
    """C1 + C2 + S36 + S37 + U1: apply a change log to the master: per cell
    the last change wins; untouched cells stay."""
    from tessera.operators.reconcile import apply_cell_writes, change_log_writes
    ch = changes_input(spark, sf_dir)
    writes = change_log_writes(ch, {"name": "men_coach_name", "email": "men_coach_email"})
    master = read_table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("row_id"))
    out = apply_cell_writes(master, writes, ["men_coach_name", "men_coach_email"])
    return out.select(F.col("row_id").alias("c_custkey"), "men_coach_name", "men_coach_email")


@register("keyed_upsert", """
WITH r AS (SELECT o_custkey, o_orderkey, o_totalprice, o_orderpriority,
    regexp_replace(regexp_replace(lower(regexp_replace('https://shop' || CAST(o_custkey AS VARCHAR) || '.example.com', '^https?://', '')), '^waf\\.', ''), '^www\\.', '') AS k FROM orders),
l AS (SELECT k, arg_max(o_totalprice, o_orderkey) AS last_total, arg_max(o_orderpriority, o_orderkey) AS priority, count(*) AS n FROM r GROUP BY k),
m AS (SELECT c_custkey, c_acctbal,
    regexp_replace(regexp_replace(regexp_replace(lower(regexp_replace('www.Shop' || CAST(c_custkey AS VARCHAR) || '.example.com/', '^https?://', '')), '^waf\\.', ''), '^www\\.', ''), '/$', '') AS k FROM customer)
SELECT c_custkey, c_acctbal, l.last_total, l.priority, coalesce(l.n, 0) AS dup_count,
  CASE WHEN coalesce(l.n, 0) > 1 THEN 'Duplicate' ELSE '' END AS duplicate
FROM m LEFT JOIN l USING (k)""")
def keyed_upsert(spark, sf_dir):
    """S6 + E7 + F4 + U2: results keyed by canonical URL upserted onto the
    master (last result wins, absent columns added, duplicates flagged)."""
    from tessera.functions.urls import canonical_url
    from tessera.operators.reconcile import keyed_upsert as ku
    c = read_table(spark, sf_dir, "customer").select(
        "c_custkey", "c_acctbal",
        F.concat(F.lit("www.Shop"), F.col("c_custkey").cast("string"), F.lit(".example.com/")).alias("site"))
    o = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_totalprice", "o_orderpriority",
        F.concat(F.lit("https://shop"), F.col("o_custkey").cast("string"), F.lit(".example.com")).alias("url"))
    out = ku(c, o, canonical_url(F.col("site")), canonical_url(F.col("url")),
             {"o_totalprice": "last_total", "o_orderpriority": "priority"}, order="o_orderkey")
    return out.select("c_custkey", "c_acctbal", "last_total", "priority", "dup_count", "duplicate")


# ------------------------------------------------------------------ incremental

@register("pending_split", """
WITH f AS (SELECT l_orderkey, min(l_linenumber) FILTER (WHERE l_returnflag = 'R' AND l_linestatus = 'F') AS ff
           FROM lineitem GROUP BY l_orderkey)
SELECT l.l_orderkey, l.l_linenumber,
  CASE WHEN f.ff IS NOT NULL AND l.l_linenumber >= f.ff THEN 'pending' ELSE 'applied' END AS state
FROM lineitem l JOIN f USING (l_orderkey)""")
def pending_split(spark, sf_dir):
    """Per write group (order) the first failed write (line) and all
    later ones stay pending; earlier ones are applied."""
    from tessera.streaming.incremental import split_pending
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", ((F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "F")).alias("failed"))
    return split_pending(li, "l_orderkey", "l_linenumber", "failed").select("l_orderkey", "l_linenumber", "state")


@register("first_hit", """
SELECT l_orderkey, l_linenumber, l_partkey FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) AS rn FROM lineitem
  WHERE l_returnflag <> 'R' AND l_quantity > 10) WHERE rn = 1""")
def first_hit(spark, sf_dir):
    """Per entity (order) the first candidate (line) that loaded and
    yielded rows (not returned, quantity > 10)."""
    from tessera.sources.pages import first_hit as fh
    li = read_table(spark, sf_dir, "lineitem").withColumn("priority", F.struct("l_linenumber", "l_partkey", "l_suppkey"))
    li = li.select("l_orderkey", "l_linenumber", "l_partkey", "priority",
                   ((F.col("l_returnflag") != "R") & (F.col("l_quantity") > 10)).alias("loaded"))
    return fh(li, "l_orderkey", "priority", F.col("loaded")).select("l_orderkey", "l_linenumber", "l_partkey")


@register("union_sources", """
SELECT 'customer' AS source, c_custkey AS id, c_name AS name, c_nationkey AS nationkey, c_acctbal AS acctbal, c_mktsegment AS segment FROM customer
UNION ALL
SELECT 'supplier', s_suppkey, s_name, s_nationkey, s_acctbal, NULL FROM supplier""")
def union_sources(spark, sf_dir):
    """H1: rows of two sources with different columns in one table."""
    from tessera.operators.reconcile import union_sources as us
    c = read_table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_nationkey").alias("nationkey"),
        F.col("c_acctbal").alias("acctbal"), F.col("c_mktsegment").alias("segment"))
    s = read_table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.col("s_nationkey").alias("nationkey"),
        F.col("s_acctbal").alias("acctbal"))
    return us({"customer": c, "supplier": s}).select("source", "id", "name", "nationkey", "acctbal", "segment")


# ------------------------------------------------------------------ mail, scholarships, requests, substring

def mail_input(spark, sf_dir):
    """Mail stand-ins from documents: the HTML part is the text with one
    ``<p>`` per line (base64url, as mail APIs return it); non-English
    documents also carry the text as the plain part."""
    d = read_table(spark, sf_dir, "documents")
    html = F.concat(F.lit("<p>"), F.replace(F.coalesce("text", F.lit("")), F.lit("\n"), F.lit("</p><p>")), F.lit("</p>"))
    b64 = F.translate(F.base64(F.encode(html, "UTF-8")), "+/", "-_")
    plain = F.when(F.col("lang") == "en", F.lit("")).otherwise(F.col("text"))
    parts = F.array(F.struct(F.lit("text/plain").alias("mimeType"), F.lit("").alias("data")),
                    F.struct(F.lit("text/html").alias("mimeType"), b64.alias("data")))
    return d.select(F.col("doc_id").alias("id"), F.col("source").alias("subject"), plain.alias("plain"),
                    parts.alias("parts"))


def _sql_html_to_text(x: str) -> str:
    s = x
    for pat, rep in ((r"(?i)<br\s*/?>", "chr(10)"), (r"(?i)</(p|div|li|h\d)>", "chr(10)"), (r"(?i)<li>", "'• '"),
                     ("&nbsp;", "' '"), ("&amp;", "'&'"), ("&lt;", "'<'"), ("&gt;", "'>'"), ("<[^>]+>", "''"),
                     (r"\n{3,}", "chr(10) || chr(10)"), (r"^\s+|\s+$", "''")):
        s = f"regexp_replace({s}, '{pat}', {rep}, 'g')"
    return s


@register("mail_bodies", f"""
WITH m AS (SELECT doc_id, CASE WHEN lang = 'en' THEN '' ELSE text END AS plain,
             '<p>' || replace(coalesce(text, ''), chr(10), '</p><p>') || '</p>' AS html FROM documents),
d AS (SELECT doc_id, plain, decode(from_base64(translate(translate(to_base64(encode(html)), '+/', '-_'), '-_', '+/'))) AS h FROM m),
b AS (SELECT doc_id, CASE WHEN length({sql_strip("coalesce(plain, '')")}) < 50 THEN {_sql_html_to_text("h")}
                          ELSE coalesce(plain, '') END AS body FROM d),
f AS (SELECT doc_id, CASE WHEN regexp_matches(body, '(?i)Begin forwarded message')
          THEN regexp_replace(substring(body, strpos(lower(body), 'begin forwarded message')), '(?is)^.*?Subject:[^\\n]*\\n', '')
          ELSE body END AS body FROM b),
c AS (SELECT *, unnest(range(0, greatest(CAST(ceil(length(body) / 40000.0) AS BIGINT), 1))) AS i FROM f)
SELECT doc_id AS id, CAST(length(body) AS INTEGER) AS body_chars, CAST(i AS INTEGER) AS chunk_idx,
  substring(body, CAST(i * 40000 + 1 AS BIGINT), 40000) AS body FROM c""")
def mail_bodies(spark, sf_dir):
    """A10 + A11 + B27 + B28 + S42: decode the HTML part (base64url), take the
    plain part or, when it is under 50 characters, the HTML as text; strip a
    forward header; the whole body in pieces of at most 40,000 characters."""
    from tessera.sources.pages import mail_body, mail_html
    m = mail_input(spark, sf_dir)
    x = m.select("id", mail_body(F.col("plain"), mail_html(F.col("parts"))).alias("b"))
    return x.select("id", F.length("b").alias("body_chars"), F.posexplode(tx.text_chunks("b", 40000)).alias("chunk_idx", "body"))


def scholarship_answers_input(spark, sf_dir):
    """Stored scholarship answers, one per event: a fenced JSON array of two
    items made from the event; view events lack an amount, click events with
    an even value lack a closing date, error events answer with prose."""
    e = read_table(spark, sf_dir, "events")
    item = lambda i: F.struct(
        F.concat(F.lit(f"{i}. "), F.initcap("event_type"), F.lit(" Award "), F.col("user_id").cast("string")).alias("title"),
        F.concat(F.lit("Fund "), F.col("user_id").cast("string")).alias("sponsor"),
        F.when(F.col("event_type") == "view", F.lit("")).otherwise(
            F.concat(F.lit("$"), F.format_string("%.2f", F.col("value") * i))).alias("amount"),
        F.when((F.col("event_type") == "click") & (F.floor("value") % 2 == 0), F.lit("")).otherwise(
            F.date_format(F.date_add("ts", 30 * i), "yyyy-MM-dd")).alias("closing_date"),
        F.concat(F.lit("https://aid.example.org/"), F.col("event_id").cast("string"), F.lit("/"), F.lit(i)).alias("link"))
    arr = F.to_json(F.array(item(1), item(2)))
    content = F.when(F.col("event_type") == "error", F.lit("Sorry, no scholarships found.")).otherwise(
        F.concat(F.lit("```json\n"), arr, F.lit("\n```")))
    env = F.to_json(F.struct(F.array(F.struct(F.struct(content.alias("content")).alias("message"))).alias("choices")))
    return e.select(F.col("event_id").alias("msg_id"), env.alias("response"))


@register("scholarship_items", """
WITH a AS (SELECT event_id AS msg_id, event_type,
    '[' || string_agg('{"title":"' || i || '. ' || upper(substring(event_type, 1, 1)) || substring(event_type, 2) || ' Award ' || user_id ||
      '","sponsor":"Fund ' || user_id || '","amount":"' ||
      CASE WHEN event_type = 'view' THEN '' ELSE '$' || printf('%.2f', value * i) END ||
      '","closing_date":"' || CASE WHEN event_type = 'click' AND floor(value) % 2 = 0 THEN '' ELSE strftime(ts + to_days(30 * i), '%Y-%m-%d') END ||
      '","link":"https://aid.example.org/' || event_id || '/' || i || '"}', ',' ORDER BY i) || ']' AS arr
    FROM events, range(1, 3) t(i) GROUP BY event_id, event_type, user_id, value, ts),
c AS (SELECT msg_id, CASE WHEN event_type = 'error' THEN 'Sorry, no scholarships found.' ELSE '```json' || chr(10) || arr || chr(10) || '```' END AS content FROM a),
b AS (SELECT msg_id, regexp_replace(regexp_replace(trim(regexp_replace(content, '^`+|`+$', '', 'g')), '^json', ''), '[\\r\\n]', '', 'g') AS body FROM c),
v AS (SELECT msg_id, body FROM b WHERE json_valid(body) AND json_type(body) = 'ARRAY'),
u AS (SELECT msg_id, unnest(json_extract(body, '$[*]')) AS e, generate_subscripts(json_extract(body, '$[*]'), 1) - 1 AS item_idx FROM v)
SELECT msg_id, CAST(item_idx AS INTEGER) AS item_idx,
  coalesce(json_extract_string(e, '$.title'), '') AS title, coalesce(json_extract_string(e, '$.sponsor'), '') AS sponsor,
  coalesce(json_extract_string(e, '$.amount'), '') AS amount, coalesce(json_extract_string(e, '$.closing_date'), '') AS closing_date,
  coalesce(json_extract_string(e, '$.description'), '') AS description, coalesce(json_extract_string(e, '$.link'), '') AS link,
  coalesce(json_extract_string(e, '$.how_to_apply'), '') AS how_to_apply, coalesce(json_extract_string(e, '$.eligibility'), '') AS eligibility,
  coalesce(json_extract_string(e, '$.type'), '') AS type, coalesce(json_extract_string(e, '$.location'), '') AS location,
  coalesce(json_extract_string(e, '$.application_window'), '') AS application_window
FROM u WHERE json_type(e) = 'OBJECT'
  AND trim(coalesce(json_extract_string(e, '$.closing_date'), '')) <> '' AND trim(coalesce(json_extract_string(e, '$.amount'), '')) <> ''""")
def scholarship_items(spark, sf_dir):
    """M2 + M4 + M7 + M9: answers -> fence strip -> strict JSON array ->
    items with an amount and a closing date -> the 11 sheet columns."""
    from tessera.operators.answers import scholarship_rows
    return scholarship_rows(scholarship_answers_input(spark, sf_dir), ["msg_id"])


_CAMP_TEMPLATE = "Extract the camp name, dates, ages and cost as JSON from:\n{snippet}"


@register("camp_requests", f"""
WITH c AS (SELECT page_id, {SQL_CLEAN_HTML} AS h FROM pages),
s AS (SELECT page_id, string_split(regexp_replace(h, '<(p|li|div)([\\s>])', chr(1) || '<\\1\\2', 'g'), chr(1)) AS parts FROM c),
u AS (SELECT page_id, unnest(parts[2:]) AS piece, generate_subscripts(parts[2:], 1) AS k FROM s),
t AS (SELECT page_id, k, CASE
        WHEN starts_with(piece, '<li') THEN regexp_extract(piece, '(?s)^(.*?)(?:</li>|</(?:ul|ol)>|$)', 1)
        WHEN starts_with(piece, '<div') THEN regexp_extract(piece, '(?s)^(.*?)(?:</div>|$)', 1)
        ELSE regexp_extract(piece, '(?s)^(<p.*?)(?:</p>|<(?:{_P_BLOCK})[\\s/>]|</(?:{_P_CONTAINER_END})>|$)', 1) END AS content FROM u),
x AS (SELECT page_id, k, {sql_strip(sql_decode(sql_strip_tags("content")))} AS line FROM t),
r AS (SELECT page_id, string_agg(line, chr(10) ORDER BY k) AS s
      FROM x WHERE line <> '' AND {_relevant_sql("line")} GROUP BY page_id),
a AS (SELECT p.page_id, coalesce(r.s, '') AS s FROM pages p LEFT JOIN r USING (page_id)),
i AS (SELECT page_id, s, unnest(range(0, greatest(CAST(ceil(length(s) / 5000.0) AS BIGINT), 1))) AS i FROM a),
q AS (SELECT page_id, CAST(i AS INTEGER) AS chunk_idx, substring(s, CAST(i * 5000 + 1 AS BIGINT), 5000) AS snippet FROM i)
SELECT page_id, chunk_idx, replace('{_CAMP_TEMPLATE.replace(chr(10), "' || chr(10) || '")}', '{{snippet}}', snippet) AS prompt FROM q""")
def camp_requests(spark, sf_dir):
    """B1 + B24 + S42 + M1: relevant ``p``/``li``/``div`` lines of every page
    (document order, pieces of at most 5,000 characters) -> a model request
    each; a page without a relevant line still gives one."""
    from tessera.operators.answers import build_requests
    from tessera.operators.extract import relevant_lines_nodes
    pages = _pages(spark, sf_dir)
    nodes = hx.html_nodes(pages, text_tags={"p", "li", "div"}, tags={"p", "li", "div"})
    return build_requests(relevant_lines_nodes(nodes, pages), ["page_id", "chunk_idx"], "snippet", _CAMP_TEMPLATE)


@register("substring_search", """
WITH w AS (SELECT DISTINCT unnest(string_split(p_name, ' ')) AS name FROM part),
m AS (SELECT min(p_partkey) AS row_id, p_name AS master_name FROM part GROUP BY p_name)
SELECT w.name, m.row_id, m.master_name FROM w JOIN m ON contains(lower(m.master_name), lower(w.name))
WHERE length(trim(w.name)) > 0""")
def substring_search(spark, sf_dir):
    """Every master name containing a search text (each word used in
    part names), via the n-gram-blocked join, no nested loop."""
    from tessera.operators.match import substring_candidates
    left, master = match_input(spark, sf_dir)
    words = read_table(spark, sf_dir, "part").select(F.explode(F.split("p_name", " ")).alias("name")).distinct()
    return substring_candidates(words, master, name="name", k=None, score=False)


@register("fuzzy_threshold_topk", f"""
WITH {_SQL_MATCH_INPUT},
lt AS (SELECT p_partkey, name, {sql_tokens("name")} AS t FROM l),
mt AS (SELECT row_id, master_name, {sql_tokens("master_name")} AS t FROM m),
s AS (SELECT p_partkey, row_id, master_name, {sql_jaccard("lt.t", "mt.t")} AS score FROM lt, mt),
r AS (SELECT *, row_number() OVER (PARTITION BY p_partkey ORDER BY score DESC, row_id) AS rank
      FROM s WHERE score >= 0.5)
SELECT l.p_partkey, CAST(r.rank AS INTEGER) AS rank, r.row_id, r.master_name, round(r.score, 6) AS score
FROM l LEFT JOIN r ON l.p_partkey = r.p_partkey AND r.rank <= 3""")
def fuzzy_threshold_topk(spark, sf_dir):
    """S27 + E2/G3 with a minimum score: top-3 masters with word Jaccard >=
    0.5 per scraped name, candidates from prefix-filtered token blocking
    (exact above the threshold)."""
    from tessera.operators.match import fuzzy_topk
    left, master = match_input(spark, sf_dir)
    out = fuzzy_topk(left.select("p_partkey", "name"), master, k=3, name="name", scorer="jaccard", min_score=0.5)
    return out.select("p_partkey", "rank", "row_id", "master_name", F.round("score", 6).alias("score"))


def _sql_text_counts() -> str:
    from tessera.functions.roster import POSITION_BUCKETS, POSITION_MAP
    parts = []
    for code, bucket in POSITION_BUCKETS.items():
        terms = []
        for w in [w for w, c in POSITION_MAP.items() if c == code]:
            if " " in w:
                terms.append(f"CASE WHEN regexp_matches(low, '(^|[^\\p{{L}}\\p{{N}}_]){w}([^\\p{{L}}\\p{{N}}_]|$)') THEN 1 ELSE 0 END")
            else:
                terms.append(f"CASE WHEN list_contains(tok, '{w}') THEN 1 ELSE 0 END")
        parts.append(f"CAST(sum({' + '.join(terms)}) AS BIGINT) AS {bucket}")
    for y in ["freshman", "sophomore", "junior", "senior"]:
        parts.append(f"count(*) FILTER (WHERE contains(low, '{y}')) AS {y}")
    return ",\n  ".join(parts)


@register("roster_text_counts", f"""
WITH d AS (SELECT source, lower(coalesce(text, '')) AS low FROM documents),
t AS (SELECT source, low, {sql_tokens("low")} AS tok FROM d)
SELECT source,
  {_sql_text_counts()}
FROM t GROUP BY source""")
def roster_text_counts(spark, sf_dir):
    """F3 (D5): position and class-year word counts over whole card texts
    (each document is a card, its source the team)."""
    from tessera.operators.aggregate import text_roster_counts
    d = read_table(spark, sf_dir, "documents").select("source", "text")
    return text_roster_counts(d, ["source"])
