"""Field extraction from the node table.

Every operator here is native DataFrame code over ``html_nodes`` output;
the only Python left is B1 itself (and ``url_join`` for rare relative links).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from tessera.functions.common import at

from tessera.functions import events as ev
from tessera.functions import facts as fa
from tessera.functions import roster as ro
from tessera.functions.text import clean_text, strip, text_chunks
from tessera.functions.urls import url_join
from tessera.operators import html as hx


def first_text(nodes: DataFrame, tag: str, out: str) -> DataFrame:
    """Text of the first element with ``tag`` per page, trimmed (map-only)."""
    return nodes.filter((F.col("tag") == tag) & (F.col("tag_idx") == 0)).select(
        "page_id", strip(F.col("text")).alias(out))


def first_texts(nodes: DataFrame, tags: dict[str, str]) -> DataFrame:
    """Texts of the first element of several tags per page, trimmed: ``tags``
    maps a tag to its output column.  One aggregate over the node table."""
    x = nodes.filter(F.col("tag").isin(*tags) & (F.col("tag_idx") == 0))
    return x.groupBy("page_id").agg(*[F.min_by(F.when(F.col("tag") == t, strip(F.col("text"))),
                                               F.when(F.col("tag") == t, F.col("node_id"))).alias(c) for t, c in tags.items()])


def first_matching_text(nodes: DataFrame, cond: Column, out: str) -> DataFrame:
    """First text chunk per page satisfying ``cond`` (own text of elements,
    document order): ``min_by`` per page, a partial aggregate."""
    x = nodes.filter(F.col("own_text").isNotNull() & cond)
    return x.groupBy("page_id").agg(F.min_by(strip(F.col("own_text")), F.col("node_id")).alias(out))


# ------------------------------------------------------------------ B21 camp page

def camp_page_fields(nodes: DataFrame, pages: DataFrame) -> DataFrame:
    """Camp page -> title (first h1), city/state from ``.location``, ages,
    date and cost texts, then S21 grade levels, S22 gender, S25 date range.
    Misses keep the reference's defaults ('Unknown Camp Name', 'Not listed')."""
    # one aggregate over the node table: the first element that meets each rule
    own, held = F.coalesce(F.col("own_text"), F.lit("")), F.col("own_text").isNotNull()
    rules = {"camp_name": (F.col("tag") == "h1") & (F.col("tag_idx") == 0), "_loc": hx.has_class("location"),
             "_ages": held & F.lower(own).contains("ages"), "_date": held & F.lower(own).contains("date"),
             "_cost": held & own.contains("$")}
    value = {"camp_name": "text", "_loc": "text", "_ages": "own_text", "_date": "own_text", "_cost": "own_text"}
    found = nodes.groupBy("page_id").agg(*[F.min_by(F.when(c, strip(F.col(value[k]))), F.when(c, F.col("node_id"))).alias(k)
                                           for k, c in rules.items()])
    x = pages.select("page_id", "url").join(found, "page_id", "left")
    cs = ev.split_city_state(F.col("_loc"))
    age = F.when(F.col("_ages").isNotNull(), ev.after_last_colon(F.col("_ages"))).otherwise(F.lit("Not listed"))
    dt = F.when(F.col("_date").isNotNull(), ev.after_last_colon(F.col("_date"))).otherwise(F.lit("Not listed"))
    rng = ev.split_date_range(dt)
    name = F.coalesce(F.col("camp_name"), F.lit("Unknown Camp Name"))
    return x.select(
        "page_id", "url", name.alias("camp_name"),
        F.when(F.col("_loc").isNotNull(), cs["city"]).otherwise(F.lit("")).alias("city"),
        F.when(F.col("_loc").isNotNull(), cs["state"]).otherwise(F.lit("")).alias("state"),
        age.alias("ages"), dt.alias("date"), rng["start_date"].alias("start_date"), rng["end_date"].alias("end_date"),
        F.coalesce(F.col("_cost"), F.lit("Not listed")).alias("cost"),
        ev.grade_levels(age).alias("grade_level"), ev.gender_from_title(name).alias("gender"))


# ------------------------------------------------------------------ B24 relevant lines

# Words that make a text block relevant for the camp snippet.
RELEVANT_WORDS = ["camp", "date", "session", "ages", "$", "–", "to", "through"]


def is_relevant(text: Column) -> Column:
    """B24 predicate: lower-case text contains a keyword or any digit."""
    t = F.lower(text)
    c = t.rlike("[0-9]")
    for w in RELEVANT_WORDS:
        c = c | t.contains(w)
    return c


def relevant_lines_nodes(nodes: DataFrame, pages: DataFrame, size: int = 5000) -> DataFrame:
    """B24 on pages: text of ``p``, ``li``, ``div`` blocks that are relevant,
    trimmed, joined by newline in document order, in pieces of at most
    ``size`` characters (``chunk_idx``).  Every page of ``pages`` gives a
    piece, an empty one where no block is relevant."""
    x = nodes.filter(F.col("tag").isin("p", "li", "div")).withColumn("_t", strip(F.col("text")))
    x = x.filter((F.coalesce(F.col("text"), F.lit("")) != "") & is_relevant(F.col("_t")))
    g = x.groupBy("page_id").agg(F.array_sort(F.collect_list(F.struct("node_id", "_t"))).alias("_l"))
    g = g.select("page_id", F.array_join(F.transform("_l", lambda s: s["_t"]), "\n").alias("_s"))
    x = pages.select(F.col("page_id").cast("long").alias("page_id")).join(g, "page_id", "left")
    return x.select("page_id", F.posexplode(text_chunks("_s", size)).alias("chunk_idx", "snippet"))


def relevant_lines_text(text: Column) -> Column:
    """B24 on plain text: the relevant lines as an array, trimmed (one row
    in, one row out; no shuffle)."""
    lines = F.transform(F.split(F.coalesce(text, F.lit("")), "\n"), lambda l: strip(l))
    return F.filter(lines, lambda l: (l != "") & is_relevant(l))


# ------------------------------------------------------------------ rosters

def is_sidearm(nodes: DataFrame) -> DataFrame:
    """Generator meta mentions sidearm, or a class / script src does."""
    gen = F.lower(F.coalesce(F.col("attrs")["content"], F.lit("")))
    cond = (((F.col("tag") == "meta") & (F.lower(F.coalesce(F.col("attrs")["name"], F.lit(""))) == "generator")
             & gen.contains("sidearm"))
            | F.lower(F.coalesce(F.col("attrs")["class"], F.lit(""))).contains("sidearm")
            | ((F.col("tag") == "script") & F.lower(F.coalesce(F.col("attrs")["src"], F.lit(""))).contains("sidearm")))
    return nodes.groupBy("page_id").agg(F.bool_or(cond).alias("sidearm"))


def _year_from_text(t: Column) -> Column:
    """B17/B18 fallback: the level of the first class-year word (YEAR_MAP
    order) found in the text; decision D18: on token boundaries, so ``so``
    does not hit ``soccer``."""
    low = F.lower(F.coalesce(t, F.lit("")))
    out = F.lit(None).cast("string")
    for k, v in reversed(list(ro.YEAR_MAP.items())):
        rx = r"(?<![\p{L}\p{N}_])" + k.replace(".", r"\.") + r"(?![\p{L}\p{N}_])"
        out = F.when(low.rlike(rx), F.lit(v)).otherwise(out)
    return out


def _year_map():
    return F.create_map(*[F.lit(x) for kv in ro.YEAR_MAP.items() for x in kv])


def _pos_map():
    return F.create_map(*[F.lit(x) for kv in ro.POSITION_MAP.items() for x in kv])


# Fixed value: the label of a position.
_LABEL_RE = r"(?i)^\s*(pos|position)\s*[:\-]\s*"


def _inside(nodes: DataFrame, owners: DataFrame, owner_col: str) -> DataFrame:
    """Descendants of the owner elements (via the ancestor chain)."""
    d = nodes.select("page_id", F.explode("ancestor_ids").alias(owner_col), "node_id", "tag", "attrs", "text", "own_text")
    return d.join(owners.select("page_id", owner_col), ["page_id", owner_col], "left_semi")


def sidearm_players(nodes: DataFrame) -> DataFrame:
    """One player per ``li.sidearm-roster-player`` / ``-item``.
    Position: the first ``.sidearm-roster-player-position``, ``.position`` or
    ``[data-player-position]`` element, else the first ``div/span/p`` whose
    text starts with a ``pos:`` label, else the first position token of the
    card; all through ``canon_pos``.  Year: the
    ``.sidearm-roster-player-academic-year`` element through YEAR_MAP, else
    the first class-year word of the card."""
    li = nodes.filter((F.col("tag") == "li") & (hx.has_class("sidearm-roster-player") | hx.has_class("sidearm-roster-item"))) \
        .select("page_id", F.col("node_id").alias("li_id"), clean_text(F.col("text")).alias("card"))
    inner = _inside(nodes, li, "li_id")
    pos_el = (inner.filter(hx.has_class("sidearm-roster-player-position") | hx.has_class("position")
                           | F.col("attrs")["data-player-position"].isNotNull())
              .groupBy("page_id", "li_id").agg(F.min_by(clean_text(F.col("text")), F.col("node_id")).alias("_pos")))
    lab = (inner.filter(F.col("tag").isin("div", "span", "p")).withColumn("_t", clean_text(F.col("text")))
           .filter(F.col("_t").rlike(_LABEL_RE))
           .groupBy("page_id", "li_id").agg(F.min_by(F.regexp_replace("_t", _LABEL_RE, ""), F.col("node_id")).alias("_lab")))
    yr = (inner.filter(hx.has_class("sidearm-roster-player-academic-year")).groupBy("page_id", "li_id")
          .agg(F.min_by(F.lower(clean_text(F.col("text"))), F.col("node_id")).alias("_yr")))
    x = li.join(pos_el, ["page_id", "li_id"], "left").join(lab, ["page_id", "li_id"], "left") \
        .join(yr, ["page_id", "li_id"], "left")
    tok = ro.position_token(F.col("card"))
    position = (F.when(F.col("_pos").isNotNull(), ro.canon_pos(F.col("_pos")))
                .when(F.col("_lab").isNotNull(), ro.canon_pos(F.col("_lab")))
                .when(tok != "", ro.canon_pos(tok)).otherwise(F.lit("")))
    year = F.when(F.col("_yr").isNotNull(), F.coalesce(at(_year_map(), F.col("_yr")), F.col("_yr"))) \
        .otherwise(F.coalesce(_year_from_text(F.col("card")), F.lit("")))
    return x.select("page_id", F.col("li_id").alias("player_id"), position.alias("position"), year.alias("year"))


def data_field_players(nodes: DataFrame) -> DataFrame:
    """Every ``tr`` of the first ``.roster-data`` element; position from
    ``td[data-field=position]`` own text through POSITION_MAP (unknown text
    kept); year from ``td[data-field=year]`` own text (lower case) through
    YEAR_MAP, else the first class-year word of the row.  Header rows give
    empty players, as in the reference."""
    box = nodes.filter(hx.has_class("roster-data")).groupBy("page_id").agg(F.min("node_id").alias("box_id"))
    tr = (nodes.filter(F.col("tag") == "tr").select("page_id", F.col("node_id").alias("tr_id"), "ancestor_ids",
                                                   clean_text(F.col("text")).alias("row_text"))
          .join(box, "page_id").filter(F.array_contains("ancestor_ids", F.col("box_id"))).drop("ancestor_ids", "box_id"))
    td = nodes.filter(F.col("tag") == "td").select(
        "page_id", hx.nearest_ancestor("tr").alias("tr_id"), "node_id",
        F.col("attrs")["data-field"].alias("field"), strip(F.coalesce(F.col("own_text"), F.lit(""))).alias("v"))
    f = (td.filter(F.col("field").isin("position", "year")).groupBy("page_id", "tr_id")
         .agg(F.min_by(F.when(F.col("field") == "position", F.col("v")),
                       F.when(F.col("field") == "position", F.col("node_id"))).alias("_pos"),
              F.min_by(F.when(F.col("field") == "year", F.lower(F.col("v"))),
                       F.when(F.col("field") == "year", F.col("node_id"))).alias("_yr")))
    x = tr.join(f, ["page_id", "tr_id"], "left")
    position = F.coalesce(at(_pos_map(), F.col("_pos")), F.col("_pos"), F.lit(""))
    year = F.when(F.col("_yr").isNotNull(), F.coalesce(at(_year_map(), F.col("_yr")), F.col("_yr"))) \
        .otherwise(F.coalesce(_year_from_text(F.col("row_text")), F.lit("")))
    return x.select("page_id", F.col("tr_id").alias("player_id"), position.alias("position"), year.alias("year"))


def roster_nodes(pages: DataFrame) -> DataFrame:
    """B1 for rosters: the nodes of ``pages`` with the text of rows, cards and
    what lies in cards, which is all that B17 and B18 read."""
    return hx.html_nodes(pages.select("page_id", "html"), text_when=lambda tag, attrs, above: tag in ("li", "tr") or "li" in above)


def camp_nodes(pages: DataFrame) -> DataFrame:
    """B1 for camp pages: with the text of ``h1`` and ``.location``."""
    place = hx.in_class("location")
    return hx.html_nodes(pages, text_when=lambda tag, attrs, above: tag == "h1" or place(tag, attrs, above))


def roster_players(nodes: DataFrame) -> DataFrame:
    """B19 + V1: route each page to the Sidearm or the data-field extractor
    (the extractor registry is the page-kind test)."""
    kind = is_sidearm(nodes)
    side = sidearm_players(nodes).join(kind.filter("sidearm"), "page_id", "left_semi")
    other = data_field_players(nodes).join(kind.filter(~F.col("sidearm")), "page_id", "left_semi")
    return side.unionByName(other)


# ------------------------------------------------------------------ rankings

def rankings_from_rows(rows: DataFrame) -> DataFrame:
    """(rank, name) per table row from its ``td`` cells (rows with at
    least 2): rank text in cell 0 (name = cell 1); else, with 4+ cells, in
    cell 1 (name = cell 3); else the first of the first 3 cells that starts
    with 1-2 digits, the name being the first non-empty cell with another
    text.  Rank = the leading 1-2 digits; rows without a name are dropped."""
    z = F.arrays_zip(F.col("cells").alias("c"), F.col("tags").alias("t"))
    td = F.transform(F.filter(z, lambda e: e["t"] == "td"), lambda e: e["c"])
    lead = lambda s: F.regexp_extract(F.coalesce(s, F.lit("")), r"^\s*([0-9]{1,2})", 1)
    x = rows.withColumn("_td", td).withColumn("_n", F.size("_td"))
    c = lambda i: at(F.col("_td"), i + 1)
    rt3 = at(F.filter(F.slice(F.col("_td"), 1, 3), lambda v: lead(v) != ""), 1)
    name3 = at(F.filter(F.col("_td"), lambda v: (strip(v) != "") & (v != rt3)), 1)
    p1 = lead(c(0)) != ""
    p2 = (F.col("_n") >= 4) & (lead(c(1)) != "")
    rank_text = F.when(p1, c(0)).when(p2, c(1)).otherwise(rt3)
    name = F.when(p1, c(1)).when(p2, c(3)).otherwise(F.when(rt3.isNotNull(), name3))
    out = x.filter(F.col("_n") >= 2).select(*rows.columns, lead(rank_text).try_cast("int").alias("rank"),
                                            strip(F.coalesce(name, F.lit(""))).alias("name"))
    return out.filter(F.col("rank").isNotNull() & (F.col("name") != ""))


# Fixed value: a text line that holds a rank and a name, and the characters of a name.
RANK_LINE = r"^\s*(\d{1,2})[\.)]\s*([A-Za-z0-9&'\".\- ,/]{3,120})$"


def rankings_from_lines(pages_text: DataFrame, text: str = "text") -> DataFrame:
    """``1. Name`` / ``1) Name`` lines of the page text, one text chunk a
    line; names of less than two characters are dropped."""
    x = pages_text.select("page_id", F.posexplode_outer(F.split(F.col(text), "\n")).alias("pos", "line"))
    x = x.filter(F.col("line").rlike(RANK_LINE)).select(
        "page_id", "pos", F.regexp_extract("line", RANK_LINE, 1).cast("int").alias("rank"),
        strip(F.regexp_extract("line", RANK_LINE, 2)).alias("name"))
    return x.filter(F.length("name") >= 2)


# Classes that mark team names on ranking pages.
TEAM_CLASSES = ["team-name", "team", "school", "rank-team"]


def rankings_from_elements(nodes_sep: DataFrame) -> DataFrame:
    """B13 (element text): on pages that have a team-name element with text,
    every ``div``/``li``/``tr``/``p`` whose text (chunks joined by a space,
    ``html_nodes(text_sep=' ')``) reads ``12. Name`` / ``12 Name``."""
    team = nodes_sep.filter(F.exists(F.split(F.coalesce(F.col("attrs")["class"], F.lit("")), r"\s+"),
                                     lambda c: c.isin(TEAM_CLASSES)) & (strip(F.coalesce("text", F.lit(""))) != ""))
    pages = team.select("page_id").distinct()
    rx = r"^([0-9]{1,2})[\.)]?\s+(.*)$"
    el = nodes_sep.filter(F.col("tag").isin("div", "li", "tr", "p")).withColumn("_t", strip(F.coalesce("text", F.lit(""))))
    el = el.filter(F.col("_t").rlike(rx)).join(pages, "page_id", "left_semi")
    return el.select("page_id", F.col("node_id").alias("pos"), F.regexp_extract("_t", rx, 1).cast("int").alias("rank"),
                     strip(F.regexp_extract("_t", rx, 2)).alias("name"))


def rankings_from_anchors(nodes_nosep: DataFrame) -> DataFrame:
    """B13 (anchors): links whose text (stripped chunks joined with no
    separator, ``html_nodes(text_sep='')``) is longer than 3 characters and
    reads ``#12 - Name`` / ``12: Name``."""
    rx = r"^#?([0-9]{1,2})\s*[-.:)]\s*(.+)$"
    a = nodes_nosep.filter(F.col("tag") == "a").withColumn("_t", F.coalesce("text", F.lit("")))
    a = a.filter((F.length("_t") > 3) & F.col("_t").rlike(rx))
    return a.select("page_id", F.col("node_id").alias("pos"), F.regexp_extract("_t", rx, 1).cast("int").alias("rank"),
                    strip(F.regexp_extract("_t", rx, 2)).alias("name"))


def dedup_rankings(r: DataFrame) -> DataFrame:
    """Keep the first (rank, lower(name)) per page, sorted by rank then
    position (stable)."""
    w = Window.partitionBy("page_id", "rank", F.lower("name")).orderBy("pos")
    return r.withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n")


def first_strategy(results: DataFrame, priority: str = "strategy") -> DataFrame:
    """Per page keep the rows of the first strategy that produced any."""
    w = Window.partitionBy("page_id")
    return results.withColumn("_best", F.min(priority).over(w)).filter(F.col(priority) == F.col("_best")).drop("_best")


# ------------------------------------------------------------------ standings

def block_nodes(pages: DataFrame) -> DataFrame:
    """B1 for B10: the nodes of ``pages`` with the text of cells, headings and links."""
    return hx.html_nodes(pages, text_tags={"td", "a", "h1", "h2", "h3", "h4"})


def positional_standings(nodes: DataFrame) -> DataFrame:
    """Rows with at least two ``td`` cells and a school, read by position:
    ``page_id, pos, conference, standing, school, conf_record,
    overall_record``.  A row that holds other rows (layout) is no row.

    The conference is the title that is open at the row (decision D14: a
    heading, else a link, else the own text of a ``div`` of class title or
    header).  A title belongs to the innermost element around it in which a
    row follows, so a heading inside a header box reaches the rows beside the
    box, and a title of a nested block ends with that block.  Of the open
    titles the one of the innermost block counts, then the last heading, the
    first link, the last title box.  One sweep in document order over the
    titles and rows of each block; titles inside rows do not count."""
    root = lambda a: F.concat(F.array(F.lit(-1)), a)
    td = nodes.filter(F.col("tag") == "td").select("page_id", "node_id", hx.nearest_ancestor("tr").alias("tr_id"),
                                                   clean_text(F.coalesce(F.col("text"), F.lit(""))).alias("c"))
    cells = td.filter(F.col("tr_id").isNotNull()).groupBy("page_id", "tr_id").agg(F.array_sort(F.collect_list(F.struct("node_id", "c"))).alias("cs"))
    trs = nodes.filter(F.col("tag") == "tr").select("page_id", F.col("node_id").alias("tr_id"), root(F.col("ancestor_ids")).alias("above"),
                                                   hx.nearest_ancestor("tr").alias("outer_tr"))
    layout = trs.filter(F.col("outer_tr").isNotNull()).select("page_id", F.col("outer_tr").alias("tr_id")).distinct()
    rows = trs.drop("outer_tr").join(cells, ["page_id", "tr_id"]).filter(F.size("cs") >= 2).join(layout, ["page_id", "tr_id"], "left_anti")
    text = lambda c: F.nullif(clean_text(F.coalesce(F.col(c), F.lit(""))), F.lit(""))
    cls = F.lower(F.coalesce(F.col("attrs")["class"], F.lit("")))
    heading, link = F.col("tag").isin("h1", "h2", "h3", "h4"), F.col("tag") == "a"
    box = (F.col("tag") == "div") & (cls.contains("title") | cls.contains("header"))
    titles = nodes.filter(heading | link | box).select(
        "page_id", "node_id", root(F.col("ancestor_ids")).alias("above"), hx.nearest_ancestor("tr").alias("tr_id"),
        F.when(heading, text("text")).alias("h"), F.when(link, text("text")).alias("a"), F.when(box, text("own_text")).alias("d"))
    titles = titles.filter(F.coalesce("h", "a", "d").isNotNull()).join(rows.select("page_id", "tr_id"), ["page_id", "tr_id"], "left_anti")
    # the last row below every element, and from it the block of each title
    below = rows.select("page_id", "tr_id", F.posexplode("above").alias("depth", "block"))
    last = below.groupBy("page_id", "block").agg(F.max("tr_id").alias("last"))
    scope = (titles.select("page_id", "node_id", "h", "a", "d", F.posexplode("above").alias("depth", "block")).join(last, ["page_id", "block"])
                   .filter(F.col("last") > F.col("node_id")).groupBy("page_id", "node_id")
                   .agg(F.max_by(F.struct("block", "h", "a", "d"), "depth").alias("s")).select("page_id", "node_id", "s.*"))
    none = F.lit(None).cast("string")
    blocks = scope.select("page_id", "block").distinct()
    events = (below.join(blocks, ["page_id", "block"], "left_semi").select("page_id", "block", F.col("tr_id").alias("node_id"), "depth", none.alias("h"),
                                                                          none.alias("a"), none.alias("d"))
                   .unionByName(scope.withColumn("depth", F.lit(None).cast("int"))))
    w = Window.partitionBy("page_id", "block").orderBy("node_id").rowsBetween(Window.unboundedPreceding, 0)
    swept = events.select("page_id", "node_id", "depth", F.last("h", ignorenulls=True).over(w).alias("h"),
                          F.first("a", ignorenulls=True).over(w).alias("a"), F.last("d", ignorenulls=True).over(w).alias("d"))
    best = swept.filter(F.col("depth").isNotNull()).groupBy("page_id", F.col("node_id").alias("tr_id")).agg(
        *[F.max_by(c, F.when(F.col(c).isNotNull(), F.col("depth"))).alias(c) for c in ("h", "a", "d")])
    out = rows.select("page_id", "tr_id", F.transform("cs", lambda x: x["c"]).alias("cells")).join(best, ["page_id", "tr_id"], "left")
    cell = lambda i: F.coalesce(F.try_element_at("cells", F.lit(i)), F.lit(""))
    return out.select("page_id", F.col("tr_id").alias("pos"), F.coalesce("h", "a", "d", F.lit("")).alias("conference"), cell(1).alias("standing"),
                      cell(2).alias("school"), cell(3).alias("conf_record"), cell(4).alias("overall_record")).filter(F.col("school") != "")


# ------------------------------------------------------------------ JSON-LD

# Schema.org types kept as events.
EVENT_TYPES = ["Event", "SportsEvent"]


def jsonld_events(nodes: DataFrame) -> DataFrame:
    """Every ``script[type=application/ld+json]``; object or array; keep
    ``@type`` in Event/SportsEvent; 13 columns.  Bad JSON is dropped; an
    organizer/location that is not an object gives nulls (decision D23)."""
    s = nodes.filter((F.col("tag") == "script")
                     & (F.lower(F.coalesce(F.col("attrs")["type"], F.lit(""))) == "application/ld+json"))
    v = F.try_parse_json(F.col("own_text"))
    s = s.select("page_id", "node_id", v.alias("v")).filter(F.col("v").isNotNull())
    arr = F.when(F.schema_of_variant(F.col("v")).startswith("ARRAY"),
                 F.try_variant_get(F.col("v"), "$", "array<variant>")).otherwise(F.array(F.col("v")))
    e = s.select("page_id", "node_id", F.posexplode_outer(arr).alias("i", "e")).filter(F.col("e").isNotNull())
    g = lambda path, t="string": F.try_variant_get(F.col("e"), path, t)
    e = e.filter(g("$['@type']").isin(EVENT_TYPES))
    desc = F.coalesce(g("$.description"), F.lit(""))
    name = F.coalesce(g("$.name"), F.lit(""))
    return e.select(
        "page_id", "node_id", "i",
        name.alias("name"),
        F.coalesce(g("$.organizer.name"), g("$.organizer"), F.lit("")).alias("organizer"),
        F.coalesce(g("$.url"), F.lit("")).alias("url"),
        F.coalesce(g("$.startDate"), F.lit("")).alias("start_date"),
        F.coalesce(g("$.endDate"), F.lit("")).alias("end_date"),
        ev.to_unix(g("$.startDate")).alias("start_unix"),
        ev.to_unix(g("$.endDate")).alias("end_unix"),
        g("$.location.geo.latitude", "double").alias("lat"),
        g("$.location.geo.longitude", "double").alias("lng"),
        F.coalesce(g("$.location.address.streetAddress"), g("$.location.address"), F.lit("")).alias("address"),
        F.coalesce(g("$.offers.price"), g("$.offers[0].price"), F.lit("")).alias("price"),
        ev.ages_from_text(F.concat_ws(" ", name, desc)).alias("ages"),
        ev.extract_division(F.concat_ws(" ", name, desc)).alias("division"))


# ------------------------------------------------------------------ facts

def _first_under(nodes: DataFrame, titles: DataFrame) -> DataFrame:
    """Per element: its first descendant title (document order), from the
    titles' ancestor chains (one row per title and ancestor, no pairs)."""
    t = titles.select("page_id", "t_id", "title", F.explode("ancestor_ids").alias("anc"))
    return t.groupBy("page_id", "anc").agg(F.min_by("title", "t_id").alias("title"))


def labelled_values(nodes: DataFrame, value_cls: str, title_cls: str, tag: str = "div") -> DataFrame:
    """Each value element (``tag.value_cls``) with its label: the nearest
    previous sibling title, else the nearest next sibling title, else the
    first title under the parent, else under the grandparent (a candidate
    with empty text passes to the next rule).  Siblings are found with
    windows over a parent's children and first-descendant titles with a
    per-ancestor aggregate: no pairs of elements are formed."""
    is_val = (F.col("tag") == tag) & hx.has_class(value_cls)
    is_tit = (F.col("tag") == tag) & hx.has_class(title_cls)
    kids = nodes.filter(is_val | is_tit).select(
        "page_id", "node_id", "parent_id", "sib_idx", "ancestor_ids", is_val.alias("is_val"),
        F.when(is_tit, clean_text(F.coalesce(F.col("text"), F.lit("")))).alias("t_text"))
    w = Window.partitionBy("page_id", "parent_id").orderBy("sib_idx")
    kids = (kids.withColumn("_prev", F.last("t_text", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1)))
            .withColumn("_next", F.first("t_text", ignorenulls=True).over(w.rowsBetween(1, Window.unboundedFollowing))))
    vals = kids.filter("is_val").select("page_id", F.col("node_id"), "parent_id", "_prev", "_next",
                                        at(F.col("ancestor_ids"), -2).alias("gp_id"))
    titles = kids.filter(F.col("t_text").isNotNull()).select("page_id", F.col("node_id").alias("t_id"),
                                                             F.col("t_text").alias("title"), "ancestor_ids")
    first = _first_under(nodes, titles)
    fp = first.select("page_id", F.col("anc").alias("parent_id"), F.col("title").alias("_par"))
    fg = first.select("page_id", F.col("anc").alias("gp_id"), F.col("title").alias("_gp"))
    x = vals.join(fp, ["page_id", "parent_id"], "left").join(fg, ["page_id", "gp_id"], "left")
    ne = lambda c: F.when(F.col(c) != "", F.col(c))
    title = F.coalesce(ne("_prev"), ne("_next"), ne("_par"), ne("_gp"), F.lit(""))
    vtext = nodes.filter(is_val).select("page_id", "node_id", clean_text(F.coalesce(F.col("text"), F.lit(""))).alias("value"))
    return x.select("page_id", "node_id", title.alias("title")).join(vtext, ["page_id", "node_id"])


def academic_facts(tv: DataFrame, nodes: DataFrame | None = None, undergrad_cls: str | None = None) -> DataFrame:
    """B20 per page from its (title, value) pairs in document order:
    a 'cost of attendance' title is skipped; under a 'tuition' title the
    value text decides: in-state -> in-state tuition (the last one wins),
    out-of-state -> out-of-state (last wins), any other amount fills both
    only where still empty (the first such wins); otherwise a decimal value
    or a 'gpa' title gives the GPA (the first one); last resort, the first
    ``d.dd`` token in any value.  Undergraduates: the first integer of the
    first ``div.undergrad_cls``."""
    t = F.lower(F.coalesce(F.col("title"), F.lit("")))
    v = F.lower(F.col("value"))
    money = fa.parse_currency(F.col("value"))
    skip = t.contains("cost of attendance")
    tuition = ~skip & t.contains("tuition")
    is_in = tuition & (v.contains("in-state") | v.contains("in state"))
    is_out = tuition & ~is_in & (v.contains("out-of-state") | v.contains("out of state") | v.contains("out-of state"))
    is_both = tuition & ~is_in & ~is_out & money.isNotNull()
    gpa_tok = fa.gpa_token(F.col("value"))
    is_gpa = ~skip & ~(is_in | is_out | is_both) & (fa.is_decimal_number(F.col("value")) | t.contains("gpa"))
    last_resort = fa.gpa_token(F.col("value"), strict=True)
    pick = lambda cond, val: F.when(cond & val.isNotNull(), F.col("node_id"))
    g = tv.groupBy("page_id").agg(
        F.max_by(F.when(is_in, money), pick(is_in, money)).alias("_in"),
        F.max_by(F.when(is_out, money), pick(is_out, money)).alias("_out"),
        F.min_by(F.when(is_both, money), pick(is_both, money)).alias("_both"),
        F.min_by(F.when(is_gpa, gpa_tok), pick(is_gpa, gpa_tok)).alias("_gpa"),
        F.min_by(last_resort, pick(F.lit(True), last_resort)).alias("_gpa2"))
    out = g.select("page_id", F.coalesce("_in", "_both").alias("in_state_tuition"),
                   F.coalesce("_out", "_both").alias("out_state_tuition"),
                   F.coalesce("_gpa", "_gpa2").alias("avg_gpa"))
    if nodes is not None and undergrad_cls:
        ug = (hx.select_nodes(nodes, tag="div", cls=undergrad_cls).groupBy("page_id")
              .agg(F.min_by(fa.first_integer(clean_text(F.col("text"))), F.col("node_id")).alias("undergraduates")))
        out = out.join(ug, "page_id", "full")
    return out


# ------------------------------------------------------------------ camp directory

def camp_directory(rec: DataFrame, nodes: DataFrame, pages: DataFrame, min_cells: int = 2,
                   link_cell: int = 2) -> DataFrame:
    """Table rows with >= ``min_cells`` cells and a link in cell
    ``link_cell`` (1-based): resolved camp URL and school name without a
    trailing ``Camp`` word (the cell text when the link text is blank)."""
    a = nodes.filter((F.col("tag") == "a") & F.col("attrs")["href"].isNotNull()).select(
        "page_id", hx.nearest_ancestor("td").alias("td_id"), hx.nearest_ancestor("tr").alias("tr_id"),
        "node_id", F.col("attrs")["href"].alias("href"), strip(F.col("text")).alias("a_text"))
    tds = nodes.filter(F.col("tag").isin("td", "th")).select(
        "page_id", F.col("node_id").alias("td_id"), hx.nearest_ancestor("tr").alias("tr_id"), "sib_idx")
    w = Window.partitionBy("page_id", "tr_id").orderBy("td_id")
    tds = tds.withColumn("cell_no", F.row_number().over(w))
    links = (a.join(tds, ["page_id", "td_id", "tr_id"]).filter(F.col("cell_no") == link_cell)
             .groupBy("page_id", "tr_id").agg(F.min_by(F.struct("href", "a_text"), F.col("node_id")).alias("l")))
    trs = nodes.filter(F.col("tag") == "tr").select("page_id", F.col("node_id").alias("tr_id"),
                                                   hx.nearest_ancestor("table").alias("table_id"))
    w2 = Window.partitionBy("page_id", "table_id").orderBy("tr_id")
    trs = trs.withColumn("tr_idx", F.row_number().over(w2) - 1)
    r = (rec.filter(F.size("cells") >= min_cells).join(trs, ["page_id", "table_id", "tr_idx"])
         .join(links, ["page_id", "tr_id"]).join(pages.select("page_id", "url"), "page_id"))
    cell_text = F.coalesce(F.try_element_at(F.col("cells"), F.lit(link_cell)), F.lit(""))
    school = F.when(strip(F.col("l.a_text")) != "", F.col("l.a_text")).otherwise(cell_text)
    return r.select("page_id", "tr_idx", F.regexp_replace(strip(school), r"\s+[Cc]amp$", "").alias("camp_school_name"),
                    url_join(F.col("url"), F.col("l.href")).alias("camp_url"), "cells")


def camp_list_seed(rows: DataFrame, nodes: DataFrame, pages: DataFrame) -> DataFrame:
    """Table rows with exactly two ``td`` cells: state = cell 1, host =
    cell 2 without a trailing ``Camp``, link = the first ``a`` of cell 2 ('' if
    none), gender from the page URL (``womens`` -> Women, else Men)."""
    z = F.arrays_zip(F.col("cells").alias("c"), F.col("tags").alias("t"))
    td = F.transform(F.filter(z, lambda e: e["t"] == "td"), lambda e: e["c"])
    r = rows.withColumn("_td", td).filter(F.size("_td") == 2)
    trs = nodes.filter(F.col("tag") == "tr").select("page_id", F.col("node_id").alias("tr_id"),
                                                   hx.nearest_ancestor("table").alias("table_id"))
    w = Window.partitionBy("page_id", "table_id").orderBy("tr_id")
    trs = trs.withColumn("tr_idx", F.row_number().over(w) - 1)
    tds = nodes.filter(F.col("tag") == "td").select("page_id", F.col("node_id").alias("td_id"),
                                                   hx.nearest_ancestor("tr").alias("tr_id"))
    wt = Window.partitionBy("page_id", "tr_id").orderBy("td_id")
    tds = tds.withColumn("cell_no", F.row_number().over(wt))
    a = nodes.filter(F.col("tag") == "a").select("page_id", hx.nearest_ancestor("td").alias("td_id"), "node_id",
                                                F.coalesce(F.col("attrs")["href"], F.lit("")).alias("href"))
    links = (a.join(tds.filter("cell_no = 2"), ["page_id", "td_id"]).groupBy("page_id", "tr_id")
             .agg(F.min_by("href", "node_id").alias("href")))
    x = r.join(trs, ["page_id", "table_id", "tr_idx"]).join(links, ["page_id", "tr_id"], "left") \
        .join(pages.select("page_id", "url"), "page_id")
    x = x.withColumn("_h", strip(at(F.col("_td"), 2)))
    host = F.when(F.col("_h").endswith("Camp"), strip(F.expr("substring(_h, 1, length(_h) - 4)"))).otherwise(F.col("_h"))
    return x.select("page_id", "tr_idx", strip(at(F.col("_td"), 1)).alias("state"), host.alias("organiser"),
                    F.coalesce(F.col("href"), F.lit("")).alias("camp_info_url"),
                    F.when(F.col("url").contains("womens"), F.lit("Women")).otherwise(F.lit("Men")).alias("gender"))


# ------------------------------------------------------------------ coach links

def coach_profile_links(changes: DataFrame, nodes: DataFrame, pages: DataFrame) -> DataFrame:
    """Per change row ``(change_id, page_id, mode, name)`` the first
    link on the captured listing page that names the coach: roster mode needs
    ``/roster/coaches/`` in the href and the name in the text, aria-label or
    the href (hyphen, underscore or joined); staff mode needs the name in the
    text and ``/staff-directory/`` in the href; general mode the name in the
    text or the hyphenated name in the href.  Resolved with B31."""
    from tessera.functions.text import person_name_keys
    a = nodes.filter((F.col("tag") == "a") & F.col("attrs")["href"].isNotNull()).select(
        "page_id", "node_id", F.col("attrs")["href"].alias("href"),
        F.lower(clean_text(F.coalesce(F.col("text"), F.lit("")))).alias("a_text"),
        F.lower(F.coalesce(F.col("attrs")["aria-label"], F.lit(""))).alias("aria"))
    c = changes.withColumn("_keys", person_name_keys(F.col("name")))
    x = c.join(a, "page_id")
    href = F.lower(F.col("href"))
    k = lambda i: at(F.col("_keys"), i)
    roster = (href.contains("/roster/coaches/")
              & (F.col("a_text").contains(k(1)) | F.col("aria").contains(k(1)) | href.contains(k(2))
                 | href.contains(k(3)) | href.contains(k(4))))
    staff = F.col("a_text").contains(k(1)) & href.contains("/staff-directory/")
    general = F.col("a_text").contains(k(1)) | href.contains(k(2))
    ok = (F.when(F.col("mode") == "roster", roster).when(F.col("mode") == "staff", staff).otherwise(general))
    best = x.filter(ok).groupBy("change_id").agg(F.min_by("href", "node_id").alias("href"), F.first("page_id").alias("page_id"))
    best = best.join(pages.select("page_id", "url"), "page_id")
    return best.select("change_id", url_join(F.col("url"), F.col("href")).alias("profile_url"))


def extract_fields(nodes: DataFrame, pages: DataFrame, selectors: dict) -> DataFrame:
    """``{field: (tag, class)}`` -> first matching element text per page;
    pages without a hit keep a row with '' (decision D24: selectors are
    arguments)."""
    out = pages.select("page_id", "url")
    for field, (tag, cls) in selectors.items():
        hit = hx.select_nodes(nodes, tag=tag, cls=cls).groupBy("page_id").agg(
            F.min_by(strip(F.col("text")), F.col("node_id")).alias(field))
        out = out.join(hit, "page_id", "left").withColumn(field, F.coalesce(F.col(field), F.lit("")))
    return out
