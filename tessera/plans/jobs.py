"""Composed jobs, one per reference entry point.

Each job is a lazy composition of library operators over input tables
(captured pages, the master table, change logs, answers, gazetteer); it
returns DataFrames and writes nothing itself, so the caller picks the sink
and the path.  Network steps of the reference (fetch, model call, geocoder,
sheet writes) are input or output tables here.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions import roster as ro
from tessera.functions import status as st
from tessera.functions.similarity import round_score
from tessera.functions.text import clean_text, strip, text_chunks
from tessera.functions.urls import canonical_url, has_year_token, rewrite_host, update_year_range
from tessera.operators import aggregate as ag
from tessera.operators import answers as an
from tessera.operators import columns as co
from tessera.operators import extract as ex
from tessera.operators import html as hx
from tessera.operators import match as mt
from tessera.operators import reconcile as rc
from tessera.operators import saved_maps as sm
from tessera.operators import topk as tk
from tessera.sources.files import scan_master
from tessera.sources.sinks import cut_lineage
from tessera.sources.pages import first_hit, mail_body, mail_html, select_mail, year_logic_candidates, yearless_candidates
from tessera.streaming import keyed, runs
from tessera.streaming.tables import Tables


SITE = ("gender", "division", "conference_key")     # key columns of a site's saved maps


def _reused(df: DataFrame) -> DataFrame:
    """A table several branches of a job read (the node table above all):
    written once to the shared checkpoint folder, so that the HTML parse runs
    once and a lost executor loses nothing."""
    return cut_lineage(df)


def _tables(pages: DataFrame):
    nodes = _reused(hx.html_nodes(pages, text_tags={"td", "th", "h1", "h2", "h3", "h4", "h5", "h6", "a", "title"}))
    rows = _reused(hx.html_rows(nodes))
    headers = hx.detect_header(rows)
    return nodes, rows, headers


def table_titles(nodes: DataFrame) -> DataFrame:
    """B10 / decision D14: a table's block title is the nearest heading before
    it in the page, else the page's first link text, else its title.  The
    nearest heading is the last heading in document order before the table:
    a window over the page's tables and headings, no table x heading pairs."""
    th = nodes.filter(F.col("tag").isin("table", "h1", "h2", "h3", "h4", "h5", "h6")).select(
        "page_id", "node_id", (F.col("tag") == "table").alias("is_table"),
        F.when(F.col("tag") != "table", strip(F.col("text"))).alias("h"))
    w = Window.partitionBy("page_id").orderBy("node_id").rowsBetween(Window.unboundedPreceding, -1)
    near = th.withColumn("_h", F.last("h", ignorenulls=True).over(w)).filter("is_table") \
        .select("page_id", F.col("node_id").alias("table_id"), "_h")
    link = ex.first_text(nodes, "a", "_a")
    title = ex.first_text(nodes, "title", "_t")
    return (near.join(link, "page_id", "left").join(title, "page_id", "left")
            .select("page_id", "table_id", F.coalesce(F.nullif("_h", F.lit("")), F.nullif("_a", F.lit("")),
                                                      F.col("_t")).alias("conference")))


def standing_entries(pages: DataFrame, maps: DataFrame | None = None, sites: DataFrame | None = None, keys: tuple = SITE) -> DataFrame:
    """J1, first half: the tables of the first non-empty tier of a page ->
    header -> column map -> one row per team in page order.  With ``maps``
    (saved versions) and ``sites`` (page_id, the site's key columns,
    captured_at) the map saved for the site at the time of the capture counts
    where it fits the header (C7, C15-C17), else the keyword map (C5)."""
    ent, _ = mapped_entries(pages, maps, sites, keys)
    return ent


def mapped_entries(pages: DataFrame, maps: DataFrame | None = None, sites: DataFrame | None = None, keys: tuple = SITE):
    """``standing_entries`` and the resolved header maps (None without ``maps``)."""
    nodes, rows, headers = _tables(pages)
    # The tables of the first non-empty tier per page (inside <main>, else any)
    tiers = nodes.filter(F.col("tag") == "table").select(
        "page_id", F.col("node_id").alias("table_id"),
        F.when(F.array_contains("ancestor_tags", "main"), F.lit(1)).otherwise(F.lit(2)).alias("tier"))
    keep = hx.choose_tables(tiers, F.col("tier")).select("page_id", "table_id")
    rows = rows.join(keep, ["page_id", "table_id"], "left_semi")
    headers = headers.join(keep, ["page_id", "table_id"], "left_semi")
    side = ex.is_sidearm(nodes)
    hdr = headers.join(side, "page_id", "left").withColumn(
        "visible", hx.visible_positions(F.coalesce("header_classes", F.array().cast("array<string>")),
                                        F.coalesce("sidearm", F.lit(False))))
    if maps is None:
        mapped = co.map_by_keyword(hdr.withColumn("header", F.coalesce("header", F.array().cast("array<string>")))).withColumn("map_source", F.lit("keyword"))
        resolved = None
    else:
        at_site = sites.select("page_id", *keys, "captured_at")
        mapped = resolved = cut_lineage(sm.resolve(hdr.join(at_site, "page_id", "left"), maps, list(keys), "captured_at"))
    rec = hx.table_records(rows, headers).join(
        mapped.select("page_id", "table_id", "visible", "field_idx", "accepted", "map_source"), ["page_id", "table_id"])
    ent = co.extract_standing_rows(rec, F.col("map_source") == "index").join(table_titles(nodes), ["page_id", "table_id"], "left")
    ent = ent.select("page_id", "table_id", "conference", F.col("row_idx").alias("pos"), "school",
                     "conf_record", "overall_record", "standing", "pts")
    return ent, resolved


def block_entries(pages: DataFrame) -> DataFrame:
    """J1, first half, for pages of titled blocks read by position."""
    ent = ex.positional_standings(ex.block_nodes(pages.select("page_id", "html")))
    return ent.select("page_id", F.lit(0).alias("table_id"), "conference", "pos", "school", "conf_record", "overall_record", "standing",
                      F.lit(None).cast("double").alias("pts"))


def conference_standings(pages: DataFrame, master: DataFrame, gender: str, k: int = 10,
                         accept_at: float = 0.9, decisions: DataFrame | None = None,
                         entries: Callable[[DataFrame], DataFrame] = standing_entries) -> dict:
    """Standings tables -> header -> keyword column map -> rows (``entries``
    may be ``block_entries`` for pages read by position) -> points standing -> top-k fuzzy match with the conference bonus ->
    accepted writes / review queue; the writes are the U3 standing upsert
    (three columns of the gender) for ``reconcile.apply_cell_writes``."""
    ent = entries(pages)
    # stage boundaries: the extracted and the ranked standings are written to
    # the shared checkpoint folder, so later stages neither re-parse pages nor
    # re-plan the whole extraction
    ent = cut_lineage(ent)
    ranked = cut_lineage(ag.points_standing(ent, group=["page_id", "table_id"], pos="pos", pts="pts"))
    m = scan_master(master, gender, attr="conference").select(
        F.col("row_id"), F.col("name").alias("master_name"), "conference")
    cands = cut_lineage(tk.exact_topk(ranked.withColumn("left_key", F.concat_ws("|", "conference", "school")), m, k=k,
                                      name="school", pref="conference", master_conf="conference"))
    # a school that stands on several pages is decided once
    accepted, review = mt.resolve_matches(cands.select("left_key", "rank", "row_id", "master_name", "score").distinct(), decisions,
                                          key="left_key", accept_at=accept_at)
    best = ranked.withColumn("left_key", F.concat_ws("|", "conference", "school")).join(accepted, "left_key")
    writes = best.select(F.col("chosen_row_id").alias("row_id"), F.struct("page_id", "table_id", "pos").alias("seq"), F.explode(F.array(
        F.struct(F.lit(f"{gender}_conference_record").alias("column"), F.col("conf_record").alias("value")),
        F.struct(F.lit(f"{gender}_overall_record").alias("column"), F.col("overall_record").alias("value")),
        F.struct(F.lit(f"{gender}_conference_standing").alias("column"), F.col("standing").alias("value")))).alias("w"))
    writes = writes.select("row_id", "seq", "w.column", "w.value")
    return {"standings": ranked, "candidates": cands, "accepted": accepted, "review": review, "writes": writes}


def standings_run(tables: Tables, pages: DataFrame, sites: DataFrame, master: DataFrame, gender: str, *, k: int = 10, accept_at: float = 0.9,
                  decisions: DataFrame | None = None, attempt: Callable[[DataFrame], DataFrame] | None = None,
                  keys: tuple = SITE, force: bool = False) -> dict:
    """J1 as one call of a resumable run (T3, T4): the sites (a unit is a
    gender, division and conference) that no call has completed are read by
    their saved column maps, ranked and matched; their accepted cell writes
    go to the table ``standings`` of ``tables`` after ``attempt``, what failed
    stays pending, and maps learned from headers are saved for the next call.
    ``reconcile.apply_cell_writes(master, runs.cells(tables, 'standings'))``
    gives the master."""
    empty = sites.select(*keys).limit(0).withColumns({
        "valid_from": F.lit(None).cast("timestamp"), "by_index": F.lit(None).cast("map<string,int>"),
        "by_name": F.lit(None).cast("map<string,array<string>>"), "th_td": F.lit(None).cast("boolean")})
    maps = sm.load(tables, list(keys)) if tables.has(sm.TABLE) else empty
    seen = {}

    def work(units: DataFrame) -> DataFrame:
        todo = cut_lineage(sites.join(units.select(*keys), list(keys), "left_semi"))
        ent, seen["maps"] = mapped_entries(pages.join(todo.select("page_id"), "page_id", "left_semi"), maps, todo, keys)
        out = conference_standings(pages, master, gender, k, accept_at, decisions, entries=lambda _: ent)
        w = out["writes"].join(todo.select("page_id", *keys), F.col("seq.page_id") == F.col("page_id")).drop("page_id")
        order = Window.partitionBy(*keys).orderBy("seq", "column", "row_id")      # the writes of one conference
        return w.withColumn("seq", F.row_number().over(order))

    none = lambda w: w.withColumn("failed", F.lit(False))
    done = runs.run_units(tables, sites.select(*keys).distinct(), list(keys), work, attempt or none, "standings", force=force)
    if "maps" in seen:
        sm.save(tables, sm.learned(seen["maps"], list(keys), "captured_at"), list(keys))
    return done


def ranking_entries(pages: DataFrame) -> DataFrame:
    """J2, first half: (rank, name) rows by the first strategy that finds any
    on a page: table rows, text lines, elements, links."""
    # one parse: text chunks come apart at a mark, which each strategy reads
    # as the separator it needs
    mark = "\x1f"
    parsed = _reused(hx.html_nodes(pages, text_tags={"td", "th", "body", "div", "li", "tr", "p", "a", "span"}, text_sep=mark))
    spaced = parsed.withColumn("text", F.translate("text", mark, " "))
    two = lambda a, b: F.struct(a.cast("long").alias("a"), b.cast("long").alias("b"))
    t = ex.rankings_from_rows(hx.html_rows(spaced)).select(
        "page_id", two(F.col("table_id"), F.col("tr_idx")).alias("pos"), "rank", "name", F.lit(0).alias("strategy"))
    body = parsed.filter(F.col("tag") == "body").select("page_id", F.translate("text", mark, "\n").alias("text"))
    lines = ex.rankings_from_lines(body)
    els = ex.rankings_from_elements(spaced)
    anchors = ex.rankings_from_anchors(parsed.withColumn("text", F.replace("text", F.lit(mark), F.lit(""))))
    every = t
    for k, x in enumerate((lines, els, anchors), 1):
        every = every.unionByName(x.select("page_id", two(F.col("pos"), F.lit(0)).alias("pos"), "rank", "name", F.lit(k).alias("strategy")))
    return ex.dedup_rankings(ex.first_strategy(every))


def rankings(pages: DataFrame, master: DataFrame, gender: str, division: str, k: int = 10,
             accept_at: float = 0.9, decisions: DataFrame | None = None) -> dict:
    """Rankings by the table strategy, else text lines (first strategy
    with rows per page), dedup, division-filtered fuzzy candidates, writes of
    the rank to ``<gender>_top_25`` (U4; several ranks on one row: the last
    write wins in ``apply_cell_writes``)."""
    r = ranking_entries(pages)
    r = r.select("page_id", "pos", F.col("rank").alias("poll_rank"), "name").withColumn("division", F.lit(division))
    m = scan_master(master, gender, attr="division").select("row_id", F.col("name").alias("master_name"),
                                                            F.col("division").alias("m_div"))
    cands = cut_lineage(tk.exact_topk(r, m, k=k, name="name", left_attr="division", master_attr="m_div"))
    acc, review = mt.resolve_matches(cands.select(F.col("name").alias("left_key"), "rank", "row_id", "master_name",
                                                  "score").distinct(), decisions, key="left_key", accept_at=accept_at)
    ranks = r.select(F.col("name").alias("left_key"), "poll_rank", "pos")
    writes = acc.join(ranks, "left_key").select(F.col("chosen_row_id").alias("row_id"), F.col("pos").alias("seq"),
                                                F.lit(f"{gender}_top_25").alias("column"),
                                                F.col("poll_rank").cast("string").alias("value"))
    return {"rankings": r, "candidates": cands, "accepted": acc, "review": review, "writes": writes}


def roster_counts(rosters: DataFrame, captures: DataFrame, season_start: int | None = None, year: int | None = None) -> DataFrame:
    """Per (university, gender) roster URL: the URL of the season, the
    first captured candidate that yields players, players normalised and
    counted, men and women side by side (F2).

    With ``season_start`` and ``year`` the season logic S12 applies: a
    ``yyyy-yy`` range is set to the season; of another URL the form without
    year segments counts if it was captured, else its year is replaced.  Only
    a URL with a year in its path is looked up (C10), itself first, then
    without its year segments (S13).  Universities without players keep a row
    of zeros.  Without ``year`` every URL is looked up, and ``season_start``
    only updates a range."""
    base = rosters.withColumn("_k", F.concat_ws("|", "university", "gender"))
    live = captures.filter((F.col("status") == 200) & ~st.is_error_page(F.col("html")))
    if year is None:
        cand = yearless_candidates(base, "_k", season_start=season_start)
        updated = base.select("_k", (update_year_range(F.col("url"), season_start) if season_start is not None else F.col("url")).alias("updated_url"))
    else:
        forms = year_logic_candidates(base, "_k", season_start, year)
        seen = forms.join(live.select(F.col("url").alias("candidate_url"), F.lit(True).alias("loads")).distinct(), "candidate_url", "left")
        # the first form that loads, else the last one
        pick = F.struct(F.coalesce(F.col("loads"), F.lit(False)).alias("ok"), F.when(F.coalesce("loads", F.lit(False)), -F.col("priority")).otherwise(F.col("priority")).alias("p"))
        updated = cut_lineage(seen.groupBy("_k").agg(F.max_by("candidate_url", pick).alias("updated_url")))
        cand = yearless_candidates(updated.where(has_year_token(F.col("updated_url"))), "_k", url="updated_url")
    pages = live.select("page_id", F.col("url").alias("candidate_url"), "html")
    # only captures that some candidate names are parsed
    pages = pages.join(cand.select("candidate_url").distinct(), "candidate_url", "left_semi")
    players = _reused(ex.roster_players(_reused(ex.roster_nodes(pages))))
    n = players.groupBy("page_id").agg(F.count(F.lit(1)).alias("n_players"))
    hits = cand.join(pages.select("page_id", "candidate_url"), "candidate_url").join(n, "page_id")
    chosen = first_hit(hits, "_k", "priority", F.col("n_players") > 0)
    p = chosen.select("_k", "page_id", "candidate_url").join(players, "page_id")
    counts = ag.roster_counts(ro.normalize_players(p), ["_k"])
    x = base.join(updated, "_k", "left").join(counts, "_k", "left").join(chosen.select("_k", "candidate_url"), "_k", "left")
    cols = list(ro.POSITION_BUCKETS.values()) + [y.replace(" ", "_") for y in ro.YEAR_BUCKETS]
    x = x.select("university", "gender", "url", "updated_url", "candidate_url", *[F.coalesce(F.col(c), F.lit(0)).alias(c) for c in cols])
    return ag.wide_by(x, ["university"], "gender", ["men", "women"], cols + ["url", "updated_url", "candidate_url"], fill=None)


def yearless_roster(master: DataFrame, captures: DataFrame, limit: int | None = None) -> dict:
    """Rows whose freshman count cell says 'no longer exist' (C9):
    per gender the roster URL without year segments (S13) is looked up in
    the capture table; where it loads and yields players, the URL and the
    position/year counts (F1) become cell writes."""
    from tessera.operators.aggregate import no_longer_exist
    rows = master.filter(no_longer_exist(master, "men_freshman", "women_freshman"))
    if limit:
        rows = rows.orderBy("row_id").limit(limit)      # C9: the optional row limit (a feature)
    urls = rows.select("row_id", F.lit("men").alias("gender"), F.col("men_roster_url").alias("url")).unionByName(
        rows.select("row_id", F.lit("women").alias("gender"), F.col("women_roster_url").alias("url")))
    from tessera.functions.urls import has_year_token, remove_year_segment
    urls = urls.filter(has_year_token(F.col("url"))).withColumn("candidate_url", remove_year_segment(F.col("url")))
    pages = captures.filter(F.col("status") == 200).select("page_id", F.col("url").alias("candidate_url"), "html")
    pages = pages.join(urls.select("candidate_url").distinct(), "candidate_url", "left_semi")
    nodes = _reused(ex.roster_nodes(pages))
    players = ro.normalize_players(ex.roster_players(nodes))
    counts = ag.roster_counts(players, ["page_id"])
    hit = urls.join(pages.select("page_id", "candidate_url"), "candidate_url").join(counts, "page_id")
    hit = first_hit(hit.withColumn("_k", F.concat_ws("|", F.col("row_id").cast("string"), "gender"))
                    .withColumn("_n", sum((F.col(c) for c in ro.POSITION_BUCKETS.values()), F.lit(0))),
                    "_k", "page_id", F.col("_n") > 0)
    cols = ["candidate_url"] + list(ro.POSITION_BUCKETS.values()) + ["freshman", "sophomore", "junior", "senior"]
    names = {"candidate_url": "roster_url"}
    writes = hit.select("row_id", "gender", "page_id", F.explode(F.array(*[
        F.struct(F.lit(names.get(c, c)).alias("c"), F.col(c).cast("string").alias("value")) for c in cols])).alias("w"))
    writes = writes.select("row_id", F.col("page_id").alias("seq"), F.concat_ws("_", "gender", "w.c").alias("column"), "w.value")
    return {"rows": rows, "writes": writes}


def roster_card_texts(rosters: DataFrame, captures: DataFrame, season_start: int, year: int) -> DataFrame:
    """J4, first half: the captured page of each roster URL by the season logic
    (S12) and the text of its roster cards."""
    forms = year_logic_candidates(rosters.withColumn("_k", F.concat_ws("|", "university", "gender")), "_k", season_start, year)
    pages = captures.filter((F.col("status") == 200) & ~st.is_error_page(F.col("html"))).select("page_id", F.col("url").alias("candidate_url"), "html")
    hits = forms.join(pages.select("page_id", "candidate_url"), "candidate_url")
    chosen = first_hit(hits, "_k", "priority", F.lit(True))
    nodes = ex.roster_nodes(pages.join(chosen.select("page_id").distinct(), "page_id", "left_semi"))
    cards = nodes.filter((F.col("tag") == "li") & (hx.has_class("sidearm-roster-player") | hx.has_class("sidearm-roster-item")))
    return chosen.select("_k", "page_id", "candidate_url").join(cards.select("page_id", "node_id", clean_text(F.col("text")).alias("text")), "page_id")


def roster_counts_text(cards: DataFrame, keys: tuple = ("page_id",)) -> DataFrame:
    """Counts from roster-card text (F3, decision D5)."""
    return ag.text_roster_counts(cards, list(keys))


def camp_directory(pages: DataFrame, master: DataFrame, n_lowest: int = 30) -> dict:
    """Camp directory tables -> (school, camp URL) -> best master school
    (E1) -> lowest-score report of unconfirmed rows (G4)."""
    nodes, rows, headers = _tables(pages)
    rec = rows.filter(F.size("cells") >= 2)
    camps = ex.camp_directory(rec, nodes, pages)
    m = master.select("row_id", F.col("university_name").alias("master_name"))
    best = tk.exact_topk(camps, m, k=1, name="camp_school_name").withColumnsRenamed({"row_id": "match_row_id", "master_name": "match_name"})
    best = cut_lineage(best.withColumn("similarity_score", round_score(F.coalesce("score", F.lit(0.0)), 3)).drop("rank", "score"))
    best = best.withColumn("pos", F.struct(*[c for c in ("page_id", "table_id", "tr_idx") if c in best.columns]))
    low = ag.lowest_n(best.withColumn("similarity_score", F.col("similarity_score").cast("string")),
                      "similarity_score", "pos", n_lowest)
    return {"camps": best, "lowest": low}


CAMP_KEY = ["organiser", "url", "event_details", "start_date"]


def camp_list(pages: DataFrame) -> DataFrame:
    """J6, seed: the camp lists (B23) as base rows, numbered by page and row."""
    nodes, rows, _ = _tables(pages)
    seed = ex.camp_list_seed(rows, nodes, pages)
    return seed.withColumn("pos", F.struct("page_id", "tr_idx"))


def camp_rows_append(tables: Tables, camps: DataFrame, *, status: str = "page_load", batch_id: int | None = None) -> dict:
    """Merged camp rows (``pos, sub_pos`` and the camp columns): rows
    whose page loaded are appended to the table ``camps`` below its last row
    unless their key (organiser, url, event details, start date) is there; the
    others go to the table ``camp_errors``.  A repeated batch adds nothing."""
    ok, errors = rc.split_errors(camps, status)
    first = runs.append_rows(tables, "camps", ok, CAMP_KEY, ["pos", "sub_pos"], stream="camps", batch_id=batch_id)
    return {"camps": first, "errors": runs.append_rows(tables, "camp_errors", errors, CAMP_KEY, ["pos", "sub_pos"], stream="camp_errors", batch_id=batch_id)}


def all_sites_camps(sites: dict) -> DataFrame:
    """Camp rows of several sites (name -> rows) in one table with a
    ``source`` column (H1)."""
    return rc.union_sources(sites)


def partner_camps(pages: DataFrame, base: DataFrame, answers: DataFrame | None, template: str) -> dict:
    """Relevant-line snippets -> model requests; stored answers ->
    camp rows (first answer updates the base row, the rest are copies)."""
    nodes = hx.html_nodes(pages, text_tags={"p", "li", "div"}, tags={"p", "li", "div"})
    snip = ex.relevant_lines_nodes(nodes, pages)
    req = an.build_requests(snip, ["page_id", "chunk_idx"], "snippet", template)
    out = {"requests": req}
    if answers is not None:
        out["camps"] = an.explode_answers(base, answers, "page_id")
    return out


def camp_enrichment(camps: DataFrame, captures: DataFrame, gazetteer: DataFrame, answers: DataFrame) -> dict:
    """U8 / J6 second half: camp rows ``(camp_id, organiser, camp_info_url,
    + camp columns)`` -> page status from the capture table (S39 short form,
    C19) -> latitude/longitude/city by organiser (E13) -> the model answer
    applied (M6; extra camps as copies).  Rows whose page did not load go to
    the error output."""
    cap = captures.groupBy("url").agg(F.max_by(F.struct("status", "error"), F.col("page_id")).alias("_c"))
    x = camps.join(cap, F.col("camp_info_url") == F.col("url"), "left").drop("url")
    x = x.withColumn("page_load", F.when(F.col("_c").isNull(), F.lit("Not captured")).otherwise(
        st.page_load_status(F.col("_c.status"), F.col("_c.error")))).drop("_c")
    ok, errors = rc.split_errors(x, "page_load")
    geo = rc.geocode(ok, F.col("organiser"), gazetteer, out=("lat", "long", "city"))
    base_cols = [c for c in geo.columns]
    out = an.explode_answers(geo.select(*base_cols), answers, "camp_id")
    return {"camps": out, "errors": errors}


def branded_camps(pages: DataFrame, gazetteer: DataFrame) -> DataFrame:
    """Camp page fields (B21, S21, S22, S25, S26) + geocode of
    'title, city, state' (E14)."""
    c = ex.camp_page_fields(ex.camp_nodes(pages), pages)
    return rc.geocode(c, F.concat_ws(", ", "camp_name", "city", "state"), gazetteer)


def event_camps(pages: DataFrame) -> DataFrame:
    """JSON-LD events of every page."""
    nodes = hx.html_nodes(pages, tags={"script"}, text_tags=set())
    return ex.jsonld_events(nodes)


def showcase_geocode(events: DataFrame, gazetteer: DataFrame, start: int, end: int) -> DataFrame:
    """Geocode a row range of the events sheet by its address."""
    from tessera.sources.files import row_range
    return rc.geocode(row_range(events, start, end), F.col("address"), gazetteer)


def showcase_update(events: DataFrame, gazetteer: DataFrame, start: int, end: int) -> DataFrame:
    """J10 whole: the events sheet with latitude and longitude written back to
    the rows ``start..end`` by row number (U2); other rows, and rows whose
    address is not found, keep their values."""
    found = showcase_geocode(events.select("row_id", "address"), gazetteer, start, end).select(F.col("row_id").alias("_row"), "latitude", "longitude")
    found = found.filter(F.col("latitude").isNotNull())
    out = rc.keyed_upsert(events, found, F.col("row_id"), F.col("_row"), {"latitude": "latitude", "longitude": "longitude"}, order="_row")
    return out.drop("dup_count", "duplicate")


def showcase_pages(pages: DataFrame, selectors: dict) -> DataFrame:
    """J10, page half: the fields of event pages by their selectors (B32);
    pages without a field keep a row with ''."""
    held = {(tag, cls) for tag, cls in selectors.values()}
    wanted = lambda tag, attrs, above: any(t in (None, tag) and (c is None or c in attrs.get("class", "").split()) for t, c in held)
    return ex.extract_fields(_reused(hx.html_nodes(pages, text_when=wanted)), pages, selectors)


def geocode_file(rows: DataFrame, gazetteer: DataFrame) -> DataFrame:
    """Add latitude, longitude, city to a table with an address column."""
    from tessera.sources.files import require_columns
    return rc.geocode(require_columns(rows, ["address"]), F.col("address"), gazetteer)


def academic_facts(pages: DataFrame, master: DataFrame, value_cls: str, title_cls: str, undergrad_cls: str,
                   host_suffix: str) -> dict:
    """Labelled facts per page -> joined to the master on the canonical
    URL (last master row wins) -> keyed upsert with duplicate flag."""
    nodes = _reused(hx.html_nodes(pages, text_when=hx.in_class(value_cls, title_cls, undergrad_cls)))
    tv = ex.labelled_values(nodes, value_cls, title_cls)
    facts = ex.academic_facts(tv, nodes, undergrad_cls).join(pages.select("page_id", "url"), "page_id", "right")
    m = master.withColumn("_fetch", rewrite_host(F.col("academic_info_url"), host_suffix))
    out = rc.keyed_upsert(m, facts.withColumn("_o", F.col("page_id")), canonical_url(F.col("academic_info_url")),
                          canonical_url(F.col("url")),
                          {"undergraduates": "undergraduates", "in_state_tuition": "in_state_tuition",
                           "out_state_tuition": "out_of_state_tuition", "avg_gpa": "avg_admission_gpa"}, order="_o")
    return {"facts": facts, "master": out.drop("_fetch")}


def coach_changes(change_logs: DataFrame, aliases: DataFrame, master: DataFrame, gender: str,
                  listing_pages: DataFrame | None = None, accept_at: float = 0.9) -> dict:
    """Change logs (C1, C2) -> alias-first school match (E4) -> cell
    writes per S37 -> last write per cell onto the master (U1); new coach
    profile links found on captured listing pages (B29, B30)."""
    ch = change_logs.filter(F.col("gender") == gender).filter(
        st.is_head_coach(F.col("position")) & st.is_actionable_change(F.col("change")))
    m = master.select("row_id", F.col("university_name").alias("master_name"))
    res = mt.alias_then_fuzzy(ch, aliases, m, name="school", accept_at=accept_at)
    firsts = m.groupBy("master_name").agg(F.min("row_id").alias("row_id"))
    res = res.join(firsts, F.col("matched_name") == F.col("master_name"), "left").drop("master_name")
    review = res.filter(F.col("row_id").isNull()).drop("row_id")    # no school found: for a person
    res = res.filter(F.col("row_id").isNotNull())
    res = res.withColumn("seq", F.concat_ws(":", "file_name", F.lpad(F.col("pos").cast("string"), 9, "0")))
    cols = {"name": f"{gender}_coach_name", "email": f"{gender}_coach_email"}
    writes = rc.change_log_writes(res, cols)
    if listing_pages is not None:
        prev = master.select("row_id", F.col(f"{gender}_coach_url").alias("prev_url"))
        r2 = (res.join(prev, "row_id").withColumn("_pb", st.profile_base(F.col("prev_url")))
              .withColumn("name", F.trim(F.concat_ws(" ", "first_name", "last_name")))
              .withColumn("change_id", F.concat_ws("|", "file_name", F.col("pos").cast("string"))))
        lp = listing_pages.select("page_id", F.col("url").alias("_base"))
        r2 = r2.join(lp, F.col("_pb.base") == F.col("_base")).select(
            "change_id", "row_id", "seq", "page_id", F.col("_pb.mode").alias("mode"), "name")
        nodes = hx.html_nodes(listing_pages, text_tags={"a"}, tags={"a"})
        links = ex.coach_profile_links(r2, nodes, listing_pages)
        url_writes = r2.join(links, "change_id").select("row_id", "seq", F.lit(f"{gender}_coach_url").alias("column"),
                                                        F.col("profile_url").alias("value"))
        writes = writes.unionByName(url_writes)
    out = rc.apply_cell_writes(master, writes, [f"{gender}_coach_name", f"{gender}_coach_email", f"{gender}_coach_url"])
    return {"resolved": res, "review": review, "writes": writes, "master": out}


def scholarship_requests(mail: DataFrame, template: str, chunk: int = 3) -> DataFrame:
    """J14 (first half): message HTML -> ``<p>`` list -> chunks of 3 -> one
    model request per chunk."""
    pages = mail.select(F.col("id").alias("msg_id"), mail_html(F.col("parts")).alias("html")) \
        .withColumn("page_id", F.xxhash64("msg_id"))
    nodes = hx.html_nodes(pages, text_tags=set(), outer_tags={"p"}, tags={"p"}, carry=["msg_id"])
    ps = nodes.select("msg_id", F.col("tag_idx").alias("p_idx"), "outer_html")
    ch = hx.chunk_rows(ps, "msg_id", "p_idx", "outer_html", chunk, index="p_idx")
    return an.build_requests(ch, ["msg_id", "chunk_idx"], "chunk", template)


def listed_mail(mail: DataFrame, label: str | None, ref_ts: str, offset: int = 1, limit: int = 9, listing: int = 100) -> DataFrame:
    """The mail of a run: C18 (label, age, subject; newest ``listing``),
    then G6: of that list the messages after ``offset``, at most ``limit``."""
    return ag.slice_rows(select_mail(mail, label, ref_ts, limit=listing), [F.col("ts").desc(), F.col("id")], offset, limit)


def scholarship_run(mail: DataFrame, template: str, label: str | None, ref_ts: str, chunk: int = 3, **listing) -> DataFrame:
    """J14, mail half whole: listed mail -> requests."""
    return scholarship_requests(listed_mail(mail, label, ref_ts, **listing), template, chunk)


def keyed_requests(mail: DataFrame, template: str, label: str | None, ref_ts: str, threads: int = 500, size: int = 40000) -> DataFrame:
    """J15, mail half: labelled mail with a subject (C18) -> body (A11, B27,
    B28: plain text, or HTML as text when it is short; forward header removed)
    -> one model request per piece of at most ``size`` characters (M1).
    ``{subject}`` in the template stands for the subject."""
    x = select_mail(mail, label, ref_ts, limit=threads)
    body = mail_body(F.col("plain"), mail_html(F.col("parts")))
    x = x.select(F.col("id").alias("msg_id"), "subject", F.posexplode(text_chunks(body, size)).alias("chunk_idx", "piece"))
    req = an.build_requests(x.withColumn("subject", strip(F.col("subject"))), ["msg_id", "chunk_idx", "subject"], "piece", template)
    return req.select("msg_id", "chunk_idx", F.replace("prompt", F.lit("{subject}"), F.col("subject")).alias("prompt"))


def scholarships_import(tables: Tables, answers: DataFrame, *, batch_id: int | None = None) -> int:
    """J15, answer half as one batch (T1, U9): items with a title whose key
    ``msgId|title`` was never imported become rows of the table
    ``scholarships``, and their keys are logged, in one commit."""
    items = an.scholarship_rows(answers, ["msg_id"], require=(), form="js")
    items = items.withColumn("key", F.concat_ws("|", "msg_id", "title")).withColumn("at", F.struct("msg_id", "item_idx"))
    return keyed.process_once(tables, items, ["key"], "at", lambda df: an.to_sheet_columns(df).withColumn("imported", F.lit(batch_id).cast("long")),
                              "scholarships", stream="scholarships", batch_id=batch_id)


def scholarship_rows(answers: DataFrame, stored: DataFrame) -> DataFrame:
    """J14 (second half): answers -> items with amount and closing date ->
    11 sheet columns -> drop rows already stored (normalised title + link,
    decision D3) and repeats within the batch."""
    items = an.scholarship_rows(answers, ["msg_id", "chunk_idx"])
    rows = items.select("msg_id", "chunk_idx", "item_idx", *an.SCHOLARSHIP_FIELDS)
    key = rc.title_link_key(F.col("title"), F.col("link"))
    fresh = rc.anti_known(rows, stored, key, rc.title_link_key(F.col("title"), F.col("link")),
                          order=["msg_id", "chunk_idx", "item_idx"])
    return an.to_sheet_columns(fresh)


def scholarships_keyed(answers: DataFrame, processed: DataFrame) -> dict:
    """JS form: items (deadline fallback, cleaned link, title needed) ->
    processed key ``msgId|title`` anti-join -> rows + new keys (T1 batch);
    the new keys are the U9 key-log rows the caller appends."""
    items = an.scholarship_rows(answers, ["msg_id"], require=(), form="js")
    items = items.withColumn("key", F.concat_ws("|", "msg_id", "title"))
    fresh = rc.anti_known(items, processed, F.col("key"), F.col("key"), order=["msg_id", "item_idx"])
    return {"rows": an.to_sheet_columns(fresh), "keys": fresh.select("key")}


def link_status(rows: DataFrame, captures: DataFrame, url: str = "url") -> DataFrame:
    """Status text per row from the capture table."""
    return rc.link_status(rows, captures, url)
