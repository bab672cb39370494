from pyspark.sql import functions as F

from conftest import rows
from tessera.operators import extract as ex
from tessera.operators import html as hx

SIDEARM = """<html><head><meta name="generator" content="SIDEARM Sports"></head><body><ul>
<li class="sidearm-roster-player"><span class="sidearm-roster-player-position">D/M</span>
  <span class="sidearm-roster-player-academic-year">Fr.</span> Ann</li>
<li class="sidearm-roster-player">Bea <span>Position: Forward</span> sophomore in soccer</li>
<li class="sidearm-roster-player">Cy plays keeper, Sr</li>
</ul></body></html>"""

DATAFIELD = """<html><body><table class="roster-data">
<tr><th>Name</th><th>Pos</th><th>Yr</th></tr>
<tr><td>Dee</td><td data-field="position">GK</td><td data-field="year">Jr.</td></tr>
<tr><td>Eve</td><td>Midfielder senior</td><td></td></tr>
</table></body></html>"""


def _nodes(spark, pages):
    return hx.html_nodes(spark.createDataFrame(pages, "page_id long, html string"))


def test_roster_extractors(spark):
    n = _nodes(spark, [(1, SIDEARM), (2, DATAFIELD)])
    side = {r["page_id"]: r["sidearm"] for r in ex.is_sidearm(n).collect()}
    assert side == {1: True, 2: False}
    p = ex.roster_players(n).orderBy("page_id", "player_id").collect()
    got = [(r["page_id"], r["position"], r["year"]) for r in p]
    assert got[:3] == [(1, "D/M", "freshman"), (1, "F", "sophomore"), (1, "GK", "senior")]
    assert got[3:] == [(2, "", ""), (2, "GK", "junior"), (2, "", "senior")]


def test_rankings(spark):
    html = """<table><tr><td>1</td><td>North State</td><td>10-0</td></tr>
    <tr><td>T-2</td><td>x</td><td>West U</td><td>y</td></tr>
    <tr><td>Team</td><td>3</td><td>South Tech</td></tr>
    <tr><td>1</td><td>north state</td></tr></table>"""
    n = _nodes(spark, [(1, html)])
    r = hx.html_rows(n).withColumn("pos", F.col("tr_idx"))
    rk = ex.rankings_from_rows(r)
    assert rows(rk, "pos", "rank", "name") == [(0, 1, "North State"), (2, 3, "Team"), (3, 1, "north state")]
    d = ex.dedup_rankings(rk)
    assert rows(d, "pos", "rank") == [(0, 1), (2, 3)]
    naia = spark.createDataFrame([(1, 0, ["x", "4", "y", "Delta College"], ["td"] * 4, [""] * 4)],
                                 "page_id long, pos int, cells array<string>, tags array<string>, classes array<string>")
    assert rows(ex.rankings_from_rows(naia), "rank", "name") == [(4, "Delta College")]
    t = spark.createDataFrame([(5, "Poll\n1. Alpha College\n2) Beta U\n3. x\n100. Too Big")], "page_id long, text string")
    assert rows(ex.rankings_from_lines(t), "rank", "name") == [(1, "Alpha College"), (2, "Beta U")]


def test_jsonld_events(spark):
    html = """<script type="application/ld+json">[{"@type": "SportsEvent", "name": "ID Camp Division II",
      "organizer": {"name": "Coach Co"}, "startDate": "2024-06-01", "location": {"geo": {"latitude": 30.5, "longitude": -97}},
      "offers": [{"price": "150"}], "description": "ages 12-18"}, {"@type": "Place", "name": "no"}]</script>
      <script type="application/ld+json">{"@type": "Event", "name": "Clinic", "organizer": "plain text",
      "offers": {"price": 20}}</script><script type="application/ld+json">{bad json</script>"""
    n = hx.html_nodes(spark.createDataFrame([(1, html)], "page_id long, html string"), tags={"script"})
    e = ex.jsonld_events(n).orderBy("node_id", "i").collect()
    assert [(r["name"], r["organizer"], r["price"], r["division"], r["ages"]) for r in e] == [
        ("ID Camp Division II", "Coach Co", "150", "D2", "12-18"), ("Clinic", "plain text", "20", "", "")]
    assert e[0]["lat"] == 30.5 and e[0]["start_unix"] == 1717200000 and e[1]["start_unix"] == 0


def test_labelled_facts(spark):
    html = """<div class="StatBlock_body__x">12,345 undergraduates</div>
    <div><div class="t">Tuition</div><div class="v">$9,000</div></div>
    <div><div class="t">Tuition and Fees</div><div class="v">In-state: $10,000</div></div>
    <div><div class="v">Out-of-state $30,000</div><div class="t">Tuition</div></div>
    <div><div class="t">Tuition</div><div class="v">Out of state $31,000</div></div>
    <div><div class="t">Cost of Attendance</div><div class="v">$60,000</div></div>
    <div><div class="t"></div><div class="x"><div class="v">2.5 avg</div></div></div>
    <section><div class="t">Average GPA</div><div><div class="v">3.71</div></div></section>"""
    n = _nodes(spark, [(1, html)])
    tv = ex.labelled_values(n, "v", "t")
    titles = [r["title"] for r in tv.orderBy("node_id").collect()]
    assert titles == ["Tuition", "Tuition and Fees", "Tuition", "Tuition", "Cost of Attendance", "", "Average GPA"]
    f = ex.academic_facts(tv, n, "StatBlock_body__x").first()
    # in: the in-state row overwrites the first plain amount; out: the last out-of-state row
    assert (f["undergraduates"], f["in_state_tuition"], f["out_state_tuition"], f["avg_gpa"]) == (12345, 10000, 31000, 3.71)


def test_camp_page_and_relevant_lines(spark):
    html = """<h1>Girls Elite Camp</h1><div class="location">Austin, TX</div>
    <p>Ages: 8–17</p><p>Dates: October 1 to October 3</p><p>Cost $250 per player</p><p>hello</p>"""
    pages = spark.createDataFrame([(1, "https://c.example.org/a", html)], "page_id long, url string, html string")
    n = hx.html_nodes(pages.select("page_id", "html"))
    c = ex.camp_page_fields(n, pages).first()
    assert (c["camp_name"], c["city"], c["state"], c["ages"], c["start_date"], c["end_date"], c["cost"], c["grade_level"],
            c["gender"]) == ("Girls Elite Camp", "Austin", "TX", "8–17", "October 1", "October 3", "Cost $250 per player",
                             "Elementary School, High School", "Girls")
    s = ex.relevant_lines_nodes(n, pages).first()["snippet"]
    assert s.split("\n") == ["Ages: 8–17", "Dates: October 1 to October 3", "Cost $250 per player"]


def test_camp_directory_and_coach_links(spark):
    html = """<table><tr><td>TX</td><td><a href="/camps/1">North State Camp</a></td></tr>
    <tr><td>OH</td><td><a href="https://o.edu/c"> </a>Ohio Tech camp</td></tr><tr><td>only</td></tr></table>"""
    pages = spark.createDataFrame([(1, "https://dir.example.com/list", html)], "page_id long, url string, html string")
    n = hx.html_nodes(pages.select("page_id", "html"))
    rec = hx.html_rows(n)
    d = rows(ex.camp_directory(rec, n, pages), "tr_idx", "camp_school_name", "camp_url")
    assert d == [(0, "North State", "https://dir.example.com/camps/1"), (1, "Ohio Tech", "https://o.edu/c")]
    lst = """<a href="/sports/wsoc/roster/coaches/jane-doe/7">Jane Doe</a><a href="/staff-directory/jane-doe">Jane Doe</a>
    <a href="/x">Other</a>"""
    lp = spark.createDataFrame([(5, "https://s.edu/sports/wsoc/roster", lst)], "page_id long, url string, html string")
    ln = hx.html_nodes(lp.select("page_id", "html"))
    ch = spark.createDataFrame([("c1", 5, "roster", "Jane  Doe"), ("c2", 5, "staff", "Jane Doe"), ("c3", 5, "general", "Nobody")],
                               "change_id string, page_id long, mode string, name string")
    got = rows(ex.coach_profile_links(ch, ln, lp), "change_id", "profile_url")
    assert got == [("c1", "https://s.edu/sports/wsoc/roster/coaches/jane-doe/7"), ("c2", "https://s.edu/staff-directory/jane-doe")]


def test_ranking_element_and_anchor_strategies(spark):
    html = """<div class="team-name">x</div><ul><li><b>1.</b> Alpha College</li><li>2 Beta U</li><li>junk</li></ul>
    <a href="/t">#3 - Gamma Tech</a><a>4:D</a>"""
    pages = spark.createDataFrame([(1, html)], "page_id long, html string")
    els = ex.rankings_from_elements(hx.html_nodes(pages, text_sep=" "))
    assert rows(els, "rank", "name") == [(1, "Alpha College"), (2, "Beta U")]
    anc = ex.rankings_from_anchors(hx.html_nodes(pages, tags={"a"}, text_sep=""))
    assert rows(anc, "rank", "name") == [(3, "Gamma Tech")]        # '4:D' is 3 characters: too short
    none = spark.createDataFrame([(2, "<li>1. Alpha</li>")], "page_id long, html string")
    assert ex.rankings_from_elements(hx.html_nodes(none, text_sep=" ")).count() == 0   # no team-name element


def test_camp_list_seed(spark):
    html = """<table><tr><td>TX</td><td><a href="/c/1">North State Camp</a></td></tr>
    <tr><td>OH</td><td>Ohio Tech</td></tr><tr><td>a</td><td>b</td><td>c</td></tr></table>"""
    pages = spark.createDataFrame([(1, "https://d.example.org/womens-camps", html)], "page_id long, url string, html string")
    n = hx.html_nodes(pages.select("page_id", "html"))
    out = rows(ex.camp_list_seed(hx.html_rows(n), n, pages), "tr_idx", "state", "organiser", "camp_info_url", "gender")
    assert out == [(0, "TX", "North State", "/c/1", "Women"), (1, "OH", "Ohio Tech", "", "Women")]


def test_year_logic_candidates(spark):
    from tessera.sources.pages import year_logic_candidates
    u = spark.createDataFrame([("a", "https://s.edu/x/2019-20/roster"), ("b", "https://s.edu/x/2019/roster")],
                              "k string, url string")
    got = rows(year_logic_candidates(u, "k", 2025, 2026), "k", "priority", "candidate_url")
    assert got == [("a", 0, "https://s.edu/x/2025-26/roster"), ("b", 0, "https://s.edu/x/roster"),
                   ("b", 1, "https://s.edu/x/2026/roster")]


def test_positional_standings_titles_at_any_nesting(spark):
    row = lambda *c: "<tr>" + "".join(f"<td>{x}</td>" for x in c) + "</tr>"
    html = {
        1: "<h1>Page</h1><div><div class=x><h2>Alpha</h2></div><table>" + row(1, "A", "1-0", "2-0") + row("only") + row(2, "") + "</table>"
           "<div><h3>Beta</h3><table>" + row(1, "B <b>x</b>", "0-1") + "</table></div><table>" + row(3, "C") + "</table></div>"
           "<table>" + row(9, "D") + "</table>",
        2: "<section><a>First link</a><a>Second</a><table>" + row(1, "<a>E</a>") + row(2, "<a>F</a>") + "</table></section>"
           "<section><div class='my-title'>Box</div><table>" + row(1, "G") + "</table></section>",
        3: "<table>" + row(1, "H") + "</table><h2>too late</h2>",
        4: "<h2>L</h2><table><tr><td><h4>In cell</h4><table>" + row(1, "I") + "</table></td><td><table>" + row(2, "J") + "</table></td></tr></table>",
        5: row(1, "K") + "<h2>M</h2>" + row(2, "N"), 6: "", 7: None}
    pages = spark.createDataFrame(list(html.items()), "page_id long, html string")
    got = sorted((r["page_id"], r["conference"], r["standing"], r["school"], r["conf_record"], r["overall_record"])
                 for r in ex.positional_standings(ex.block_nodes(pages)).collect())
    assert got == [(1, "Alpha", "1", "A", "1-0", "2-0"), (1, "Alpha", "3", "C", "", ""), (1, "Beta", "1", "B x", "0-1", ""), (1, "Page", "9", "D", "", ""),
                   (2, "Box", "1", "G", "", ""), (2, "First link", "1", "E", "", ""), (2, "First link", "2", "F", "", ""), (3, "", "1", "H", "", ""),
                   (4, "In cell", "1", "I", "", ""), (4, "L", "2", "J", "", ""), (5, "", "1", "K", "", ""), (5, "M", "2", "N", "", "")]
