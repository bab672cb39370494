import base64
import json

from pyspark.sql import functions as F

from conftest import rows
from tessera.plans import jobs

MASTER_SCHEMA = ("row_id long, university_name string, men_conference string, men_ncaa_division string, "
                 "men_coach_name string, men_coach_email string, men_coach_url string, men_roster_url string, "
                 "women_roster_url string, men_freshman string, women_freshman string, academic_info_url string, "
                 "undergraduates int, in_state_tuition int, out_of_state_tuition int, avg_admission_gpa double")


def _master(spark):
    return spark.createDataFrame([
        (3, "North State University", "Alpha", "D2", "Old Coach", "old@x", "https://ns.edu/sports/msoc/roster/coaches/old/1",
         "https://ns.edu/sports/msoc/2024-25/roster", "", "no longer exists", "", "www.facts.example.com/ns/", None, None, None, None),
        (4, "South Tech", "Alpha", "D2", None, None, None, "", "", "3", "", "facts.example.com/st", None, None, None, None),
        (5, "West College", "Beta", "D3", None, None, None, "", "", "", "", "", None, None, None, None)], MASTER_SCHEMA)


def test_rankings_job(spark):
    html = "<table><tr><th>Rank</th><th>Team</th></tr><tr><td>1</td><td>North State</td></tr><tr><td>2</td><td>West College</td></tr></table>"
    pages = spark.createDataFrame([(1, "https://polls.example.org/d2", html)], "page_id long, url string, html string")
    out = jobs.rankings(pages, _master(spark), "men", "D2", k=3, accept_at=0.5)
    assert rows(out["rankings"], "poll_rank", "name") == [(1, "North State"), (2, "West College")]
    w = rows(out["writes"], "row_id", "column", "value")
    assert w == [(3, "men_top_25", "1")]                        # West College is D3: filtered by division (C11)


def test_yearless_roster_job(spark):
    roster = """<html><head><meta name="generator" content="Sidearm"></head><body><ul>
    <li class="sidearm-roster-player"><span class="sidearm-roster-player-position">D</span>
    <span class="sidearm-roster-player-academic-year">Fr.</span></li>
    <li class="sidearm-roster-player"><span class="sidearm-roster-player-position">F/M</span>
    <span class="sidearm-roster-player-academic-year">Sr.</span></li></ul></body></html>"""
    caps = spark.createDataFrame([(10, "https://ns.edu/sports/msoc/roster", 200, None, roster)],
                                 "page_id long, url string, status int, error string, html string")
    out = jobs.yearless_roster(_master(spark), caps)
    w = dict((r["column"], r["value"]) for r in out["writes"].collect())
    assert w["men_roster_url"] == "https://ns.edu/sports/msoc/roster"
    assert (w["men_defenders"], w["men_forwards"], w["men_midfielders"], w["men_freshman"], w["men_senior"]) == \
        ("1", "1", "1", "1", "1")


def test_academic_facts_job(spark):
    html = """<div class="ug">4,321 students</div><div><div class="t">Tuition</div><div class="v">$20,000</div></div>
    <div><div class="t">GPA</div><div class="v">3.5</div></div>"""
    pages = spark.createDataFrame([(1, "https://facts.example.com/ns", html), (2, "https://facts.example.com/st", "<p>x</p>")],
                                  "page_id long, url string, html string")
    out = jobs.academic_facts(pages, _master(spark), "v", "t", "ug", "example.com")
    m = {r["row_id"]: r for r in out["master"].collect()}
    assert (m[3]["undergraduates"], m[3]["in_state_tuition"], m[3]["out_of_state_tuition"], m[3]["avg_admission_gpa"]) == \
        (4321, 20000, 20000, 3.5)
    assert m[4]["undergraduates"] is None and m[3]["duplicate"] == ""


def test_coach_changes_job(spark):
    logs = spark.createDataFrame([
        ("men_DII.csv", 0, "Alpha", "North State Univ", "Head Coach", "Jane", "Doe", "J X", "jane@ns.edu", "men", "DII"),
        ("men_DII.csv", 1, "Alpha", "NSU", "Head Coach", "Ann", "Lee", "e", "ann@ns.edu", "men", "DII")],
        "file_name string, pos int, conference string, school string, position string, first_name string, "
        "last_name string, change string, email_address string, gender string, division string")
    aliases = spark.createDataFrame([("NSU", "North State University")], "alias string, canonical string")
    listing = spark.createDataFrame(
        [(20, "https://ns.edu/sports/msoc/roster", '<a href="/sports/msoc/roster/coaches/jane-doe/9">Jane Doe</a>')],
        "page_id long, url string, html string")
    out = jobs.coach_changes(logs, aliases, _master(spark), "men", listing_pages=listing, accept_at=0.5)
    m = {r["row_id"]: r for r in out["master"].collect()}
    assert (m[3]["men_coach_name"], m[3]["men_coach_email"], m[3]["men_coach_url"]) == \
        ("Jane Doe", "ann@ns.edu", "https://ns.edu/sports/msoc/roster/coaches/jane-doe/9")


def test_scholarship_jobs(spark):
    html = "<p>A</p><p>B</p><p>C</p><p>D</p>"
    enc = base64.urlsafe_b64encode(html.encode()).decode()
    mail = spark.createDataFrame([("m1", "s", "", [("text/html", enc)])],
                                 "id string, subject string, plain string, parts array<struct<mimeType:string,data:string>>")
    req = jobs.scholarship_requests(mail, "Items in:\n{snippet}")
    assert rows(req, "chunk_idx", "prompt") == [(0, "Items in:\n<p>A</p>\n<p>B</p>\n<p>C</p>"), (1, "Items in:\n<p>D</p>")]
    items = [{"title": "1. Big Award", "amount": "$500", "closing_date": "May 1", "link": "aid.org/a"},
             {"title": "Small", "amount": "", "closing_date": "May 2"},
             {"title": "Known", "amount": "$1", "closing_date": "x", "link": "https://k.org"}]
    env = json.dumps({"choices": [{"message": {"content": "```json\n" + json.dumps(items) + "\n```"}}]})
    ans = spark.createDataFrame([("m1", 0, env)], "msg_id string, chunk_idx int, response string")
    stored = spark.createDataFrame([("known", "k.org")], "title string, link string")
    got = rows(jobs.scholarship_rows(ans, stored), "title", "amount", "link")
    assert got == [("1. Big Award", "$500", "aid.org/a")]
    js = [{"title": "T1", "deadline": "June 1", "link": "<t1.org>"}, {"title": "", "deadline": "x"}]
    env2 = json.dumps({"choices": [{"message": {"content": "```JSON\n" + json.dumps(js) + "\n```"}}]})
    ans2 = spark.createDataFrame([("m2", env2), ("m3", env2)], "msg_id string, response string")
    proc = spark.createDataFrame([("m3|T1",)], "key string")
    k = jobs.scholarships_keyed(ans2, proc)
    assert rows(k["rows"], "title", "closing_date", "link") == [("T1", "June 1", "https://t1.org")]
    assert rows(k["keys"], "key") == [("m2|T1",)]


def test_camp_and_geocode_jobs(spark):
    camp = """<h1>Boys ID Camp</h1><div class="location">Austin, TX</div><p>Ages: 12+</p>
    <p>Dates: June 1 to June 3</p><p>$300</p>
    <script type="application/ld+json">{"@type": "Event", "name": "Clinic D3", "startDate": "2024-06-01"}</script>"""
    pages = spark.createDataFrame([(1, "https://camps.example.org/a", camp)], "page_id long, url string, html string")
    gz = spark.createDataFrame([("boys id camp, austin, tx", 30.2, -97.7, "Austin")],
                               "address_norm string, lat double, lng double, city string")
    b = jobs.branded_camps(pages, gz).first()
    assert (b["camp_name"], b["grade_level"], b["gender"], b["start_date"], b["latitude"]) == \
        ("Boys ID Camp", "Elementary School", "Boys", "June 1", 30.2)
    ev = jobs.event_camps(pages).first()
    assert (ev["name"], ev["division"], ev["start_unix"]) == ("Clinic D3", "D3", 1717200000)
    base = spark.createDataFrame([(1, "https://camps.example.org/a", "", "ID", "", "", "", "")],
                                 "page_id long, camp_info_url string, camp_found string, event_details string, "
                                 "start_date string, end_date string, ages_grade_level string, cost string")
    p = jobs.partner_camps(pages, base, None, "Camp text:\n{snippet}")
    assert p["requests"].first()["prompt"].startswith("Camp text:\nAges: 12+\nDates: June 1 to June 3\n$300")
    rows_ = spark.createDataFrame([(2, "Austin,  TX"), (3, "Nowhere"), (9, "Austin, TX")], "row_id long, address string")
    gz2 = spark.createDataFrame([("austin, tx", 30.2, -97.7, "Austin")], "address_norm string, lat double, lng double, city string")
    assert rows(jobs.showcase_geocode(rows_, gz2, 2, 3), "row_id", "latitude") == [(2, 30.2), (3, None)]
    assert rows(jobs.geocode_file(rows_, gz2), "row_id", "city") == [(2, "Austin"), (3, None), (9, "Austin")]
    caps = spark.createDataFrame([(1, "https://camps.example.org/a", 200, None)], "page_id long, url string, status int, error string")
    assert rows(jobs.link_status(spark.createDataFrame([("https://camps.example.org/a",)], "url string"), caps),
                "status_text") == [("Loaded Successfully",)]


def test_rankings_strategies_order_and_large_page(spark):
    import re
    filler = "<i></i>" * 23000
    html = {1: f"<body>{filler}<table><tr><td>2</td><td>Beta U</td></tr><tr><td>1</td><td>Alpha U</td></tr></table></body>",
            2: "<body><div>1. North State</div><div>2) South &amp; West, Tech</div><div>3. bad; name</div></body>",
            3: "<body><span class='team'>x</span><div>7 <b>Gamma</b> U</div></body>", 4: "<body><a>#4 - Delta U</a></body>"}
    pages = spark.createDataFrame(list(html.items()), "page_id long, html string")
    got = sorted((r["page_id"], r["poll_rank"], re.sub(" +", " ", r["name"]))
                 for r in jobs.rankings(pages, _master(spark), "men", "D2")["rankings"].collect())
    assert got == [(1, 1, "Alpha U"), (1, 2, "Beta U"), (2, 1, "North State"), (2, 2, "South & West, Tech"), (3, 7, "Gamma U"), (4, 4, "Delta U")]
