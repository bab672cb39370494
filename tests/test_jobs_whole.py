"""The jobs from their first step: seasons, camp lists, mail, write-back."""
import base64
import datetime as dt
import json
import os

from conftest import rows
from tessera.plans import jobs
from tessera.streaming import keyed, runs
from tessera.streaming.tables import Tables


def card(pos, year):
    return (f'<li class="sidearm-roster-player"><span class="sidearm-roster-player-position">{pos}</span>'
            f'<span class="sidearm-roster-player-academic-year">{year}</span> {pos} sophomore</li>')


def roster(*players):
    return '<html><meta name="generator" content="Sidearm"><ul>' + "".join(card(*p) for p in players) + "</ul></html>"


def test_roster_counts_follow_the_season(spark):
    teams = spark.createDataFrame([
        ("A", "men", "https://a.edu/msoc/2019-20/roster"), ("A", "women", "https://a.edu/wsoc/2019/roster"),
        ("B", "men", "https://b.edu/msoc/2019/roster"), ("B", "women", "https://b.edu/wsoc/roster"),
        ("C", "men", "https://c.edu/msoc/2019-20/roster"), ("D", "men", "")], "university string, gender string, url string")
    caps = spark.createDataFrame([
        (1, "https://a.edu/msoc/2025-26/roster", 200, roster(("D", "Fr."), ("GK", "Sr."))),
        (2, "https://a.edu/wsoc/2025/roster", 200, roster(("F", "Jr."))),            # /wsoc/roster was not captured: the year is replaced
        (3, "https://b.edu/msoc/roster", 200, roster(("M", "So."))),                 # loads without a year: not looked up (C10)
        (4, "https://b.edu/wsoc/roster", 200, roster(("M", "So."))),
        (5, "https://c.edu/msoc/2025-26/roster", 200, "<p>empty</p>"),               # no players: the form without the year counts
        (6, "https://c.edu/msoc/roster", 200, roster(("F", "Fr."), ("F", "Fr.")))], "page_id long, url string, status int, html string")
    out = {r["university"]: r for r in jobs.roster_counts(teams, caps, 2025, 2025).collect()}
    a, b, c, d = (out[u] for u in "ABCD")
    assert (a["men_defenders"], a["men_goalkeepers"], a["men_freshman"], a["men_senior"], a["women_forwards"]) == (1, 1, 1, 1, 1)
    assert (a["men_updated_url"], a["women_updated_url"]) == ("https://a.edu/msoc/2025-26/roster", "https://a.edu/wsoc/2025/roster")
    assert (b["men_updated_url"], b["men_midfielders"], b["women_midfielders"], b["men_candidate_url"]) == ("https://b.edu/msoc/roster", 0, 0, None)
    assert (c["men_forwards"], c["men_candidate_url"], c["women_forwards"]) == (2, "https://c.edu/msoc/roster", None)
    assert (d["men_forwards"], d["men_url"]) == (0, "")
    # without the season logic every URL is looked up
    old = {r["university"]: r for r in jobs.roster_counts(teams, caps, 2025).collect()}
    assert (old["A"]["men_defenders"], old["B"]["men_midfielders"], old["B"]["women_midfielders"]) == (1, 1, 1)


def test_roster_card_texts(spark):
    teams = spark.createDataFrame([("A", "men", "https://a.edu/msoc/2019-20/roster")], "university string, gender string, url string")
    caps = spark.createDataFrame([(1, "https://a.edu/msoc/2025-26/roster", 200, roster(("goalkeeper", "x"), ("forward", "y")))],
                                 "page_id long, url string, status int, html string")
    c = jobs.roster_counts_text(jobs.roster_card_texts(teams, caps, 2025, 2025), ("_k",)).first()
    assert (c["_k"], c["goalkeepers"], c["forwards"], c["sophomore"]) == ("A|men", 1, 1, 2)


def test_camp_list_append_and_union(spark, tmpdir_run):
    page = ("<table><tr><th>State</th><th>Host</th></tr><tr><td>OH</td><td><a href='/c1'>Ohio Camp</a></td></tr>"
            "<tr><td>TX</td><td>Texas State</td></tr><tr><td>1</td><td>2</td><td>3</td></tr></table>")
    pages = spark.createDataFrame([(1, "https://x.org/womens-camps", page)], "page_id long, url string, html string")
    seed = jobs.camp_list(pages)
    assert rows(seed, "state", "organiser", "camp_info_url", "gender") == [("OH", "Ohio", "/c1", "Women"), ("TX", "Texas State", "", "Women")]
    tables = Tables(spark, os.path.join(tmpdir_run, "t"), buckets=4)
    schema = "organiser string, url string, event_details string, start_date string, pos int, sub_pos int, page_load string"
    batch = spark.createDataFrame([("Ohio", "u1", "ID", "June 1", 2, 1, "OK"), ("Ohio", "u1", "ID", "May 1", 2, 0, "OK"), ("Texas", "u2", "", "", 1, 0, "OK"),
                                   ("Bad", "u3", "", "", 3, 0, "Error 404"), ("Ohio", "u1", "ID", "June 1", 9, 0, "OK")], schema)
    jobs.camp_rows_append(tables, batch, batch_id=0)
    jobs.camp_rows_append(tables, batch, batch_id=0)
    more = spark.createDataFrame([("Ohio", "u1", "ID", "June 1", 1, 0, "OK"), ("New", "u9", "x", "y", 5, 0, "OK"), ("Bad", "u3", "", "", 3, 0, None)], schema)
    jobs.camp_rows_append(tables, more, batch_id=1)
    assert rows(runs.appended(tables, "camps"), "row_number", "organiser", "start_date") == [(2, "Texas", ""), (3, "Ohio", "May 1"), (4, "Ohio", "June 1"), (5, "New", "y")]
    assert rows(runs.appended(tables, "camp_errors"), "row_number", "organiser") == [(2, "Bad")]
    both = jobs.all_sites_camps({"list": seed.select("organiser"), "partner": batch.select("organiser", "url")})
    assert both.count() == 7 and both.where("source = 'list' and url is null").count() == 2


def test_showcase_update_and_pages(spark):
    events = spark.createDataFrame([(2, "Austin, TX", 1.0, None), (3, "Nowhere", 5.0, 6.0), (4, "Austin,  TX", None, None)],
                                   "row_id long, address string, latitude double, longitude double")
    gz = spark.createDataFrame([("austin, tx", 30.2, -97.7, "Austin")], "address_norm string, lat double, lng double, city string")
    out = jobs.showcase_update(events, gz, 2, 3)
    assert rows(out, "row_id", "latitude", "longitude") == [(2, 30.2, -97.7), (3, 5.0, 6.0), (4, None, None)] and out.columns == events.columns
    pages = spark.createDataFrame([(1, "u1", "<div class='event-row'> Dallas <b>TX</b></div><p class=price>$1</p>"), (2, "u2", "<p>none</p>")],
                                  "page_id long, url string, html string")
    got = rows(jobs.showcase_pages(pages, {"location": ("div", "event-row"), "price": ("p", "price")}), "url", "location", "price")
    assert got == [("u1", "Dallas TX", "$1"), ("u2", "", "")]


def mail(spark, n=12):
    enc = lambda s: base64.urlsafe_b64encode(s.encode()).decode()
    html = "<p>Award {}</p><p>two</p><p>three</p><p>four</p>"
    long = "Begin forwarded message\nFrom: x\nSubject: old\n" + "An award of {} dollars for many students in every state of the union."
    data = [(f"m{k:02d}", dt.datetime(2024, 5, 1) + dt.timedelta(days=k), f"s{k}" if k != 5 else " ", ["aid"] if k != 6 else ["x"],
             long.format(k) if k % 2 else "short", [("text/html", enc(html.format(k)))]) for k in range(n)]
    data.append(("old", dt.datetime(2020, 1, 1), "s", ["aid"], "", []))
    return spark.createDataFrame(data, "id string, ts timestamp, subject string, labels array<string>, plain string, parts array<struct<mimeType:string,data:string>>")


def test_scholarship_mail_runs(spark):
    m = mail(spark)
    # newest first, m05 without a subject, m06 of another label: the list is m11 m10 m09 m08 m07 m04 ...
    assert rows(jobs.listed_mail(m, "aid", "2024-06-01", 1, 4), "id") == [("m07",), ("m08",), ("m09",), ("m10",)]
    req = jobs.scholarship_run(m, "Find: {snippet}", "aid", "2024-06-01", offset=1, limit=2)
    assert rows(req, "msg_id", "chunk_idx", "prompt")[1] == ("m09", 1, "Find: <p>four</p>") and req.count() == 4
    k = {r["msg_id"]: r["prompt"] for r in jobs.keyed_requests(m, "[{subject}] {snippet}", "aid", "2024-06-01").collect()}
    assert len(k) == 10 and k["m07"] == "[s7] An award of 7 dollars for many students in every state of the union."
    assert k["m08"].startswith("[s8] Award 8\ntwo")


def test_scholarships_import_once(spark, tmpdir_run):
    tables = Tables(spark, os.path.join(tmpdir_run, "t"), buckets=4)

    def answers(**items):
        env = [(m, json.dumps({"choices": [{"message": {"content": json.dumps(v)}}]})) for m, v in items.items()]
        return spark.createDataFrame(env, "msg_id string, response string")
    one = answers(m1=[{"title": "T1", "deadline": "June 1"}, {"title": "T2"}, {"title": ""}], m2=[{"title": "T1"}])
    two = answers(m1=[{"title": "T1", "amount": "changed"}, {"title": "T3"}])
    for n, a in ((0, one), (0, one), (1, two), (2, two)):
        jobs.scholarships_import(tables, a, batch_id=n)
    assert rows(tables.read("scholarships"), "title", "closing_date", "imported") == [("T1", "", 0), ("T1", "June 1", 0), ("T2", "", 0), ("T3", "", 1)]
    assert rows(tables.read(keyed.LOG), "key", "status") == [("m1|T1", "done"), ("m1|T2", "done"), ("m1|T3", "done"), ("m2|T1", "done")]
