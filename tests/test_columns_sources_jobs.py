import base64
import os

from pyspark.sql import functions as F

from conftest import rows
from tessera.operators import columns as co
from tessera.sources import files as fs
from tessera.sources import pages as pg


def test_resolve_columns(spark):
    df = spark.createDataFrame([(1, "a", "b")], "`Row` int, `University Name` string, `Men Coach` string")
    out = co.resolve_columns(df, {"name": ["university", "school"], "coach": ["coach"], "x": ["zzz"]}, mode="contains")
    assert out.columns == ["name", "coach", "x"] and out.first()["name"] == "a" and out.first()["x"] is None
    out2 = co.resolve_columns(df, {"name": ["school"]}, positions={"name": 1})
    assert out2.first()["name"] == "a"


def test_keyword_and_name_mapping(spark):
    h = spark.createDataFrame([(1, 1, ["Rank", "Team", "Conf (W-L)", "Overall", "Pts"], [0, 1, 2, 3, 4]),
                               (1, 2, ["Name", "Record"], [0, 1])],
                              "page_id long, table_id int, header array<string>, visible array<int>")
    m = {r["table_id"]: (dict(r["field_idx"] or {}), r["accepted"]) for r in co.map_by_keyword(h).collect()}
    assert m[1] == ({"standing": 0, "school": 1, "conf_record": 2, "overall_record": 3}, True)
    assert m[2][1] is False                       # no school field: not accepted (D1)
    h2 = spark.createDataFrame([(1, 1, ["School", "Record (W-L)", "Record"], [0, 1, 2])],
                               "page_id long, table_id int, header array<string>, visible array<int>")
    n = co.map_by_name(h2, {"school": "school", "record": ["conf_record", "overall_record"]}).first()
    assert dict(n["field_idx"]) == {"school": 0, "conf_record": 1, "overall_record": 2}      # D2
    r, rev = co.names_to_indices(h2, {"school": "School", "rec": "record"})
    assert rows(r, "field", "i") == [("rec", 2), ("school", 0)] and rev.count() == 0
    df = spark.createDataFrame([(["th", "td", "td", "td"], 2)], "tags array<string>, v int")
    assert df.select(co.th_td_index(F.col("tags"), F.col("v"))).first()[0] == 2
    df = spark.createDataFrame([(["A", "B", "C"], {"school": 1, "conf_record": 2, "overall_record": 0})],
                               "h array<string>, idx map<string,int>")
    assert dict(df.select(co.indices_to_names(F.col("h"), F.col("idx"))).first()[0]) == {
        "B": "school", "C": "conf_record", "A": "overall_record"}


def test_extract_standing_rows(spark):
    rec = spark.createDataFrame([
        (["1", "North College*", "5-1", "9-2", "15"], ["Pos", "Team", "Conf", "Overall", "PTS"], [0, 1, 2, 3, 4],
         {"standing": 0, "school": 1, "conf_record": 2, "overall_record": 3}, 1),
        (["", "12", "x", "South (OH) U", "4-4"], ["Pos", "Team", "Conf", "Overall", "PTS"], [0, 1, 2, 3, 4],
         {"standing": 0, "school": 1, "conf_record": 2, "overall_record": 3}, 2)],
        "cells array<string>, header array<string>, visible array<int>, field_idx map<string,int>, row_idx int")
    out = rows(co.extract_standing_rows(rec), "school", "conf_record", "standing", "pts")
    # row 2: the mapped school "12" has no letter -> first cell with a letter ("x"); records fall back likewise
    assert out == [("North College", "5-1", "1", 15.0), ("x", "4-4", "2", 4.0)]


def test_config_report_and_start_at(spark):
    cfg = spark.createDataFrame([("men", "d2", 1, "A", "u", "x"), ("men", "d2", 2, "B", "u", None),
                                 ("men", "d2", 3, "C", None, None)],
                                "gender string, division string, seq int, conference string, url string, xpath string")
    ready, rest = co.config_report(cfg)
    assert rows(ready, "conference") == [("A",)] and rows(rest, "conference", "missing") == [("B", "xpath"), ("C", "url, xpath")]
    assert rows(co.start_at(cfg, "B"), "conference") == [("B",), ("C",)]


def test_read_change_logs(spark, tmpdir_run):
    d = os.path.join(tmpdir_run, "logs")
    os.makedirs(d)
    pre = "Title line\n,,\nnotes\n,\n,\n"
    with open(os.path.join(d, "Women DII changes.csv"), "w") as f:
        f.write(pre + "Conference,School,Position,First name,Last name,,Email address\n"
                "GLIAC,North U,Head Coach,Ann,\"Lee\nJr\",e,ann@x.edu\nGLIAC,South U,Head Coach,Bo,Ray,J X,\n")
    with open(os.path.join(d, "men_NAIA.csv"), "w") as f:
        f.write("Conference,School,Position,First name,Last name,Change,Email address\nX,Y,Head Coach,C,D,x,c@x\n")
    with open(os.path.join(d, "other.csv"), "w") as f:
        f.write("Conference,School\nA,B\n")
    df = fs.read_change_logs(spark, os.path.join(d, "*.csv"))
    got = rows(df, "gender", "division", "pos", "school", "last_name", "change", "email_address")
    assert got == [("men", "NAIA", 0, "Y", "D", "x", "c@x"), ("women", "DII", 0, "North U", "Lee\nJr", "e", "ann@x.edu"),
                   ("women", "DII", 1, "South U", "Ray", "J X", None)]


def test_mail_decode_and_body(spark):
    html = "<p>Scholarship A</p><p>Deadline: May 1</p>"
    enc = base64.urlsafe_b64encode(html.encode()).decode()
    mail = spark.createDataFrame([("m1", "Offers", "short", [("text/plain", "eA"), ("text/html", enc)]),
                                  ("m2", "", "x" * 60, [("text/plain", "eA")])],
                                 "id string, subject string, plain string, parts array<struct<mimeType:string,data:string>>")
    x = mail.select("id", pg.mail_html(F.col("parts")).alias("h")).withColumn(
        "body", pg.mail_body(F.lit("short"), F.col("h")))   # plain part under 50 chars -> HTML as text
    got = {r["id"]: (r["h"], r["body"]) for r in x.collect()}
    assert got["m1"] == (html, "Scholarship A\nDeadline: May 1")
    assert got["m2"][0] is None


def test_first_hit_and_candidates(spark):
    u = spark.createDataFrame([("k1", "https://s.edu/sports/2024-25/roster")], "k string, url string")
    c = pg.yearless_candidates(u, "k", season_start=2025)
    assert rows(c, "priority", "candidate_url") == [(0, "https://s.edu/sports/2025-26/roster"),
                                                    (1, "https://s.edu/sports/roster")]
    cand = spark.createDataFrame([("a", 0, 0), ("a", 1, 5), ("a", 2, 7), ("b", 0, 0)], "e string, priority int, n int")
    assert rows(pg.first_hit(cand, "e", "priority", F.col("n") > 0), "e", "priority") == [("a", 1)]


STANDINGS = """<html><body><main><h2>Alpha Conference</h2><table>
<tr><th>Pos</th><th>Team</th><th>Conf</th><th>Overall</th><th>PTS</th></tr>
<tr><td>1</td><td>North State*</td><td>5-1</td><td>9-2-1</td><td>12</td></tr>
<tr><td>2</td><td>South Tech (OH)</td><td>4-2</td><td>8-3</td><td>15</td></tr>
</table></main></body></html>"""


def test_conference_standings_job(spark):
    from tessera.plans import jobs
    pages = spark.createDataFrame([(1, "https://c.example.org/s", STANDINGS)], "page_id long, url string, html string")
    master = spark.createDataFrame([(3, "North State University", "Alpha Conference", "D2"),
                                    (4, "South Tech", "Alpha Conference", "D2"), (5, "Unrelated", "", "")],
                                   "row_id long, university_name string, men_conference string, men_ncaa_division string")
    out = jobs.conference_standings(pages, master, "men", k=3, accept_at=0.8)
    st = rows(out["standings"], "conference", "school", "standing")
    assert st == [("Alpha Conference", "North State", "2"), ("Alpha Conference", "South Tech", "1")]
    acc = rows(out["accepted"], "left_key", "chosen_row_id")
    assert ("Alpha Conference|South Tech", 4) in acc
    w = rows(out["writes"], "row_id", "column", "value")
    assert (4, "men_conference_standing", "1") in w and (4, "men_conference_record", "4-2") in w


def test_entry_and_registry(spark):
    import __spark_entry__ as e
    df = e.entry(spark)
    assert df.count() > 0 and df.columns == ["page_id", "p_idx", "outer_html", "text"]
    q, o = e.queries(), e.oracle_sql()
    assert set(o) <= set(q) and len(q) >= 30
