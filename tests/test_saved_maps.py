"""Saved column maps: as-of versions, checks against the header, fall back."""
import datetime as dt
import os

from pyspark.sql import functions as F

from tessera.operators import saved_maps as sm
from tessera.streaming.tables import Tables

KEYS = ["site"]
HEAD = "page_id long, table_id int, header array<string>, header_tags array<string>, visible array<int>, site string, captured_at timestamp"
MAPS = "site string, " + sm.MAP_SCHEMA


def day(n):
    return dt.datetime(2024, 1, 1) + dt.timedelta(days=n)


def head(page, site, when, cells, tags=None, visible=None):
    return (page, 0, cells, tags or ["th"] * len(cells or []), list(range(len(cells or []))) if visible is None else visible, site, day(when))


def test_resolution(spark):
    idx = {"school": 0, "conf_record": 1, "overall_record": 2}
    maps = [("a", day(5), idx, None, False), ("a", day(10), {"school": 2, "conf_record": 0, "overall_record": 1}, None, False),
            ("b", day(0), None, {"name": ["school"], "rec": ["conf_record", "overall_record"], "w": ["standing"]}, False),
            ("c", day(0), idx, None, True), ("d", day(0), {"school": 9, "conf_record": 1, "overall_record": 2}, {"team": ["school"]}, False),
            (None, day(0), idx, None, None)]
    heads = [head(1, "a", 4, ["School", "Conf", "All"]), head(2, "a", 5, ["x", "y", "z"]), head(3, "a", 30, ["x", "y", "z"]), head(4, "a", 30, ["x", "y"]),
             head(5, "b", 1, ["Name [1]", "Rec", "REC", "Rec", "W", "w"]), head(6, "b", 1, ["Name", "Rec", "Rec"], visible=[0, 2]), head(7, "b", 1, ["?", "Rec"]),
             head(8, "c", 1, ["n", "t", "a", "b"], ["th", "th", "td", "td"]), head(9, "c", 1, ["n", "t"], ["th", "td"]),
             head(10, "d", 1, ["Team", "Conf", "Overall"]), head(11, None, 1, ["x", "y", "z"]), head(12, "new", 1, ["Pos", "Team", "Conf"]),
             head(13, "a", 30, None)]
    H, M = spark.createDataFrame(heads, HEAD), spark.createDataFrame(maps, MAPS)
    got = {r["page_id"]: (r["map_source"], r["field_idx"], r["accepted"], r["review"]) for r in sm.resolve(H, M, KEYS, "captured_at").collect()}
    assert got == {
        1: ("keyword", {"school": 0, "conf_record": 1}, True, []),                      # before the first version
        2: ("index", idx, True, []), 3: ("index", {"school": 2, "conf_record": 0, "overall_record": 1}, True, []),
        4: ("keyword", None, False, []),                                                # a position outside the header
        5: ("name", {"school": 0, "conf_record": 1, "overall_record": 2, "standing": 4}, True, ["standing"]),
        6: ("name", {"school": 0, "conf_record": 2}, True, []), 7: ("keyword", None, False, []),
        8: ("index", {"school": 0, "conf_record": 2, "overall_record": 3}, True, []),   # n-th td
        9: ("keyword", None, False, []), 10: ("keyword", {"school": 0, "conf_record": 1, "overall_record": 2}, True, []),
        11: ("index", idx, True, []), 12: ("keyword", {"school": 1, "conf_record": 2, "standing": 0}, True, []), 13: ("keyword", None, False, [])}


def test_versions_are_saved_when_they_change(spark, tmpdir_run):
    tables = Tables(spark, os.path.join(tmpdir_run, "t"), buckets=2)
    empty = spark.createDataFrame([], MAPS)
    for when, cells in ((1, ["Team", "Conf", "Overall"]), (2, ["Team", "Conf", "Overall"]), (3, ["Rank", "Team", "Conf", "Overall"])):
        H = spark.createDataFrame([head(1, "s", when, cells), head(2, "s", when, cells), head(3, "other", when, ["?", "!"])], HEAD)
        known = sm.load(tables, KEYS) if tables.has(sm.TABLE) else empty
        res = sm.resolve(H, known if when < 3 else empty, KEYS, "captured_at")
        sm.save(tables, sm.learned(res, KEYS, "captured_at"), KEYS, batch_id=when)
        sm.save(tables, sm.learned(res, KEYS, "captured_at"), KEYS, batch_id=when)
    got = sorted((r["site"], r["valid_from"], r["by_index"], r["by_name"]) for r in sm.load(tables, KEYS).collect())
    assert got == [("s", day(1), {"school": 0, "conf_record": 1, "overall_record": 2}, {"team": ["school"], "conf": ["conf_record"], "overall": ["overall_record"]}),
                   ("s", day(3), {"school": 1, "conf_record": 2, "overall_record": 3, "standing": 0},
                    {"rank": ["standing"], "team": ["school"], "conf": ["conf_record"], "overall": ["overall_record"]})]
    H = spark.createDataFrame([head(1, "s", 9, ["a", "b", "c", "d"]), head(2, "s", 2, ["a", "b", "c", "d"])], HEAD)
    got = {r["page_id"]: (r["map_source"], r["field_idx"]["school"]) for r in sm.resolve(H, sm.load(tables, KEYS), KEYS, "captured_at").collect()}
    assert got == {1: ("index", 1), 2: ("index", 0)}


def test_entries_of_pages_with_saved_maps(spark):
    from tessera.plans import jobs
    page = "<main><h2>Alpha</h2><table><tr><th>n</th><td>x</td><td>y</td></tr><tr><th>North</th><td>1-0</td><td>2-0</td></tr></table></main>"
    pages = spark.createDataFrame([(1, page), (2, page.replace("North", "12"))], "page_id long, html string")
    sites = spark.createDataFrame([(1, "s", day(3)), (2, "t", day(3))], "page_id long, site string, captured_at timestamp")
    maps = spark.createDataFrame([("s", day(1), {"school": 0, "conf_record": 1, "overall_record": 2}, None, True),
                                  ("t", day(1), {"school": 0, "conf_record": 1, "overall_record": 2}, None, False)], MAPS)
    got = sorted((r["page_id"], r["conference"], r["school"], r["conf_record"], r["overall_record"])
                 for r in jobs.standing_entries(pages, maps, sites, ("site",)).collect())
    assert got == [(1, "Alpha", "North", "1-0", "2-0"), (2, "Alpha", "12", "1-0", "2-0")]     # saved positions are taken as they are
