import random

from pyspark.sql import functions as F

from conftest import rows
from tessera.operators import aggregate as ag
from tessera.operators import reconcile as rc


def test_rank_in_group_hot_group_spans_tasks(spark):
    rng = random.Random(5)
    data = [(0 if rng.random() < 0.6 else rng.randint(1, 5), rng.random(), i) for i in range(3000)]
    df = spark.createDataFrame(data, "g int, v double, id long")
    out = ag.rank_in_group(df, ["g"], "v", "id")
    got = {r["id"]: r["rank"] for r in out.collect()}
    exp = {}
    for g in set(d[0] for d in data):
        grp = sorted([d for d in data if d[0] == g], key=lambda d: (-d[1], d[2]))
        for k, d in enumerate(grp, 1):
            exp[d[2]] = k
    assert got == exp


def test_points_standing(spark):
    df = spark.createDataFrame([
        ("A", 1, "a1", 3.0, None), ("A", 2, "a2", None, None), ("A", 3, "a3", 3.0, None), ("A", 4, "a4", 9.0, None),
        ("B", 1, "b1", None, ""), ("B", 2, "b2", None, "7"), ("B", 3, "b3", None, None)],
        "conference string, pos int, school string, pts double, standing string")
    got = rows(ag.points_standing(df), "school", "standing")
    assert got == [("a1", "2"), ("a2", "4"), ("a3", "3"), ("a4", "1"), ("b1", "1"), ("b2", "7"), ("b3", "3")]


def test_roster_counts_and_wide(spark):
    df = spark.createDataFrame([("U", "men", "D/M", "freshman"), ("U", "men", "gk", "Senior"), ("U", "men", "", "x"),
                                ("U", "women", "f", "graduate student")], "u string, g string, position string, year string")
    c = ag.roster_counts(df, ["u", "g"]).orderBy("g").collect()
    men = c[0].asDict()
    assert (men["defenders"], men["midfielders"], men["goalkeepers"], men["forwards"], men["freshman"], men["senior"]) == \
        (1, 1, 1, 0, 1, 1)
    w = ag.wide_by(ag.roster_counts(df, ["u", "g"]), ["u"], "g", ["men", "women"], ["forwards", "graduate_student"]).first()
    assert (w["men_forwards"], w["women_forwards"], w["women_graduate_student"]) == (0, 1, 1)


def test_keep_first_lowest_n_text_counts(spark):
    df = spark.createDataFrame([(1, "a", 5, "x"), (1, "a", 3, "y"), (1, "b", 9, "z"), (2, "a", 1, "w")],
                               "u int, t string, o int, v string")
    assert rows(ag.keep_first(df, ["u", "t"], ["o"]), "u", "t", "v") == [(1, "a", "y"), (1, "b", "z"), (2, "a", "w")]
    m = spark.createDataFrame([(1, "0.5", "no"), (2, "", None), (3, "n/a", "yes"), (4, "0.1", "0"), (5, "x", None)],
                              "pos int, s string, c string")
    from tessera.functions.status import is_confirmed
    low = ag.lowest_n(m, "s", "pos", 3, confirmed=is_confirmed(F.col("c"))).collect()
    assert [(r["pos"], r["s"]) for r in low] == [(2, 0.0), (5, 0.0), (4, 0.1)]
    cards = spark.createDataFrame([(1, "John Defender Freshman"), (1, "GK midfielder sophomore")], "page_id int, text string")
    t = ag.text_roster_counts(cards, ["page_id"]).first()
    assert (t["defenders"], t["goalkeepers"], t["midfielders"], t["freshman"], t["sophomore"]) == (1, 1, 1, 1, 1)


def test_duplicate_count_flags_only_that_key(spark):
    df = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b")], "id int, k string")
    assert rows(ag.duplicate_count(df, ["k"]), "id", "dup_count", "duplicate") == \
        [(1, 2, "Duplicate"), (2, 2, "Duplicate"), (3, 1, "")]


def test_change_log_apply(spark):
    ch = spark.createDataFrame([
        (1, 1, "Head Coach", "e", "Ann", "Lee", "ann@x.edu"),
        (1, 2, "Head Coach", "J X", "Bo", "Ray", None),
        (1, 3, "Head Coach", "#", "No", "Pe", "no@x"),
        (2, 4, "Assistant Coach", "j", "Cy", "Do", "cy@x"),
        (2, 5, "Interim Head Coach", "x", None, "Solo", "s@x"),
        (2, 6, "Head Coach", None, "Z", "Z", "z@x"),
        (2, 7, "Head Coach", "e", "E", "E", None)],
        "row_id long, seq long, position string, change string, first_name string, last_name string, email_address string")
    w = rc.change_log_writes(ch, {"name": "men_coach_name", "email": "men_coach_email"})
    m = spark.createDataFrame([(1, "Old", "old@x"), (2, "Old2", None), (3, "Keep", "k@x")],
                              "row_id long, men_coach_name string, men_coach_email string")
    out = rows(rc.apply_cell_writes(m, w, ["men_coach_name", "men_coach_email"]), "row_id", "men_coach_name", "men_coach_email")
    assert out == [(1, "Bo Ray", "ann@x.edu"), (2, "Solo", "s@x"), (3, "Keep", "k@x")]


def test_keyed_upsert_and_canonical_join(spark):
    from tessera.functions.urls import canonical_url
    master = spark.createDataFrame([(3, "https://www.a.edu/", 1), (4, "http://b.edu", 2), (5, "c.edu", None)],
                                   "row_id long, site string, undergraduates int")
    res = spark.createDataFrame([(1, "a.edu", 100), (2, "https://A.edu", 200), (3, "waf.b.edu/", 300)],
                                "o long, url string, ug int")
    out = rows(rc.keyed_upsert(master, res, canonical_url(F.col("site")), canonical_url(F.col("url")),
                               {"ug": "undergraduates"}, order="o"), "row_id", "undergraduates", "duplicate")
    assert out == [(3, 200, "Duplicate"), (4, 300, ""), (5, None, "")]
    j = rows(rc.canonical_join(res, master.union(spark.createDataFrame([(9, "a.edu", 0)], master.schema)), "url", "site"),
             "o", "row_id")
    assert j == [(1, 9), (2, 9), (3, 4)]                                  # last master row wins


def test_anti_known_geocode_link_status(spark):
    new = spark.createDataFrame([(1, "1. Big Award", "a.org/x"), (2, "big award", "https://a.org/x."), (3, "Other", "b.org")],
                                "o int, title string, link string")
    known = spark.createDataFrame([("Other ", "https://b.org")], "title string, link string")
    k = rc.title_link_key(F.col("title"), F.col("link"))
    out = rows(rc.anti_known(new, known, k, rc.title_link_key(F.col("title"), F.col("link")), order=["o"]), "o")
    assert out == [(1,)]
    gz = spark.createDataFrame([("austin, tx", 30.2, -97.7, "Austin")], "address_norm string, lat double, lng double, city string")
    df = spark.createDataFrame([(1, " Austin,  TX"), (2, "Nowhere"), (3, "AUSTIN, TX")], "id int, address string")
    g = rows(rc.geocode(df, F.col("address"), gz), "id", "latitude", "city")
    assert g == [(1, 30.2, "Austin"), (2, None, None), (3, 30.2, "Austin")]
    caps = spark.createDataFrame([(1, "u1", 200, None), (2, "u2", 404, None)], "page_id long, url string, status int, error string")
    rs = spark.createDataFrame([("u1",), ("u2",), ("u3",), ("",)], "url string")
    assert rows(rc.link_status(rs, caps), "url", "status_text") == [
        ("", "No URL Provided"), ("u1", "Loaded Successfully"), ("u2", "Error 404"), ("u3", "Not captured")]
