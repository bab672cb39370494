import datetime
import json
import os

from pyspark.sql import functions as F

from conftest import rows
from tessera.operators import aggregate as ag
from tessera.operators import html as hx
from tessera.operators import extract as ex
from tessera.operators import reconcile as rc
from tessera.sources import files as fs
from tessera.sources import pages as pg
from tessera.sources import sinks as sk


def test_sinks_and_reads(spark, tmpdir_run):
    df = spark.createDataFrame([(1, "a")], "id int, name string")
    p = os.path.join(tmpdir_run, "out_csv")
    sk.write_csv(df, p, ["id", "name", "error"])
    back = fs.read_csv(spark, p, "id int, name string, error string", required=["id"])
    assert rows(back) == [(1, "a", None)]                    # error column always present (D13)
    jp = os.path.join(tmpdir_run, "map.json")
    with open(jp, "w") as f:
        json.dump([{"camp_school_name": "A", "similarity_score": 0.5}, {"camp_school_name": "B"}], f)
    j = fs.read_json_array(spark, jp, "camp_school_name string, similarity_score double")
    assert rows(j) == [("A", 0.5), ("B", None)]
    ap = os.path.join(tmpdir_run, "app")
    sk.append_parquet(df, ap)
    sk.append_parquet(df, ap)
    assert spark.read.parquet(ap).count() == 2
    sk.write_json_lines(df, os.path.join(tmpdir_run, "jl"))
    assert spark.read.json(os.path.join(tmpdir_run, "jl")).count() == 1
    c = sk.cut_lineage(df.withColumn("x", F.lit(1)))
    assert c.count() == 1
    try:
        fs.require_columns(df, ["address"])
        raise AssertionError("expected a missing-column error")
    except ValueError:
        pass
    assert rows(fs.row_range(spark.createDataFrame([(i,) for i in range(10)], "row_id int"), 3, 5)) == [(3,), (4,), (5,)]


def test_scan_master_and_pages(spark, tmpdir_run):
    m = spark.createDataFrame([(3, " North U ", "D2", "GLIAC"), (4, "", "D1", "X"), (5, "West", None, None)],
                              "row_id long, university_name string, men_ncaa_division string, men_conference string")
    assert rows(fs.scan_master(m, "men")) == [(3, "North U", "D2"), (5, "West", "")]
    assert rows(fs.scan_master(m, "men", attr="conference")) == [(3, "North U", "GLIAC"), (5, "West", "")]
    p = os.path.join(tmpdir_run, "caps")
    spark.createDataFrame([(1, "u", "<p>x</p>")], "page_id long, url string, html string").write.parquet(p)
    assert rows(pg.scan_pages(spark, p), "page_id", "status", "error") == [(1, 200, None)]


def test_extract_fields_and_small_aggregates(spark):
    pages = spark.createDataFrame([(1, "u1", '<div class="loc"> Austin </div><span class="price">$5</span>'),
                                   (2, "u2", "<p>nothing</p>")], "page_id long, url string, html string")
    n = hx.html_nodes(pages.select("page_id", "html"))
    out = rows(ex.extract_fields(n, pages, {"location": ("div", "loc"), "price": ("span", "price")}),
               "page_id", "location", "price")
    assert out == [(1, "Austin", "$5"), (2, "", "")]
    df = spark.createDataFrame([(1, "a", 3), (1, "b", 1), (2, "c", 2)], "k int, v string, o int")
    assert rows(ag.first_value(df, ["k"], "v", "o"), "k", "v") == [(1, "b"), (2, "c")]
    assert rows(ag.last_value(df, ["k"], "v", "o"), "k", "v") == [(1, "a"), (2, "c")]
    assert [r["o"] for r in ag.head_n(df, [F.col("o")], 2).collect()] == [1, 2]
    assert [r["o"] for r in ag.slice_rows(df, [F.col("o")], 1, 1).collect()] == [2]
    rc_ = ag.run_counters(df, big=F.col("o") > 1).first()
    assert (rc_["rows"], rc_["big"]) == (3, 2)


def test_select_mail_and_camp_append(spark):
    ts = datetime.datetime(2024, 6, 1)
    mail = spark.createDataFrame([("a", "S1", ts, ["Scholarships"]), ("b", "", ts, ["Scholarships"]),
                                  ("c", "S3", datetime.datetime(2022, 1, 1), ["Scholarships"]),
                                  ("d", "S4", ts, ["Other"])], "id string, subject string, ts timestamp, labels array<string>")
    assert [r["id"] for r in pg.select_mail(mail, "Scholarships", "2024-07-01 00:00:00").collect()] == ["a"]
    existing = spark.createDataFrame([("O", "u", "E", "d1")], "organiser string, url string, event_details string, start_date string")
    new = spark.createDataFrame([("O", "u", "E", "d1"), ("O", "u", "E", "d2")], existing.schema)
    assert rows(rc.camp_append(existing, new), "start_date") == [("d2",)]
    cfg = spark.createDataFrame([("men", "d2", "A"), ("women", "d2", "B")], "gender string, division string, conference string")
    units = spark.createDataFrame([("men", "d2")], "gender string, division string")
    assert rows(rc.config_lookup(units, cfg), "conference") == [("A",)]


def test_camp_enrichment_job(spark):
    from tessera.plans import jobs
    camps = spark.createDataFrame([(1, "Austin FC", "https://c/1", "", "Camp 1", "", "", "", ""),
                                   (2, "Nowhere", "https://c/2", "", "Camp 2", "", "", "", "")],
                                  "camp_id long, organiser string, camp_info_url string, camp_found string, "
                                  "event_details string, start_date string, end_date string, ages_grade_level string, cost string")
    caps = spark.createDataFrame([(10, "https://c/1", 200, None), (11, "https://c/2", 404, None)],
                                 "page_id long, url string, status int, error string")
    gz = spark.createDataFrame([("austin fc", 30.0, -97.0, "Austin")], "address_norm string, lat double, lng double, city string")
    env = json.dumps({"choices": [{"message": {"content": json.dumps([{"event_name": "A"}, {"event_name": "B"}])}}]})
    ans = spark.createDataFrame([(1, env)], "camp_id long, response string")
    out = jobs.camp_enrichment(camps, caps, gz, ans)
    got = rows(out["camps"], "camp_id", "sub_pos", "event_details", "lat", "city")
    assert got == [(1, 0, "A", 30.0, "Austin"), (1, 1, "B", 30.0, "Austin")]
    assert rows(out["errors"], "camp_id", "page_load") == [(2, "HTTP 404")]


def test_checkpoint_dir_is_read_from_the_session(spark):
    from tessera.session import checkpoint_dir
    d = spark.conf.get("spark.checkpoint.dir")          # set by the test fixture because none was set
    assert checkpoint_dir(spark) == d
    assert checkpoint_dir(spark, allow_local_default=True) == d   # an existing setting always wins
