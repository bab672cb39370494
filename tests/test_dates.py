"""Free-form dates: typed tokens in any order, and why a text is no date."""
import datetime as dt

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tessera.functions.events import parse_date, to_unix


def ts(*a):
    return int(dt.datetime(*a, tzinfo=dt.timezone.utc).timestamp())


CASES = {
    "2024-06-01": ts(2024, 6, 1), "2024-06-01T10:30:15": ts(2024, 6, 1, 10, 30, 15), "2024-06-01T10:30:15.123Z": ts(2024, 6, 1, 10, 30, 15),
    "2024-06-01T10:30:00-04:00": ts(2024, 6, 1, 14, 30), "2024-06-01 10:30+0530": ts(2024, 6, 1, 5, 0), "2024/6/1": ts(2024, 6, 1), "20240601": ts(2024, 6, 1),
    "June 1, 2024": ts(2024, 6, 1), "1 June 2024": ts(2024, 6, 1), "Saturday, June 1st, 2024": ts(2024, 6, 1), "Sat. Jun. 1 2024 at 2 PM": ts(2024, 6, 1, 14),
    "the 3rd of Sept 2024": ts(2024, 9, 3), "2024 June 1": ts(2024, 6, 1), "Jun-01-2024": ts(2024, 6, 1), "01-Jun-24": ts(2024, 6, 1), "1 Jan 70": ts(1970, 1, 1),
    "6/1/2024": ts(2024, 6, 1), "06/01/24": ts(2024, 6, 1), "25/12/2024": ts(2024, 12, 25), "6.1.2024": ts(2024, 6, 1), "12:05 am June 1, 2024": ts(2024, 6, 1, 0, 5),
    "June 1, 2024 12:00 p.m. EST": ts(2024, 6, 1, 17), "May 5 2024": ts(2024, 5, 5), "march 2, 2024, 7:15:09 utc": ts(2024, 3, 2, 7, 15, 9), " 2024-02-29 ": ts(2024, 2, 29)}
REASONS = {"": "empty", None: "empty", "  ": "empty", "TBD": "unknown word", "June 2024": "no day", "2024": "no month", "June 1": "no year", "6/1": "no year",
           "2023-02-29": "no such date", "June 31, 2024": "no such date", "June 1, 2024 25:00": "no such date", "June 1, 2024 13:00 pm": "no such date",
           "June 1 - June 3, 2024": "several dates", "June 1 to June 3, 2024": "unknown word", "June 1-3, 2024": "several dates", "Marchmont 2024": "unknown word",
           "1": "no month", "99999999999999999999": "no month", "2024-13-01": "no such date"}


def test_texts(spark):
    df = spark.createDataFrame([(k,) for k in [*CASES, *REASONS]], "s string").select("s", parse_date("s").alias("p"), to_unix("s").alias("u"))
    got = {r["s"]: (r["p"]["epoch"], r["p"]["reason"], r["u"]) for r in df.collect()}
    for s, want in CASES.items():
        assert got[s] == (want, None, want), s
    for s, why in REASONS.items():
        assert got[s] == (None, why, 0), s


def test_default_year(spark):
    df = spark.createDataFrame([("June 1",), ("1 June 9:30",), ("6/1",), ("13/6",), ("June",)], "s string").select(to_unix("s", 2025).alias("u"))
    assert [r["u"] for r in df.collect()] == [ts(2025, 6, 1), ts(2025, 6, 1, 9, 30), ts(2025, 6, 1), ts(2025, 6, 13), 0]


def test_round_trips_of_many_formats(spark):
    formats = ["%Y-%m-%d %H:%M:%S", "%B %d, %Y %I:%M %p", "%d %b %Y, %H:%M", "%A, %B %d, %Y", "%m/%d/%Y %I:%M%p", "%Y%m%d", "%b %d %y", "%I:%M %p on %d %B %Y"]
    rows, at = [], dt.datetime(1971, 1, 1, 0, 0, tzinfo=dt.timezone.utc)
    for k in range(400):
        at += dt.timedelta(days=47, hours=5, minutes=13)
        f = formats[k % len(formats)]
        s = at.strftime(f)
        rows.append((s, int(dt.datetime.strptime(s, f).replace(tzinfo=dt.timezone.utc).timestamp())))
    df = spark.createDataFrame(rows, "s string, want long")
    assert [r for r in df.withColumn("u", to_unix("s")).where("u <> want").collect()] == []


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(max_size=25), min_size=40, max_size=40))
def test_any_text_gives_a_date_or_a_reason(spark, texts):
    df = spark.createDataFrame([(t.replace("\x00", ""),) for t in texts], "s string").select(parse_date("s").alias("p"))
    assert all((r["p"]["epoch"] is None) == (r["p"]["reason"] is not None) for r in df.collect())
