"""Resumable runs and gap-free appends."""
import os
import random

import pytest
from pyspark.sql import functions as F

from tessera.streaming import runs
from tessera.streaming.tables import Tables

UNITS = "conf string, n int"


def rows(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=str)


def work(units):
    """Two cells per unit and write number."""
    w = units.where("n > 0").withColumn("seq", F.explode(F.sequence(F.lit(1), "n")))
    return w.select("conf", "seq", (F.ascii("conf") * 10 + F.col("seq") % 2).alias("row_id"), F.lit("standing").alias("column"),
                    F.concat_ws(":", "conf", "seq").alias("value"))


def refuse(*values):
    return lambda w: w.withColumn("failed", F.col("value").isin(*values))


def test_a_run_resumes_where_it_stopped(spark, tmpdir_run):
    tables = Tables(spark, os.path.join(tmpdir_run, "t"), buckets=3)
    units = spark.createDataFrame([("A", 4), ("B", 3), ("C", 0), ("D", 2)], UNITS)
    first = runs.run_units(tables, units.where("conf <> 'D'"), ["conf"], work, refuse("A:3", "B:1"), "cells")
    assert first == {"version": 0, "units": 3, "applied": 2, "pending": 5}
    assert rows(runs.cells(tables, "cells"), "row_id", "value") == [(650, "A:2"), (651, "A:1")]
    assert rows(runs.todo(tables, units, ["conf"]), "conf") == [("A",), ("B",), ("D",)]
    second = runs.run_units(tables, units, ["conf"], work, refuse("B:2"), "cells")
    assert second == {"version": 1, "units": 3, "applied": 2 + 1 + 2, "pending": 2}
    third = runs.run_units(tables, units, ["conf"], work, refuse(), "cells")
    assert third["units"] == 1 and third["pending"] == 0
    want = [(650, "A:4"), (651, "A:3"), (660, "B:2"), (661, "B:3"), (680, "D:2"), (681, "D:1")]
    assert rows(runs.cells(tables, "cells"), "row_id", "value") == want
    # nothing is left: another call changes no cell
    assert runs.run_units(tables, units, ["conf"], work, refuse(), "cells")["units"] == 0
    assert rows(runs.cells(tables, "cells"), "row_id", "value") == want
    manifest = rows(tables.read(runs.MANIFEST), "conf", "call", "applied", "pending")
    assert manifest == [("A", 0, 2, 2), ("A", 1, 2, 0), ("B", 0, 0, 3), ("B", 1, 1, 2), ("B", 2, 2, 0), ("C", 0, 0, 0), ("D", 1, 2, 0)]
    # a forced run works on all units again
    assert runs.run_units(tables, units, ["conf"], work, refuse(), "cells", force=True)["units"] == 4


def test_a_call_that_dies_leaves_nothing(spark, tmpdir_run, monkeypatch):
    tables = Tables(spark, os.path.join(tmpdir_run, "t"), buckets=3)
    units = spark.createDataFrame([("A", 2)], UNITS)
    monkeypatch.setattr(Tables, "commit", lambda *a, **k: (_ for _ in ()).throw(IOError("lost")))
    with pytest.raises(IOError):
        runs.run_units(tables, units, ["conf"], work, refuse(), "cells")
    monkeypatch.undo()
    assert tables.version() == -1 and rows(runs.todo(tables, units, ["conf"]), "conf") == [("A",)]
    assert runs.run_units(tables, units, ["conf"], work, refuse(), "cells")["applied"] == 2


CAMPS = "organiser string, url string, pos int, sub_pos int, note string"
KEY = ["organiser", "url"]


def plain_append(have, batch):
    """(key -> number) after appending the batch below the last row."""
    best = {}
    for r in batch:
        if r[:2] not in best or (r[2], r[3], r[4]) < best[r[:2]][2:]:
            best[r[:2]] = r
    new = sorted((r for k, r in best.items() if k not in have), key=lambda r: r[2:])
    return have | {r[:2]: 2 + len(have) + i for i, r in enumerate(new)}


def test_numbers_have_no_gaps_and_agree_on_a_retry(spark, tmpdir_run, monkeypatch):
    rng = random.Random(2)
    tables = Tables(spark, os.path.join(tmpdir_run, "t"), buckets=4)
    have, k = {}, 0
    for n in range(4):
        batch = [(rng.choice(["x", "y", None]), rng.choice([None, *map(str, range(40))]), rng.randint(0, 30), (k := k + 1), f"n{k}") for _ in range(120)]
        df = spark.createDataFrame(batch, CAMPS).repartition(5)
        if n == 2:      # dies before its commit, then comes again
            monkeypatch.setattr(Tables, "commit", lambda *a, **kw: (_ for _ in ()).throw(IOError("lost")))
            with pytest.raises(IOError):
                runs.append_rows(tables, "camps", df, KEY, ["pos", "sub_pos"], batch_id=n)
            monkeypatch.undo()
        runs.append_rows(tables, "camps", df.repartition(n + 1), KEY, ["pos", "sub_pos"], batch_id=n)
        runs.append_rows(tables, "camps", df, KEY, ["pos", "sub_pos"], batch_id=n)
        have = plain_append(have, batch)
        got = {(r["organiser"], r["url"]): r[runs.ROW] for r in runs.appended(tables, "camps").collect()}
        assert got == have and sorted(got.values()) == list(range(2, 2 + len(have)))
    runs.append_rows(tables, "camps", spark.createDataFrame([], CAMPS), KEY, ["pos", "sub_pos"], batch_id=9)
    assert runs.appended(tables, "camps").count() == len(have)


def test_numbers_do_not_depend_on_partitions(spark):
    df = spark.range(500).select(F.pmod(F.xxhash64("id"), F.lit(50)).alias("a"), "id")
    seen = {tuple(rows(runs.numbered(df.repartition(n), ["a"], 10), "row_number", "id")) for n in (1, 3, 8)}
    assert len(seen) == 1 and [x[0] for x in sorted(next(iter(seen)))] == list(range(10, 510))


def test_standings_run(spark, tmpdir_run):
    import datetime as dt

    from tessera.operators import reconcile as rc
    from tessera.operators import saved_maps as sm
    from tessera.plans import jobs
    table = "<main><h2>{c}</h2><table><tr><th>{h}</th><th>Conf</th><th>Overall</th></tr>{r}</table></main>"
    row = "<tr><td>{}</td><td>{}</td><td>{}</td></tr>"
    pages = spark.createDataFrame([
        (1, table.format(c="Alpha", h="Team", r=row.format("North State", "1-0", "2-0") + row.format("South Tech", "0-1", "1-1"))),
        (2, table.format(c="Beta", h="Team", r=row.format("West College", "3-0", "3-3"))),
        (3, table.format(c="Gamma", h="Mystery", r=row.format("East U", "9-9", "9-9")))], "page_id long, html string")
    sites = spark.createDataFrame([(p, "men", "D2", c, dt.datetime(2024, 1, p)) for p, c in ((1, "Alpha"), (2, "Beta"), (3, "Gamma"))],
                                  "page_id long, gender string, division string, conference_key string, captured_at timestamp")
    master = spark.createDataFrame([(3, "North State", "Alpha"), (4, "South Tech", "Alpha"), (5, "West College", "Beta"), (6, "East U", "Gamma")],
                                   "row_id long, university_name string, men_conference string")
    tables = Tables(spark, os.path.join(tmpdir_run, "t"), buckets=4)
    fail = lambda w: w.withColumn("failed", (F.col("row_id") == 4) & (F.col("column") == "men_overall_record"))
    first = jobs.standings_run(tables, pages, sites, master, "men", attempt=fail)
    assert (first["units"], first["pending"] > 0) == (3, True)
    assert {r["conference_key"] for r in sm.load(tables, list(jobs.SITE)).collect()} >= {"Alpha", "Beta"}
    second = jobs.standings_run(tables, pages, sites, master, "men")
    assert second["units"] == 1 and second["pending"] == 0
    assert jobs.standings_run(tables, pages, sites, master, "men")["units"] == 0
    cols = ["men_conference_record", "men_overall_record", "men_conference_standing"]
    got = rows(rc.apply_cell_writes(master, runs.cells(tables, "standings"), cols), "row_id", *cols)
    assert got[:3] == [(3, "1-0", "2-0", "1"), (4, "0-1", "1-1", "2"), (5, "3-0", "3-3", "1")]
