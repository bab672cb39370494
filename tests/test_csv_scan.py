"""The parallel CSV scan against the standard library on whole files."""
import csv
import io
import os
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tessera.sources import csv_scan, files


@pytest.fixture()
def small_blocks(spark):
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes", "spark.sql.files.minPartitionNum")
           if spark.conf.get(k, None) is not None}

    def use(n):
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(n))
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield use
    for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"):
        if k in old:
            spark.conf.set(k, old[k])
        else:
            spark.conf.unset(k)


def write(folder, texts):
    for name, text in texts.items():
        with open(os.path.join(folder, name), "w", newline="", encoding="utf-8") as f:
            f.write(text)
    return os.path.join(folder, "*.csv")


def plain(texts):
    return {name: list(csv.reader(io.StringIO(text, newline=""))) for name, text in texts.items() if text}


def scanned(spark, paths, **options):
    got = {}
    for r in csv_scan.csv_records(spark, paths, **options).collect():
        assert r["error"] is None
        got.setdefault(r["file_name"].split("/")[-1], []).append((r["pos"], r["cells"]))
    out = {}
    for name, rows in got.items():
        rows.sort()
        assert [p for p, _ in rows] == list(range(len(rows)))
        out[name] = [c for _, c in rows]
    return out


def random_text(rng, n, end="\n"):
    out = io.StringIO()
    w = csv.writer(out, lineterminator=end)
    for _ in range(n):
        w.writerow([rng.choice(["", "plain", 'with "quotes"', "a, b", "two\nlines", 'x\n"\n",y\n\n', 'tall 5" man', "ü" * rng.randint(0, 9), "q\r\nr"])
                    for _ in range(rng.randint(1, 5))])
        if rng.random() < 0.1:
            out.write(end)
    return out.getvalue()


@pytest.mark.parametrize("block", [7, 40, 1000, 1 << 20])
def test_any_cut_into_blocks(spark, tmpdir_run, small_blocks, block):
    rng = random.Random(block)
    texts = {"a.csv": random_text(rng, 60), "b.csv": random_text(rng, 25, "\r\n"), "c.csv": "one,line", "d.csv": "",
             "e.csv": '"' + "long\n" * 60 + '",x\nlast,"row"\n', "f.csv": 'a,5" tall,b\n"x"y,"z"\n,\n'}
    small_blocks(block)
    assert scanned(spark, write(tmpdir_run, texts)) == plain(texts)


def test_open_quote_is_reported_line_by_line(spark, tmpdir_run, small_blocks):
    small_blocks(30)
    path = write(tmpdir_run, {"a.csv": 'x,y\n1,"open\n' + "more text here\n" * 20})
    rows = csv_scan.csv_records(spark, path, max_record=100).collect()
    assert [r["cells"] for r in rows if r["error"] is None] == [["x", "y"]]
    assert len([r for r in rows if r["error"]]) == 21 and {r["pos"] for r in rows if r["error"]} == {1}


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet='a,"\n', max_size=12), max_size=6))
def test_states_agree_with_the_standard_library(parts):
    text = "\n".join(parts)
    want = len(list(csv.reader(io.StringIO(text + "\n", newline=""))))
    state, begun = False, 0
    for line in (text + "\n").split("\n")[:-1]:
        begun += not state
        state = csv_scan.ends_inside(line, state)
    assert begun == want


def test_change_logs(spark, tmpdir_run, small_blocks):
    small_blocks(60)
    head = "Conference,School,Position,First Name,Last Name,Whatever,Email,School\n"
    body = 'Alpha,"North\nState",Head Coach,Jane,Doe,J X,j@x,Other\nBeta,West,Head Coach,Ann,,e\n\nGamma,East,HC,,,,,\n'
    texts = {"men_DII.csv": head + body, "women DIII list.csv": "junk\n,,\n\n\"a\nb\"\nlast junk\n" + head + body,
             "nobody.csv": head + body, "men_short.csv": "a\nb\n", "men_narrow.csv": "Conference,School\nAlpha,West\n"}
    got = sorted((r["file_name"].split("/")[-1], r["pos"], r["conference"], r["school"], r["first_name"], r["change"], r["email_address"], r["gender"])
                 for r in files.read_change_logs(spark, write(tmpdir_run, texts)).collect())
    rows = [(0, "Alpha", "North\nState", "Jane", "J X", "j@x"), (1, "Beta", "West", "Ann", "e", None), (2, None, None, None, None, None),
            (3, "Gamma", "East", None, None, None)]
    want = [("men_DII.csv", *r, "men") for r in rows] + [("men_narrow.csv", 0, "Alpha", "West", None, None, None, "men")]
    want += [("women%20DIII%20list.csv" if "%" in got[-1][0] else "women DIII list.csv", *r, "women") for r in rows]
    assert got == want
