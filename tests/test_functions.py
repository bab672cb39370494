import datetime

import pytest
from pyspark.sql import functions as F

from tessera.functions import events as ev
from tessera.functions import facts as fa
from tessera.functions import roster as ro
from tessera.functions import status as st
from tessera.functions import text as tx
from tessera.functions import urls as ul


def one(spark, expr_fn, values, typ="string"):
    df = spark.createDataFrame([(v,) for v in values], f"v {typ}")
    return [r[0] for r in df.select(expr_fn(F.col("v"))).collect()]


def test_text(spark):
    assert one(spark, tx.clean_text, ["  a \t b  c \n"]) == ["a b c"]
    assert one(spark, tx.normalize_title, ["  12.  Big   Award ", "Award 1. x", None]) == ["big award", "award 1. x", ""]
    assert one(spark, tx.strip, ["　 x  "]) == ["x"]
    assert one(spark, tx.normalize_header, ["Conf (W-L) [1]  Record"]) == ["conf record"]
    assert one(spark, tx.strip_camp_suffix, ["Ohio State Camp", "Campbell"]) == ["Ohio State", "Campbell"]
    assert one(spark, tx.safe, [None, " a "]) == ["", "a"]


def test_urls(spark):
    assert one(spark, ul.canonical_url, [" HTTPS://WWW.X.com/a/ ", "http://waf.www.x.com", "Https://x.com"]) == \
        ["https://www.x.com/a", "x.com", "https://x.com"]
    assert one(spark, lambda c: ul.rewrite_host(c, "factsite.example.com"),
               ["http://www.factsite.example.com/a?b=1", "factsite.example.com/x", "https://waf.factsite.example.com/y",
                "https://other.org/z"]) == \
        ["https://waf.factsite.example.com/a?b=1", "https://waf.factsite.example.com/x", "https://waf.factsite.example.com/y",
         "https://other.org/z"]
    assert one(spark, ul.clean_url, ["<apply.example.org/form>", "<a.org/x>.", "https://a.com/x - open in new window", "no link"]) == \
        ["https://apply.example.org/form", "https://a.org/x>", "https://a.com/x", "no link"]
    assert one(spark, ul.remove_year_segment, ["https://s.edu/sports/msoc/2025-26/roster?x=1#f", "https://s.edu/2024"]) == \
        ["https://s.edu/sports/msoc/roster?x=1#f", "https://s.edu/"]
    assert one(spark, ul.has_year_token, ["https://s.edu/a/2025/roster", "https://s.edu/a2025/x"]) == [True, False]
    assert one(spark, lambda c: ul.update_year_range(c, 2025), ["https://s.edu/2019-20/r"]) == ["https://s.edu/2025-26/r"]
    df = spark.createDataFrame([("https://a.com/x/y", "../z"), ("https://a.com/x/y", "/r"), ("http://a.com", "//c.org/p")],
                               "b string, h string")
    assert [r[0] for r in df.select(ul.url_join("b", "h")).collect()] == ["https://a.com/z", "https://a.com/r", "http://c.org/p"]


def test_facts(spark):
    assert one(spark, fa.parse_currency, ["Tuition: $12,345 per year", "12,345", None]) == [12345, None, None]
    assert one(spark, lambda c: fa.parse_currency(c, allow_plain=True), ["12,345", "x12"]) == [12345, None]  # D6
    assert one(spark, fa.is_decimal_number, [" 3.75 ", "3", "a3.7"]) == [True, False, False]
    assert one(spark, fa.gpa_token, ["GPA 13.5", "none"]) == [3.5, None]
    assert one(spark, lambda c: fa.gpa_token(c, strict=True), ["avg 3.75 gpa", "3.7"]) == [3.75, None]
    assert one(spark, fa.first_integer, ["Undergrads 12,034 students"]) == [12034]
    assert one(spark, fa.points_value, ["Pts: -1.5", "x"]) == [-1.5, None]
    rec = one(spark, fa.record_struct, ["9-1-2", "4 – 3", "none"])
    assert [tuple(r) if r else None for r in rec] == [(9, 1, 2), (4, 3, None), None]


def test_roster_functions(spark):
    assert one(spark, ro.canon_pos, ["D/M", "Goal Keeper", "gk", "Def.", "F, M", "CB\\RB", "Utility", "M-F-M"]) == \
        ["D/M", "GK", "GK", "D", "F/M", "D", "", "M/F"]
    assert one(spark, ro.class_year, ["Sr.", "R-Fr.", "FY"]) == ["senior", "R-Fr.", "freshman"]
    assert one(spark, ro.position_token, ["plays as Defender", "none"]) == ["defender", ""]
    df = spark.createDataFrame([("Class of 2026", datetime.date(2025, 9, 1)), ("2029", datetime.date(2025, 9, 1)),
                                ("2030", datetime.date(2025, 9, 1)), ("2024", datetime.date(2025, 9, 1)),
                                ("Sr.", datetime.date(2025, 3, 1)), ("", datetime.date(2025, 3, 1)),
                                ("2026", datetime.date(2025, 3, 1))], "t string, d date")
    got = [r[0] for r in df.select(ro.academic_level("t", F.col("d"))).collect()]
    assert got == ["senior", "freshman", "freshman", "graduate student", "senior", "", "junior"]
    assert one(spark, ro.season_start_year, [datetime.date(2025, 6, 1), datetime.date(2025, 5, 31)], "date") == [2025, 2024]
    cls = one(spark, ro.position_classes, ["d", "d/m", "Defense & Midfield", "goal", "x/y", "D/D"])
    assert cls == [["D"], ["D", "M"], ["D", "M"], ["GK"], [], ["D", "D"]]


def test_event_functions(spark):
    assert one(spark, ev.extract_division, ["NCAA Division II", "division iii camp", "Division I", "NAIA event", "D3", "x"]) == \
        ["D2", "D3", "D1", "NAIA", "D3", ""]                                      # D7
    assert one(spark, ev.division_from_filename, ["/x/Men DII changes.csv", "/x/Indiana Division.csv",
                                                   "women_NAIA.csv"]) == ["DII", None, "NAIA"]   # D8
    assert one(spark, ev.grade_levels, ["8–17", "12+", "13–14", "x"]) == \
        ["Elementary School, High School", "Elementary School", "Middle School", ""]
    assert one(spark, ev.gender_from_title, ["Boys Elite", "GIRLS camp", "Team"]) == ["Boys", "Girls", "Coed"]
    assert one(spark, ev.gender_from_name, ["Womens_D1.csv", "men.csv", "x.csv"]) == ["women", "men", None]
    assert one(spark, ev.ages_from_text, ["Ages 8-12 welcome", "age 15+"]) == ["8-12", "15+"]
    r = one(spark, ev.split_date_range, ["October 1 to October 3", "October 5"])
    assert [tuple(x) for x in r] == [("October 1", "October 3"), ("", "")]      # D10
    r = one(spark, ev.split_city_state, ["Austin, TX", "Paris"])
    assert [tuple(x) for x in r] == [("Austin", "TX"), ("Paris", "")]
    assert one(spark, ev.to_unix, ["2024-06-01", "June 1, 2024", "garbage"]) == [1717200000, 1717200000, 0]


def test_status_functions(spark):
    df = spark.createDataFrame([("", 200, None), ("u", 200, None), ("u", 404, None), ("u", None, "timeout")],
                               "u string, s int, e string")
    got = [r[0] for r in df.select(st.status_text("u", "s", "e")).collect()]
    assert got == ["No URL Provided", "Loaded Successfully", "Error 404", "Failed to load. Error: timeout"]
    assert one(spark, st.is_confirmed, ["yes", "TRUE", "0", "2", None, "no"]) == [True, True, False, True, False, False]
    assert one(spark, st.change_code, ["J X", None]) == ["jx", ""]
    pb = one(spark, st.profile_base, ["https://s.edu/sports/wsoc/roster/coaches/jane-doe/12",
                                      "https://s.edu/staff-directory/jane", "https://s.edu/sports/wsoc/coaches/Jane"])
    assert [tuple(x) for x in pb] == [("roster", "https://s.edu/sports/wsoc/roster"),
                                      ("staff", "https://s.edu/staff-directory"),
                                      ("general", "https://s.edu/sports/wsoc/coaches")]
    df = spark.createDataFrame([("e", "A B", "a@x"), ("J X", "A B", None), ("x", None, "b@x"), ("c", "n", "m")],
                               "c string, n string, m string")
    got = [[tuple(w) for w in r[0]] for r in df.select(st.change_columns(st.change_code("c"), F.col("n"), F.col("m"))).collect()]
    assert got == [[("email", "a@x")], [("name", "A B")], [("email", "b@x")], []]


def test_similarity_functions(spark):
    from tessera.functions.similarity import combined_py, seq_ratio, token_jaccard
    df = spark.createDataFrame([("Ohio State", "ohio state university"), ("", "x"), ("São Paulo FC", "sao paulo")],
                               "a string, b string")
    out = df.select(token_jaccard("a", "b").alias("j"), seq_ratio("a", "b").alias("s")).collect()
    assert out[0]["j"] == pytest.approx(2 / 3)
    assert out[1]["j"] == 0.0
    assert out[2]["j"] == pytest.approx(1 / 4)       # Unicode word characters: {são, paulo, fc} vs {sao, paulo}
    for (a, b), r in zip([("Ohio State", "ohio state university"), ("", "x"), ("São Paulo FC", "sao paulo")], out):
        assert 0.4 * r["s"] + 0.6 * r["j"] == pytest.approx(combined_py(a, b))
