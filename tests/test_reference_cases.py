"""The reference's own unit tests (model answer applied to a base camp),
re-expressed against explode_answers."""

import json

from tessera.operators.answers import LLM_ERROR, explode_answers

BASE = ("camp_id long, camp_info_url string, camp_found string, event_details string, start_date string, "
        "end_date string, ages_grade_level string, cost string")


def _base(spark):
    return spark.createDataFrame([(1, "https://x.example/camp", "", "", "", "", "", "")], BASE)


def _answer(spark, content):
    env = json.dumps({"choices": [{"message": {"content": content}}]})
    return spark.createDataFrame([(1, env)], "camp_id long, response string")


def test_valid_answer_fills_fields(spark):
    content = json.dumps([{"event_name": "Summer Camp", "start_date": "June 1", "end_date": "June 3",
                           "ages": "8-12", "cost": "$100"}])
    out = explode_answers(_base(spark), _answer(spark, content), "camp_id").collect()
    assert len(out) == 1
    r = out[0]
    assert r["camp_found"] == "Yes"
    assert (r["event_details"], r["start_date"], r["end_date"], r["ages_grade_level"], r["cost"]) == \
        ("Summer Camp", "June 1", "June 3", "8-12", "$100")


def test_malformed_answer_is_llm_error(spark):
    content = "[{'event_name': 'Summer Camp', 'start_date': 'June 1'}]"
    out = explode_answers(_base(spark), _answer(spark, content), "camp_id").collect()
    assert len(out) == 1
    r = out[0]
    assert (r["start_date"], r["end_date"], r["ages_grade_level"], r["cost"]) == (LLM_ERROR,) * 4


def test_empty_array_fence_and_copies(spark):
    out = explode_answers(_base(spark), _answer(spark, "```json\n[]\n```"), "camp_id").collect()
    assert [(r["camp_found"], r["start_date"]) for r in out] == [("No", "")]
    content = "```json\n" + json.dumps([{"start_date": "a"}, {"event_name": "B", "cost": "$5"}]) + "\n```"
    out = sorted(explode_answers(_base(spark), _answer(spark, content), "camp_id").collect(), key=lambda r: r["sub_pos"])
    assert [(r["sub_pos"], r["event_details"], r["start_date"], r["cost"]) for r in out] == [(0, "", "a", ""), (1, "B", "", "$5")]


def test_missing_choices_and_no_bracket(spark):
    ans = spark.createDataFrame([(1, '{"error": "x"}')], "camp_id long, response string")
    out = explode_answers(_base(spark), ans, "camp_id").collect()
    assert out[0]["cost"] == LLM_ERROR
    out = explode_answers(_base(spark), _answer(spark, "no json here"), "camp_id").collect()
    assert out[0]["cost"] == LLM_ERROR
    out = explode_answers(_base(spark), _answer(spark, '[{"a": 1}] trailing'), "camp_id").collect()
    assert out[0]["cost"] == LLM_ERROR
