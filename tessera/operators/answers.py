"""Stored model answers as data (M1-M9).

The model call itself is outside the plan: ``build_requests`` writes a
request table, something else answers it, and ``explode_answers`` /
``scholarship_rows`` read the answer table back.  JSON is parsed with
``try_parse_json`` (strict JSON: single quotes or trailing text are errors,
as with Python's ``json.loads``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.common import at

from tessera.functions.text import strip
from tessera.functions.urls import clean_url

LLM_ERROR = "LLM Error"   # Fixed value: the error marker written into camp rows.
CAMP_FIELDS = ["event_details", "start_date", "end_date", "ages_grade_level", "cost"]
# Answer keys -> camp columns.
ANSWER_KEYS = {"event_details": "event_name", "start_date": "start_date", "end_date": "end_date",
               "ages_grade_level": "ages", "cost": "cost"}
# The 11 scholarship columns, in sheet order.
SCHOLARSHIP_FIELDS = ["title", "sponsor", "amount", "closing_date", "description", "link", "how_to_apply",
                      "eligibility", "type", "location", "application_window"]


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def build_requests(df: DataFrame, key: list[str], snippet: str, template: str,
                   placeholder: str = "{snippet}") -> DataFrame:
    """M1 / V3: one request per row: the caller's template with the snippet
    put in place of ``placeholder``."""
    return df.select(*key, F.replace(F.lit(template), F.lit(placeholder), F.coalesce(F.col(snippet), F.lit("")))
                     .alias("prompt"))


def answer_content(resp) -> Column:
    """M2: ``choices[0].message.content`` of the answer envelope (null when
    missing or when the envelope is not JSON)."""
    return F.get_json_object(_c(resp), "$.choices[0].message.content")


def strip_fence_camp(content) -> Column:
    """M3: when it starts with three backticks remove all outer backticks and
    white space; then keep from the first ``[`` (null when there is none)."""
    c = _c(content)
    c = F.when(c.startswith("```"), strip(F.regexp_replace(c, r"^`+|`+$", ""))).otherwise(c)
    i = F.instr(c, "[")
    return F.when(i > 0, F.substring(c, i, F.lit(1 << 30)))


def strip_fence_scholarship(content) -> Column:
    """M4: outer backticks removed, a leading ``json`` tag removed (decision
    D16: only the fence tag, never ``json`` inside data), newlines removed."""
    c = strip(F.regexp_replace(_c(content), r"^`+|`+$", ""))
    c = F.regexp_replace(c, r"^json", "")
    return F.regexp_replace(c, r"[\r\n]", "")


def strip_fence_js(content) -> Column:
    """M5: a leading fence with an optional ``json`` tag and a trailing
    fence, case-insensitive."""
    return strip(F.regexp_replace(F.regexp_replace(_c(content), r"(?i)^\s*```(json)?\s*", ""), r"\s*```\s*$", ""))


_ITEMS = "array<array<map<string,string>>>"


def with_json_array(df: DataFrame, text, out: str) -> DataFrame:
    """``df`` plus ``out``: the JSON array of objects in ``text`` as
    ``array<map<string,string>>``, or null when ``text`` is not exactly one
    JSON array of objects (bad JSON, single quotes, trailing text, an item
    that is not an object) - the cases where Python's ``json.loads`` and the
    reference's item access fail.  ``from_json`` stops after the first value,
    so the text is wrapped as ``[text]`` and must hold exactly one element.
    The parse is its own projected column, evaluated once per row."""
    x = df.withColumn("_wrapped", F.from_json(F.concat(F.lit("["), _c(text), F.lit("]")), _ITEMS,
                                              {"allowSingleQuotes": "false", "mode": "PERMISSIVE"}))
    return x.withColumn(out, F.when(F.size("_wrapped") == 1, at(F.col("_wrapped"), 1))).drop("_wrapped")


def strict_json_array(text) -> Column:
    """Column form of ``with_json_array`` (parses twice; prefer the
    DataFrame form)."""
    w = F.from_json(F.concat(F.lit("["), _c(text), F.lit("]")), _ITEMS,
                    {"allowSingleQuotes": "false", "mode": "PERMISSIVE"})
    return F.when(F.size(w) == 1, at(w, 1))


def explode_answers(base: DataFrame, answers: DataFrame, key: str, resp: str = "response") -> DataFrame:
    """M6: apply a model answer to its base camp row.

    A non-empty array: the first object updates the base row (``sub_pos``
    0), each further object is a copy of the base with the five fields
    overwritten (``sub_pos`` 1..n); an absent ``event_name`` keeps the base
    value, other absent keys give ''; ``camp_found = 'Yes'``.  An empty
    array: ``camp_found = 'No'``, nothing else changes.  No answer, no
    ``choices``, no ``[``, bad JSON or a non-object item: the base row with
    start/end date, ages and cost set to ``LLM Error`` (D20).
    """
    a = answers.select(F.col(key), F.col(resp).alias("_resp"))
    x = base.join(a, key, "left")
    x = x.withColumn("_snip", strip_fence_camp(answer_content(F.col("_resp"))))
    x = with_json_array(x, F.col("_snip"), "_arr")
    state = (F.when(F.col("_arr").isNull(), F.lit("error"))
             .when(F.size("_arr") == 0, F.lit("none"))
             .otherwise(F.lit("found")))
    x = x.withColumn("_state", state)
    # one pass: found rows explode their items, other rows explode one null
    items = F.when(F.col("_state") == "found", F.col("_arr")).otherwise(
        F.array(F.lit(None).cast("map<string,string>")))
    # the outer form: Spark infers no size>0 filter for it, which would be
    # pushed below the projections and re-run the JSON parse per predicate
    y = x.select("*", F.posexplode_outer(items).alias("sub_pos", "_e"))
    get = lambda k: at(F.col("_e"), k)
    st = F.col("_state")
    out = y.withColumn("camp_found", F.when(st == "found", F.lit("Yes")).when(st == "none", F.lit("No"))
                       .otherwise(F.col("camp_found")))
    for col, k in ANSWER_KEYS.items():
        if col == "event_details":
            v = F.when(st == "found", F.coalesce(get(k), F.col(col))).otherwise(F.col(col))
        else:
            v = (F.when(st == "found", F.coalesce(get(k), F.lit(""))).when(st == "error", F.lit(LLM_ERROR))
                 .otherwise(F.col(col)))
        out = out.withColumn(col, v)
    return out.select(*base.columns, F.col("sub_pos").cast("int").alias("sub_pos"))


def scholarship_rows(answers: DataFrame, key: list[str], resp: str = "response",
                     require: tuple = ("closing_date", "amount"), form: str = "py") -> DataFrame:
    """M7 (+ M7b with ``require=()``, M5/M8 with ``form='js'``): the items of
    every answer; an answer that is not a JSON array is skipped; items need
    the ``require`` fields non-empty.  ``form='js'`` also fills a blank
    ``closing_date`` from ``deadline``, cleans the link and needs a title."""
    content = answer_content(F.col(resp))
    body = strip_fence_js(content) if form == "js" else strip_fence_scholarship(content)
    x = with_json_array(answers.select(*key, body.alias("_body")), F.col("_body"), "_arr")
    x = x.select(*key, F.posexplode_outer("_arr").alias("item_idx", "_e")).filter(F.col("_e").isNotNull())
    for f in SCHOLARSHIP_FIELDS + ["deadline"]:
        x = x.withColumn(f, at(F.col("_e"), f))
    if form == "js":
        x = x.withColumn("closing_date", F.when(strip(F.coalesce("closing_date", F.lit(""))) == "", F.col("deadline"))
                         .otherwise(F.col("closing_date")))
        x = x.withColumn("link", clean_url(F.col("link")))
        require = tuple(require) + ("title",)
    for r in require:
        x = x.filter(strip(F.coalesce(F.col(r), F.lit(""))) != "")
    return x.select(*key, "item_idx", *[F.coalesce(F.col(f), F.lit("")).alias(f) for f in SCHOLARSHIP_FIELDS])


def to_sheet_columns(df: DataFrame, fields=SCHOLARSHIP_FIELDS) -> DataFrame:
    """M9: exactly the sheet columns, '' for missing values."""
    return df.select(*[(F.coalesce(F.col(f).cast("string"), F.lit("")) if f in df.columns else F.lit("")).alias(f)
                       for f in fields])
