"""Status text, change codes, flags and predicates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.functions.text import strip


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def status_text(url, status, error) -> Column:
    """No URL -> ``No URL Provided``; a fetch error ->
    ``Failed to load. Error: <text>``; 200 -> ``Loaded Successfully``;
    otherwise ``Error <code>``."""
    u = F.coalesce(_c(url).cast("string"), F.lit(""))
    return (F.when(u == "", F.lit("No URL Provided"))
            .when(_c(error).isNotNull() & (_c(error) != ""), F.concat(F.lit("Failed to load. Error: "), _c(error)))
            .when(_c(status) == 200, F.lit("Loaded Successfully"))
            .otherwise(F.concat(F.lit("Error "), _c(status).cast("string"))))


def page_load_status(status, error) -> Column:
    """S39 short form used on camp rows: ``OK`` or the error text."""
    return (F.when(_c(error).isNotNull() & (_c(error) != ""), _c(error))
            .when(_c(status) == 200, F.lit("OK"))
            .otherwise(F.concat(F.lit("HTTP "), _c(status).cast("string"))))


# Phrases of CDN / firewall error pages.
ERROR_PAGE_PHRASES = ["Request unsuccessful", "Incapsula incident", "Access Denied"]


def is_error_page(html) -> Column:
    """The page is a CDN/WAF error page."""
    h = F.coalesce(_c(html), F.lit(""))
    out = F.lit(False)
    for p in ERROR_PAGE_PHRASES:
        out = out | h.contains(p)
    return out


# The head-coach positions a change log may update.
HEAD_COACH_POSITIONS = [
    "Head Coach",
    "Interim Head Coach",
    "Head Coach (second email)",
    "Head Coach, Director of Soccer",
    "Head Coach, Director of Operations",
    "Head Coach, JV Head Coach",
]


def is_head_coach(position) -> Column:
    """C1."""
    return _c(position).isin(HEAD_COACH_POSITIONS)


def is_actionable_change(change) -> Column:
    """Not null, not ``#``, not ``c``."""
    c = _c(change)
    return c.isNotNull() & ~c.isin("#", "c")


def change_code(change) -> Column:
    """Lower case without spaces."""
    return F.regexp_replace(F.lower(F.coalesce(_c(change), F.lit(""))), " ", "")


def change_columns(code, name, email) -> Column:
    """The cells a change writes, as ``array<struct<field, value>>``.
    ``e`` = mail only (when present); contains ``j`` or ``x`` = name (when
    present) and mail (when present).  Other codes write nothing (D11)."""
    c = _c(code)
    nm, em = _c(name), _c(email)
    mail = F.when(em.isNotNull() & (strip(em) != ""), F.struct(F.lit("email").alias("field"), em.alias("value")))
    nme = F.when(nm.isNotNull() & (nm != ""), F.struct(F.lit("name").alias("field"), nm.alias("value")))
    arr = (F.when(c == "e", F.array(mail))
           .when(c.contains("j") | c.contains("x"), F.array(nme, mail))
           .otherwise(F.array().cast("array<struct<field:string,value:string>>")))
    return F.filter(arr, lambda x: x.isNotNull())


def profile_base(prev_url) -> Column:
    """Where to look for the new coach's page:
    ``struct(mode, base)`` with mode roster / staff / general."""
    u = F.coalesce(_c(prev_url), F.lit(""))
    roster = F.concat(F.substring_index(u, "/roster/coaches/", 1), F.lit("/roster"))
    staff = F.concat(F.substring_index(u, "/staff-directory/", 1), F.lit("/staff-directory"))
    general = F.when(u.contains("/coaches"), F.concat(F.substring_index(u, "/coaches", 1), F.lit("/coaches"))
                     ).otherwise(u)
    return (F.when(u == "", F.lit(None))
            .when(u.contains("/roster/coaches/"), F.struct(F.lit("roster").alias("mode"), roster.alias("base")))
            .when(u.contains("/staff-directory/"), F.struct(F.lit("staff").alias("mode"), staff.alias("base")))
            .otherwise(F.struct(F.lit("general").alias("mode"), general.alias("base"))))


def division_compatible(target, candidate) -> Column:
    """C11: incompatible only when both are known and differ (case-insensitive)."""
    t = F.coalesce(_c(target), F.lit(""))
    d = F.coalesce(_c(candidate), F.lit(""))
    return (t == "") | (d == "") | (F.lower(t) == F.lower(d))


def is_confirmed(v) -> Column:
    """C14: loose truthiness of a string/bool/number flag column."""
    s = F.lower(strip(F.coalesce(_c(v).cast("string"), F.lit(""))))
    num = s.try_cast("double")
    return F.coalesce(s.isin("true", "yes", "1") | (num.isNotNull() & (num != 0)), F.lit(False))
