"""Captured pages (A8, A9) and mail.

Network fetches are outside the plan: a crawler writes a capture table
``(page_id, url, status, error, html)``; these scans read it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from tessera.functions.common import at

from tessera.functions.text import strip
from tessera.operators.html import html_to_text, strip_forward_header

CAPTURE_COLUMNS = ["page_id", "url", "status", "error", "html"]


def scan_pages(spark: SparkSession, path: str) -> DataFrame:
    """The capture table; columns absent from a capture (a plain
    ``(page_id, url, html)`` crawl) become status 200 and no error."""
    df = spark.read.parquet(path)
    cols = [F.col(c) if c in df.columns else
            (F.lit(200).alias(c) if c == "status" else F.lit(None).cast("string").alias(c))
            for c in CAPTURE_COLUMNS]
    return df.select(*cols)


def first_hit(candidates: DataFrame, entity: str, priority: str, ok: Column) -> DataFrame:
    """Per entity the first candidate (lowest ``priority``) for which
    ``ok`` holds (the page loaded and yielded rows).  ``min_by`` over a
    struct: a partial aggregate, no window."""
    others = [c for c in candidates.columns if c != entity]
    best = (candidates.filter(ok).groupBy(entity)
            .agg(F.min_by(F.struct(*[F.col(c) for c in others]), F.col(priority)).alias("_b")))
    return best.select(entity, *[F.col("_b")[c].alias(c) for c in others])


def yearless_candidates(urls: DataFrame, key: str, url: str = "url", season_start: int | None = None) -> DataFrame:
    """S10-S13 as candidates for A9: the URL as given (with the season range
    updated when one is present), then the URL without year segments."""
    from tessera.functions.urls import remove_year_segment, update_year_range
    first = update_year_range(F.col(url), season_start) if season_start is not None else F.col(url)
    a = urls.select(key, first.alias("candidate_url"), F.lit(0).alias("priority"))
    b = urls.select(key, remove_year_segment(F.col(url)).alias("candidate_url"), F.lit(1).alias("priority"))
    return a.unionByName(b).dropDuplicates([key, "candidate_url"])


def year_logic_candidates(urls: DataFrame, key: str, season_start: int, year: int, url: str = "url") -> DataFrame:
    """S12 as candidates for A9: a URL with a ``yyyy-yy`` range -> the range
    updated to the season (S10); otherwise the URL without year segments
    first (S13, decision D19), then every year token replaced by ``year``
    (S11).  ``first_hit`` against the capture table picks the one that
    loads."""
    from tessera.functions.urls import has_year_range, remove_year_segment, replace_year, update_year_range
    u = F.col(url)
    arr = F.when(has_year_range(u), F.array(F.struct(F.lit(0).alias("priority"), update_year_range(u, season_start)
                                                      .alias("candidate_url")))) \
        .otherwise(F.array(F.struct(F.lit(0).alias("priority"), remove_year_segment(u).alias("candidate_url")),
                           F.struct(F.lit(1).alias("priority"), replace_year(u, year).alias("candidate_url"))))
    return urls.select(key, F.explode(arr).alias("c")).select(key, "c.priority", "c.candidate_url")


def decode_base64url(data: Column) -> Column:
    """base64url (``-``/``_``) text -> UTF-8 string."""
    return F.decode(F.unbase64(F.translate(data, "-_", "+/")), "UTF-8")


def mail_html(parts: Column) -> Column:
    """A10: the first ``text/html`` part, decoded (null when none)."""
    html = F.filter(parts, lambda p: p["mimeType"] == "text/html")
    return F.when(F.size(html) > 0, decode_base64url(at(html, 1)["data"]))


def mail_body(plain: Column, html: Column) -> Column:
    """A11 + B27 + B28: the plain text, or the HTML as text when the plain
    text is shorter than 50 characters; forward header removed.  The whole
    body; ``text_chunks`` cuts it into pieces for a model."""
    p = F.coalesce(plain, F.lit(""))
    body = F.when(F.length(strip(p)) < 50, html_to_text(html)).otherwise(p)
    return strip_forward_header(body)


def select_mail(mail: DataFrame, label: str | None, ref_ts: str, max_age_days: int = 365,
                limit: int = 100) -> DataFrame:
    """Labelled mail newer than ``max_age_days`` before ``ref_ts`` with a
    subject, newest first, at most ``limit`` (a listing limit, the feature)."""
    x = mail
    if label is not None and "labels" in mail.columns:
        x = x.filter(F.array_contains("labels", label))
    ref = F.lit(ref_ts).cast("timestamp")
    x = x.filter((F.col("ts") >= ref - F.expr(f"INTERVAL {max_age_days} DAYS"))
                 & (strip(F.coalesce(F.col("subject"), F.lit(""))) != ""))
    return x.orderBy(F.col("ts").desc(), F.col("id")).limit(limit)
