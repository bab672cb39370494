"""URL normalisation as native Column expressions."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.text import strip


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def canonical_url(u) -> Column:
    """Trim, drop a lower-case ``http://``/``https://``, lower, drop a
    leading ``waf.`` and then ``www.``, drop one trailing ``/``."""
    s = strip(F.coalesce(_c(u), F.lit("")))
    s = F.regexp_replace(s, r"^https?://", "")
    s = F.lower(s)
    s = F.regexp_replace(s, r"^waf\.", "")
    s = F.regexp_replace(s, r"^www\.", "")
    return F.regexp_replace(s, r"/$", "")


def rewrite_host(u, host_suffix: str, prefix: str = "waf.") -> Column:
    """For URLs whose host ends with ``host_suffix``: force ``https``,
    drop a leading ``www.`` and prepend ``prefix`` (unless already there).
    Other URLs are returned trimmed and unchanged."""
    s = strip(F.coalesce(_c(u), F.lit("")))
    low = F.lower(s)
    pre = prefix.lower()
    already = low.startswith("https://" + pre) | low.startswith("http://" + pre) | low.startswith(pre)
    bare = low.startswith(host_suffix.lower())
    scheme_host = F.regexp_extract(s, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)
    has_netloc = scheme_host != ""
    # no scheme: netloc is the first path segment
    path_host = F.regexp_extract(s, r"^([^/?#]*)", 1)
    host = F.when(has_netloc, scheme_host).otherwise(path_host)
    after = F.when(has_netloc, F.regexp_replace(s, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*", "")).otherwise(
        F.regexp_replace(s, r"^[^/?#]*", ""))
    match_host = F.lower(host).endswith(host_suffix.lower())
    host_low = F.lower(host)
    base = F.when(host_low.startswith(pre), host).otherwise(
        F.concat(F.lit(prefix), F.regexp_replace(host, r"(?i)^www\.", "")))
    rebuilt = F.concat(F.lit("https://"), base, after)
    return (F.when(already, s)
            .when(bare, F.concat(F.lit("https://" + prefix), s))
            .when((host != "") & match_host, rebuilt)
            .otherwise(s))


# The link clean-up of the scholarship importer.
TRAILING_PUNCT = r"[)\].,;:!?'\"»›…\-–—]+$"


def clean_url(u) -> Column:
    """Trim; drop an ``open in new window`` tail; strip one leading ``<``
    and one trailing ``>``; add ``https://`` to bare domains; strip trailing
    punctuation and dashes."""
    x = strip(F.coalesce(_c(u), F.lit("")))
    x = F.regexp_replace(x, r"(?i)\s*[-–—]?\s*open in new window.*$", "")
    x = F.regexp_replace(x, r"^<|>$", "")
    bare = (~x.rlike(r"(?i)^https?://")) & x.rlike(r"(?i)\b[a-z0-9-]+\.[a-z]{2,}\b")
    x = F.when(bare, F.concat(F.lit("https://"), x)).otherwise(x)
    return F.regexp_replace(x, TRAILING_PUNCT, "")


def url_parts(u) -> Column:
    """``struct(scheme, netloc, path, query, fragment)`` following RFC 3986's
    reference regex (what ``urllib.parse.urlparse`` does for web URLs)."""
    s = F.coalesce(_c(u), F.lit(""))
    rx = r"^(?:([A-Za-z][A-Za-z0-9+.-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#(.*))?$"
    return F.struct(F.regexp_extract(s, rx, 1).alias("scheme"), F.regexp_extract(s, rx, 2).alias("netloc"),
                    F.regexp_extract(s, rx, 3).alias("path"), F.regexp_extract(s, rx, 4).alias("query"),
                    F.regexp_extract(s, rx, 5).alias("fragment"))


def update_year_range(u, season_start: int) -> Column:
    """Every ``yyyy-yy`` token becomes the given season range."""
    rng = f"{season_start}-{str(season_start + 1)[-2:]}"
    return F.regexp_replace(_c(u), r"\b[0-9]{4}-[0-9]{2}\b", rng)


def replace_year(u, year: int) -> Column:
    """Every 4-digit token (with optional ``-yy``) becomes ``year``."""
    return F.regexp_replace(_c(u), r"\b[0-9]{4}(-[0-9]{2})?\b", str(year))


def has_year_range(u) -> Column:
    return _c(u).rlike(r"\b[0-9]{4}-[0-9]{2}\b")


def has_year_token(u) -> Column:
    """The path has a ``/yyyy`` or ``/yyyy-yy`` segment."""
    return url_parts(u)["path"].rlike(r"/[0-9]{4}(-[0-9]{2})?(/|$)")


def remove_year_segment(u) -> Column:
    """Drop path segments that are a year or a year range (and empty
    segments); keep query and fragment; missing scheme becomes https."""
    p = url_parts(u)
    segs = F.filter(F.split(p["path"], "/"), lambda s: (s != "") & ~s.rlike(r"^[0-9]{4}(-[0-9]{2})?$"))
    path = F.concat(F.lit("/"), F.array_join(segs, "/"))
    scheme = F.when(p["scheme"] == "", F.lit("https")).otherwise(p["scheme"])
    out = F.concat(scheme, F.lit("://"), p["netloc"], path,
                   F.when(p["query"] != "", F.concat(F.lit("?"), p["query"])).otherwise(F.lit("")),
                   F.when(p["fragment"] != "", F.concat(F.lit("#"), p["fragment"])).otherwise(F.lit("")))
    return F.when(_c(u).isNull() | (_c(u) == ""), _c(u)).otherwise(out)


@F.pandas_udf(T.StringType())
def _urljoin_udf(base: pd.Series, href: pd.Series) -> pd.Series:
    from urllib.parse import urljoin
    return pd.Series([None if h is None else urljoin(b or "", h) for b, h in zip(base, href)])


def url_join(base, href) -> Column:
    """Absolute URL of ``href`` against ``base``.

    Absolute, scheme-relative and root-relative links are resolved natively;
    other relative forms (``../x``, ``x``, ``?q``) and links with dot segments
    to fold go to a vectorised ``urljoin``.
    """
    b, h = _c(base), strip(_c(href))
    p = url_parts(b)
    root = F.concat(p["scheme"], F.lit("://"), p["netloc"])
    dots = h.startswith("/") & h.rlike(r"/\.\.?(/|$|[?#])")
    native = (h.isNull() | h.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:") | h.startswith("/")) & ~F.coalesce(dots, F.lit(False))
    # Python UDFs are evaluated for every row of the batch, whatever the
    # branch: rows resolved natively pass nulls, so only real work is shipped
    slow = _urljoin_udf(F.when(~native, b), F.when(~native, h))
    return (F.when(h.isNull(), F.lit(None).cast("string"))
            .when(h.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), h)
            .when(dots, slow)
            .when(h.startswith("//"), F.concat(p["scheme"], F.lit(":"), h))
            .when(h.startswith("/"), F.concat(root, h))
            .otherwise(slow))
