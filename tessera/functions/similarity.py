"""Name similarity.

Jaccard is native.  The sequence ratio (``difflib.SequenceMatcher``) has no
SQL form; it runs in an Arrow-batched pandas UDF and callers apply it only to
candidate pairs that survived native pruning.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.text import word_tokens

SEQ_WEIGHT = 0.4   # Fixed values: weights of the combined score.
JAC_WEIGHT = 0.6
BONUS = 0.15       # Fixed value: same-conference bonus of the top-k search.


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def jaccard(a_tokens, b_tokens) -> Column:
    """S27 + H2: intersection size over union size of two distinct token
    arrays; 0.0 if either is empty."""
    a, b = _c(a_tokens), _c(b_tokens)
    inter = F.size(F.array_intersect(a, b))
    union = F.size(F.array_union(a, b))
    return F.when((F.size(a) == 0) | (F.size(b) == 0), F.lit(0.0)).otherwise(inter / union)


def token_jaccard(a, b) -> Column:
    """S27 on raw strings."""
    return jaccard(word_tokens(a), word_tokens(b))


def seq_ratio_py(a: str, b: str) -> float:
    from difflib import SequenceMatcher
    return SequenceMatcher(None, (a or "").lower(), (b or "").lower()).ratio()


@F.pandas_udf(T.DoubleType())
def seq_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """``SequenceMatcher(None, a.lower(), b.lower()).ratio()`` (asymmetric;
    auto-junk applies when ``b`` has 200+ characters, as in the stdlib)."""
    from difflib import SequenceMatcher
    out = []
    for x, y in zip(a, b):
        out.append(SequenceMatcher(None, (x or "").lower(), (y or "").lower()).ratio())
    return pd.Series(out, dtype="float64")


def combined(seq: Column, jac: Column) -> Column:
    """``0.4 * seq + 0.6 * jaccard``."""
    return F.lit(SEQ_WEIGHT) * seq + F.lit(JAC_WEIGHT) * jac


def round_score(x, digits: int = 3) -> Column:
    """Python ``round`` is half-even: ``bround``."""
    return F.bround(_c(x), digits)


def combined_py(a: str, b: str) -> float:
    """Plain-Python combined score, used by tests as the brute-force oracle."""
    import re
    ta = set(re.findall(r"\w+", (a or "").lower()))
    tb = set(re.findall(r"\w+", (b or "").lower()))
    jac = 0.0 if not ta or not tb else len(ta & tb) / len(ta | tb)
    return SEQ_WEIGHT * seq_ratio_py(a, b) + JAC_WEIGHT * jac


def edit_ratio(a: Column, b: Column) -> Column:
    """Native character score: 1 - edit distance / longer length, on
    lower-case text (1 for two empty texts)."""
    x, y = F.lower(F.coalesce(a, F.lit(""))), F.lower(F.coalesce(b, F.lit("")))
    longer = F.greatest(F.length(x), F.length(y))
    return F.when(longer == 0, F.lit(1.0)).otherwise(1 - F.levenshtein(x, y) / longer)
