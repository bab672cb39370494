"""Rows and fixtures the tests of this folder share."""
import random

import pytest
from pyspark.sql import types as T

from tessera.session import ship_package

SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
                       T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])


@pytest.fixture(autouse=True)
def package(spark):
    ship_package(spark)


def sentence(rng, n):
    return " ".join("".join(rng.choice("abcdeéßThe") for _ in range(rng.randint(1, 7))) for _ in range(n))


def corpus(seed=1, n=60):
    """Rows with copies, near copies, shared passages, junk, and edge cases."""
    rng = random.Random(seed)
    passage = sentence(rng, 120)
    rows = []
    for i in range(n):
        kind = i % 6
        if kind == 1 and rows:
            text = rng.choice(rows)[1] or ""
        elif kind == 2 and rows:
            ws = (rng.choice(rows)[1] or "x").split(" ")
            ws[rng.randrange(len(ws))] = "changed"
            text = " ".join(ws)
        elif kind == 3:
            text = sentence(rng, 30) + "\n" + passage + "\n" + sentence(rng, 20)
        else:
            text = ".\n".join(sentence(rng, rng.randint(1, 80)) for _ in range(rng.randint(1, 6)))
        rows.append((i * 7 - 50, text, rng.choice(["en", "de", None]), rng.choice(["s1", "s2", "s2", None]), len(text)))
    return rows


def edge_rows():
    """Nulls in every column, empty and long texts, ties and repeated rows."""
    long = " ".join(f"w{k % 977} x{k % 13}" for k in range(30_000))
    return [(None, None, None, None, None), (None, "null id text " * 40, "en", "s1", None), (1, None, "en", None, 0), (2, "", None, "s1", 0),
            (3, "  \n\t ", "en", "s1", 6), (4, "same words here", "en", "s1", 1), (4, "same words here", "en", "s1", 1),
            (4, "same id, other text", "de", "s2", 1), (5, long, "en", "s1", len(long)), (6, long, "fr", "s9", len(long)),
            (7, "x", "en", "s1", 1), (8, "Ünïcode " * 90 + "日本語 \x00 end", "en", "s2", 1)]


@pytest.fixture(scope="session")
def make(spark):
    def build(rows, extra=True):
        df = spark.createDataFrame(rows, SCHEMA)
        if extra:  # names that results or inner steps also use
            from pyspark.sql import functions as F
            for name in ("fingerprint", "size", "kept", "text_hash", "chunk", "fp", "key", "ids", "cuts", "mu", "draw", "bucket", "start", "grp", "weight", "group"):
                df = df.withColumn(name, F.lit("clash"))
        return df.repartition(3)
    return build


def got(df):
    return [r.asDict() for r in df.collect()]
