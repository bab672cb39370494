"""The registered queries of this package: one per operator, each over the
whole ``documents`` table with production parameters, and their SQL where SQL
can say the same."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import bytebpe, exactdedup, fingerprint, licenses, lmscore, mixing, negatives, quality, simhash, spelling, suffixdedup, tokencounts, tokenfiles
from tessera.session import read_table

QUERIES: dict = {}
ORACLE: dict = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def vocabulary(name: str) -> str:
    """Path of a public vocabulary file; ``TOKENIZER_DIR`` names another folder."""
    folder = os.environ.get("TOKENIZER_DIR")
    if folder:
        return os.path.join(folder, name)
    import public_tokenizers
    return public_tokenizers.path(name)


def _docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "documents")


@register("op1_fingerprints")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Multiset fingerprint of every text and of its edited text."""
    return fingerprint.fingerprints(_docs(spark, sf_dir))


def _license_sql() -> str:
    rows = ", ".join("('{}', {}, {})".format(
        k, len(licenses.template_bigrams(v)),
        "[" + ", ".join("'" + b.replace("'", "''") + "'" for b in licenses.template_bigrams(v)) + "]")
        for k, v in licenses.TEMPLATES.items())
    t = licenses.THRESHOLD
    return rf"""
WITH tpl(name, m, grams) AS (VALUES {rows}),
lines AS (
  SELECT doc_id, pos, list_filter(regexp_split_to_array(lower(line), '[^a-z0-9.+\x{{80}}-\x{{10FFFF}}]+'), lambda x: x <> '') AS ws
  FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
               generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM documents)),
kept AS (SELECT * FROM lines WHERE len(ws) > 0),
whole AS (SELECT doc_id, 0 AS pos, flatten(list(ws ORDER BY pos)) AS ws FROM kept GROUP BY doc_id HAVING count(*) > 1),
blocks AS (SELECT * FROM kept UNION ALL SELECT * FROM whole),
grams AS (
  SELECT doc_id, pos, CASE WHEN len(ws) < 2 THEN [] ELSE
    list_distinct(list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1])) END AS g FROM blocks),
scored AS (
  SELECT doc_id, pos, name, 2.0 * len(list_intersect(g, grams)) / (len(g) + m) AS score
  FROM grams, tpl WHERE len(g) BETWEEN m * {t} / (2 - {t}) AND m * (2 - {t}) / {t}),
hit AS (SELECT * FROM scored WHERE score >= {t}),
per AS (
  SELECT doc_id, count(DISTINCT pos) AS n_matched, string_agg(DISTINCT name, ',' ORDER BY name) AS licenses,
         max(score) AS score FROM hit GROUP BY doc_id),
top AS (SELECT h.doc_id, min(h.name) AS license FROM hit h JOIN per p ON h.doc_id = p.doc_id AND h.score = p.score GROUP BY h.doc_id)
SELECT d.doc_id, CAST(coalesce(b.n, 0) AS BIGINT) AS n_blocks, CAST(coalesce(p.n_matched, 0) AS BIGINT) AS n_matched,
       top.license, p.score, coalesce(p.licenses, '') AS licenses
FROM documents d LEFT JOIN (SELECT doc_id, count(*) AS n FROM blocks GROUP BY doc_id) b ON b.doc_id = d.doc_id
LEFT JOIN per p ON p.doc_id = d.doc_id LEFT JOIN top ON top.doc_id = d.doc_id"""


@register("op2_license_scan", _license_sql())
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence notices in every document, by Dice over word bigrams."""
    return licenses.scan(_docs(spark, sf_dir))


@register("op3_lm_score")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log-probability of every whole text under the corpus' n-gram automaton."""
    return lmscore.score(_docs(spark, sf_dir))


@register("op4_suffix_dedup")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of repeated 400-byte strings removed from every text."""
    return suffixdedup.deduplicated(_docs(spark, sf_dir)).drop("kept", "text_hash")


@register("op5_token_counts")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token count of every whole text."""
    return tokencounts.counts(_docs(spark, sf_dir), vocabulary("word_bpe_49k.json"))


@register("op6_token_files")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every text, written to files and read back."""
    return tokenfiles.round_trip(_docs(spark, sf_dir), vocabulary("word_bpe_49k.json"))


@register("op7_simhash")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash fingerprints and the components of their links."""
    return simhash.groups(_docs(spark, sf_dir)).select("doc_id", "fingerprint", "component_id")


@register("op8_quality")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality statistics, base rules and the robust outlier verdict."""
    return quality.judge(_docs(spark, sf_dir)).drop("text_hash")


@register("op9_byte_bpe")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Byte-level BPE ids of every whole text, and their decoding."""
    return bytebpe.digests(_docs(spark, sf_dir), vocabulary("byte_bpe_multi_50k.tiktoken"))


_MIX_SQL = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
    -ln((('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 13))::BIGINT::DOUBLE + 0.5) / 4503599627370496.0)
      / CASE WHEN q > 0 THEN 2.0 WHEN q = 0 THEN 0.5 ELSE 1.0 END AS draw
  FROM documents LEFT JOIN (SELECT doc_id AS lid, max(quality) AS q FROM labels GROUP BY doc_id) ON doc_id = lid),
s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
    [5.0, 2.0, 1.0][CAST((row_number() OVER (ORDER BY source IS NULL, hex(source)) - 1) % 3 + 1 AS INT)] AS weight
  FROM d GROUP BY source),
f AS (
  SELECT *, (sum(source_size) OVER () - 3 * coalesce(sum(source_size) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(weight) OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM s WINDOW w AS (ORDER BY source_size / weight, source IS NULL, hex(source))),
t AS (
  SELECT source, source_size, CASE WHEN level * weight > 3 * source_size THEN CAST(3 * source_size AS DOUBLE)
    ELSE least(CAST(3 * source_size AS DOUBLE), weight * (SELECT max(level) FROM f WHERE level * weight <= 3 * source_size)) END AS target
  FROM f),
r AS (
  SELECT d.*, t.source_size, t.target,
    CASE WHEN t.source_size > 0 THEN CAST(floor(t.target / t.source_size) AS BIGINT) ELSE 0 END AS epochs,
    coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY draw, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
  CAST(size * (epochs + CASE WHEN epochs < 3 AND before + size / 2.0 <= target - epochs * source_size THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM r"""


@register("op10_mixing", _MIX_SQL)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words each document gives to the mix of all sources."""
    weights = mixing.quality_weights(read_table(spark, sf_dir, "labels"))
    return mixing.mix(_docs(spark, sf_dir), weights).drop("text_hash", "source")


@register("op11_spelling_variants")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents, the frequent form and the root of each."""
    return spelling.grouped(_docs(spark, sf_dir))


_EXACT_SQL = r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS chars,
    sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256 FROM documents),
r AS (
  SELECT *, row_number() OVER w AS nth, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY text_sha256) AS n
  FROM d WINDOW w AS (PARTITION BY text_sha256 ORDER BY chars DESC, doc_id NULLS LAST))
SELECT doc_id, keep_id, CAST(n AS BIGINT) AS group_size, nth = 1 AS kept, text_sha256 FROM r"""


@register("op12_exact_dedup", _EXACT_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of equal texts, and the row of each that stays."""
    return exactdedup.deduplicated(_docs(spark, sf_dir))


_NEGATIVES_SQL = """
WITH e AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same, CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
  FROM e a JOIN e b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
p AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT anchor_id, positive_id,
  CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id) AS INT) AS rank,
  id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id) WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY rank <= 10"""


@register("op13_hard_negatives", _NEGATIVES_SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every hundredth vector."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = negatives.prepared(read_table(spark, sf_dir, "embeddings"), "vec_id", "embedding", label)
    return negatives.mine(rows, F.col("id") % 100 == 0)
