"""One registered query for each operator, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import (
    curve_search, decontamination, fill_in_middle, near_duplicates, pieces, pseudonyms, quality, ranked_search, repetition, sharding, token_counts,
    toxicity, url_filter,
)

WORDS_49K = public_tokenizers.path("word_bpe_49k.json")
PIECES_32K = public_tokenizers.path("piece_bpe_32k.model")

# A fixed key for the registered queries; real data need a secret one.
PII_KEY = "registered queries"

RULES = [
    url_filter.Rule("allow", "com", "/"),
    url_filter.Rule("block", "example.com", "/en/"),
    url_filter.Rule("allow", "www.example.com", "/en/"),
    url_filter.Rule("block", "net", "/es/"),
    url_filter.Rule("block", "net", "/fr/"),
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), WORDS_49K)


def op2_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudonyms.pseudonymize(table(spark, sf_dir, "documents"), PII_KEY, count="n_replaced").select(
        "doc_id", "text", "n_replaced")


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents"), 8)


def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encode_digests(table(spark, sf_dir, "documents"), PIECES_32K)


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates.near_duplicates(table(spark, sf_dir, "documents"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages"), RULES)


def op10_repetition(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repetition.repetition(table(spark, sf_dir, "documents"))


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_in_middle.digests(table(spark, sf_dir, "documents"))


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), 20)


def op13_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curve_search.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, 10)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_token_counts, op2_pseudonyms, op3_sharding, op4_sentencepiece, op5_decontamination, op6_near_duplicates,
        op7_toxicity, op8_quality, op9_url_filter, op10_repetition, op11_fill_in_middle,
        op12_ranked_search, op13_nearest_neighbours)
}

_RULE_ROWS = ", ".join(f"('{r.verdict}', '{r.host}', '{r.path}')" for r in RULES)

_TERMS = f"regexp_extract_all(translate(text, '{url_filter.UPPER}', '{url_filter.LOWER}'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"

ORACLE_SQL = {
    "op9_url_filter": f"""
WITH rules(verdict, host, path) AS (VALUES {_RULE_ROWS}),
rest AS (SELECT page_id, coalesce(regexp_extract(url, '^.*?://(.*)$', 1, 's'), '') AS rest FROM pages),
sites AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), '{url_filter.UPPER}', '{url_filter.LOWER}') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM rest),
fitting AS (
  SELECT s.page_id, s.host, s.path, r.host || r.path AS rule, r.verdict,
         row_number() OVER (PARTITION BY s.page_id ORDER BY length(r.host) DESC, length(r.path) DESC) AS place
  FROM sites s LEFT JOIN rules r
    ON (s.host = r.host OR ends_with(s.host, '.' || r.host)) AND starts_with(s.path, r.path))
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM fitting WHERE place = 1""",
    "op11_fill_in_middle": """
WITH hashed AS (SELECT doc_id, coalesce(text, '') AS text, sha256('7:' || doc_id) AS digest FROM documents),
drawn AS (
  SELECT doc_id, text, regexp_extract_all(text, '[^\n]*\n|[^\n]+') AS units,
         [('0x' || digest[8 * k + 1:8 * k + 8])::BIGINT FOR k IN range(4)] AS h
  FROM hashed),
cut AS (
  SELECT doc_id, text, units, len(units) AS n, h,
         least(h[1] % (len(units) + 1), h[2] % (len(units) + 1)) AS low, greatest(h[1] % (len(units) + 1), h[2] % (len(units) + 1)) AS high
  FROM drawn),
parts AS (
  SELECT doc_id, text, n, array_to_string(units[1:low], '') AS prefix, array_to_string(units[low + 1:high], '') AS middle,
         array_to_string(units[high + 1:], '') AS suffix,
         CASE WHEN text = '' OR regexp_matches(text, '<[PSM]>') OR h[3] % 100 >= 100 THEN 'plain'
              WHEN h[4] % 100 < 50 THEN 'spm' ELSE 'psm' END AS form
  FROM cut)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN length(prefix) END::BIGINT AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(middle) END::BIGINT AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
              ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM parts""",
    "op12_ranked_search": f"""
WITH docs AS (SELECT row_number() OVER () AS place, doc_id, text FROM documents),
counted AS (
  SELECT place, term, count(*) AS tf FROM (SELECT place, unnest({_TERMS}) AS term FROM docs) GROUP BY place, term),
lengths AS (SELECT place, sum(tf)::BIGINT AS n FROM counted GROUP BY place),
corpus AS (SELECT count(*) AS docs, sum(n)::BIGINT AS words FROM lengths),
weights AS (
  SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w
  FROM counted, corpus GROUP BY term, docs),
asked AS (
  SELECT item, item_id, term, count(*) AS times
  FROM (SELECT item, item_id, unnest({_TERMS}) AS term FROM (
    SELECT row_number() OVER () AS item, item_id, text FROM (SELECT DISTINCT item_id, text FROM benchmark)))
  GROUP BY item, item_id, term),
scored AS (
  SELECT item, item_id, place, sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * docs) // words))))::BIGINT AS score
  FROM asked JOIN counted USING (term) JOIN weights USING (term) JOIN lengths USING (place), corpus
  GROUP BY item, item_id, place),
ranked AS (
  SELECT item_id, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id) AS rank, doc_id, score
  FROM scored JOIN docs USING (place) WHERE score > 0)
SELECT item_id, rank::INT AS rank, doc_id, score FROM ranked WHERE rank <= 20""",
}
