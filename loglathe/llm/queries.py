"""The corpus operators as named queries, each over its whole table, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loglathe.llm import (
    bpe, exact_dedup, fingerprints, katz, middle, mixing, negatives, ngram_join, pii, quality,
    substring, toxicity, url_filter,
)
from loglathe.session import configure_session

Query = Callable[[SparkSession, str], DataFrame]
# The vocabulary file the token queries use.
VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(function: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return function(configure_session(spark), sf_dir)

    QUERIES[function.__name__] = run
    return run


def _documents(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", *columns)


@query
def op1_mix(spark, sf_dir):
    return mixing.taken(_documents(spark, sf_dir, "source", "text")).select(
        "doc_id", "size", "source_size", "target", "taken")


@query
def op2_ngram_join(spark, sf_dir):
    return ngram_join.components(_documents(spark, sf_dir, "text")).select(
        "doc_id", "n_shingles", "component_id")


@query
def op3_pii(spark, sf_dir):
    return pii.report(_documents(spark, sf_dir, "text"))


@query
def op4_quality(spark, sf_dir):
    return quality.judge(_documents(spark, sf_dir, "text", "source", "lang"),
                         spark.read.parquet(f"{sf_dir}/labels.parquet"))


@query
def op5_fingerprints(spark, sf_dir):
    return fingerprints.compare_neighbours(_documents(spark, sf_dir, "text"))


@query
def op6_bpe(spark, sf_dir):
    return bpe.digests(_documents(spark, sf_dir, "text"), VOCABULARY)


@query
def op7_substring(spark, sf_dir):
    """Passages of one document that another one has too."""
    return substring.passages(_documents(spark, sf_dir, "text"), inner=False)


@query
def op8_url_filter(spark, sf_dir):
    return url_filter.judge(spark.read.parquet(f"{sf_dir}/pages.parquet").select(
        "page_id", "url", "html"))


@query
def op10_katz(spark, sf_dir):
    return katz.scores(_documents(spark, sf_dir, "text"))


@query
def op9_exact_dedup(spark, sf_dir):
    return exact_dedup.groups(_documents(spark, sf_dir, "text"))


@query
def op11_hard_negatives(spark, sf_dir):
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select(
        "vec_id", label.alias("label"), "embedding")
    return negatives.mine(rows, F.col("vec_id") % 100 == 0)


@query
def op12_toxicity(spark, sf_dir):
    held_out = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 3 == 1
    found = toxicity.judge(_documents(spark, sf_dir, "text"),
                           spark.read.parquet(f"{sf_dir}/labels.parquet"), learn_from=~held_out)
    return found.select("doc_id", held_out.alias("held_out"), "score", "predicted")


@query
def op13_fill_in_middle(spark, sf_dir):
    return middle.digests(_documents(spark, sf_dir, "text"))


ORACLES["op1_mix"] = r"""
WITH sized AS (
  SELECT doc_id, source, md5('mix:' || coalesce(doc_id::VARCHAR, '')) AS place,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size
  FROM documents),
per_source AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight
  FROM sized GROUP BY source),
rates AS (
  SELECT *, (sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER filling, 0))::DOUBLE
            / (sum(weight) OVER () - coalesce(sum(weight) OVER filling, 0))::DOUBLE AS rate
  FROM per_source
  WINDOW filling AS (ORDER BY 3 * source_size / weight, source NULLS LAST
                     ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
targets AS (
  SELECT source, source_size,
         least((3 * source_size)::DOUBLE, (SELECT max(rate) FROM rates) * weight) AS target
  FROM rates),
queued AS (
  SELECT doc_id, size, source_size, target, floor(target)::BIGINT AS due,
         (sum(size) OVER (PARTITION BY s.source ORDER BY place, doc_id, size
                          ROWS UNBOUNDED PRECEDING) - size)::BIGINT AS before
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       (greatest(0, least(due - before, size))
        + greatest(0, least(due - source_size - before, size))
        + greatest(0, least(due - 2 * source_size - before, size)))::BIGINT AS taken
FROM queued"""

ORACLES["op9_exact_dedup"] = r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS size,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents)
SELECT doc_id, first_value(doc_id) OVER best AS keep_id,
       count(*) OVER (PARTITION BY text_sha256) AS group_size,
       row_number() OVER best = 1 AS kept, text_sha256
FROM d
WINDOW best AS (PARTITION BY text_sha256 ORDER BY size DESC, doc_id NULLS LAST)"""

ORACLES["op13_fill_in_middle"] = r"""
WITH hashed AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('7:' || coalesce(doc_id::VARCHAR, '')) AS h,
         regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS lines
  FROM documents),
numbers AS (
  SELECT *, len(lines) AS n, ('0x' || h[1:8])::BIGINT AS h1, ('0x' || h[9:16])::BIGINT AS h2,
         ('0x' || h[25:32])::BIGINT AS h4
  FROM hashed),
parts AS (
  SELECT *, array_to_string(lines[1:least(h1 % (n + 1), h2 % (n + 1))], '') AS prefix,
         array_to_string(lines[least(h1 % (n + 1), h2 % (n + 1)) + 1
                               :greatest(h1 % (n + 1), h2 % (n + 1))], '') AS middle,
         array_to_string(lines[greatest(h1 % (n + 1), h2 % (n + 1)) + 1:], '') AS suffix,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
              THEN 'plain' WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form
  FROM numbers)
SELECT doc_id, n::BIGINT AS n, form,
       CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text
                        WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM parts"""

ORACLES["op11_hard_negatives"] = r"""
WITH vectors AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scores AS (
  SELECT a.vec_id AS anchor_id, a.label = b.label AS same, b.vec_id AS other,
         list_dot_product(a.v, b.v)::BIGINT AS score
  FROM vectors a JOIN vectors b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
positives AS (
  SELECT * FROM scores WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5)
SELECT p.anchor_id, p.other AS positive_id,
       (row_number() OVER best)::INTEGER AS rank,
       n.other AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM positives p JOIN scores n ON n.anchor_id = p.anchor_id AND NOT n.same
  AND 30 * p.score <= 100 * n.score AND 100 * n.score <= 90 * p.score
WINDOW best AS (PARTITION BY p.anchor_id, p.other ORDER BY n.score DESC, n.other)
QUALIFY row_number() OVER best <= 10"""
