"""The registered queries of this package, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ripple.llm import (bagminhash, exact_dedup, html_extraction, importance, language_id, mixing, packing, spelling, spotsigs,
                        substring_dedup, suffix_dedup, token_counts, word_bpe)
from ripple.llm.common import Scratch, table
from ripple.llm.lexical_sql import IMPORTANCE_SQL, SPELLING_SQL

Query = Callable[[SparkSession, str], DataFrame]


def op1_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, folder, "documents"), Scratch(spark, "token-counts"))


def op2_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, folder, "documents"))


def op3_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return language_id.identify(docs, language_id.train(docs, Scratch(spark, "language-id")))


def op4_document_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return spotsigs.fingerprints(docs, Scratch(spark, "fingerprints"), spotsigs.frequent_words(docs))


def op5_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(table(spark, folder, "documents"), Scratch(spark, "packing"))


def op6_minhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return bagminhash.near_duplicates(table(spark, folder, "documents"), Scratch(spark, "near-duplicates"))


def op7_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(table(spark, folder, "documents"), Scratch(spark, "mixing"))


def op8_suffix_array_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return suffix_dedup.remove_repeats(table(spark, folder, "documents"), Scratch(spark, "suffix-dedup"))


def op9_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return substring_dedup.remove_repeats(table(spark, folder, "documents"), Scratch(spark, "substring-dedup"))


def op10_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages")
    return html_extraction.extract(pages, html_extraction.train(pages))


def op11_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    return spelling.variants(table(spark, folder, "documents"), Scratch(spark, "spelling"))


def op12_bpe_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    return word_bpe.round_trip(table(spark, folder, "documents"))


def op13_importance_resampling(spark: SparkSession, folder: str) -> DataFrame:
    return importance.resample(table(spark, folder, "documents"), table(spark, folder, "benchmark"), Scratch(spark, "importance"))


def queries() -> dict[str, Query]:
    return {f.__name__: f for f in (
        op1_token_counts, op2_exact_dedup, op3_language_id, op4_document_fingerprints, op5_packing,
        op6_minhash_near_dedup, op7_mixing, op8_suffix_array_dedup, op9_substring_dedup, op10_html_extraction,
        op11_spelling_variants, op12_bpe_round_trip, op13_importance_resampling)}


# Equal texts by their normalised bytes; the row with most code points, then the smallest id, stays.
EXACT_DEDUP_SQL = r"""
WITH plain AS (
  SELECT doc_id, length(coalesce(text, '')) AS n,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS t
  FROM documents
), best AS (
  SELECT t, count(*) AS group_size, arg_min(doc_id, (-n, doc_id)) AS keep_id FROM plain GROUP BY t
)
SELECT p.doc_id, b.keep_id, b.group_size, p.doc_id = b.keep_id AS kept, sha256(p.t) AS text_sha256
FROM plain p JOIN best b ON p.t = b.t
"""

# The share of each source is the smaller of its limit and a common part per weight; sources reach
# their limit in the order of limit per weight.
MIXING_SQL = r"""
WITH docs AS (
  SELECT doc_id, source, md5('mix-1:' || coalesce(doc_id::VARCHAR, 'null')) AS k,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size
  FROM documents
), sources AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM docs GROUP BY source
), weighted AS (
  SELECT source, source_size, 3 * source_size AS cap,
         [5, 2, 1][1 + ((row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3)::INT]::BIGINT AS w
  FROM sources
), filling AS (
  SELECT *, (sum(source_size) OVER () - coalesce(sum(cap) OVER before_it, 0))::BIGINT AS left_over,
         (sum(w) OVER () - coalesce(sum(w) OVER before_it, 0))::BIGINT AS weight_left
  FROM weighted
  WINDOW before_it AS (ORDER BY cap::DOUBLE / w, encode(source) NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), level AS (
  SELECT left_over, weight_left FROM filling
  WHERE cap * weight_left >= left_over * w
  ORDER BY cap::DOUBLE / w, encode(source) NULLS LAST LIMIT 1
), target AS (
  SELECT source, source_size, least(cap::DOUBLE, (w * left_over)::DOUBLE / weight_left::DOUBLE) AS target
  FROM weighted, level
), cut AS (
  SELECT d.doc_id, d.size, t.source_size, t.target, round(t.target)::BIGINT AS whole,
         coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.k, d.size
                                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before
  FROM docs d JOIN target t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size::BIGINT AS size, source_size, target,
       CASE WHEN source_size = 0 THEN 0
            ELSE (whole // source_size) * size
                 + greatest(0, least(size, whole % source_size - before)) END::BIGINT AS taken
FROM cut
"""


def oracle_sql() -> dict[str, str]:
    return {"op2_exact_dedup": EXACT_DEDUP_SQL, "op7_mixing": MIXING_SQL, "op11_spelling_variants": SPELLING_SQL,
            "op13_importance_resampling": IMPORTANCE_SQL}
