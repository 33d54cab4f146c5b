"""The corpus pipeline: stages applied to documents, each written as Parquet before the next reads it.

Every stage but the last takes and returns the columns of ``documents``. Rows are told apart by id and text, so
null and repeated ids go through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ripple.llm import bagminhash, exact_dedup, language_id, mixing, packing
from ripple.llm.common import Scratch, prepare, table, text_or_empty

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def in_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the languages that the labelled rows are in."""
    docs = docs.select(*COLUMNS)
    return language_id.accepted(docs, language_id.train(docs, Scratch(prepare(spark), "stage-language")))


def without_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    sha = F.sha2(exact_dedup.normalised(text_or_empty()).cast("binary"), 256)
    kept = exact_dedup.exact_groups(docs).filter("kept") \
        .select(F.col("doc_id").alias("_id"), F.col("text_sha256").alias("_kept")).distinct()
    keyed = docs.select(*COLUMNS).withColumn("_sha", sha)
    found = keyed.join(kept, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_sha") == F.col("_kept")), "left_semi")
    # an id that repeats within its group
    return found.dropDuplicates(["doc_id", "_sha"]).select(*COLUMNS)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    classes = bagminhash.near_duplicates(docs, Scratch(prepare(spark), "stage-near"))
    kept = classes.filter("kept").select(F.col("doc_id").alias("_id"), F.col("text_md5").alias("_kept")).distinct()
    keyed = docs.select(*COLUMNS).withColumn("_md5", F.md5(text_or_empty().cast("binary")))
    found = keyed.join(kept, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_md5") == F.col("_kept")), "left_semi")
    return found.dropDuplicates(["doc_id", "_md5"]).select(*COLUMNS)


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's share takes them."""
    return mixing.mixed(docs.select(*COLUMNS), Scratch(prepare(spark), "stage-mix"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the tokenised documents, in sequences."""
    return packing.pack(docs, Scratch(prepare(spark), "stage-pack"))


STAGES = [
    ("language ID", in_known_languages),
    ("exact dedup", without_exact_copies),
    ("MinHash near-dedup", without_near_copies),
    ("mixing", mixed_sources),
    ("packing", packed),
]

# language models, signatures and the tokenizer have no SQL
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of one folder."""
    docs = table(spark, sf_dir, "documents")
    scratch = Scratch(spark, "pipeline")
    for i, (_, stage) in enumerate(STAGES):
        docs = scratch.save(stage(spark, docs, sf_dir), f"stage{i}")
    return docs
