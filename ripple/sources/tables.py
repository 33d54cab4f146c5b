"""Readers and writers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ripple.session import Scratch, exists


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One parquet table of a data folder."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def read_edge_list(spark: SparkSession, path: str) -> DataFrame:
    """Edge list from text: two integers split by one space or one tab; later tokens are ignored.

    A token that is no integer, or a line with one token only, fails the job.
    """
    tokens = F.split("value", "[ \t]")
    return spark.read.text(path).select(
        F.element_at(tokens, 1).cast("int").alias("src"),
        F.element_at(tokens, 2).cast("int").alias("dst"),
    )


def write_edge_list(edges: DataFrame, path: str) -> None:
    edges.select(F.concat_ws("\t", F.col("src").cast("string"), F.col("dst").cast("string")).alias("value")) \
        .write.mode("overwrite").text(path)


def read_stop_words(spark: SparkSession, path: str) -> DataFrame:
    """Stop-word list, one word per line."""
    return spark.read.text(path).select(F.trim("value").alias("word")).filter(F.col("word") != "")


def newest(rows: DataFrame, keys: Sequence[str], order: str | None = None) -> DataFrame:
    """One row per key: the one with the highest ``order``; without it, the one with the highest values.

    ``max_by`` keeps one row per key on the map side, so a key with many rows does not gather in one task.
    """
    rest = [c for c in rows.columns if c not in keys]
    if not rest:
        return rows.distinct()
    by = F.struct(F.col(order), *rest) if order else F.struct(*rest)
    kept = rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), by).alias("row"))
    return kept.select(*keys, "row.*").select(*rows.columns)


def upsert(existing: DataFrame, new: DataFrame, keys: Sequence[str], order: str | None = None) -> DataFrame:
    """Rows of ``new`` replace rows of ``existing`` with the same key; all others stay.

    Of repeats of a key within ``new`` the one with the highest ``order`` counts.
    """
    fresh = newest(new, keys, order)
    return existing.join(fresh.select(*keys), list(keys), "left_anti").unionByName(fresh)


def append_rows(existing: DataFrame, new: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """Append ``new`` to a table with one row per key; where a key is taken, the row with the highest ``order`` stays.

    Only the taken rows are folded; the others of the stored table are kept as they are.
    """
    taken = new.select(*keys).distinct()
    free = existing.join(taken, list(keys), "left_anti")
    return free.unionByName(newest(existing.join(taken, list(keys), "left_semi").unionByName(new), keys, order))


# -- stored tables with a key ------------------------------------------------------

#: Buckets of a stored table. A lookup of one key reads one of them, and a batch of changes rewrites those it touches.
BUCKETS = 64


def bucket_of(key: Column, buckets: int = BUCKETS) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def _write_buckets(rows: DataFrame, path: str, order: Sequence[str], mode: str) -> None:
    # a range sort, so that a key with very many rows is spread over several files of its bucket
    rows.repartitionByRange("bucket", *order).sortWithinPartitions("bucket", *order).write.partitionBy("bucket").mode("overwrite") \
        .option("partitionOverwriteMode", mode).option(f"parquet.bloom.filter.enabled#{order[0]}", "true").parquet(path)


def write_keyed(rows: DataFrame, path: str, key: str, order: Sequence[str] = (), buckets: int = BUCKETS) -> None:
    """Store a table in buckets of ``key``, sorted by it, with Bloom filters of it."""
    _write_buckets(rows.withColumn("bucket", bucket_of(F.col(key), buckets)), path, [key, *order], "static")


def lookup(spark: SparkSession, path: str, key: str, value: str | int, buckets: int = BUCKETS) -> DataFrame:
    """Rows of one key. The bucket is known before the table is read, so the files of one bucket are listed, and of these the
    row groups without the key are passed over.
    """
    return spark.read.parquet(path).filter((F.col("bucket") == bucket_of(F.lit(value), buckets)) & (F.col(key) == value)).drop("bucket")


def lookup_each(spark: SparkSession, path: str, key: str, keys: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """Rows of each of a few keys (a column ``key``): the buckets that they are in are found before the table is read."""
    wanted = keys.select(key).distinct().withColumn("bucket", bucket_of(F.col(key), buckets))
    return spark.read.parquet(path).join(wanted, ["bucket", key]).drop("bucket")


def read_stored(spark: SparkSession, path: str) -> DataFrame:
    """The table that :func:`write_recommendations` keeps."""
    return spark.read.parquet(path).drop("bucket")


def write_recommendations(recommendations: DataFrame, path: str, order: str | None = None, buckets: int = BUCKETS) -> None:
    """Put recommendations into the stored table: equal (username, url) are replaced, all other rows stay.

    Only the buckets of users that the batch has are read and written; the files of the others stay as they are. The new
    rows of a bucket are written aside first. A run that ends between two buckets is mended by running it again, as
    putting a row twice changes nothing.
    """
    spark, keys = recommendations.sparkSession, ["username", "url"]
    run = Scratch(spark, "upsert")
    fresh = run.save(newest(recommendations, keys, order).withColumn("bucket", bucket_of(F.col("username"), buckets)), "fresh")
    if not exists(spark, f"{path}/_SUCCESS"):
        _write_buckets(fresh, path, keys, "static")
    else:
        touched = [r.bucket for r in fresh.select("bucket").distinct().collect()]       # at most ``buckets`` numbers
        stored = spark.read.parquet(path).filter(F.col("bucket").isin(touched))
        merged = stored.join(fresh.select(*keys), keys, "left_anti").unionByName(fresh)
        _write_buckets(run.save(merged, "merged"), path, keys, "dynamic")
    run.drop("")
