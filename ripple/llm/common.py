"""What the operators of this package share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ripple.session import Scratch, prepare

__all__ = ["Scratch", "WHITE_SPACE", "drop_folder", "prepare", "ranked", "table", "text_or_empty"]

#: The white space every contract of this package names.
WHITE_SPACE = " \t\n\u000b\f\r"


def table(spark, folder: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{folder}/{name}.parquet")


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def drop_folder(scratch: Scratch) -> None:
    """Delete all tables of one run."""
    scratch.drop("")


def ranked(df: DataFrame, scratch: Scratch, keys: list[str], order: list[str], values: dict[str, str],
           name: str = "ranked") -> DataFrame:
    """``df`` with, for each item of ``values``, a column of that name: the sum of the value column over
    the rows of the same keys that come earlier.

    A distributed prefix sum. Rows are written, as the range sort reads them twice (bounds, then rows);
    they are range-partitioned by keys and order, so that the rows of one hot key lie in many
    partitions; the sorted rows are written with the partition they fell in. Sums per partition and key (one row each) give every partition its offset. No task sees
    more than one partition of rows, and the window over offsets sees one row per partition.

    Null keys form a key of their own. Rows equal in keys and order come in any order.
    """
    columns = df.columns
    sort = [F.col(c).asc_nulls_last() for c in [*keys, *order]]
    df = scratch.save(df, f"{name}-rows")
    placed = scratch.save(df.repartitionByRange(*sort).sortWithinPartitions(*sort)
                          .withColumn("_part", F.spark_partition_id()), name)
    local = placed.groupBy("_part", *keys).agg(*[F.sum(v).alias(f"_sum_{n}") for n, v in values.items()])
    earlier = (Window.unboundedPreceding, -1)
    by_key = Window.partitionBy(*keys).orderBy("_part").rowsBetween(*earlier)
    zero = F.lit(0).cast("long")
    offsets = local.select(F.col("_part").alias("_p"), *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)],
                           *[F.coalesce(F.sum(f"_sum_{n}").over(by_key), zero).alias(f"_from_{n}") for n in values])
    within = Window.partitionBy("_part", *keys).orderBy(*sort[len(keys):]).rowsBetween(*earlier)
    rows = placed.select("*", *[F.coalesce(F.sum(v).over(within), zero).alias(f"_in_{n}") for n, v in values.items()])
    return rows.join(offsets, (F.col("_part") == F.col("_p")) & _same(keys)) \
        .select(*columns, *[(F.col(f"_in_{n}") + F.col(f"_from_{n}")).alias(n) for n in values])


def _same(keys: list[str]) -> Column:
    """Equality of the keys with their copies ``_k0``, ``_k1``, ..., nulls equal."""
    out = F.lit(True)
    for i, k in enumerate(keys):
        out &= F.col(k).eqNullSafe(F.col(f"_k{i}"))
    return out
