"""Exact duplicates: groups by 128-bit content hash, with a comparison of bytes inside each group.

Texts are equal when they are identical after deleting white space (blank, tab, line feed, vertical
tab, form feed, carriage return). A null text counts as empty. Of equal texts the row with the most
code points in its original text stays, of those the one with the smallest id.

Grouping is by (MD5 of the normalised bytes, the bytes themselves), so two texts with one hash are
told apart by their bytes inside the shuffle's own key comparison, without a list of a group's
members anywhere. Each map task sends one row per distinct text, which takes care of groups of any
size; the members find their group again by two hashes and a length of a few bytes.

Null ids come last in order; the largest long is taken for a null id. Repeated rows are members like any other; a row
whose id repeats gets ``kept`` on each of the repeats. An empty table gives an empty result.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ripple.llm.common import WHITE_SPACE, text_or_empty


_UNIT = Decimal(1 << 64)
_LAST = Decimal((1 << 63) - 1)


def normalised(text: Column) -> Column:
    return F.translate(text, WHITE_SPACE, "")


def exact_groups(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per document: its id, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``."""
    plain = normalised(text_or_empty(text))
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.length(text_or_empty(text)).alias("_n"),
                       plain.alias("_plain"))
    # the order of a group as one number, so that the aggregate keeps its buffer in place:
    # code points above, then 2^63 - 1 - id
    unit, last = F.lit(_UNIT), F.lit(_LAST)
    rank = F.col("_n").cast("decimal(12,0)") * unit + (last - F.coalesce(F.col("doc_id").cast("decimal(20,0)"), last))
    groups = rows.groupBy(F.md5(F.col("_plain").cast("binary")).alias("_md5"), "_plain").agg(
        F.max(rank.cast("decimal(38,0)")).alias("_best"), F.count(F.lit(1)).alias("group_size"))
    keep = F.nullif((last - F.col("_best") % unit).cast("long"), F.lit((1 << 63) - 1))
    groups = groups.select("_md5", F.sha2(F.col("_plain").cast("binary"), 256).alias("_sha"),
                           F.octet_length("_plain").alias("_bytes"), keep.alias("keep_id"), "group_size")
    members = rows.select("doc_id", F.md5(F.col("_plain").cast("binary")).alias("_m"),
                          F.sha2(F.col("_plain").cast("binary"), 256).alias("text_sha256"),
                          F.octet_length("_plain").alias("_b"))
    joined = members.join(groups, (F.col("_m") == F.col("_md5")) & (F.col("text_sha256") == F.col("_sha"))
                          & (F.col("_b") == F.col("_bytes")))
    return joined.select("doc_id", "keep_id", F.col("group_size").cast("long").alias("group_size"),
                         F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")
