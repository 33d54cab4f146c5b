"""Mixing of sources to target weights.

Every document gets a hash-random key; rows are range-sorted by key within their source, prefix sums
of sizes are computed over partitions, and each source is cut at its exact budget. A budget above the
source's size repeats it in whole epochs first.

A document's size is its number of words (runs without white space; null text: 0). Sources are taken
by code point, a null source last, with weights that repeat over them. They share the given part of
all sizes; no source takes more than ``max_epochs`` times its size, what is left over is shared again
by weight among the others until none is above. The document at the cut is taken in part, so that
the words taken from a source add up to its target rounded to a whole number.

Documents with one key (repeated ids) are told apart by their size; equal rows are interchangeable.
A null id is a key of its own. Empty texts and sources without words take nothing. The key depends
on id and seed alone, so reruns agree. The shares are found by a loop over one-row aggregates of the
per-source table; rows are moved once, by the range sort.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ripple.llm.common import Scratch, ranked, text_or_empty

WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3
SEED = "mix-1"


def n_words(text: Column) -> Column:
    """Number of maximal runs without white space."""
    return F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def targets(sizes: DataFrame, scratch: Scratch, weights=WEIGHTS, share: float = 1.0,
            max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """``source``, ``source_size``, ``target`` from ``source``, ``source_size``.

    Any number of sources: their places by code point come from a distributed prefix sum, and each
    round of sharing is one aggregate over them.
    """
    placed = ranked(sizes.withColumn("_one", F.lit(1)).withColumn("_all", F.lit(0)), scratch,
                    ["_all"], ["source"], {"before": "_one"}, "sources").drop("_one", "_all")
    weight = F.element_at(F.array(*[F.lit(int(w)) for w in weights]),
                          (F.col("before") % len(weights) + 1).cast("int")).cast("long")
    rows = scratch.save(placed.select("source", "source_size", weight.alias("w"),
                                      (F.col("source_size") * max_epochs).alias("cap")), "weights")
    total, weight_of_all = rows.agg(F.coalesce(F.sum("source_size"), F.lit(0)), F.coalesce(F.sum("w"), F.lit(0))).first()
    budget = int(total * share)
    left, over = budget, weight_of_all      # what the sources below their limit share, and their weight
    while True:
        # a source is at its limit when its part, left * w / over, would be above
        wide = [F.lit(n).cast("decimal(19,0)") for n in (over, left)]
        full = F.col("cap").cast("decimal(19,0)") * wide[0] < wide[1] * F.col("w").cast("decimal(19,0)")
        taken, used = rows.filter(full).agg(F.coalesce(F.sum("cap"), F.lit(0)), F.coalesce(F.sum("w"), F.lit(0))).first()
        new_left, new_over = budget - taken, weight_of_all - used
        if (new_left, new_over) == (left, over) or new_over <= 0:
            break
        left, over = new_left, new_over
    part = (F.col("w") * F.lit(left)).cast("double") / F.lit(float(max(over, 1)))
    return rows.select("source", "source_size", F.least(F.col("cap").cast("double"), part).alias("target"))


def mix(docs: DataFrame, scratch: Scratch, weights=WEIGHTS, share: float = 1.0,
        max_epochs: int = MAX_EPOCHS, seed: str = SEED, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per document: ``doc_id``, ``size``, ``source_size``, ``target``, ``taken``.

    ``keep`` names further columns of ``docs`` to carry along through the sort.
    """
    key = F.md5(F.concat(F.lit(seed + ":"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))))
    carried = [c for c in keep if c not in ("doc_id", "source")]
    sized = docs.select("doc_id", "source", n_words(text_or_empty()).alias("size"), key.alias("_key"), *carried)
    rows = ranked(sized, scratch, ["source"], ["_key", "size"], {"before": "size"})
    per_source = scratch.spark.read.schema(sized.schema).parquet(scratch.path("ranked")).groupBy("source") \
        .agg(F.sum("size").alias("source_size"))
    cut = targets(per_source, scratch, weights, share, max_epochs).withColumnRenamed("source", "_source")
    whole = F.round("target").cast("long")
    epochs = F.when(F.col("source_size") > 0, F.floor(whole / F.col("source_size"))).otherwise(0)
    rest = whole - F.col("epochs") * F.col("source_size")
    extra = F.greatest(F.lit(0), F.least(F.col("size"), rest - F.col("before")))
    return rows.join(cut, F.col("source").eqNullSafe(F.col("_source"))).withColumn("epochs", epochs.cast("long")) \
        .select("doc_id", "size", "source_size", "target",
                (F.col("epochs") * F.col("size") + extra).cast("long").alias("taken"), *keep)


def first_words(text: Column, n: Column) -> Column:
    """The first ``n`` words, joined by one blank."""
    return F.array_join(F.slice(F.regexp_extract_all(text, F.lit(r"([^\x20\x09-\x0D]+)"), F.lit(1)), F.lit(1), n.cast("int")), " ")


def mixed(docs: DataFrame, scratch: Scratch, **options) -> DataFrame:
    """The mix itself: each document as often as it is taken, the last time up to the words taken."""
    # every column under a name of its own, so that none can clash with those of the plan
    keyed = docs.select("doc_id", "source", "text", F.md5(text_or_empty().cast("binary")).alias("_md5"),
                        *[F.col(c).alias(f"_row_{c}") for c in docs.columns if c not in ("text", "n_chars")])
    plan = mix(keyed, scratch, keep=("_md5",), **options).filter("taken > 0") \
        .groupBy(F.col("doc_id").alias("_id"), F.col("_md5").alias("_m")) \
        .agg(F.first("size").alias("size"), F.sort_array(F.collect_list("taken")).alias("takes"))
    # rows that repeat whole have several takes; each row stands for one of them
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_md5") == F.col("_m"))
    rest = F.col("taken") % F.col("size")
    each = keyed.dropDuplicates(["doc_id", "_md5"]).join(plan, same).withColumn("taken", F.explode("takes")) \
        .withColumn("words", F.explode(F.concat(
            F.array_repeat(F.col("size"), F.floor(F.col("taken") / F.col("size")).cast("int")),
            F.when(rest > 0, F.array(rest)).otherwise(F.array().cast("array<long>")))))
    text = F.when(F.col("words") == F.col("size"), F.col("text")).otherwise(first_words(F.col("text"), F.col("words")))
    fields = {"text": text, "n_chars": F.length(text).cast("long")}
    return each.select(*[(fields[c] if c in fields else F.col(f"_row_{c}")).alias(c) for c in docs.columns])
