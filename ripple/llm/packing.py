"""Packing of tokenised documents into sequences, as a cutting-stock problem solved by column generation.

A document's ids (with the end id) are cut into whole sequences and a remainder shorter than a
sequence. Remainders are counted by length in units of ``UNIT`` ids, rounded up: a histogram of at most
``capacity / UNIT`` numbers at any corpus size, which the driver plans:

1. A linear program chooses how often each *pattern* (a multiset of lengths that fits a sequence) is
   used. Its columns are generated: the dual prices of the lengths go into an unbounded knapsack
   (dynamic programming over the capacity), whose best pattern enters the basis, until no pattern
   improves the program by more than ``GAP`` (Farley's bound).
2. Counts are rounded down; what is left over (fewer items than the patterns hold together, at
   any corpus size) is packed largest first into the fullest sequence it fits.
3. Remainders are ranked within their length by a distributed prefix sum, and rank ranges are
   assigned to the patterns' slots. Offsets are sums of true lengths within a sequence, so the
   rounding leaves its gap at the end only (about 1 % of all places).

The plan depends on the histogram, not on the number of documents; documents are joined with at most
``capacity / UNIT`` lengths times their patterns. A hot length is spread by the range sort over many partitions.

Null text: no ids, the end id alone. Repeated ids are packed like others. Empty table: empty result.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ripple.llm.bpe import BYTE_BPE, encoder
from ripple.llm.common import Scratch, ranked, text_or_empty

CAPACITY = 1024
END = 0
UNIT = 8
GAP = 0.0005
Pattern = tuple[tuple[int, int], ...]       # (length, times) from the longest


def knapsack(price: np.ndarray, lengths: np.ndarray, capacity: int) -> tuple[float, Counter]:
    """The most valuable multiset of lengths that fits, by dynamic programming over the capacity."""
    best, last = np.zeros(capacity + 1), np.zeros(capacity + 1, np.int64)
    upto = np.searchsorted(lengths, np.arange(capacity + 1), "right")
    for c in range(1, capacity + 1):
        best[c] = best[c - 1]
        last[c] = -1
        if k := upto[c]:
            value = price[:k] + best[c - lengths[:k]]
            i = int(value.argmax())
            if value[i] > best[c] + 1e-12:
                best[c], last[c] = value[i], i
    found, c = Counter(), capacity
    while c > 0:
        if last[c] < 0:
            c -= 1
        else:
            found[int(last[c])] += 1
            c -= int(lengths[last[c]])
    return float(best[capacity]), found


def solve(histogram: dict[int, int], capacity: int, gap: float = GAP) -> dict[Pattern, float]:
    """How often to use which pattern: the linear program over generated columns."""
    lengths = np.array(sorted(histogram), np.int64)
    need = np.array([histogram[int(x)] for x in lengths], float)
    m = len(lengths)
    if not m:
        return {}
    columns = np.diag((capacity // lengths).astype(float))      # column j: one length alone
    inverse = np.diag(1 / (capacity // lengths).astype(float))
    level = inverse @ need
    for _ in range(50 * m):
        price = np.maximum(inverse.sum(axis=0), 0)
        value, found = knapsack(price, lengths, capacity)
        # no plan is below the sum of prices over the best pattern's value
        if value <= 1 + 1e-9 or level.sum() * (1 - gap) <= (price @ need) / value:
            break
        entering = np.zeros(m)
        for i, times in found.items():
            entering[i] = min(times, capacity // lengths[i])
        step = inverse @ entering
        ratio = np.where(step > 1e-9, level / np.where(step > 1e-9, step, 1), np.inf)
        out = int(ratio.argmin())
        if not np.isfinite(ratio[out]):
            break
        columns[:, out] = entering
        pivot = inverse[out] / step[out]
        inverse -= np.outer(step, pivot)
        inverse[out] = pivot
        level = np.maximum(level - ratio[out] * step, 0)
        level[out] = ratio[out]
    plan: dict[Pattern, float] = {}
    for j in range(m):
        pattern = tuple((int(lengths[i]), int(columns[i, j])) for i in reversed(range(m)) if columns[i, j] > 0.5)
        plan[pattern] = plan.get(pattern, 0.0) + float(level[j])
    return plan


def rounded(plan: dict[Pattern, float], histogram: dict[int, int], capacity: int) -> list[tuple[Pattern, int]]:
    """Whole counts of patterns that hold each length exactly as often as the histogram says."""
    left, out = dict(histogram), []
    for pattern, times in sorted(plan.items(), key=lambda x: -x[1]):
        whole = min([int(times + 1e-6), *(left[length] // n for length, n in pattern)])
        if whole > 0:
            out.append((pattern, whole))
            for length, n in pattern:
                left[length] -= n * whole
    room: list[list[Counter]] = [[] for _ in range(capacity + 1)]       # open sequences by free room
    for length in sorted(left, reverse=True):
        for _ in range(left[length]):
            free = next((r for r in range(length, capacity + 1) if room[r]), None)
            held = Counter() if free is None else room[free].pop()
            held[length] += 1
            room[(capacity if free is None else free) - length].append(held)
    rest = Counter(tuple(sorted(held.items(), reverse=True)) for r in room for held in r)
    return out + sorted(rest.items())


def slots(patterns: list[tuple[Pattern, int]]) -> list[tuple[int, int, int, int, int, int]]:
    """(length, first rank, rank after the last, first sequence, times, place): the ranks of a length
    that go to one pattern."""
    used, out, sequence = Counter(), [], 0
    for pattern, count in patterns:
        for place, (length, times) in enumerate(pattern):
            out.append((length, used[length], used[length] + times * count, sequence, times, place))
            used[length] += times * count
        sequence += count
    return out


def _tokenise(name: str, capacity: int, end: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(name)
        for b in batches:
            counts, sums = [], []
            for text in b.column("_text"):
                ids = np.append(e.ids(text.as_py()), end).astype("<u4")
                counts.append(len(ids))
                sums.append([zlib.crc32(ids[i:i + capacity].tobytes()) for i in range(0, len(ids), capacity)])
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(counts, pa.int64()),
                                              pa.array(sums, pa.list_(pa.int64()))], ["doc_id", "doc_tokens", "sums"])
    return run


def pack(docs: DataFrame, scratch: Scratch, tokenizer: str = BYTE_BPE, capacity: int = CAPACITY,
         end: int = END, unit: int = UNIT) -> DataFrame:
    """One row per piece: ``doc_id``, ``start``, ``length``, ``ids_crc32``, ``doc_tokens``, ``sequence_id``, ``offset``."""
    spark = scratch.spark
    rows = docs.select("doc_id", text_or_empty().alias("_text")) \
        .mapInArrow(_tokenise(tokenizer, capacity, end), "doc_id long, doc_tokens long, sums array<long>") \
        .withColumn("rest", (F.col("doc_tokens") % capacity).cast("int")) \
        .withColumn("units", F.ceil(F.col("rest") / unit).cast("int")) \
        .withColumn("whole", F.floor(F.col("doc_tokens") / capacity)).withColumn("_one", F.lit(1))
    placed = ranked(rows, scratch, ["units"], ["doc_id", "doc_tokens"], {"rank": "_one", "whole_before": "whole"})
    # at most capacity / unit + 1 rows
    totals = spark.read.schema(rows.schema).parquet(scratch.path("ranked")).groupBy("units") \
        .agg(F.count(F.lit(1)), F.sum("whole")).collect()
    histogram = {units: n for units, n, _ in totals if units}
    patterns = rounded(solve(histogram, capacity // unit), histogram, capacity // unit)
    at, bases = sum(n for _, n in patterns), []
    for units, _, whole in sorted(totals):
        bases.append((units, at))
        at += whole
    base = F.broadcast(spark.createDataFrame(bases, "units int, base long"))
    slot = F.broadcast(spark.createDataFrame(slots(patterns), "s_units int, s_from long, s_to long, s_sequence long, "
                                                              "s_times long, s_place long"))
    here = (F.col("units") == F.col("s_units")) & (F.col("rank") >= F.col("s_from")) & (F.col("rank") < F.col("s_to"))
    nth = F.col("rank") - F.col("s_from")
    placed = placed.join(base, "units")
    # the remainders of one sequence, at most capacity / unit of them
    in_order = Window.partitionBy("sequence_id").orderBy("s_place", "nth").rowsBetween(Window.unboundedPreceding, -1)
    ends = placed.filter("rest > 0").join(slot, here).select(
        "doc_id", (F.col("whole") * capacity).alias("start"), F.col("rest").cast("long").alias("length"),
        F.element_at("sums", -1).alias("ids_crc32"), "doc_tokens",
        (F.col("s_sequence") + F.floor(nth / F.col("s_times"))).cast("long").alias("sequence_id"),
        "s_place", (nth % F.col("s_times")).alias("nth")) \
        .withColumn("offset", F.coalesce(F.sum("length").over(in_order), F.lit(0)).cast("long")).drop("s_place", "nth")
    full = placed.filter("whole > 0") \
        .select("*", F.posexplode(F.slice("sums", F.lit(1), F.col("whole").cast("int"))).alias("i", "ids_crc32")).select(
        "doc_id", (F.col("i") * capacity).cast("long").alias("start"), F.lit(capacity).cast("long").alias("length"),
        "ids_crc32", "doc_tokens", (F.col("base") + F.col("whole_before") + F.col("i")).alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"))
    return ends.unionByName(full)
