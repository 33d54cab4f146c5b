"""Splitting of hot join keys.

A node with more than ``chunk`` edges has its edges dealt over several chunks
by a hash of the other end, and the one row of the node on the other side of
the join is copied once per chunk. Results are the same; no task has to take
all edges of the node.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Edges of one node that may meet in one task.
CHUNK_ROWS = 1_000_000

# Chunks grow with the graph so that fewer than this many nodes can exceed
# one: the list of hot nodes has a fixed upper size and may be broadcast.
MAX_HOT_NODES = 50_000


@dataclass(frozen=True)
class Chunking:
    """How the edges of one graph are dealt over chunks."""

    chunk: int          # edges per chunk
    n_edges: int
    by_source: bool     # some node has more outgoing edges than fit one chunk
    by_target: bool     # the same for incoming edges

    @classmethod
    def of(cls, degrees: DataFrame, chunk_rows: int = CHUNK_ROWS) -> Chunking:
        """From a table with ``out_degree`` and ``in_degree``; one small aggregate."""
        total, most_out, most_in = degrees.agg(
            F.sum("out_degree"), F.max("out_degree"), F.max("in_degree")).first()
        total = total or 0
        # 2 * total ends, each hot node uses up more than a chunk of them
        chunk = max(chunk_rows, 2 * total // MAX_HOT_NODES)
        return cls(chunk, total, (most_out or 0) > chunk, (most_in or 0) > chunk)

    def fan(self, degree: str) -> Column:
        """Number of chunks of a node."""
        return F.greatest(F.lit(1), F.ceil(F.col(degree) / self.chunk)).cast("int")


def chunk_of(other_end: str, fan: Column) -> Column:
    """Chunk an edge belongs to."""
    return F.pmod(F.xxhash64(other_end), fan.cast("bigint")).cast("int")


def spread(rows: DataFrame, fan: str, chunk: str, needed: bool) -> DataFrame:
    """One copy of each row per chunk of its node."""
    if not needed:
        return rows
    return rows.withColumn(chunk, F.explode(F.sequence(F.lit(0), F.col(fan) - 1)))


def keys(key: str, chunk: str, needed: bool) -> list[str]:
    return [key, chunk] if needed else [key]


def split_join(many: DataFrame, one: DataFrame, on: list[str], counts: DataFrame, spread_by: str, how: str = "inner",
               chunk_rows: int | None = None) -> DataFrame:
    """``many`` joined with ``one`` (a row per key, often an aggregate), with the rows of hot keys dealt over chunks.

    Adaptive execution does not split such a join where one side is an aggregate on the join key. ``counts``
    has the rows of ``many`` per key as ``n``. Keys with more than a chunk of rows form a list of fewer than
    ``MAX_HOT_NODES`` rows, which is broadcast to both sides; ``spread_by`` is what the rows of a key differ in.
    """
    chunk_rows = chunk_rows or CHUNK_ROWS
    total, most = counts.agg(F.sum("n"), F.max("n")).first()
    chunk = max(chunk_rows, (total or 0) // MAX_HOT_NODES)
    if (most or 0) <= chunk:
        return many.join(one, on, how)
    fans = F.broadcast(counts.filter(F.col("n") > chunk).select(*on, F.ceil(F.col("n") / chunk).cast("int").alias("_fan")))
    fan = F.coalesce("_fan", F.lit(1))
    dealt = many.join(fans, on, "left").withColumn("_chunk", chunk_of(spread_by, fan)).drop("_fan")
    copied = one.join(fans, on, "left").withColumn("_chunk", F.explode(F.sequence(F.lit(0), fan - 1))).drop("_fan")
    return dealt.join(copied, [*on, "_chunk"], how).drop("_chunk")
