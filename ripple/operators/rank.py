"""PageRank variant with edges back from the sinks.

Edges are packed once by the part of their target, with numbers for vertices. A round reads them where they lie and shuffles
nothing: what each vertex passes on, one number per vertex, is broadcast, and what each receives comes back. A graph of more than
``LOCAL_NODES`` vertices is ranked by joins instead.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

from ripple.operators.edges import degree_table
from ripple.functions import scalars
from ripple.operators.hot import CHUNK_ROWS, Chunking, chunk_of, keys, spread
from ripple.session import Scratch

BASE, DAMPING = 0.15, 0.85

# Vertices whose numbers may be broadcast, vertices of a part, and edges of a packed row.
LOCAL_NODES, PART_NODES, PACKED_EDGES = 1 << 23, 1 << 15, 1 << 17


def social_rank(edges: DataFrame, rounds: int = 25, dmax: float = 30.0,
                chunk_rows: int = CHUNK_ROWS, local_nodes: int = LOCAL_NODES, part_nodes: int = PART_NODES) -> DataFrame:
    """Rank of each vertex, (v, r); ``edges`` has ``src, dst``.

    Starts at 1.0 for vertices with outgoing edges. A vertex that receives
    nothing has no rank after the first round and sends nothing later. The loop
    stops after the round in which no vertex ranked before and after moved by
    ``dmax`` or more.
    """
    run = Scratch(edges.sparkSession, "rank")
    edges = run.save(edges.select("src", "dst"), "edges")
    degrees = run.save(degree_table(edges), "degrees")
    n = degrees.count()     # from the files' footers
    if rounds and n <= local_nodes:
        return _ranked(run, edges, degrees, -(-n // part_nodes) or 1, rounds, dmax, min(chunk_rows, PACKED_EDGES))
    split = Chunking.of(degrees, chunk_rows)
    fans = degrees.select("v", "out_degree", split.fan("out_degree").alias("out_fan"),
                          split.fan("in_degree").alias("in_fan"))
    if split.by_source or split.by_target:
        hot = fans.filter("out_fan > 1 or in_fan > 1")      # below hot.MAX_HOT_NODES rows
        edges = edges \
            .join(F.broadcast(hot.select(F.col("v").alias("src"), F.col("out_fan").alias("so"))), "src", "left") \
            .join(F.broadcast(hot.select(F.col("v").alias("dst"), F.col("in_fan").alias("di"))), "dst", "left") \
            .withColumn("out_chunk", chunk_of("dst", F.coalesce("so", F.lit(1)))) \
            .withColumn("in_chunk", chunk_of("src", F.coalesce("di", F.lit(1))))
    else:
        edges = edges.withColumn("out_chunk", F.lit(0)).withColumn("in_chunk", F.lit(0))

    # each edge carries what it passes on and the chunks of its target, once for all rounds
    sending = fans.filter("out_degree > 0")
    source = spread(sending.select(F.col("v").alias("src"), "out_fan", (1.0 / F.col("out_degree")).alias("pass_on")),
                    "out_fan", "out_chunk", split.by_source)
    target = spread(fans.select(F.col("v").alias("dst"), F.col("out_fan").alias("dst_fan"), "in_fan"),
                    "in_fan", "in_chunk", split.by_target)
    graph = run.save(
        edges.join(source.drop("out_fan"), keys("src", "out_chunk", split.by_source))
             .join(target, keys("dst", "in_chunk", split.by_target))
             .select("src", "out_chunk", "dst", "dst_fan", "pass_on"), "graph")
    ranks = run.save(sending.select(
        "v", F.lit(1.0).alias("r"), F.col("out_fan").alias("fan"), F.lit(0.0).alias("moved")), "ranks-0")

    run.drop("edges")
    run.drop("degrees")

    for i in range(rounds):
        seen = Observation()
        following = run.save(_round(ranks, graph, split).observe(seen, F.max("moved").alias("moved")),
                             f"ranks-{i + 1}")
        run.drop(f"ranks-{i}")
        ranks = following
        moved = seen.get["moved"]
        if moved is None or moved < dmax:
            break
    run.drop("graph")
    return ranks.select("v", "r")


def _ranked(run: Scratch, edges: DataFrame, degrees: DataFrame, parts: int, rounds: int, dmax: float, chunk_rows: int) -> DataFrame:
    """:func:`social_rank` of a graph whose vertices' numbers can be broadcast."""
    place = F.row_number().over(Window.partitionBy("part").orderBy("v")) - 1
    # a vertex that is null is met by no edge, but the edges to it count in the degrees
    nodes = run.save(degrees.filter("v is not null").withColumn("part", F.pmod(F.xxhash64("v"), F.lit(parts)).cast("int"))
                     .select("v", "part", place.alias("row"), "out_degree"), "nodes")
    number = F.col("row") * parts + F.col("part")
    ends = edges.join(nodes.select(F.col("v").alias("src"), number.alias("s")), "src") \
        .join(nodes.select(F.col("v").alias("dst"), "part", "row"), "dst").select("part", "s", "row")
    n_edges = edges.count()
    chunks = max(1, n_edges // (parts * PACKED_EDGES * 8))      # a part with many edges is dealt over tasks
    graph = run.save(ends.withColumn("chunk", F.pmod("s", F.lit(chunks))).repartition("part", "chunk").sortWithinPartitions("part")
                     .select("part", "s", "row").mapInArrow(_pack(chunk_rows), "part int, src binary, dst binary"), "graph")
    run.drop("edges")
    run.drop("degrees")

    listed = nodes.select(number.cast("int").alias("id"), "out_degree").toArrow()
    ids, fans = listed.column("id").to_numpy(), listed.column("out_degree").to_numpy()
    size = int(ids.max(initial=-1)) + 1
    fan = np.zeros(size, np.int32 if fans.max(initial=0) < 1 << 31 else np.int64)
    fan[ids] = fans
    ranks = np.where(fan > 0, 1.0, np.nan)      # no number: no rank
    for _ in range(rounds):
        passed = np.where(np.isnan(ranks) | (fan == 0), 0.0, ranks) / np.maximum(fan, 1)
        shared = run.spark.sparkContext.broadcast(passed)
        got = np.zeros(size)
        for r in graph.mapInArrow(_receive(shared), "part int, got binary").toLocalIterator(prefetchPartitions=True):
            came = np.frombuffer(r.got, np.float64)
            got[r.part:r.part + len(came) * parts:parts] += came
        shared.destroy()
        before, ranks = ranks, np.where(got > 0, BASE + DAMPING * got, np.nan)
        moved = np.abs(ranks - before)
        moved = moved[~np.isnan(moved)]
        if not len(moved) or moved.max() < dmax:
            break
    run.drop("graph")
    shared = run.spark.sparkContext.broadcast(ranks)

    def named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            r = shared.value[b.column("id").to_numpy()]
            some = ~np.isnan(r)
            yield pa.RecordBatch.from_arrays([b.column("v").filter(pa.array(some)), pa.array(r[some])], names=["v", "r"])
    return nodes.select("v", number.cast("int").alias("id")).mapInArrow(named, f"v {nodes.schema['v'].dataType.simpleString()}, r double")


def _pack(most: int):
    """Edges in the order of the part of their target, as rows of at most ``most``."""
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def packed() -> Iterator[pa.RecordBatch]:
            part, src, dst = (pa.concat_arrays([b.column(c) for b in held]).to_numpy() for c in ("part", "s", "row"))
            cuts = np.concatenate(([0], np.flatnonzero(part[1:] != part[:-1]) + 1, [len(part)])).tolist()
            for lo, hi in zip(cuts, cuts[1:]):
                for at in range(lo, hi, most):
                    end = min(hi, at + most)
                    yield pa.RecordBatch.from_arrays([pa.array([part[at]], pa.int32()), pa.array([src[at:end].astype(np.int32).tobytes()], pa.binary()),
                                                      pa.array([dst[at:end].astype(np.int32).tobytes()], pa.binary())], names=["part", "src", "dst"])
        for b in batches:
            if b.num_rows:
                held.append(b)
            if sum(b.num_rows for b in held) >= PACKED_EDGES:
                yield from packed()
                held = []
        if held:
            yield from packed()
    return pack


def _receive(shared):
    """What the vertices of each part receive along the edges of one task."""
    def receive(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        passed, sums = shared.value, {}
        for b in batches:
            for part, src, dst in zip(*(b.column(c) for c in ("part", "src", "dst"))):
                came = np.bincount(np.frombuffer(dst.as_buffer(), np.int32), passed[np.frombuffer(src.as_buffer(), np.int32)])
                held = sums.get(part.as_py(), np.zeros(0))
                if len(held) < len(came):
                    held, came = came, held
                held[:len(came)] += came
                sums[part.as_py()] = held
        for part, held in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([held.tobytes()], pa.binary())], names=["part", "got"])
    return receive


def _round(ranks: DataFrame, graph: DataFrame, split: Chunking) -> DataFrame:
    none = F.lit(None).cast("double")
    sent = graph.join(spread(ranks.withColumnRenamed("v", "src"), "fan", "out_chunk", split.by_source),
                      keys("src", "out_chunk", split.by_source)) \
        .select(F.col("dst").alias("v"), (F.col("pass_on") * F.col("r")).alias("got"),
                none.alias("before"), F.col("dst_fan").alias("fan"))
    kept = ranks.select("v", none.alias("got"), F.col("r").alias("before"), "fan")
    return sent.unionByName(kept).groupBy("v").agg(
        F.sum("got").alias("got"), F.max("before").alias("before"), F.max("fan").alias("fan")) \
        .filter("got is not null") \
        .withColumn("r", BASE + DAMPING * F.col("got")) \
        .select("v", "r", "fan", F.abs(F.col("r") - F.col("before")).alias("moved"))


def top_ranks(ranks: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` highest ranks; ties go by vertex. Runs as a per-partition top-k."""
    return ranks.orderBy(scalars.by_weight(F.col("r")).desc(), "v").limit(k)
