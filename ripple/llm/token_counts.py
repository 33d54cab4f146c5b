"""Token counts of whole texts, with overlap resynchronisation for huge ones.

A text above ``chunk`` characters is cut into chunks that overlap; chunks are encoded anywhere in
the cluster, with offsets. Two neighbours are spliced at a character position that is a word boundary
of the tokenizer in both, inside their overlap:

- in the left chunk it is the boundary of the whole text, since the chunk was right from the splice
  before, and a boundary at least ``MARGIN`` characters before the chunk's end does not depend on what
  follows (the tokenizer looks ahead by three characters, or by one special string);
- from a boundary on, words depend on what follows only, so the right chunk is right from there on.

Texts with a junction without such a position go round again with chunks and overlaps four times as
wide, at the end as one chunk. Only positions and counts inside overlaps leave the tasks.

Null text: empty, 0 tokens. Equal huge texts are encoded once per row and spliced once. Null or repeated
ids stay as they are. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema

from ripple.llm.bpe import BYTE_BPE, encoder
from ripple.llm.common import Scratch, text_or_empty

LIMIT = 512
CHUNK, OVERLAP, MARGIN = 65_536, 1_024, 32

_LONG = pa.int64()
_ENDS = pa.schema([("key", pa.string()), ("part", _LONG), ("last", pa.bool_()), ("total", _LONG),
                   *[(c, pa.list_(_LONG)) for c in ("left_at", "left_n", "right_at", "right_n")]])


def _count(name: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(name)
        for b in batches:
            counts = pa.array([len(e.ids(t.as_py())) for t in b.column("_text")], pa.int64())
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("n_bytes"), counts],
                                             ["doc_id", "n_bytes", "n_tokens"])
    return run


def _cut(chunk: int, overlap: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for key, text in zip(b.column("key"), b.column("_text")):
                key, text = key.as_py(), text.as_py()
                n = max(1, -(-(len(text) - overlap) // chunk))
                for i in range(n):
                    piece = text[i * chunk:(i + 1) * chunk + overlap if i < n - 1 else len(text)]
                    yield pa.RecordBatch.from_pydict({"key": [key], "part": [i], "last": [i == n - 1], "piece": [piece]})
    return run


def _encode(name: str, chunk: int, overlap: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(name)
        for b in batches:
            for row in b.to_pylist():
                total, at, before = e.boundaries(row["piece"])
                left = at < overlap
                right = (at >= chunk) & (at + MARGIN <= len(row["piece"]))
                start = row["part"] * chunk
                yield pa.RecordBatch.from_pydict({
                    "key": [row["key"]], "part": [row["part"]], "last": [row["last"]], "total": [total],
                    "left_at": [(at[left] + start).tolist()], "left_n": [before[left].tolist()],
                    "right_at": [(at[right] + start).tolist()], "right_n": [before[right].tolist()]}, schema=_ENDS)
    return run


def _huge(texts: DataFrame, scratch: Scratch, name: str, chunk: int, overlap: int) -> DataFrame:
    """``key``, ``n_tokens`` of texts above one chunk."""
    done, attempt = None, 0
    while True:
        ends = texts.mapInArrow(_cut(chunk, overlap), "key string, part long, last boolean, piece string") \
            .repartition("key", "part").mapInArrow(_encode(name, chunk, overlap), from_arrow_schema(_ENDS)).dropDuplicates(["key", "part"])
        by_text = Window.partitionBy("key").orderBy("part")
        spliced = ends.withColumn("next_at", F.lead("left_at").over(by_text)) \
            .withColumn("next_n", F.lead("left_n").over(by_text)) \
            .withColumn("at", F.array_max(F.array_intersect("right_at", "next_at"))) \
            .withColumn("tokens", F.when(F.col("last"), F.col("total")).otherwise(
                F.element_at("right_n", F.array_position("right_at", F.col("at")).cast("int"))
                - F.element_at("next_n", F.array_position("next_at", F.col("at")).cast("int"))))
        counts = scratch.save(spliced.groupBy("key").agg(
            F.sum("tokens").alias("n_tokens"), F.count_if(F.col("tokens").isNull()).alias("open")), f"huge{attempt}")
        good = counts.filter("open = 0").select("key", "n_tokens")
        done = good if done is None else done.unionByName(good)
        still = counts.filter("open > 0").select("key")
        if still.isEmpty():
            return done
        texts = texts.join(still, "key", "left_semi").select("key", "_text")
        chunk, overlap, attempt = chunk * 4, overlap * 4, attempt + 1


def count_tokens(docs: DataFrame, scratch: Scratch, tokenizer: str = BYTE_BPE, limit: int = LIMIT,
                 chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """``doc_id``, ``n_bytes``, ``n_tokens``, ``over_limit`` of every row."""
    if not 0 < overlap <= chunk:
        raise ValueError("an overlap is at most as long as a chunk")
    rows = docs.select("doc_id", text_or_empty().alias("_text"), F.octet_length(text_or_empty()).cast("long").alias("n_bytes"))
    # a sentencepiece model has no words of its own to splice at
    is_huge = F.length("_text") > F.lit(chunk if tokenizer.endswith(".json") else 1 << 31)
    plain = rows.filter(~is_huge).mapInArrow(_count(tokenizer), "doc_id long, n_bytes long, n_tokens long")
    huge = rows.filter(is_huge).withColumn("key", F.sha2("_text", 256))
    spliced = huge.select("doc_id", "n_bytes", "key") \
        .join(_huge(huge.select("key", "_text"), scratch, tokenizer, chunk, overlap), "key")
    return plain.unionByName(spliced.select("doc_id", "n_bytes", "n_tokens")) \
        .withColumn("over_limit", F.col("n_tokens") > limit)
