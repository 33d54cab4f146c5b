"""Questions about all windows of a corpus, with packed blocks instead of a row per window.

Documents are written once as *blocks* (runs of rows of the scan of about ``BLOCK_BYTES`` bytes of text), into a table
bucketed by block, so that each later pass over texts reads its blocks where they are, without a shuffle of text. A
pass hashes all windows of a block with array operations and sends, per (block, bucket of the hash space), one row with
the sorted hashes, packed. The bucket's group answers each such row with a bitmap in the order sent.
Equal windows of one block are one entry, so a window of a third of all documents costs one entry a block.

Blocks and buckets both grow with the corpus, a row for each pair of them would grow with its square. So a block deals
its hashes over at most ``2 ** FAN_BITS`` ranges; where there are more buckets, as many blocks as there are ranges form
a team, whose entries in one range are merged (equal ones become one) and dealt on over the ranges inside it, until ranges are
buckets. Answers come back by the same way. Rows grow with the blocks, times the number of hops (one to 256 buckets,
some 1 GB; two to 65,536), and no group holds more than about a block's or a bucket's entries.

A block's hashes are recomputed in each pass; answers find their place by the same sort. Blocks and what teams merge are rows
of written tables, hence the same when a task is run again.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructType

from ripple.llm.common import Scratch, text_or_empty

#: Bytes of text of a block; its last text may go beyond. Each row counts as ``ROW_BYTES`` more, which bounds rows too.
BLOCK_BYTES, ROW_BYTES = 12 << 20, 256
#: Entries of a bucket, about.
BUCKET_ENTRIES = 1 << 21
#: A sender deals its entries over at most two to the power of this ranges at a time.
FAN_BITS = 8
SENT = "block long, level int, bucket int, answer binary"


class BlockTable:
    """The documents of one run as blocks, inside a ``with``; the table goes at its end, so write results before."""

    def __init__(self, docs: DataFrame, size: int | None = None):
        self.spark = docs.sparkSession
        self.name = f"blocks_{uuid.uuid4().hex}"
        size = size or BLOCK_BYTES

        def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            # the task above 33 bits, below it the row, or the number of the block, within the task
            first, rows, weight = TaskContext.get().partitionId() << 33, 0, 0
            for b in batches:
                after = weight + np.cumsum(pc.binary_length(b.column("text")).to_numpy(zero_copy_only=False).astype(np.int64) + ROW_BYTES)
                before = np.concatenate(([weight], after[:-1])) if b.num_rows else after
                row = first + rows + np.arange(b.num_rows)
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(row, pa.int64()), pa.array(first + before // size, pa.int64())],
                                                 [*b.schema.names, "row", "block"])
                rows, weight = rows + b.num_rows, int(after[-1]) if b.num_rows else weight

        docs = docs.select(F.col("doc_id"), text_or_empty().alias("text"))
        placed = docs.mapInArrow(place, StructType([*docs.schema.fields]).add("row", LongType()).add("block", LongType()))
        tasks = max(1, int(self.spark.conf.get("spark.sql.shuffle.partitions")))
        placed.write.option("compression", "zstd").bucketBy(tasks, "block").sortBy("block", "row").saveAsTable(self.name)

    def __enter__(self) -> DataFrame:
        return self.spark.table(self.name)

    def __exit__(self, *_) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")


def pack(*arrays: np.ndarray) -> bytes:
    """Integer arrays as bytes: planes of equal significance side by side, compressed."""
    raw = b"".join(np.ascontiguousarray(a).view(np.uint8).reshape(-1, a.itemsize).T.tobytes() for a in arrays)
    return len(raw).to_bytes(8, "little") + pa.compress(raw, "zstd", asbytes=True)


def unpack(packed: bytes, *kinds: str) -> list[np.ndarray]:
    size = int.from_bytes(packed[:8], "little")
    raw = np.frombuffer(pa.decompress(packed[8:], size, "zstd", asbytes=True), np.uint8) if size else np.zeros(0, np.uint8)
    widths = [np.dtype(k).itemsize for k in kinds]
    n, at, out = size // sum(widths), 0, []
    for kind, width in zip(kinds, widths):
        planes = raw[at:at + n * width].reshape(width, n)
        out.append(np.ascontiguousarray(planes.T).view(kind).reshape(n))
        at += n * width
    return out


def cuts(sorted_hashes: np.ndarray, done: int, more: int, prefix: int = 0) -> np.ndarray:
    """First entry of each of the ``2 ** more`` ranges of the next bits among sorted 64-bit hashes that all begin
    with the ``done`` bits ``prefix``, and the number of entries at the end."""
    edges = (np.arange(1, 1 << more, dtype=np.uint64) + np.uint64(prefix << more)) << np.uint64(max(0, 63 - done - more)) << np.uint64(1)
    return np.concatenate(([0], np.searchsorted(sorted_hashes, edges), [len(sorted_hashes)]))


@dataclass(frozen=True)
class Space:
    """How the hash space of one run is dealt."""

    bits: int           # of a bucket's number
    fan: int            # bits dealt at a time
    blocks: int         # about

    @staticmethod
    def of(entries: int, size: int) -> Space:
        """For so many windows in so many bytes of text."""
        return Space(max(0, int(np.ceil(np.log2(max(entries, 1) / BUCKET_ENTRIES))) + 1), FAN_BITS, size // BLOCK_BYTES + 1)

    def cuts(self, sorted_hashes: np.ndarray) -> np.ndarray:
        """First entry of each range that a block sends to, and the number of entries."""
        return cuts(sorted_hashes, 0, min(self.bits, self.fan))

    def coarse(self, hashes: np.ndarray) -> np.ndarray:
        """Hashes without what follows the 32 bits below the bucket's: enough to rule windows out, at any size of corpus."""
        spare = np.uint64(max(0, 32 - self.bits))
        return hashes >> spare << spare


def send(block: int, level: int, at: np.ndarray, *columns: np.ndarray, prefix: int = 0) -> Iterator[tuple]:
    """A row for each range that has entries."""
    for i, (x, y) in enumerate(zip(at, at[1:])):
        if x < y:
            yield block, level, prefix + i, pack(*[c[x:y] for c in columns])


def sent(rows: Iterator[tuple]) -> pa.Table:
    kinds = {"block": pa.int64(), "level": pa.int32(), "bucket": pa.int32(), "answer": pa.binary()}
    columns = list(zip(*rows)) or [()] * len(kinds)
    return pa.table({name: pa.array(c, kind) for (name, kind), c in zip(kinds.items(), columns)})


def bits(flags: np.ndarray) -> bytes:
    return np.packbits(flags).tobytes()


def answers(table: pa.Table, level: int, at: np.ndarray, first: int = 0) -> np.ndarray:
    """The flags of one level in the order of the sorted entries, whose ranges are numbered from ``first`` on."""
    out = np.zeros(at[-1], bool)
    levels, buckets, packed = (table.column(c) for c in ("level", "bucket", "answer"))
    for i in range(table.num_rows):
        if levels[i].as_py() == level:
            b = buckets[i].as_py() - first
            n = at[b + 1] - at[b]
            out[at[b]:at[b + 1]] = np.unpackbits(np.frombuffer(packed[i].as_py(), np.uint8), count=n).astype(bool)
    return out


class Question:
    """What is asked of entries, the first column of which is the hash: here, which of them are there more than once."""

    kinds: tuple[str, ...] = ("uint64",)

    def __init__(self, *levels: int):
        self.levels = levels        # the numbers of the answers

    def answer(self, h: np.ndarray) -> list[np.ndarray]:
        """Flags of the entries of one bucket, for each level."""
        _, member, count = np.unique(h, return_inverse=True, return_counts=True)
        return [count[member] > 1]

    def merge(self, h: np.ndarray) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
        """The entries of a team, sorted and equal ones as one: columns, of each entry which it became, and of each of those
        the entry it stands for."""
        values, chosen, member = np.unique(h, return_index=True, return_inverse=True)
        return [values], member, chosen

    def back(self, told: list[np.ndarray], member: np.ndarray, chosen: np.ndarray) -> list[np.ndarray]:
        """Flags of a team's entries from those of its merged ones."""
        return [(told[0] | (np.bincount(member, minlength=len(chosen)) > 1))[member]]


def _columns(group: pa.Table, kinds: tuple[str, ...]) -> tuple[list[int], list[np.ndarray]]:
    parts = [unpack(p.as_py(), *kinds) for p in group.column("answer")]
    return [len(p[0]) for p in parts], [np.concatenate(c) for c in zip(*parts)]


def _replies(group: pa.Table, question: Question, sizes: list[int], flags: list[np.ndarray]) -> pa.Table:
    return pa.concat_tables([pa.table({
        "block": group.column("block"), "level": pa.array([level] * len(sizes), pa.int32()), "bucket": group.column("bucket"),
        "answer": pa.array([bits(x) for x in np.split(f, np.cumsum(sizes)[:-1])], pa.binary())})
        for level, f in zip(question.levels, flags)])


def _answer(question: Question) -> Callable[[pa.Table], pa.Table]:
    def run(group: pa.Table) -> pa.Table:
        sizes, columns = _columns(group, question.kinds)
        return _replies(group, question, sizes, question.answer(*columns))
    return run


def _merge(question: Question, done: int, more: int) -> Callable[[pa.Table], pa.Table]:
    def run(group: pa.Table) -> pa.Table:
        prefix = group.column("bucket")[0].as_py()
        merged, _, _ = question.merge(*_columns(group, question.kinds)[1])
        return sent(send(group.column("team")[0].as_py(), question.levels[0], cuts(merged[0], done, more, prefix), *merged,
                         prefix=prefix << more))
    return run


def _back(question: Question, done: int, more: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def run(group: pa.Table, told: pa.Table) -> pa.Table:
        prefix = group.column("bucket")[0].as_py()
        sizes, columns = _columns(group, question.kinds)
        merged, member, chosen = question.merge(*columns)
        at = cuts(merged[0], done, more, prefix)
        flags = [answers(told, level, at, prefix << more) for level in question.levels]
        return _replies(group, question, sizes, question.back(flags, member, chosen))
    return run


def ask(rows: DataFrame, question: Question, space: Space, scratch: Scratch, name: str) -> DataFrame:
    """The answers to the rows that blocks have sent, as a written table."""

    def hop(rows: DataFrame, name: str, done: int, senders: int) -> DataFrame:
        more = min(space.fan, space.bits - done)
        if not more:
            return scratch.save(rows.groupBy("bucket").applyInArrow(_answer(question), SENT), name)
        teams = (senders >> space.fan) + 1
        rows = scratch.save(rows, f"{name}-sent").withColumn("team", F.pmod(F.xxhash64("block"), F.lit(teams)).cast("long"))
        by_team = rows.groupBy("team", "bucket")
        told = hop(by_team.applyInArrow(_merge(question, done, more), SENT), f"{name}-{done + more}", done + more, teams)
        by_prefix = told.withColumn("prefix", F.shiftright("bucket", more)).groupBy("block", "prefix")
        found = scratch.save(by_team.cogroup(by_prefix).applyInArrow(_back(question, done, more), SENT), name)
        scratch.drop(f"{name}-sent")
        scratch.drop(f"{name}-{done + more}")
        return found

    return hop(rows, name, min(space.bits, space.fan), space.blocks)
