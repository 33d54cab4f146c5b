"""Repeated passages by level-wise doubling of word windows.

Words are runs without white space, unchanged. A window of ``length`` consecutive words of a document is a repeat
if its words also start earlier: in a document with a smaller id, or in the same one at an earlier place.
Words covered by a repeat are removed; windows are judged on the input.

Levels: windows of a short length are hashed everywhere; those found only once are out. Windows of twice the
length are candidates only where both halves are still in, and so on up to ``length`` (longer repeats are chains of
windows of that length) or until none survive. The last level compares 128-bit hashes and finds the first occurrence
of each; the levels below only rule windows out, by 32 bits beside those of the bucket. See ``blocks`` for how
hashes travel: no row per window, hot windows once per block.

Null text: no words. Fewer words than a window: nothing removed. Documents with one id are taken in the order of
the scan. A null id comes last. Empty table: empty result.
"""

from __future__ import annotations

import hashlib
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ripple.llm import blocks
from ripple.llm.common import Scratch
from ripple.llm.hashing import U, mix, slices, windows, words

LENGTH = 20
SHORTEST = 8
_LAST = np.iinfo(np.int64).max
LAST = 99        # the number of the last level


def lower_levels(length: int) -> list[int]:
    """Lengths before ``length``, each half of the next; the first has at least ``SHORTEST`` words."""
    out = []
    while length % 2 == 0 and length // 2 >= SHORTEST:
        length //= 2
        out.append(length)
    return out[::-1]


class Block:
    """All windows of one block's documents."""

    def __init__(self, rows: pa.Table):
        self.rows = rows.sort_by("row")
        text = self.rows.column("text").combine_chunks()
        text = text.chunk(0) if isinstance(text, pa.ChunkedArray) else text
        hashes, owner, self.first = [], [], [0]
        for _, data, offsets in slices(text):
            w = words(data, offsets)
            hashes.append(w.hashes)
            owner.append(w.row + len(self.first) - 1)
            self.first += (self.first[-1] + w.first[1:]).tolist()
        self.text = text
        self.hashes = np.concatenate(hashes) if hashes else np.zeros(0, U)
        self.owner = np.concatenate(owner) if owner else np.zeros(0, np.int64)
        self.first = np.array(self.first)
        self.n = len(self.hashes)

    def starts(self, length: int) -> np.ndarray:
        """Whether a window of this many words of one document starts at each word."""
        out = np.zeros(self.n, bool)
        if self.n >= length:
            out[:self.n - length + 1] = self.owner[:self.n - length + 1] == self.owner[length - 1:]
        return out

    def level(self, length: int) -> np.ndarray:
        out = np.zeros(self.n, U)
        found = windows(self.hashes, length)
        out[:len(found)] = found
        return out


class Level:
    """The windows of some places of a block: sorted by hash, equal ones together."""

    def __init__(self, hashes: np.ndarray, at: np.ndarray, second: np.ndarray | None = None):
        order = np.argsort(hashes[at], kind="stable")
        self.at = at[order]
        h = hashes[self.at]
        self.new = np.concatenate(([True], h[1:] != h[:-1])) if len(h) else np.zeros(0, bool)
        if second is not None:
            self.new[1:] |= second[self.at[1:]] != second[self.at[:-1]]
        self.distinct = h[self.new]
        self.group = np.cumsum(self.new) - 1
        self.count = np.bincount(self.group, minlength=len(self.distinct)) if len(h) else np.zeros(0, np.int64)


def _candidates(block: Block, length: int, alive: np.ndarray | None) -> np.ndarray:
    """Places of windows whose halves are both alive."""
    valid = block.starts(length)
    half = length // 2
    if alive is not None and block.n >= length:
        valid &= alive
        valid[:block.n - half] &= alive[half:]
    return np.flatnonzero(valid)


def _alive(block: Block, lengths: list[int], replies: pa.Table, space: blocks.Space) -> np.ndarray | None:
    """Whether the window of the last of these levels is repeated, at each place; None before the first level."""
    alive = None
    for number, length in enumerate(lengths):
        level = Level(block.level(length), _candidates(block, length, alive))
        seen = blocks.answers(replies, number, space.cuts(level.distinct)) | (level.count > 1)
        alive = np.zeros(block.n, bool)
        alive[level.at] = seen[level.group]
    return alive


def _final(block: Block, length: int, alive: np.ndarray | None) -> tuple[Level, np.ndarray]:
    """Candidate windows of the full length, and a second hash of each place."""
    second = np.zeros(block.n, U)
    found = windows(mix(block.hashes ^ U(0x3C79AC492BA7B653)), length)
    second[:len(found)] = found
    return Level(block.level(length), _candidates(block, length, alive), second), second


def _ids(rows: pa.Table) -> np.ndarray:
    return np.array([_LAST if x is None else x for x in rows.column("doc_id").to_pylist()], np.int64)


def _first_of_groups(level: Level, block: Block, ids: np.ndarray) -> np.ndarray:
    """Position in ``level.at`` of the earliest window of each distinct hash."""
    order = np.lexsort((level.at, ids[block.owner[level.at]], level.group))
    return order[np.flatnonzero(level.new)] if len(order) else order


class Later(blocks.Question):
    """Which entry of two hashes is not the first by id and block."""

    kinds = ("uint64", "uint64", "int64", "int64")

    def answer(self, *columns: np.ndarray) -> list[np.ndarray]:
        later = np.ones(len(columns[0]), bool)
        later[self.merge(*columns)[2]] = False
        return [later]

    def merge(self, h, g, ids, block):
        order = np.lexsort((block, ids, g, h))
        new = np.ones(len(h), bool)
        new[1:] = (h[order][1:] != h[order][:-1]) | (g[order][1:] != g[order][:-1])
        member = np.empty(len(h), np.int64)
        member[order] = np.cumsum(new) - 1
        chosen = order[new]
        return [x[chosen] for x in (h, g, ids, block)], member, chosen

    def back(self, told, member, chosen):
        later = np.ones(len(member), bool)
        later[chosen] = told[0]
        return [later]


def covered(n: int, starts: np.ndarray, length: int) -> np.ndarray:
    """Which of ``n`` places a run of ``length`` from one of the starts covers."""
    step = np.zeros(n + 1, np.int64)
    np.add.at(step, starts, 1)
    np.add.at(step, np.minimum(starts + length, n), -1)
    return np.cumsum(step[:-1]) > 0


def _removed(placed: DataFrame, scratch: Scratch, length: int) -> DataFrame:
    lengths = lower_levels(length)
    size = placed.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    space = blocks.Space.of(size // 6, size)        # a word and its white space take some six bytes

    def coarse_pass(number: int):
        def run(rows: pa.Table, replies: pa.Table) -> pa.Table:
            block = Block(rows)
            alive = _alive(block, lengths[:number], replies, space)
            level = Level(block.level(lengths[number]), _candidates(block, lengths[number], alive))
            hashes = space.coarse(level.distinct)
            return blocks.sent(blocks.send(rows.column("block")[0].as_py(), number, space.cuts(hashes), hashes))
        return run

    def last_pass(rows: pa.Table, replies: pa.Table) -> pa.Table:
        block = Block(rows)
        level, second = _final(block, length, _alive(block, lengths, replies, space))
        ids = _ids(block.rows)
        earliest = level.at[_first_of_groups(level, block, ids)]
        number = rows.column("block")[0].as_py()
        return blocks.sent(blocks.send(number, LAST, space.cuts(level.distinct), level.distinct, second[earliest],
                                       ids[block.owner[earliest]], np.full(len(earliest), number)))

    def result(rows: pa.Table, replies: pa.Table) -> pa.Table:
        block = Block(rows)
        level, _ = _final(block, length, _alive(block, lengths, replies, space))
        repeat = np.ones(len(level.at), bool)       # all but the first of a block, and that too if another block has it before
        repeat[_first_of_groups(level, block, _ids(block.rows))] = \
            blocks.answers(replies, LAST, space.cuts(level.distinct))
        gone = covered(block.n, level.at[repeat], length)
        n_removed, sums = [], []
        for i, text in enumerate(block.text):
            flags = gone[block.first[i]:block.first[i + 1]]
            n_removed.append(int(flags.sum()))
            kept = text.as_py().encode().split()
            kept = kept if not n_removed[-1] else [w for w, f in zip(kept, flags) if not f]
            sums.append(hashlib.sha256(b" ".join(kept)).hexdigest())
        return pa.table({"doc_id": block.rows.column("doc_id"), "n_words": pa.array(np.diff(block.first), pa.int64()),
                         "n_removed": pa.array(n_removed, pa.int64()), "kept_sha256": pa.array(sums, pa.string())})

    by_block = placed.groupBy("block")
    replies = scratch.spark.createDataFrame([], blocks.SENT)
    for number in range(len(lengths)):
        asked = by_block.cogroup(replies.groupBy("block")).applyInArrow(coarse_pass(number), blocks.SENT)
        replies = replies.unionByName(blocks.ask(asked, blocks.Question(number), space, scratch, f"level{number}"))
    asked = by_block.cogroup(replies.groupBy("block")).applyInArrow(last_pass, blocks.SENT)
    replies = replies.unionByName(blocks.ask(asked, Later(LAST), space, scratch, "last"))
    return scratch.save(by_block.cogroup(replies.groupBy("block")).applyInArrow(
        result, "doc_id long, n_words long, n_removed long, kept_sha256 string"), "result")


def remove_repeats(docs: DataFrame, scratch: Scratch, length: int = LENGTH) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_removed``, ``kept_sha256`` of every row."""
    with blocks.BlockTable(docs) as placed:
        return _removed(placed, scratch, length)
