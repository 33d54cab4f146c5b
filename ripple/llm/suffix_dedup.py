"""Repeated byte strings by a difference cover.

Every byte covered by a string of ``length`` bytes that also starts anywhere else (another document or another place
of the same one) is removed; strings are judged on the input, and never cross documents.

A difference cover ``D`` of period ``v`` has, for any two places, a shift below ``v`` that brings both onto the
cover (counted from the start of each document). So two equal strings of ``length`` bytes have, at one shift, two
sampled places whose next ``length - v + 1`` bytes are equal. Only sampled places are sorted:

1. *Sampled tuples* (the ``length - v + 1`` bytes from each sampled place) are sorted and named by their hash; names
   that occur once are out. Nine places in a hundred are sampled; 32 bits beside the bucket's rule them out.
2. *Recursion on names*: what is left is named again by the whole context in which a place can matter, the bytes of all
   strings that lie around its tuple. Where that occurs twice, all ``v`` strings around the place are repeats. Places with
   an equal tuple and a context of their own lie at the edge of a repeat.
3. *Remaining suffixes*: of tuples with such an edge, the strings around the edge and around one place of each repeated
   context are sorted by their own ``length`` bytes (128-bit hashes) and compared with their neighbours.

A string's partner is either at an edge, and sorted in step 3, or in a repeated context, of which step 3 has one place;
so the result is exact. A complete suffix array would move each byte's suffix through the sort several times over;
here the insides of copies, however many, cost one name per block. See ``blocks`` for how names travel.

Null text: no bytes. Documents shorter than ``length`` have no string. Repeated rows are documents of their own, so
they are copies of each other. Null ids are kept. Empty table: empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ripple.llm import blocks
from ripple.llm.common import Scratch
from ripple.llm.hashing import U, mix, prefix, slices, span
from ripple.llm.substring_dedup import covered

LENGTH = 400
TUPLE, INSIDE, EDGE, STRING = 0, 1, 2, 3        # which question a row of hashes or its answer belongs to


def difference_cover(length: int) -> tuple[int, np.ndarray]:
    """(v, D) with v at most half of ``length``, by the rule of Colbourn and Ling."""
    r = -1
    while 24 * (r + 1) ** 2 + 36 * (r + 1) + 13 <= length // 2:
        r += 1
    if r < 0:
        return 1, np.zeros(1, np.int64)
    gaps = [1] * r + [r + 1] + [2 * r + 1] * r + [4 * r + 3] * (2 * r + 1) + [2 * r + 2] * (r + 1) + [1] * r
    return 24 * r * r + 36 * r + 13, np.concatenate(([0], np.cumsum(gaps)))


class Block:
    """The documents of a block as one run of bytes, and their sampled places."""

    def __init__(self, rows: pa.Table, length: int):
        self.length = length
        self.v, cover = difference_cover(length)
        self.core = length - self.v + 1
        self.rows = rows.sort_by("row")
        text = self.rows.column("text").combine_chunks()
        text = text.chunk(0) if isinstance(text, pa.ChunkedArray) else text
        self.parts, self.first = [], [0]        # (first byte, bytes) of slices that are hashed on their own
        for _, data, offsets in slices(text):
            self.parts.append((self.first[-1], data))
            self.first += (self.first[-1] + offsets[1:]).tolist()
        self.first = np.array(self.first, np.int64)
        at, begin, end = [], [], []
        for lo, hi in zip(self.first, self.first[1:]):
            if hi - lo >= length:
                places = (np.arange(0, hi - lo - self.core + 1, self.v)[:, None] + cover).ravel()
                places = places[places <= hi - lo - self.core]
                at.append(lo + places)
                begin.append(np.full(len(places), lo))
                end.append(np.full(len(places), hi))
        self.at, begin, end = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (at, begin, end))
        # the strings that hold the tuple start in low .. high
        self.low = np.maximum(begin, self.at - self.v + 1)
        self.high = np.minimum(self.at, end - length)

    def spans(self, start: np.ndarray, end: np.ndarray, seed: int) -> np.ndarray:
        """Hashes of strings; starts ascend."""
        out = np.zeros(len(start), U)
        for first, data in self.parts:
            lo, hi = np.searchsorted(start, [first, first + len(data)])
            if lo < hi:
                out[lo:hi] = span(*prefix(data, seed), start[lo:hi] - first, end[lo:hi] - first)
        return out

    def names(self) -> np.ndarray:
        return self.spans(self.at, self.at + self.core, 1)

    def contexts(self, which: np.ndarray) -> np.ndarray:
        """Names of all bytes of the strings that hold the tuple, and of where in them it lies."""
        start, stop, at = self.low[which], self.high[which] + self.length, self.at[which]
        order = np.argsort(start, kind="stable")
        out = np.zeros(len(which), U)
        out[order] = self.spans(start[order], stop[order], 2)
        return mix(out + (at - start).astype(U) * U(0x9E3779B97F4A7C15) + mix((stop - at).astype(U)))

    def starts(self, which: np.ndarray) -> np.ndarray:
        """Places at which a string that holds one of these tuples starts."""
        step = np.zeros(self.first[-1] + 1, np.int32)
        np.add.at(step, self.low[which], 1)
        np.add.at(step, self.high[which] + 1, -1)
        return np.flatnonzero(np.cumsum(step[:-1]) > 0)


class Sorted:
    """Places sorted by one or two hashes, equal ones together."""

    def __init__(self, h: np.ndarray, g: np.ndarray | None = None):
        self.order = np.argsort(h, kind="stable") if g is None else np.lexsort((g, h))
        h, g = h[self.order], None if g is None else g[self.order]
        self.new = np.ones(len(h), bool)
        self.new[1:] = h[1:] != h[:-1]
        if g is not None:
            self.new[1:] |= g[1:] != g[:-1]
        self.h, self.g = h[self.new], None if g is None else g[self.new]
        self.group = np.cumsum(self.new) - 1
        self.count = np.bincount(self.group, minlength=len(self.h)).astype(np.int64)

    def back(self, flags: np.ndarray) -> np.ndarray:
        """Flags of the distinct hashes as flags of the places."""
        out = np.zeros(len(self.order), bool)
        out[self.order] = flags[self.group]
        return out

    def back_first(self, flags: np.ndarray) -> np.ndarray:
        """The same for the first place of each hash only."""
        out = np.zeros(len(self.order), bool)
        out[self.order[self.new]] = flags
        return out

    def rows(self, block: int, level: int, space: blocks.Space):
        return blocks.send(block, level, space.cuts(self.h), self.h, self.g, (self.count > 1).astype(np.uint8))


class Progress:
    """What is known of a block after the answers so far; recomputed in every pass."""

    def __init__(self, block: Block, replies: pa.Table, space: blocks.Space, stage: int):
        self.block = block
        self.tuples = Sorted(block.names())
        if stage <= TUPLE:
            return
        told = lambda level, s: blocks.answers(replies, level, space.cuts(s.h))
        repeated = told(TUPLE, self.tuples) | (self.tuples.count > 1)
        self.left = np.flatnonzero(self.tuples.back(repeated))
        names = np.zeros(len(block.at), U)
        names[self.tuples.order] = self.tuples.h[self.tuples.group]
        self.contexts = Sorted(names[self.left], block.contexts(self.left))
        if stage <= INSIDE:
            return
        self.inside = self.left[self.contexts.back(told(INSIDE, self.contexts))]
        asking = self.left[self.contexts.back_first(told(EDGE, self.contexts))]
        self.starts = block.starts(asking)
        end = self.starts + block.length
        self.strings = Sorted(block.spans(self.starts, end, 1), block.spans(self.starts, end, 2))
        if stage <= STRING:
            return
        self.repeats = self.starts[self.strings.back(told(STRING, self.strings) | (self.strings.count > 1))]


def _together(h: np.ndarray, g: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order of entries by hashes, and which of them, in that order, begin a first hash and a pair of hashes."""
    order = np.lexsort((g, h))
    h, g = h[order], g[order]
    name = np.ones(len(h), bool)
    name[1:] = h[1:] != h[:-1]
    both = name.copy()
    both[1:] |= g[1:] != g[:-1]
    return order, name, both


class Strings(blocks.Question):
    """Which pairs of hashes occur twice; the third column says which do so within their block."""

    kinds = ("uint64", "uint64", "uint8")

    def answer(self, h, g, many):
        (_, _, twice), member, _ = self.merge(h, g, many)
        return [twice[member] > 0]

    def merge(self, h, g, many):
        order, _, both = _together(h, g)
        member = np.empty(len(h), np.int64)
        member[order] = np.cumsum(both) - 1
        chosen = order[both]
        twice = np.bincount(member, many.astype(np.int64) + 1, len(chosen)) > 1
        return [h[chosen], g[chosen], twice.astype(np.uint8)], member, chosen

    def back(self, told, member, chosen):
        return [told[0][member]]


class Contexts(Strings):
    """Which contexts occur twice, and which are to be compared string by string."""

    def answer(self, h, g, many):
        (tuples, _, twice), member, chosen = self.merge(h, g, many)
        name = np.cumsum(np.concatenate(([True], tuples[1:] != tuples[:-1]))) - 1
        # a tuple with a single context that occurs once has no partner
        asked = (np.bincount(name, twice == 0) > 0) & (np.bincount(name) > 1)
        edge = np.zeros(len(h), bool)
        edge[chosen] = asked[name]       # one place of each context
        return [twice[member] > 0, edge]

    def back(self, told, member, chosen):
        edge = np.zeros(len(member), bool)
        edge[chosen] = told[1]
        return [told[0][member], edge]


def _removed(placed: DataFrame, scratch: Scratch, length: int) -> DataFrame:
    v, cover = difference_cover(length)
    total = placed.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    space = blocks.Space.of(total * len(cover) // v, total)

    def ask(stage: int):
        def run(rows: pa.Table, replies: pa.Table) -> pa.Table:
            number = rows.column("block")[0].as_py()
            known = Progress(Block(rows, length), replies, space, stage)
            if stage == TUPLE:
                hashes = space.coarse(known.tuples.h)
                return blocks.sent(blocks.send(number, TUPLE, space.cuts(hashes), hashes))
            return blocks.sent((known.contexts if stage == INSIDE else known.strings).rows(number, stage, space))
        return run

    def result(rows: pa.Table, replies: pa.Table) -> pa.Table:
        block = Block(rows, length)
        known = Progress(block, replies, space, STRING + 1)
        starts = np.union1d(block.starts(known.inside), known.repeats)
        gone = covered(int(block.first[-1]), starts, length)
        out = []
        for lo, hi, text in zip(block.first, block.first[1:], block.rows.column("text")):
            flags = gone[lo:hi]
            raw = text.as_py().encode()
            if removed := int(flags.sum()):
                raw = np.frombuffer(raw, np.uint8)[~flags].tobytes()
            runs = int((flags[1:] & ~flags[:-1]).sum() + flags[0]) if removed else 0
            out.append((int(hi - lo), removed, runs, hashlib.sha256(raw).hexdigest()))
        columns = list(zip(*out))
        return pa.table({"doc_id": block.rows.column("doc_id")} | {
            name: pa.array(c) for name, c in zip(("n_bytes", "n_removed", "n_spans", "kept_sha256"), columns)})

    by_block = placed.groupBy("block")
    replies = scratch.spark.createDataFrame([], blocks.SENT)
    for stage, question in ((TUPLE, blocks.Question(TUPLE)), (INSIDE, Contexts(INSIDE, EDGE)), (STRING, Strings(STRING))):
        asked = by_block.cogroup(replies.groupBy("block")).applyInArrow(ask(stage), blocks.SENT)
        replies = replies.unionByName(blocks.ask(asked, question, space, scratch, f"stage{stage}"))
    return scratch.save(by_block.cogroup(replies.groupBy("block")).applyInArrow(
        result, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"), "result")


def remove_repeats(docs: DataFrame, scratch: Scratch, length: int = LENGTH) -> DataFrame:
    """``doc_id``, ``n_bytes``, ``n_removed``, ``n_spans``, ``kept_sha256`` of every row."""
    with blocks.BlockTable(docs) as placed:
        return _removed(placed, scratch, length)
