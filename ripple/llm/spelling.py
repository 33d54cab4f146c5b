"""Spelling variants: words one edit apart, and the more frequent form that each leads to.

Two words one edit apart share all before the edit and all after it. A word of L code points is cut into ``SEGMENTS``
parts; whatever part the edit is in, the text before and after that part is the same in both words, so words are
brought together by (length of the shorter, part, text around it). In each task the sorted rows of many such groups are
compared densely, tile by tile, as matrices of code points padded on the right for the common prefix and on the left for
the common suffix: prefix and suffix that reach the longer length less one make a single edit. A group above a tile
is compared block against block; one above ``HOT`` is spread over tasks by pairs of blocks. A pair counts in the part
in which its prefix ends, so once. Tasks send one row per word that has partners, not the pairs.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema

from ripple.llm.common import Scratch, text_or_empty
from ripple.operators.hot import MAX_HOT_NODES

LETTERS = 6         # code points of a word, at least
TIMES = 5           # occurrences of a word, at least
RATIO = 5           # times a form is more frequent than its variant, at least
EVERY = 199         # of how many hashes one loses a code point
SEGMENTS = 3
#: Words of a tile, and cells of its matrix.
TILE, CELLS = 512, 1 << 22
#: Words of one group that are compared in one task.
HOT = 20_000
#: Code points of a long text that are taken apart together, and distinct words that a task holds.
SLICE, HELD = 1 << 20, 1 << 19

_RUNS = re.compile("[a-zÀ-ÿ]+").findall
_NO_RUN = re.compile("[^a-zÀ-ÿ]")


def _slices(text: str) -> Iterator[str]:
    at = 0
    while len(text) - at > SLICE:
        gap = _NO_RUN.search(text, at + SLICE)
        if gap is None:
            break
        yield text[at:gap.start()]
        at = gap.start()
    yield text[at:]


def noisy_words(doc_id: int | None, text: str, letters: int = LETTERS, every: int = EVERY) -> Iterator[tuple[str, int]]:
    """Words of a text with how often it has each, less one code point where the hash of id and word says so."""
    start = zlib.crc32(f"{'null' if doc_id is None else doc_id}:".encode())
    # of bytes, only A to Z change
    for part in _slices(text.encode().lower().decode()):
        for word, n in Counter(_RUNS(part)).items():
            if len(word) < letters:
                continue
            h = zlib.crc32(word.encode(), start)
            if h % every == 0:
                cut = h % len(word)
                word = word[:cut] + word[cut + 1:]
                if len(word) < letters:
                    continue
            yield word, n


def vocabulary(docs: DataFrame, letters: int = LETTERS, times: int = TIMES, every: int = EVERY) -> DataFrame:
    """``word`` and its occurrences ``n`` over all texts; tasks send their own sums."""
    schema = pa.schema([("word", pa.string()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def sums() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], schema=schema)
        for b in batches:
            for doc_id, text in zip(b.column("doc_id"), b.column("text")):
                for word, n in noisy_words(doc_id.as_py(), text.as_py(), letters, every):
                    held[word] += n
                if len(held) >= HELD:
                    yield sums()
                    held.clear()
        yield sums()
    return docs.select("doc_id", text_or_empty().alias("text")).mapInArrow(run, from_arrow_schema(schema)) \
        .groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= times)


# -- groups

def _bound(length: Column, segment: int, segments: int) -> Column:
    return F.floor(length * segment / segments).cast("int")


def groups(words: DataFrame, letters: int = LETTERS, segments: int = SEGMENTS) -> DataFrame:
    """Each word in its groups, as the shorter word of a pair and as the longer one: ``short`` (length of the shorter),
    ``part``, ``around`` (hash of the text around the part), ``word``, ``n``.

    Groups whose hashes collide are compared together, which finds no further pairs.
    """
    size = F.length("word")
    places = []
    for less in (0, 1):
        short = size - less
        for part in range(segments):
            rest = short - _bound(short, part + 1, segments)
            around = F.xxhash64(F.substring(F.col("word"), F.lit(1), _bound(short, part, segments)),
                                F.substring(F.col("word"), size - rest + 1, rest))
            places.append(F.struct(short.alias("short"), F.lit(part).alias("part"), around.alias("around")))
    return words.select("word", "n", F.explode(F.array(*places)).alias("at")).select("at.*", "word", "n") \
        .filter(F.col("short") >= letters)


def _spread(rows: DataFrame, n_rows: int, hot: int) -> DataFrame:
    """Rows of large groups dealt over blocks, with a copy for each pair of blocks that theirs takes part in."""
    key = ["short", "part", "around"]
    most = max(hot, n_rows // MAX_HOT_NODES)
    # fewer than MAX_HOT_NODES groups can be as large
    large = rows.groupBy(*key).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > most) \
        .select(*key, F.ceil(F.col("_n") / most).cast("int").alias("_fan"))
    fan = F.coalesce("_fan", F.lit(1))
    dealt = rows.join(F.broadcast(large), key, "left").withColumn("block", F.pmod(F.xxhash64("word"), fan.cast("long")).cast("int"))
    return dealt.withColumn("_other", F.explode(F.sequence(F.lit(0), fan - 1))) \
        .withColumn("low", F.least("block", "_other")).withColumn("high", F.greatest("block", "_other")).drop("_fan", "_other")


# -- tiles

def _matrix(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code points of words padded at the end, the same padded at the beginning, and lengths.

    All letters are below 256; 0 is no letter.
    """
    size = np.array([len(w) for w in words], np.int64)
    data = np.frombuffer("".join(words).encode("latin-1"), np.uint8)
    width = int(size.max(initial=0))
    row = np.repeat(np.arange(len(words)), size)
    column = np.arange(len(data)) - np.repeat(np.cumsum(size) - size, size)
    left, right = (np.zeros((len(words), width), np.uint8) for _ in range(2))
    left[row, column] = data
    right[row, column + (width - size)[row]] = data
    return left, right, size


def _common(a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
    """How many leading columns each row of one matrix has in common with each row of another, up to ``most``."""
    equal = np.ones((len(a), len(b)), bool)
    total = np.zeros((len(a), len(b)), np.int32)
    for c in range(a.shape[1]):
        equal &= a[:, c, None] == b[None, :, c]
        if not equal.any():
            break
        total += equal
    return np.minimum(total, most)


class Tiles:
    """Rows of whole groups, in the order of their groups."""

    def __init__(self, words: list[str], times: np.ndarray, group: np.ndarray, short: np.ndarray, part: np.ndarray,
                 pair: np.ndarray, segments: int):
        self.left, self.right, self.size = _matrix(words)
        self.group, self.short, self.part, self.pair, self.segments = group, short, part, pair, segments
        # a better form has a smaller place: more occurrences, then the smaller word
        order = sorted(range(len(words)), key=lambda i: (-times[i], words[i]))
        self.place = np.empty(len(words), np.int64)
        self.place[order] = np.arange(len(words))
        self.order = order
        self.count = np.zeros(len(words), np.int64)
        self.best = np.full(len(words), len(words), np.int64)

    def compare(self, a: np.ndarray, b: np.ndarray, same: bool) -> None:
        """One tile: rows ``a`` against rows ``b``; the same rows, or others."""
        la, lb = self.size[a][:, None], self.size[b][None, :]
        shorter, longer = np.minimum(la, lb), np.maximum(la, lb)
        fits = (self.group[a][:, None] == self.group[b][None, :]) & (shorter == self.short[a][:, None])
        cross = self.pair[a][:, None] != self.pair[b][None, :]
        # of a group spread over tasks, a task of two blocks compares one with the other only
        fits &= cross | (self.pair[a] < 0)[:, None]
        if same:
            fits &= np.arange(len(a))[:, None] < np.arange(len(b))[None, :]
        prefix = _common(self.left[a], self.left[b], shorter)
        suffix = _common(self.right[a][:, ::-1], self.right[b][:, ::-1], shorter)
        near = fits & (prefix + suffix >= longer - 1)
        i, j = np.nonzero(near)
        # the part in which the common prefix ends; what is added at the end belongs to the last part
        at, short = prefix[i, j], np.minimum(self.size[a[i]], self.size[b[j]])
        cuts = np.stack([short * s // self.segments for s in range(1, self.segments)]) if self.segments > 1 else np.zeros((0, len(at)), int)
        mine = (cuts <= at).sum(axis=0) == self.part[a[i]]
        i, j = a[i[mine]], b[j[mine]]
        for x, y in ((i, j), (j, i)):
            np.add.at(self.count, x, 1)
            np.minimum.at(self.best, x, self.place[y])

    def run(self) -> None:
        n = len(self.size)
        rows = max(1, min(TILE, CELLS // max(1, self.left.shape[1])))
        begins = np.flatnonzero(np.concatenate(([True], self.group[1:] != self.group[:-1]))) if n else np.zeros(0, np.int64)
        ends = np.append(begins[1:], n)
        at = 0
        while at < n:
            # small groups share a tile; a larger one is cut into blocks, each against each
            last = int(np.searchsorted(ends, at + rows, "right")) - 1
            if last >= 0 and ends[last] > at:
                tile = np.arange(at, ends[last])
                self.compare(tile, tile, True)
                at = int(ends[last])
                continue
            end = int(ends[np.searchsorted(ends, at, "right")])
            blocks = [np.arange(s, min(s + rows, end)) for s in range(at, end, rows)]
            for i, a in enumerate(blocks):
                for b in blocks[i:]:
                    self.compare(a, b, a is b)
            at = end


_PARTNERS = pa.schema([("word", pa.string()), ("n_near", pa.int64()), ("minus_n", pa.int64()), ("near", pa.string())])
#: Rows whose groups are compared together.
_TOGETHER = 1 << 16


def _partners(rows: pa.Table, segments: int) -> pa.RecordBatch:
    def numbers(name: str) -> np.ndarray:
        return rows.column(name).to_numpy().astype(np.int64)
    keys = [numbers(c) for c in ("short", "part", "around", "low", "high")]
    change = np.zeros(rows.num_rows, bool)
    for k in keys:
        change[1:] |= k[1:] != k[:-1]
    words, times = rows.column("word").to_pylist(), numbers("n")
    low, high = keys[3:]
    tiles = Tiles(words, times, np.cumsum(change), keys[0], keys[1], np.where(low == high, -1, numbers("block")), segments)
    tiles.run()
    some = np.flatnonzero(tiles.count)
    best = [tiles.order[p] for p in tiles.best[some].tolist()]
    return pa.RecordBatch.from_arrays([
        pa.array([words[i] for i in some.tolist()], pa.string()), pa.array(tiles.count[some]),
        pa.array(-times[best] if len(best) else np.zeros(0, np.int64)), pa.array([words[i] for i in best], pa.string())], schema=_PARTNERS)


def _compare(segments: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0
        for b in batches:
            held.append(b)
            size += b.num_rows
            if size < _TOGETHER:
                continue
            table = pa.Table.from_batches(held).combine_chunks()
            key = [table.column(c).to_numpy() for c in ("short", "part", "around", "low", "high")]
            change = np.flatnonzero(np.any([k[1:] != k[:-1] for k in key], axis=0)) + 1
            # the last group may go on
            cut = int(change[-1]) if len(change) else 0
            if cut:
                yield _partners(table.slice(0, cut), segments)
            held, size = table.slice(cut).to_batches(), table.num_rows - cut
        if size:
            yield _partners(pa.Table.from_batches(held).combine_chunks(), segments)
    return run


def partners(words: DataFrame, n_words: int, letters: int = LETTERS, segments: int = SEGMENTS, hot: int = HOT) -> DataFrame:
    """``word`` with the number ``n_near`` of words one edit away and the best of them, ``near`` with ``near_n`` occurrences.

    ``words`` has distinct words of letters below U+0100 with their occurrences ``n``; words without partners have no row.
    """
    key = ["short", "part", "around", "low", "high"]
    rows = _spread(groups(words, letters, segments), 2 * segments * n_words, hot)
    found = rows.repartition(*[F.col(k) for k in key]).sortWithinPartitions(*key) \
        .select(*key, "block", "word", "n").mapInArrow(_compare(segments), from_arrow_schema(_PARTNERS))
    best = F.min(F.struct("minus_n", "near"))
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("_best")) \
        .select("word", "n_near", F.col("_best.near").alias("near"), (-F.col("_best.minus_n")).alias("near_n"))


def roots(forms: DataFrame, scratch: Scratch) -> DataFrame:
    """``word`` and ``root`` of rows (word, form): forms are followed to the last, by twice as many steps each round.

    Forms must lead to no circle, as those that are always more frequent than their word.
    """
    state, i = scratch.save(forms.select("word", F.col("form").alias("root")), "roots-0"), 0
    while True:
        further = state.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        i += 1
        stepped = scratch.save(state.join(further, "root", "left")
                               .select("word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("_moved")), f"roots-{i}")
        moved = not stepped.filter("_moved").isEmpty()
        state = stepped.drop("_moved")
        if not moved:
            return state


def variants(docs: DataFrame, scratch: Scratch, letters: int = LETTERS, times: int = TIMES, ratio: int = RATIO,
             every: int = EVERY, segments: int = SEGMENTS, hot: int = HOT) -> DataFrame:
    """``word``, ``form``, ``root``, ``n``, ``n_near``, ``form_n`` of every word.

    A word's form is the most frequent of the words one edit away (ties: the smallest), if it is at least ``ratio`` times as
    frequent; else null, and the word is its own root. Null and empty texts have no words; a null id counts as the text
    "null" in the hash that takes code points away. No texts, no rows.
    """
    words = scratch.save(vocabulary(docs, letters, times, every), "words")
    near = partners(words, words.count(), letters, segments, hot)
    enough = F.col("near_n") >= ratio * F.col("n")
    found = scratch.save(words.join(near, "word", "left").select(
        "word", F.when(enough, F.col("near")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(enough, F.col("near_n")).alias("form_n")), "found")
    return found.join(roots(found.filter(F.col("form").isNotNull()), scratch), "word", "left") \
        .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
