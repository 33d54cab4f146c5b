"""Resampling documents towards a target: log-likelihood ratios of hashed n-grams, and draws without replacement.

A slice of text is folded to words with one blank between, so that an n-gram is one span of bytes. All n-grams of a
slice are interned in an open-addressed numpy table: 64-bit xxHash keys choose the place, all n-grams without a slot
probe at once, and the n-gram that holds a place is compared byte by byte. A slot stores its bucket and
count. The first pass over texts adds the slots' counts per bucket; the second gathers the gains of buckets by the slot of
each occurrence. Between them only one number per bucket is gathered, as many as ``BUCKETS`` at any size of corpus.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ripple.llm.common import Scratch, ranked, text_or_empty
from ripple.llm.hashing import SLICE

MAX_WORDS = 1       # of an n-gram
BUCKETS = 10_000
MIN_WORDS = 20      # of a document that may be drawn
PERCENT = 10
SEED = "2024"

_U = np.uint64

# The primes of the 64-bit xxHash.
_P1, _P2, _P3, _P4, _P5 = (_U(p) for p in (
    11400714785074694791, 14029467366897019727, 1609587929392839161, 9650029242287828579, 2870177450012600261))

# A to Z in lower case; digits, letters and all bytes above ASCII make words.
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32
_IN_WORD = np.array([chr(b).isalnum() if b < 128 else True for b in range(256)])


def _left(x: np.ndarray, by: int) -> np.ndarray:
    return (x << _U(by)) | (x >> _U(64 - by))


def _mask(size: np.ndarray) -> np.ndarray:
    """The lowest bytes of a 64-bit number, 0 to 8 of them."""
    return np.where(size >= 8, ~_U(0), (_U(1) << (_U(8) * np.minimum(size, 7).astype(_U))) - _U(1))


def lane(words: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on, low byte first. ``words`` are aligned 64-bit numbers, with one spare at the end."""
    i, by = at >> 3, ((at & 7) << 3).astype(_U)
    return (words[i] >> by) | ((words[i + 1] << (_U(63) - by)) << _U(1))


def aligned(data: np.ndarray) -> np.ndarray:
    out = np.zeros(len(data) // 8 + 3, _U)
    out.view(np.uint8)[:len(data)] = data
    return out


def hashes(data: np.ndarray, words: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """xxHash (64 bits, seed 0) of spans of bytes, those below 32 bytes all at once."""
    h = _P5 + size.astype(_U)
    at = start.copy()
    for step in range(3):
        sel = np.flatnonzero((size >> 3) > step)
        k = _left(lane(words, at[sel]) * _P2, 31) * _P1
        h[sel] = _left(h[sel] ^ k, 27) * _P1 + _P4
        at[sel] += 8
    left = size & 7
    sel = np.flatnonzero(left >= 4)
    h[sel] = _left(h[sel] ^ ((lane(words, at[sel]) & _U(0xFFFFFFFF)) * _P1), 23) * _P2 + _P3
    at[sel] += 4
    left = left & 3
    for step in range(3):
        sel = np.flatnonzero(left > step)
        h[sel] = _left(h[sel] ^ ((lane(words, at[sel]) & _U(255)) * _P5), 11) * _P1
        at[sel] += 1
    h ^= h >> _U(33)
    h *= _P2
    h ^= h >> _U(29)
    h *= _P3
    h ^= h >> _U(32)
    for i in np.flatnonzero(size >= 32).tolist():
        h[i] = xxhash.xxh64_intdigest(data[start[i]:start[i] + size[i]])
    return h


def same_bytes(words: np.ndarray, a: np.ndarray, b: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Whether the spans of these sizes from ``a`` and from ``b`` on are equal."""
    same = np.ones(len(a), bool)
    left, open_ = size.copy(), np.arange(len(a))
    at = 0
    while len(open_):
        differs = ((lane(words, a[open_] + at) ^ lane(words, b[open_] + at)) & _mask(left[open_])) != 0
        same[open_[differs]] = False
        left[open_] -= 8
        at += 8
        open_ = open_[~differs & (left[open_] > 0)]
    return same


class Interned:
    """The distinct ones of some spans: per span its slot; per slot a span that holds it, and their number."""

    def __init__(self, data: np.ndarray, start: np.ndarray, size: np.ndarray):
        words = aligned(data)
        key = hashes(data, words, start, size)
        places = 1 << max(4, int(2 * len(start)).bit_length())
        holder = np.full(places, -1, np.int64)
        place = (key & _U(places - 1)).astype(np.int64)
        slot = np.empty(len(start), np.int64)
        open_ = np.arange(len(start))
        while len(open_):
            free = open_[holder[place[open_]] < 0]
            holder[place[free]] = free          # of several that ask for one place, one gets it
            held = holder[place[open_]]
            mine = (key[held] == key[open_]) & (size[held] == size[open_])
            mine[mine] = same_bytes(words, start[held[mine]], start[open_[mine]], size[open_[mine]])
            slot[open_[mine]] = place[open_[mine]]
            open_ = open_[~mine]
            place[open_] = (place[open_] + 1) & (places - 1)
        used = np.flatnonzero(holder >= 0)
        number = np.empty(places, np.int64)
        number[used] = np.arange(len(used))
        self.slot = number[slot]
        self.holder = holder[used]
        self.count = np.bincount(self.slot, minlength=len(used))
        raw = data.tobytes()
        self.crc = np.array([zlib.crc32(raw[s:s + n]) for s, n in zip(start[self.holder].tolist(), size[self.holder].tolist())], np.int64)


def grams(data: np.ndarray, row: np.ndarray, counted: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Folded bytes; start, size and row of each n-gram; row of each word. ``row`` is that of each byte.

    Only n-grams whose first byte is ``counted``: the others are of the next slice, which begins there.
    """
    data = _LOWER[data]
    inside = _IN_WORD[data]
    other_row = np.concatenate(([True], row[1:] != row[:-1])) if len(row) else np.zeros(0, bool)
    before = np.concatenate(([False], inside[:-1])) & ~other_row
    begins = np.flatnonzero(inside & ~before)
    stops = np.flatnonzero(inside & ~np.concatenate((inside[1:] & ~other_row[1:], [False]))) + 1
    size = stops - begins
    # words in a row, each followed by one blank
    start = np.concatenate(([0], np.cumsum(size + 1)[:-1])) if len(size) else begins
    folded = np.full(int((size + 1).sum()), 32, np.uint8)
    folded[np.arange(size.sum()) + np.repeat(np.arange(len(size)), size)] = data[inside]
    of, ends, first = row[begins], start + size, counted[begins]
    starts, sizes, rows = [], [], []
    for n in range(1, most + 1):
        whole = np.flatnonzero(first[:len(of) - n + 1] & (of[:len(of) - n + 1] == of[n - 1:])) if len(of) >= n else np.zeros(0, np.int64)
        starts.append(start[whole])
        sizes.append(ends[whole + n - 1] - start[whole])
        rows.append(of[whole])
    return folded, np.concatenate(starts), np.concatenate(sizes), np.concatenate(rows), of[first]


def _cut(text: np.ndarray, limit: int, most: int) -> Iterator[tuple[int, int, int]]:
    """(begin, end, reach) of the slices of a text: the bytes between begin and end, and up to reach the words that n-grams
    begun there go on into."""
    at = 0
    while len(text) - at > limit:
        gap = _gap(text, at + limit)
        reach = gap
        for _ in range(most - 1):
            reach = _gap(text, _word(text, reach))
        yield at, gap, reach
        at = gap
    yield at, len(text), len(text)


def _find(flag: bool, text: np.ndarray, at: int) -> int:
    while at < len(text):
        hit = np.flatnonzero(_IN_WORD[text[at:at + 4096]] == flag)
        if len(hit):
            return at + int(hit[0])
        at += 4096
    return len(text)


def _gap(text: np.ndarray, at: int) -> int:
    return _find(False, text, at)


def _word(text: np.ndarray, at: int) -> int:
    return _find(True, text, at)


def slices(column: pa.Array, limit: int, most: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Bytes, their rows, and which of them are counted, of slices of about ``limit`` bytes; a long text has several slices."""
    parts, size = [], 0
    for row, value in enumerate(column):
        text = np.frombuffer(value.as_py() or b"", np.uint8)
        for begin, end, reach in _cut(text, limit, most):
            if reach > begin:
                parts.append((row, text[begin:reach], end - begin))
                size += reach - begin
            if size >= limit:
                yield _joined(parts)
                parts, size = [], 0
    if parts:
        yield _joined(parts)


def _joined(parts: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    size = [len(t) for _, t, _ in parts]
    counted = np.concatenate([np.arange(len(t)) < n for _, t, n in parts])
    return np.concatenate([t for _, t, _ in parts]), np.repeat([r for r, _, _ in parts], size), counted


def bucket_counts(texts: DataFrame, buckets: int = BUCKETS, most: int = MAX_WORDS) -> DataFrame:
    """``bucket`` and the number ``n`` of n-grams in it; every task adds up its own before they are shuffled."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for b in batches:
            for data, row, counted in slices(b.column("text"), SLICE, most):
                folded, start, size, _, _ = grams(data, row, counted, most)
                found = Interned(folded, start, size)
                total += np.bincount(found.crc % buckets, weights=found.count, minlength=buckets).astype(np.int64)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"bucket": pa.array(some, pa.int64()), "n": pa.array(total[some], pa.int64())})
    return texts.select(text_or_empty().cast("binary").alias("text")).mapInArrow(run, "bucket long, n long") \
        .groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(source: DataFrame, target: DataFrame, buckets: int = BUCKETS, most: int = MAX_WORDS) -> np.ndarray:
    """Of each bucket, the floor of 1000 times the log of its smoothed share in the target over that in the source.

    Two numbers per bucket come to the driver.
    """
    def counted(texts: DataFrame) -> np.ndarray:
        out = np.zeros(buckets, np.int64)
        for r in bucket_counts(texts, buckets, most).collect():
            out[r.bucket] = r.n
        return out
    s, t = counted(source), counted(target)
    size_s, size_t = float(s.sum() + buckets), float(t.sum() + buckets)
    ratio = ((t + 1).astype(float) * size_s) / ((s + 1).astype(float) * size_t)
    return np.floor(1000 * np.log(ratio)).astype(np.int64)


def weights(docs: DataFrame, gain: np.ndarray, most: int = MAX_WORDS) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_features`` and ``weight``, the floored mean of the gains of the text's n-grams (none: 0)."""
    shared = docs.sparkSession.sparkContext.broadcast(gain)     # a number per bucket

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain = shared.value
        for b in batches:
            words, features, total = (np.zeros(b.num_rows, np.int64) for _ in range(3))
            for data, row, counted in slices(b.column("text"), SLICE, most):
                folded, start, size, of, word_of = grams(data, row, counted, most)
                found = Interned(folded, start, size)
                each = gain[found.crc % len(gain)][found.slot]
                words += np.bincount(word_of, minlength=b.num_rows)
                features += np.bincount(of, minlength=b.num_rows)
                # whole numbers below 2^53 in every slice, so their sums as doubles are exact
                total += np.bincount(of, weights=each, minlength=b.num_rows).astype(np.int64)
            weight = total // np.maximum(features, 1)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(words), pa.array(features), pa.array(weight)],
                                             ["doc_id", "n_words", "n_features", "weight"])
    return docs.select("doc_id", text_or_empty().cast("binary").alias("text")) \
        .mapInArrow(run, "doc_id long, n_words long, n_features long, weight long")


def noise(seed: str = SEED) -> Column:
    """Thousandths of a Gumbel number from the id: adding it to log weights draws without replacement by weight."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")))
    h = F.conv(F.substring(F.sha2(name.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296))).cast("long")


def resample(docs: DataFrame, target: DataFrame, scratch: Scratch, most: int = MAX_WORDS, buckets: int = BUCKETS,
             min_words: int = MIN_WORDS, percent: int = PERCENT, seed: str = SEED) -> DataFrame:
    """``doc_id``, ``n_features``, ``weight``, ``score`` and ``rank`` of every row; rank is null where it is not drawn.

    Drawn are the highest scores, ``percent`` in a hundred of the rows with at least ``min_words`` words, ties to the smaller
    id, null ids last and as the text "null" in the draw; rows equal in score and id are drawn in any order. Null and
    empty texts have no features, weight 0, and are never drawn. Without target texts all weights come from the source alone.
    Weights are written once; ranks are a distributed prefix sum over the rows of enough words.
    """
    found = scratch.save(weights(docs, gains(docs, target, buckets, most), most).withColumn("score", F.col("weight") + noise(seed)), "weights")
    enough = F.col("n_words") >= min_words
    drawn = found.filter(enough).count() * percent // 100
    order = found.filter(enough).withColumn("_down", -F.col("score")).withColumn("_one", F.lit(1).cast("long"))
    placed = ranked(order, scratch, [], ["_down", "doc_id"], {"_before": "_one"})
    out = ["doc_id", "n_features", "weight", "score"]
    rank = F.when(F.col("_before") < drawn, F.col("_before") + 1)
    return placed.select(*out, rank.alias("rank")).unionByName(found.filter(~enough).select(*out, F.lit(None).cast("long").alias("rank")))
