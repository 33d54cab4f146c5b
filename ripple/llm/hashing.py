"""Hashes of words and byte strings, for whole batches of texts at once."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

U = np.uint64
_BASE = 0x9E3779B97F4A7C15
# bytes of text that are hashed together; a longer text is taken whole
SLICE = 2 << 20
_tables: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers in which every input bit reaches every output bit."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x = x * U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


def _powers(n: int, seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Values of bytes, and powers of an odd base and of its inverse."""
    found = _tables.get(seed)
    if found is None or len(found[1]) < n:
        size = max(n, SLICE + 1)
        values = mix(np.arange(1, 257, dtype=U) * U(_BASE) + U(seed)) | U(1)
        base = int(mix(np.array([seed + 77], U))[0]) | 5
        inverse = pow(base, -1, 1 << 64)
        up, down = (np.cumprod(np.concatenate(([U(1)], np.full(size, U(b % (1 << 64)), U)))) for b in (base, inverse))
        found = _tables[seed] = values, up, down
    return found


def prefix(data: np.ndarray, seed: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """Prefix sums of a polynomial over bytes, and what ``span`` needs to take a string out of them."""
    values, up, down = _powers(len(data) + 1, seed)
    sums = np.empty(len(data) + 1, U)
    sums[0] = 0
    np.cumsum(values[data] * up[:len(data)], out=sums[1:])
    return sums, down


def span(sums: np.ndarray, down: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of the strings from ``start`` to ``end``."""
    return mix((sums[end] - sums[start]) * down[start])


def slices(column: pa.Array, limit: int = SLICE) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, row offsets into them) of runs of rows of a string or binary column."""
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2], np.uint8) if column.buffers()[2] is not None else np.zeros(0, np.uint8)
    row = 0
    while row < len(column):
        to = max(row + 1, int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1)
        yield row, data[offsets[row]:offsets[to]], offsets[row:to + 1] - offsets[row]
        row = to


@dataclass
class Words:
    """The words (runs without white space) of some texts."""

    start: np.ndarray       # first byte of each
    end: np.ndarray
    row: np.ndarray         # text it is of
    first: np.ndarray       # of each text, its first word; with the number of all words at the end
    hashes: np.ndarray


def words(data: np.ndarray, offsets: np.ndarray) -> Words:
    n = len(data)
    black = ~((data == 0x20) | ((data >= 9) & (data <= 13)))
    inside = np.concatenate(([False], black, [False]))
    begins = inside[1:] & ~inside[:-1]
    stops = inside[:-1] & ~inside[1:]
    cut = offsets[1:-1]
    cut = cut[(cut > 0) & (cut < n)]
    joined = cut[black[cut] & black[cut - 1]] if n else cut     # two texts that touch without white space
    begins[joined] = True
    stops[joined] = True
    start, end = np.flatnonzero(begins), np.flatnonzero(stops)
    sums, down = prefix(data)
    first = np.searchsorted(start, offsets)
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    return Words(start, end, row, first, span(sums, down, start, end))


def windows(hashes: np.ndarray, length: int) -> np.ndarray:
    """Hash of each window of ``length`` words, by doubling: from the windows of half its length."""
    if length == 1:
        return hashes
    half = length // 2
    shorter = windows(hashes, half)
    n = max(0, len(hashes) - length + 1)
    out = extend(shorter[:n], shorter[half:half + n])
    return mix(out * U(3) + hashes[length - 1:length - 1 + n]) if length % 2 else out


def extend(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Hash of a window from the hashes of its halves."""
    return mix(left * U(0xD6E8FEB86659FD93) + (right ^ U(0xA0761D6478BD642F)))
