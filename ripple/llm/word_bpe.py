"""BPE with word ends: ids of whole texts by batched merge rounds in numpy, and texts from ids.

The symbols of all new words of a batch lie in one flat array. A round looks the pairs of neighbours up by
binary search in the sorted keys of the vocabulary's pairs, and merges in every word the pair of lowest
rank, wherever it stands, from left to right; a word without such a pair leaves the array. Only pairs beside
a merge are looked up again. Words of more than ``LONG`` symbols go through the ranks in rising order instead,
all such words together, so that their rounds touch only the places of one rank.

This gives the ids of one merge at a time where every pair is made of symbols made by earlier merges,
which is checked as the vocabulary is loaded. Normalisation and the split into words are the file's own: by the
``tokenizers`` library, but for texts of characters whose class and case all Unicode versions agree on, where an
equal expression does it. What stands between white space is split and merged once and remembered, up to a limit.
"""

from __future__ import annotations

import functools
import hashlib
import heapq
import json
import os
import re
from collections.abc import Iterable, Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ripple.llm.bpe import _byte_chars
from ripple.llm.common import text_or_empty

WORD_BPE = "word_bpe_49k.json"
#: Symbols of a word from which it is merged rank by rank.
LONG = 256
#: Runs between white space that a worker remembers.
REMEMBERED = 1 << 18
#: Bytes of text that are encoded together.
TOGETHER = 4 << 20
#: Ids that are written out together.
WRITTEN = 1 << 18

_NONE = np.iinfo(np.int64).max
_BLANK = re.compile(rb"[\t-\r ]")

# The normaliser and splitter of the vocabulary file that the quick expression stands for, and the
# characters (letters, numbers, others) on whose class and lower case all Unicode versions agree.
_NORMALIZERS = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]
_SPLIT = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"
_LETTERS = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-įı-ſ"
_NUMBERS = "0-9\xb2\xb3\xb9\xbc-\xbe"
_OTHERS = "!-/:-@\\[-`{-~\xa1-\xa9\xab-\xb1\xb4\xb6-\xb8\xbb\xbf\xd7\xf7‐-‧‰-⁞€"

_SETTLED = re.compile(f"[{_LETTERS}{_NUMBERS}{_OTHERS}]*").fullmatch
_QUICK = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[{_NUMBERS}]|[{_OTHERS}]+").findall


class _Numbered(dict):
    """Numbers for keys, in the order in which they are asked for."""

    def __missing__(self, key):
        self[key] = number = len(self)
        return number


def _every_second(at: np.ndarray, touches: np.ndarray) -> np.ndarray:
    """Of places in order, where ``touches`` says that each overlaps the one before it, those merged from the left."""
    first = np.flatnonzero(~touches)
    run = np.cumsum(~touches) - 1
    return at[(np.arange(len(at)) - first[run]) % 2 == 0]


class WordBpe:
    """A vocabulary file of this kind."""

    def __init__(self, name: str = WORD_BPE):
        import public_tokenizers
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        path = name if os.path.isabs(name) else public_tokenizers.path(name)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, splitters = spec["model"], (spec.get("pre_tokenizer") or {}).get("pretokenizers", [])
        plain = not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "byte_fallback", "ignore_merges"))
        levels = [s for s in splitters if s["type"] == "ByteLevel"]
        if model.get("type") != "BPE" or not plain or splitters[-1:] != levels or levels[0].get("add_prefix_space") \
                or spec.get("decoder") or spec.get("post_processor"):
            raise ValueError(f"{path} is not a byte-level BPE whose texts are their tokens")
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        vocab = model["vocab"]
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        ids = np.array([(vocab[a], vocab[b], vocab[a + b]) for a, b in pairs], np.int64).reshape(-1, 3)
        self._check(ids)
        self.merged = ids[:, 2]
        keys = ids[:, 0] << 32 | ids[:, 1]
        self.rank_of = np.argsort(keys)
        self.keys = keys[self.rank_of]
        end = model.get("end_of_word_suffix") or ""
        self.byte_of = _byte_chars()
        self.symbol = np.array([[vocab[c + s] for c, _ in sorted(self.byte_of.items(), key=lambda x: x[1])] for s in ("", end)])
        added = self.library.get_added_tokens_decoder()
        if any(t.normalized or t.single_word or t.lstrip or t.rstrip for t in added.values()):
            raise ValueError("added tokens with conditions are not supported")
        self.special = {t.content: i for i, t in added.items()}
        self.specials = re.compile("|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) or "(?!)")
        self.token = [""] * (max([*vocab.values(), *added]) + 1)
        for text, i in [*vocab.items(), *self.special.items()]:
            self.token[i] = text
        self.decimal = [str(i) for i in range(len(self.token))]
        splits = [s.get("pattern", {}).get("Regex") for s in splitters[:-1]]
        self.quick = (spec.get("normalizer") or {}).get("normalizers") == _NORMALIZERS and splits == [_SPLIT] \
            and splitters[0].get("invert") and splitters[0].get("behavior") == "Removed" and not levels[0].get("use_regex", True)
        self._forget()

    @staticmethod
    def _check(ids: np.ndarray) -> None:
        made = np.full(int(ids.max(initial=0)) + 1, -1)
        made[ids[:, 2]] = np.arange(len(ids))
        if len(np.unique(ids[:, 2])) < len(ids) or (made[ids[:, :2]] >= np.arange(len(ids))[:, None]).any():
            raise ValueError("a pair of this vocabulary is older than its parts")

    def _forget(self) -> None:
        self.known, self.at = _Numbered(), np.zeros(1, np.int64)
        self.ids = np.zeros(0, np.int32)

    # -- merging

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, by binary search over the sorted keys."""
        if not len(self.keys):
            return np.full(len(left), _NONE)
        key = left << 32 | right
        i = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[i] == key, self.rank_of[i], _NONE)

    def merge(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all words in a row, and where those of each word begin."""
        size = np.array([len(w) for w in words], np.int64)
        at = np.concatenate(([0], np.cumsum(size)))
        data = np.frombuffer(b"".join(words), np.uint8)
        symbol = self.symbol[0][data]
        symbol[at[1:] - 1] = self.symbol[1][data[at[1:] - 1]]
        word = np.repeat(np.arange(len(words)), size)
        long = size[word] > LONG
        done = [self._rounds(symbol[~long], word[~long]), self._by_rank(symbol[long], word[long])]
        symbol, word = (np.concatenate(x) for x in zip(*done))
        order = np.argsort(word, kind="stable")
        return symbol[order].astype(np.int32), np.searchsorted(word[order], np.arange(len(words) + 1))

    def _pairs(self, symbol: np.ndarray, word: np.ndarray) -> np.ndarray:
        """Rank of the pair that begins at each symbol."""
        rank = np.full(len(symbol), _NONE)
        inside = np.flatnonzero(word[1:] == word[:-1])
        rank[inside] = self.ranks(symbol[inside], symbol[inside + 1])
        return rank

    def _rounds(self, symbol: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        rank, done = self._pairs(symbol, word), []
        while len(symbol):
            begins = np.flatnonzero(np.concatenate(([True], word[1:] != word[:-1])))
            lowest = np.repeat(np.minimum.reduceat(rank, begins), np.diff(np.append(begins, len(word))))
            left = lowest < _NONE
            if not left.all():
                done.append((symbol[~left], word[~left]))
                symbol, word, rank, lowest = symbol[left], word[left], rank[left], lowest[left]
                if not len(symbol):
                    break
            at = np.flatnonzero(rank == lowest)
            at = _every_second(at, np.concatenate(([False], np.diff(at) == 1)))
            symbol[at] = self.merged[rank[at]]
            stays = np.ones(len(symbol), bool)
            stays[at + 1] = False
            place = np.cumsum(stays) - 1
            symbol, word, rank, at = symbol[stays], word[stays], rank[stays], place[at]
            near = np.unique(np.concatenate((at, at[at > 0] - 1)))
            rank[near] = _NONE
            near = near[near + 1 < len(word)]
            near = near[word[near] == word[near + 1]]
            rank[near] = self.ranks(symbol[near], symbol[near + 1])
        empty = np.zeros(0, np.int64)
        symbols, words = zip(*done) if done else ([empty], [empty])
        return np.concatenate(symbols), np.concatenate(words)

    def _by_rank(self, symbol: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n = len(symbol)
        rank = self._pairs(symbol, word)
        # the next and the previous symbol that is left; ranks are none at the end of a word
        after, before = np.arange(1, n + 2), np.arange(-1, n)
        alive = np.ones(n, bool)
        waiting: dict[int, list[np.ndarray]] = {}
        ranks: list[int] = []

        def wait(places: np.ndarray) -> None:
            places = places[rank[places] < _NONE]
            places = places[np.argsort(rank[places], kind="stable")]
            values, begins = np.unique(rank[places], return_index=True)
            for value, group in zip(values.tolist(), np.split(places, begins[1:])):
                if value not in waiting:
                    waiting[value] = []
                    heapq.heappush(ranks, value)
                waiting[value].append(group)

        wait(np.arange(n))
        while ranks:
            lowest = heapq.heappop(ranks)
            at = np.unique(np.concatenate(waiting.pop(lowest)))
            at = at[rank[at] == lowest]
            if not len(at):
                continue
            at = _every_second(at, np.concatenate(([False], after[at[:-1]] == at[1:])))
            gone = after[at]
            symbol[at] = self.merged[lowest]
            alive[gone] = False
            rank[gone] = _NONE
            after[at] = after[gone]
            before[after[at]] = at
            near = np.unique(np.concatenate((at, before[at][before[at] >= 0])))
            rank[near] = _NONE
            near = near[after[near] < n]
            near = near[word[near] == word[after[near]]]
            rank[near] = self.ranks(symbol[near], symbol[after[near]])
            wait(near)
        return symbol[alive], word[alive]

    # -- texts

    def _words(self, run: str) -> list[bytes]:
        """The words of a run without white space, normalised."""
        if self.quick and _SETTLED(run):
            return [w.encode() for w in _QUICK(run.lower())]
        if self.library.normalizer is not None:
            run = self.library.normalizer.normalize_str(run)
        return [bytes(map(self.byte_of.__getitem__, w)) for w, _ in self.library.pre_tokenizer.pre_tokenize_str(run)]

    def _learn(self, runs: list[bytes]) -> None:
        """Encode runs that are not known yet; special strings stand for their ids."""
        number, parts, ends = _Numbered(), [], []
        for run in runs:
            run = run.decode("utf-8", "replace")
            at = 0
            for m in self.specials.finditer(run):
                parts += [number[w] for w in self._words(run[at:m.start()])]
                parts.append(-1 - self.special[m.group()])
                at = m.end()
            parts += [number[w] for w in self._words(run[at:])]
            ends.append(len(parts))
        ids, begins = self.merge(list(number))
        parts = np.array(parts, np.int64)
        special = parts < 0
        # the special ids follow those of the words, each as a word of its own
        ids = np.concatenate((ids, (-1 - parts[special]).astype(np.int32)))
        begins = np.concatenate((begins, begins[-1] + np.arange(1, special.sum() + 1)))
        parts[special] = len(number) + np.arange(special.sum())
        flat, cut = _gather(ids, begins, parts)
        self.at = np.concatenate((self.at, self.at[-1] + cut[np.array(ends, np.int64)]))
        self.ids = np.concatenate((self.ids, flat))

    def encode(self, texts: Iterable[bytes]) -> Iterator[np.ndarray]:
        """Ids of each text in UTF-8, in pieces: a piece is at most some ``TOGETHER`` bytes of one text, and None ends a text."""
        waiting: list[tuple[np.ndarray | None, bool]] = []
        size = 0
        old = len(self.known)
        for text in texts:
            for piece, last in _pieces(text):
                runs = piece.split()
                waiting.append((np.fromiter(map(self.known.__getitem__, runs), np.int64, len(runs)), last))
                size += len(piece)
                if size >= TOGETHER:
                    yield from self._answer(waiting, old)
                    waiting, size, old = [], 0, len(self.known)
        yield from self._answer(waiting, old)

    def _answer(self, waiting: list, old: int) -> Iterator[np.ndarray | None]:
        if len(self.known) > old:
            self._learn(list(islice(self.known, old, None)))
        for numbers, last in waiting:
            yield _gather(self.ids, self.at, numbers)[0]
            if last:
                yield None
        if len(self.known) > REMEMBERED:
            self._forget()

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids, special ones too: their tokens with blanks between; unknown ids stand for nothing."""
        size = len(self.token)
        return " ".join([self.token[i] for i in ids.tolist() if 0 <= i < size])


def _gather(values: np.ndarray, begins: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The values of some of the runs that ``begins`` cuts, in a row, and where each begins."""
    size = begins[which + 1] - begins[which]
    cut = np.concatenate(([0], np.cumsum(size)))
    return values[np.arange(cut[-1]) + np.repeat(begins[which] - cut[:-1], size)], cut


def _pieces(text: bytes) -> Iterator[tuple[bytes, bool]]:
    """A text, cut at white space where it is long."""
    at = 0
    while len(text) - at > TOGETHER:
        blank = _BLANK.search(text, at + TOGETHER)
        if blank is None:
            break
        yield text[at:blank.start()], False
        at = blank.start()
    yield text[at:], True


@functools.cache
def vocabulary(name: str = WORD_BPE) -> WordBpe:
    """One per worker process."""
    return WordBpe(name)


def _texts(batch: pa.RecordBatch) -> Iterator[bytes]:
    for value in batch.column("text"):
        yield value.as_py()


def encode(docs: DataFrame, tokenizer: str = WORD_BPE) -> DataFrame:
    """``doc_id`` and ``ids`` (an array) of every row, as the library gives them without begin, end or added tokens.

    A null text is empty and has no ids; ids, nulls and repeated rows pass through; special strings in a text are
    their ids, as is the library's default.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(tokenizer)
        for b in batches:
            row, pieces = 0, []
            for found in v.encode(_texts(b)):
                if found is not None:
                    pieces.append(found)
                    continue
                ids = np.concatenate(pieces)
                lists = pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), pa.array(ids))
                yield pa.RecordBatch.from_arrays([b.column("doc_id").slice(row, 1), lists], ["doc_id", "ids"])
                row, pieces = row + 1, []
    return docs.select("doc_id", text_or_empty().cast("binary").alias("text")).mapInArrow(run, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, tokenizer: str = WORD_BPE) -> DataFrame:
    """``doc_id`` and ``text`` of rows of ``doc_id`` and ``ids``; null is an empty list, unknown ids are left out."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(tokenizer)
        for b in batches:
            texts = [v.decode(np.array(x.as_py() or [], np.int64)) for x in b.column("ids")]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])
    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


_DIGESTS = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])


class _Digest:
    """SHA-256 of strings joined by blanks, added in pieces."""

    def __init__(self):
        self.sha, self.some = hashlib.sha256(), False

    def add(self, text: str) -> None:
        self.sha.update((" " if self.some else "").encode() + text.encode())
        self.some = True


def round_trip(docs: DataFrame, tokenizer: str = WORD_BPE) -> DataFrame:
    """``doc_id``, ``n_tokens``, and the digests of the ids (decimal, with blanks between) and of the text they decode to.

    The rows of :func:`encode` and :func:`decode` in one pass, so that neither lists of ids nor texts leave the task.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(tokenizer)
        for b in batches:
            rows, n, ids, text = [], 0, _Digest(), _Digest()
            for found in v.encode(_texts(b)):
                if found is None:
                    rows.append((n, ids.sha.hexdigest(), text.sha.hexdigest()))
                    n, ids, text = 0, _Digest(), _Digest()
                    continue
                n += len(found)
                for at in range(0, len(found), WRITTEN):
                    part = found[at:at + WRITTEN]
                    ids.add(" ".join([v.decimal[i] for i in part.tolist()]))
                    text.add(v.decode(part))
            columns = [pa.array(c, t) for c, t in zip(zip(*rows), _DIGESTS.types[1:])] if rows else [pa.array([], t) for t in _DIGESTS.types[1:]]
            yield pa.RecordBatch.from_arrays([b.column("doc_id").cast(pa.int64()), *columns], schema=_DIGESTS)
    return docs.select("doc_id", text_or_empty().cast("binary").alias("text")) \
        .mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
