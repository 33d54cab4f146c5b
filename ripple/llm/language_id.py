"""Language identification by interpolated Kneser-Ney character models.

One model per language over lower-cased letters (every run of other characters is one blank), of
``ORDER`` characters, fitted on a bounded sample of labelled rows: of each language the
``SAMPLE`` documents with the smallest hash of their id, of any length. Of a document longer than
``SAMPLE_CHARS`` characters, so many are taken from a place that its id decides; a language's budget
is ``SAMPLE`` times ``SAMPLE_CHARS`` characters. The sample is drawn by a threshold per language, so no
text is shuffled for it; the threshold is found among the few hashes below a first one that the language's
number of rows gives. A language whose sample has no letter is not learned. Each language is counted in a task of its own; the tables (bounded by the
sample) are merged on the driver into sorted hash arrays with one row of log probabilities for all
languages, and broadcast.

Every position of every whole text is scored: the longest known n-gram gives its row, an unknown one its
context's back-off weights plus the row of the next shorter one. The language with the lowest mean
cross-entropy wins. A quarter of the sample calibrates: the sharpness of ``score`` (a softmax over
mean cross-entropies), and for each language the cross-entropy above which a text is ``rejected`` as none
of the languages. That is taken from the rows whose prediction is their label, as the ``QUANTILE`` of their
cross-entropies, so that wrong labels and a few rows of gibberish do not raise it; rows of under
``LEAST`` characters count together, as rows of at least so many. A language without such a row takes the
highest limit of the others; without any such row in the table only texts without a letter are rejected.

Null texts and texts without a letter: ``und``, score 0, rejected. With no labelled row all are. Rows with a
null id are scored but neither learned from nor held out. Empty table: empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema

from ripple.llm.common import Scratch

ORDER = 4
SAMPLE, SAMPLE_CHARS = 400, 20_000
UNKNOWN = "und"
# above the calibrated cross-entropy by this factor, and by so many nats over the number of characters
SLACK, SLACK_SHORT = 1.6, 25.0
QUANTILE, LEAST = 0.9, 50
_P = np.uint64(0x9E3779B97F4A7C15)
_letters: np.ndarray | None = None


def letters() -> np.ndarray:
    """Which code points are letters."""
    global _letters
    if _letters is None:
        _letters = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
    return _letters


def codes(text: str) -> np.ndarray:
    """Letters as code points, every run of others as 0, with a 0 at both ends."""
    c = np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32)
    c = np.where(letters()[np.minimum(c, 0x10FFFF)], c, 0)
    c = np.concatenate(([0], c, [0])).astype(np.uint64)
    return c[np.concatenate(([True], (c[1:] > 0) | (c[:-1] > 0)))]


def grams(c: np.ndarray, order: int) -> list[np.ndarray]:
    """Hash of the n-gram that *ends* at each position, for n = 1 to ``order``; shorter ones at the start."""
    out = [(c + np.uint64(1)) * _P]
    with np.errstate(over="ignore"):
        for n in range(2, order + 1):
            h = out[-1].copy()
            # n-gram = (n-1)-gram that ends here, with the character n-1 places before in front
            h[n - 1:] += (c[:len(c) - n + 1] + np.uint64(1)) * _power(n)
            h[n - 1:] ^= h[n - 1:] >> np.uint64(29)
            out.append(h)
    return out


def _power(n: int) -> np.uint64:
    return np.uint64(pow(int(_P), 2 * n + 1, 1 << 64))


def _unique(h: np.ndarray, weight: np.ndarray | None = None):
    keys, first, inverse = np.unique(h, return_index=True, return_inverse=True)
    return keys, first, np.bincount(inverse, weight, len(keys))


def fit_one(texts: list[str], order: int = ORDER) -> list[tuple]:
    """For each n: (n, and of each n-gram its hash, the discounted part of p, the hash of its context, that context's
    back-off weight, the hash of the n-gram without its first character)."""
    c = np.concatenate([codes(t) for t in texts])
    by_n = grams(c, order)
    out = []
    for n in range(order, 0, -1):
        ends = np.arange(n - 1, len(c))
        if n == order:
            keys, first, count = _unique(by_n[n - 1][ends])
            at = ends[first]
        else:       # continuation counts: how many different characters precede the n-gram
            longer = np.arange(n, len(c))
            _, first, _ = _unique(by_n[n][longer])
            keys, first2, count = _unique(by_n[n - 1][longer[first]])
            at = longer[first][first2]
        ones, twos = (count == 1).sum(), (count == 2).sum()
        discount = float(np.clip(ones / max(ones + 2 * twos, 1), 0.1, 0.9))
        context = by_n[n - 2][at - 1] if n > 1 else np.zeros(len(at), np.uint64)
        _, inverse = np.unique(context, return_inverse=True)
        total = np.bincount(inverse, count)
        backoff = discount * np.bincount(inverse, np.minimum(count, 1)) / total
        shorter = by_n[n - 2][at] if n > 1 else np.zeros(len(at), np.uint64)
        out.append((n, keys, (count - discount) / total[inverse], context, backoff[inverse], shorter))
    return out[::-1]


@dataclass
class Model:
    languages: list[str]
    tables: list[tuple[np.ndarray, np.ndarray]]      # by n: sorted hashes, log p of each language
    contexts: list[tuple[np.ndarray, np.ndarray]]    # by n: sorted hashes, log back-off weight of each language
    floor: float                                     # log p of an unknown character
    sharpness: float = 8.0
    highest: np.ndarray | float = np.inf             # calibrated cross-entropy of each language

    def log_p(self, by_n: list[np.ndarray], at: np.ndarray, n: int) -> np.ndarray:
        """log p of the characters at the given positions, given the n - 1 before."""
        if n == 0:
            return np.full((len(at), len(self.languages)), self.floor, np.float32)
        keys, rows = self.tables[n - 1]
        if not len(keys):       # the texts were too short for such n-grams
            return self.log_p(by_n, at, n - 1) + self.backoff(by_n, at, n)
        h = by_n[n - 1][at]
        i = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
        out = rows[i]
        miss = np.flatnonzero(keys[i] != h)
        if len(miss):
            out[miss] = self.log_p(by_n, at[miss], n - 1) + self.backoff(by_n, at[miss], n)
        return out

    def backoff(self, by_n: list[np.ndarray], at: np.ndarray, n: int) -> np.ndarray:
        keys, rows = self.contexts[n - 1]
        if not len(keys):
            return np.zeros((len(at), len(self.languages)), np.float32)
        h = by_n[n - 2][at - 1] if n > 1 else np.zeros(len(at), np.uint64)
        i = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
        return np.where((keys[i] == h)[:, None], rows[i], np.float32(0))

    def entropies(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Mean cross-entropy of each text under each language, and the number of characters it is over."""
        order = len(self.tables)
        parts = [codes(t or "") for t in texts]
        sizes = np.array([len(p) for p in parts])
        # a blank context before the first text, so that every position has one
        c = np.concatenate([np.zeros(order, np.uint64), *parts])
        by_n = grams(c, order)
        starts = order + np.concatenate(([0], np.cumsum(sizes)[:-1]))
        total = np.zeros((len(parts), len(self.languages)))
        step = 1 << 20
        for lo in range(order, len(c), step):
            at = np.arange(lo, min(lo + step, len(c)))
            p = self.log_p(by_n, at, order)
            owner = np.searchsorted(starts, at, "right") - 1
            cuts = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1])))
            total[owner[cuts]] += np.add.reduceat(p, cuts, axis=0, dtype=np.float64)
        return -total / sizes[:, None], np.where(sizes > 1, sizes - 1, 0)

    def predict(self, texts: list[str | None]) -> list[tuple[str, float, bool, float | None]]:
        """(language, score, rejected, cross-entropy) of each text."""
        if not self.languages:
            return [(UNKNOWN, 0.0, True, None)] * len(texts)
        entropy, n = self.entropies(texts)
        best = entropy.argmin(axis=1)
        low = entropy[np.arange(len(best)), best]
        score = 1 / np.exp(-self.sharpness * (entropy - low[:, None])).sum(axis=1)
        limit = np.broadcast_to(self.highest, len(self.languages))[best] * SLACK + SLACK_SHORT / np.maximum(n, 1)
        return [(self.languages[b], float(s), bool(x > m), float(x)) if k else (UNKNOWN, 0.0, True, None)
                for b, s, x, m, k in zip(best, score, low, limit, n)]


def merge(fits: dict[str, list], order: int = ORDER) -> Model:
    """The languages' tables as one: every language's log p for every n-gram that any of them knows.

    Languages without any character are left out.
    """
    fits = {x: tables for x, tables in fits.items() if len(tables[0][1])}
    languages = sorted(fits)
    if not languages:
        return Model([], [], [], 0.0)
    known = np.unique(np.concatenate([fits[x][0][1] for x in languages]))
    model = Model(languages, [], [], -float(np.log(len(known) + 1)))
    with np.errstate(divide="ignore"):
        for n in range(1, order + 1):
            contexts = np.unique(np.concatenate([fits[x][n - 1][3] for x in languages]))
            weights = np.zeros((len(contexts), len(languages)), np.float32)
            keys = np.unique(np.concatenate([fits[x][n - 1][1] for x in languages]))
            rows = np.zeros((len(keys), len(languages)), np.float32)
            for j, x in enumerate(languages):
                _, _, _, context, backoff, _ = fits[x][n - 1]
                weights[np.searchsorted(contexts, context), j] = np.log(backoff)
            # context and next shorter gram of every key, from any language that knows it
            context_of, shorter = np.zeros(len(keys), np.uint64), np.zeros(len(keys), np.uint64)
            for x in languages:
                i = np.searchsorted(keys, fits[x][n - 1][1])
                context_of[i] = fits[x][n - 1][3]
                shorter[i] = fits[x][n - 1][5]
            w = weights[np.searchsorted(contexts, context_of)]
            if n == 1:
                lower = np.full(rows.shape, model.floor)
            else:
                shorter_keys, shorter_rows = model.tables[n - 2]      # not empty if there are longer ones
                i = np.minimum(np.searchsorted(shorter_keys, shorter), len(shorter_keys) - 1)
                lower = np.where((shorter_keys[i] == shorter)[:, None], shorter_rows[i], model.floor)
            p = np.exp(w + lower)
            for j, x in enumerate(languages):
                p[np.searchsorted(keys, fits[x][n - 1][1]), j] += fits[x][n - 1][2]
            model.tables.append((keys, np.log(p).astype(np.float32)))
            model.contexts.append((contexts, weights))
    return model


def grouped(entropy: np.ndarray, n: np.ndarray, least: int = LEAST) -> np.ndarray:
    """Mean cross-entropies of texts, short ones (in the given order) counted together as texts of ``least`` characters."""
    out, total, size = list(entropy[n >= least]), 0.0, 0
    for x, k in zip(entropy[n < least], n[n < least]):
        total, size = total + x * k, size + k
        if size >= least:
            out.append(total / size)
            total, size = 0.0, 0
    if size and not out:        # all texts together are shorter
        out.append(total / size)
    return np.array(out)


def calibrate(model: Model, texts: list[str], labels: list[str]) -> None:
    if not model.languages:
        return
    entropy, n = model.entropies(texts)
    truth = np.array([model.languages.index(x) if x in model.languages else -1 for x in labels])
    kept = (n > 0) & (truth >= 0)
    entropy, n, truth = entropy[kept], n[kept], truth[kept]
    if not len(truth):
        return
    agrees = entropy.argmin(axis=1) == truth
    limits = np.full(len(model.languages), np.nan)
    for j in range(len(limits)):
        own = agrees & (truth == j)
        if own.any():
            limits[j] = np.quantile(grouped(entropy[own, j], n[own]), QUANTILE)
    if agrees.any():
        model.highest = np.where(np.isnan(limits), np.nanmax(limits), limits)
    weight = np.minimum(n, LEAST)

    def loss(s: float) -> float:
        z = -s * (entropy - entropy.min(axis=1, keepdims=True))
        return float(-np.average(z[np.arange(len(truth)), truth] - np.log(np.exp(z).sum(axis=1)), weights=weight))
    model.sharpness = min((2.0 ** k for k in range(0, 6)), key=loss)


def remainder(doc_id: str = "doc_id") -> Column:
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4


#: What the task of one language sends: of each n-gram length, the fields of ``fit_one``.
_TABLES = pa.schema([("lang", pa.string()), ("n", pa.int64()), ("gram", pa.list_(pa.int64())), ("part", pa.list_(pa.float64())),
                     ("context", pa.list_(pa.int64())), ("backoff", pa.list_(pa.float64())), ("shorter", pa.list_(pa.int64()))])


def thresholds(rows: DataFrame, key: Column, sample: int) -> dict[str, str]:
    """The ``sample``-th smallest key of each language, or its largest if it has fewer rows.

    Keys are digests in hexadecimal. Only those below a first threshold are sorted, some times the sample of each language;
    it rises for languages that turn out to have too few.
    """
    counts = {r.lang: r.n for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    found: dict[str, str] = {}
    margin = 2
    while len(found) < len(counts):
        first = {x: min(margin * sample / n, 1.0) for x, n in counts.items() if x not in found}
        below = F.create_map(*[F.lit(v) for x, p in first.items() for v in (x, "g" if p == 1 else f"{int(p * 16 ** 8):08x}")])
        place = F.row_number().over(Window.partitionBy("lang").orderBy("key"))
        few = rows.filter(key < below[F.col("lang")]).select("lang", key.alias("key")) \
            .withColumn("_n", place).filter(F.col("_n") <= sample).groupBy("lang").agg(F.max("key").alias("key"), F.max("_n").alias("n"))
        found |= {r.lang: r.key for r in few.collect() if r.n == sample or first[r.lang] == 1}
        margin *= 16
    return found


def train(docs: DataFrame, scratch: Scratch, sample: int = SAMPLE, order: int = ORDER) -> Model:
    """Fitted on rows with a text, a language and an id whose crc32 mod 4 is not 2."""
    key = F.md5(F.col("doc_id").cast("string"))
    rows = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & (remainder() != 2))
    limits = thresholds(rows, key, sample)
    if not limits:
        return Model([], [], [], 0.0)
    limit = F.create_map(*[F.lit(x) for row in limits.items() for x in row])
    places = F.greatest(F.length("text") - SAMPLE_CHARS + 1, F.lit(1))
    piece = F.substring("text", (F.pmod(F.xxhash64("doc_id", F.lit("piece")), places) + 1).cast("int"), F.lit(SAMPLE_CHARS))
    drawn = scratch.save(rows.filter(key <= limit[F.col("lang")]).select(
        "lang", piece.alias("text"), (F.xxhash64("doc_id") % 4 == 0).alias("calibrates")), "sample")

    def fit(group: pa.Table) -> pa.Table:
        lang, texts = group.column("lang")[0].as_py(), group.column("text").to_pylist()
        use = [t for t, c in zip(texts, group.column("calibrates").to_pylist()) if not c]
        if not any(len(codes(t)) > 1 for t in use):
            use = texts
        rows = [[lang, n, *(a.view(np.int64) if a.dtype == np.uint64 else a for a in arrays)] for n, *arrays in fit_one(use, order)]
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _TABLES.types)], schema=_TABLES)

    parts = drawn.groupBy("lang").applyInArrow(fit, from_arrow_schema(_TABLES)).collect()
    fits: dict[str, list] = {}
    for r in sorted(parts, key=lambda r: (r.lang, r.n)):
        unsigned = [np.array(r[f], np.int64).view(np.uint64) for f in ("gram", "context", "shorter")]
        fits.setdefault(r.lang, []).append((r.n, unsigned[0], np.array(r.part, float), unsigned[1], np.array(r.backoff, float), unsigned[2]))
    model = merge(fits, order)
    held = sorted(drawn.filter("calibrates").collect(), key=lambda r: (r.lang, r.text))
    if held:
        calibrate(model, [r.text for r in held], [r.lang for r in held])
    return model


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """Every row's ``doc_id``, ``held_out``, ``lang_pred``, ``score``, ``rejected``, ``cross_entropy``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo in range(0, max(b.num_rows, 1), 256):
                part = b.slice(lo, 256)
                found = shared.value.predict(part.column("text").to_pylist()) if part.num_rows else []
                out = list(zip(*found)) or [[]] * 4
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("held_out"), pa.array(out[0], pa.string()),
                     pa.array(out[1], pa.float64()), pa.array(out[2], pa.bool_()), pa.array(out[3], pa.float64())],
                    ["doc_id", "held_out", "lang_pred", "score", "rejected", "cross_entropy"])

    return docs.select("doc_id", "text", F.coalesce(remainder() == 2, F.lit(False)).alias("held_out")).mapInArrow(
        run, "doc_id long, held_out boolean, lang_pred string, score double, rejected boolean, cross_entropy double")


def accepted(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs`` whose text is not rejected."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo in range(0, b.num_rows, 256):
                part = b.slice(lo, 256)
                found = shared.value.predict(part.column("text").to_pylist())
                yield part.filter(pa.array([not rejected for _, _, rejected, _ in found]))

    return docs.mapInArrow(run, docs.schema)
