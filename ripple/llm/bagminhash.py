"""Near duplicates by BagMinHash signatures of word multisets.

A text is the multiset of its windows of five words (a shorter text: one window of all its words). Two
texts are near duplicates when the overlap of their multisets, the sum of the smaller counts over
the sum of the larger, is at least 0.8.

**Signature.** Weights are discretised to whole counts; each window's axis of weights is cut into
intervals [0,1), [1,2), [2,4), [4,8), ... With each goes a Poisson process in time, of which only the first
point is drawn; then the interval is halved: one half has that point, the other gets a first point of
its own later on. Unit intervals below the text's count give points, each for one of ``K`` components;
a component keeps its earliest. Intervals whose next point is later than the latest component are
dropped, so heavy windows cost no more than the points that can matter. Two texts agree in a component
with the probability of their overlap, as all randomness hangs on window, interval and point.

**Search.** Equal texts are one node. Nodes with the same band of ``ROWS`` components are compared:

1. every node with the smallest node of its bucket (a star, not all pairs), in the first ``STAR_BANDS`` bands: in the first
   ``FIRST_BANDS`` all of them, in the others those that are not in one component with it by then;
2. verified links (exact overlap of the words themselves) are joined to components, after either part of the star;
3. in buckets of any band that still hold several components, all nodes of different components whose estimate is above
   ``MAYBE``, each pair in the first band it shares. Buckets of at most ``SMALL`` nodes give pairs, which are
   verified like those of the star. Larger ones are cut into blocks of about ``BLOCK`` nodes and ``BLOCK_BYTES`` bytes that carry their
   multisets; two blocks meet in one task, which takes the exact overlaps of all pairs as products of matrices and gives out only
   links that join components (fewer than the nodes), so no pairs of a large group leave a task. The blocks of a bucket of
   more than ``SPREAD`` nodes meet in many tasks, one for each pair of groups of blocks.

The texts of nodes that share any bucket are written once, and read by every comparison.

So each pair that shares a bucket is either in one component already or is compared; there is no limit on
the size of a bucket. With 21 bands of 3 a pair at 0.8 is missed with probability 3e-7, and has an estimate below
``MAYBE`` (four standard deviations) with one of 5e-5.

Nulls and texts without words have no windows: they are linked with equal texts only. Rows with a null or
repeated id are classed like others; as the id of a class and as the row that stays, a null id comes after all others. Empty
table: empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ripple.llm.common import Scratch, text_or_empty
from ripple.llm.hashing import U, mix, slices, words
from ripple.operators.hot import split_join

SHINGLE, SIMILARITY = 5, 0.8
K, ROWS = 63, 3
FIRST_BANDS, STAR_BANDS = 2, 7
SMALL, BLOCK, BLOCK_BYTES, MAYBE = 32, 128, 8 << 20, 0.6
SPREAD = 16_384


def bags(data: np.ndarray, offsets: np.ndarray, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, window hash, count) of each text's multiset, sorted by row and hash."""
    w = words(data, offsets)
    total = np.diff(w.first)
    n = len(w.hashes)
    h = np.zeros(n, U)
    for k in range(size):
        # short texts have one window that ends with their last word
        last = np.minimum(np.arange(n) + k, n - 1)
        same = (np.arange(n) + k < n) & (w.row[last] == w.row) if n else np.zeros(0, bool)
        h = np.where(same, mix(h * U(0x9FB21C651E98DF25) + w.hashes[last]), h)
    place = np.arange(n) - w.first[w.row] if n else np.zeros(0, np.int64)
    valid = place <= np.maximum(total[w.row] - size, 0) if n else np.zeros(0, bool)
    row, h = w.row[valid], h[valid]
    order = np.lexsort((h, row))
    row, h = row[order], h[order]
    new = np.flatnonzero(np.concatenate(([True], (row[1:] != row[:-1]) | (h[1:] != h[:-1])))) if len(h) else np.zeros(0, np.int64)
    return row[new], h[new], np.diff(np.append(new, len(h)))


def _wait(x: np.ndarray) -> np.ndarray:
    """Exponential waiting times from hashes."""
    return -np.log((mix(x) >> U(11)).astype(np.float64) * 2.0 ** -53 + 2.0 ** -54)


def signatures(row: np.ndarray, window: np.ndarray, count: np.ndarray, n_rows: int, k: int = K) -> np.ndarray:
    """BagMinHash signature of each row: ``k`` 32-bit names of points. Rows without windows have the largest number."""
    none = U(0xFFFFFFFFFFFFFFFF)
    best = np.full(n_rows * k, none, U)      # time in the upper half, the point's name in the lower
    heaviest = int(count.max()) if len(count) else 0
    nodes, low, size, j = [], 0, 1, 0
    while low < heaviest:                    # the intervals at the root
        at = np.flatnonzero(count > low)
        seed = mix(window[at] + U((j + 1) * 0x9E3779B97F4A7C15 % (1 << 64)))
        nodes.append((row[at], seed, np.full(len(at), low), np.full(len(at), size), count[at], _wait(seed) / size, mix(seed ^ U(0x5851F42D4C957F2D))))
        low, size, j = (low + size, max(1, low + size), j + 1)
    if not nodes:
        return np.full((n_rows, k), 0xFFFFFFFF, np.uint32)
    r, seed, low, size, weight, t, point = (np.concatenate(x) for x in zip(*nodes))
    while len(r):
        leaf = size == 1
        name = (t[leaf].astype(np.float32).view(np.uint32).astype(U) << U(32)) | (mix(point[leaf]) >> U(32))
        np.minimum.at(best, r[leaf] * k + (point[leaf] % U(k)).astype(np.int64), name)
        # a unit interval goes on to its next point
        after = mix(point[leaf] + U(0x632BE59BD9B4E019))
        grown = [(r[leaf], seed[leaf], low[leaf], size[leaf], weight[leaf], t[leaf] + _wait(after ^ U(1)), after)]
        if not leaf.all():
            s = ~leaf
            half = size[s] // 2
            left_has = (mix(point[s] ^ U(0x2545F4914F6CDD1D) ^ seed[s]) & U(1)) == 0
            for right in (False, True):
                child = mix(seed[s] * U(2) + U(1 + right))
                begin = low[s] + half * right
                has = left_has ^ right
                keep = begin < weight[s]
                grown.append(tuple(x[keep] for x in (
                    r[s], child, begin, half, weight[s], np.where(has, t[s], t[s] + _wait(child) / half),
                    np.where(has, point[s], mix(child ^ U(0x5851F42D4C957F2D))))))
        r, seed, low, size, weight, t, point = (np.concatenate(x) for x in zip(*grown))
        latest = (best.reshape(n_rows, k).max(axis=1) >> U(32)).astype(np.uint32).view(np.float32)
        live = ~(t.astype(np.float32) >= latest[r])      # a row with an empty component has NaN here
        r, seed, low, size, weight, t, point = (x[live] for x in (r, seed, low, size, weight, t, point))
    return (best & U(0xFFFFFFFF)).astype(np.uint32).reshape(n_rows, k)


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for first, data, offsets in slices(b.column("_text")):
            n = len(offsets) - 1
            row, window, count = bags(data, offsets)
            s = signatures(row, window, count, n)
            has = np.bincount(row, minlength=n) > 0
            part = b.slice(first, n)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("hash"),
                 pa.array([x.tobytes() if y else None for x, y in zip(s, has)], pa.binary())], ["doc_id", "hash", "signature"])


def overlaps(left: pa.Array, right: pa.Array) -> np.ndarray:
    """Overlap of the multisets of two columns of texts, pair by pair."""
    out = np.zeros(len(left))
    for i in range(len(left)):
        found = []
        for text in (left[i], right[i]):
            raw = np.frombuffer(text.as_py().encode(), np.uint8)
            found.append(bags(raw, np.array([0, len(raw)]))[1:])
        (h, n), (g, m) = found
        _, x, y = np.intersect1d(h, g, True, True)
        both = np.minimum(n[x], m[y]).sum()
        out[i] = both / max(n.sum() + m.sum() - both, 1)
    return out


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        near = overlaps(b.column("text_a"), b.column("text_b")) >= SIMILARITY - 1e-12
        yield pa.RecordBatch.from_arrays([b.column("a").filter(pa.array(near)), b.column("b").filter(pa.array(near))], ["a", "b"])


def _verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Pairs of nodes whose texts overlap by at least ``SIMILARITY``."""
    mine = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    other = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
    return pairs.join(other, "b").join(mine, "a").select("a", "b", "text_a", "text_b").mapInArrow(_verify, "a long, b long")


def components(links: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """``node``, ``label``: the smallest node that it is linked with, for every node with a link.

    In each round every node that has a smaller neighbour is merged into the smallest of them, and from there once more. Links
    are then between the merged nodes, equal ones once, so they become fewer from round to round, until none is left.
    """
    def unequal(a: str, b: str) -> list:
        return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]
    edges = scratch.save(links.select(*unequal("a", "b")).filter("a <> b").distinct(), f"{name}-edges-0")
    labels = edges.select(F.col("a").alias("node")).union(edges.select("b")).distinct().withColumn("label", F.col("node"))
    turn = 0
    while True:
        turn += 1
        up = edges.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("up"))
        parent = scratch.save(up.join(up.select(F.col("node").alias("up"), F.col("up").alias("next")), "up", "left")
                              .select("node", F.coalesce("next", "up").alias("up")), f"{name}-parents-{turn}")
        labels = scratch.save(labels.join(parent.select(F.col("node").alias("label"), "up"), "label", "left")
                              .select("node", F.coalesce("up", "label").alias("label")), f"{name}-{turn}")
        ends = edges.join(parent.select(F.col("node").alias("a"), F.col("up").alias("up_a")), "a", "left") \
            .join(parent.select(F.col("node").alias("b"), F.col("up").alias("up_b")), "b", "left") \
            .select(F.coalesce("up_a", "a").alias("x"), F.coalesce("up_b", "b").alias("y"))
        edges = scratch.save(ends.filter("x <> y").select(*unequal("x", "y")).distinct(), f"{name}-edges-{turn}")
        if edges.isEmpty():
            return labels


def _side(members: pa.Array, i: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Nodes, labels and signatures of one list of members."""
    own = members[i].values
    signed = np.stack([np.frombuffer(x.as_py(), np.uint32) for x in own.field("signature")])
    return own.field("node").to_numpy(), own.field("label").to_numpy(), signed


def _promising(band: int, x: tuple, y: tuple) -> tuple[np.ndarray, np.ndarray]:
    """Places of pairs of different components with a promising estimate that share no earlier band."""
    same = x[2][:, None, :] == y[2][None, :, :]
    earlier = same[:, :, :band * ROWS].reshape(*same.shape[:2], band, ROWS).all(axis=3).any(axis=2)
    return np.nonzero((same.mean(axis=2) >= MAYBE) & ~earlier & (x[1][:, None] != y[1][None, :]) & (x[0][:, None] != y[0][None, :]))


def _across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Promising pairs of a bucket of at most ``SMALL`` nodes."""
    for b in batches:
        for r in range(b.num_rows):
            x = _side(b.column("members"), r)
            i, j = _promising(b.column("band")[r].as_py(), x, x)
            i, j = i[x[0][i] < x[0][j]], j[x[0][i] < x[0][j]]
            yield pa.RecordBatch.from_arrays([pa.array(x[0][i]), pa.array(x[0][j])], ["a", "b"])


def _elements(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A multiset as a set: the n-th occurrence of a window is an element of its own."""
    for b in batches:
        for first, data, offsets in slices(b.column("text")):
            row, window, count = bags(data, offsets)
            nth = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
            element = mix(np.repeat(window, count) + nth.astype(U) * U(0xA24BAED4963EE407))
            cut = np.searchsorted(np.repeat(row, count), np.arange(1, len(offsets) - 1))
            yield pa.RecordBatch.from_arrays(
                [b.column("node").slice(first, len(offsets) - 1),
                 pa.array([e.tobytes() for e in np.split(element, cut)], pa.binary())], ["node", "elements"])


def _links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of two blocks of a large bucket, links that join their components."""
    for b in batches:
        for r in range(b.num_rows):
            x, y = _side(b.column("left"), r), _side(b.column("right"), r)
            i, j = _promising(b.column("band")[r].as_py(), x, y)
            if not len(i):
                continue
            sets = [[np.frombuffer(e.as_py(), U) for e in b.column(c)[r].values.field("elements")] for c in ("left", "right")]
            size = [np.array([len(e) for e in s]) for s in sets]
            names, code = np.unique(np.concatenate([*sets[0], *sets[1]]), return_inverse=True)
            shared = np.zeros((len(x[0]), len(y[0])), np.float32)
            rows = np.repeat(np.arange(len(size[0]) + len(size[1])), np.concatenate(size))
            for low in range(0, len(names), 8192):      # columns of the two matrices
                here = (code >= low) & (code < low + 8192)
                matrix = np.zeros((len(size[0]) + len(size[1]), min(8192, len(names) - low)), np.float32)
                matrix[rows[here], code[here] - low] = 1
                shared += matrix[:len(size[0])] @ matrix[len(size[0]):].T
            both = shared[i, j]
            near = both >= SIMILARITY * (size[0][i] + size[1][j] - both) - 1e-6
            up: dict[int, int] = {}

            def top(label: int) -> int:
                while up.get(label, label) != label:
                    label = up[label]
                return label

            found = []
            for p, q in zip(i[near], j[near]):
                one, two = top(x[1][p]), top(y[1][q])
                if one != two:
                    up[max(one, two)] = min(one, two)
                    found.append((x[0][p], y[0][q]))
            yield pa.RecordBatch.from_arrays([pa.array([int(f[k]) for f in found], pa.int64()) for k in (0, 1)], ["a", "b"])


def _large(large: DataFrame, texts: DataFrame, scratch: Scratch) -> DataFrame:
    """Links between components in buckets of more than ``SMALL`` nodes."""
    asked = texts.join(large.select("node").distinct(), "node", "left_semi")
    elements = scratch.save(asked.mapInArrow(_elements, "node long, elements binary"), "elements")
    rows = large.join(elements, "node")
    sizes = rows.groupBy("key").agg(F.sum(F.octet_length("elements")).alias("bytes"))
    number = F.greatest(F.ceil(F.col("n") / BLOCK), F.ceil(F.col("bytes") / BLOCK_BYTES))
    groups = F.greatest(F.lit(1), F.ceil(F.col("n") / SPREAD)).cast("int")
    dealt = rows.join(sizes, "key").withColumn("block", F.pmod(F.xxhash64("node"), number)).withColumn("groups", groups)
    blocks = scratch.save(dealt.groupBy("key", "band", "block", "groups").agg(
        F.collect_list(F.struct("node", "label", "signature", "elements")).alias("members")), "blocks")
    # blocks of one group meet those of another in a task of their own
    own = F.pmod(F.col("block"), F.col("groups")).cast("int")
    met = blocks.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("groups") - 1))) \
        .withColumn("low", F.least("own", "other")).withColumn("high", F.greatest("own", "other"))
    left = met.select("key", "low", "high", "band", F.col("block").alias("i"), F.col("own").alias("own_i"), F.col("other").alias("other_i"),
                      F.col("members").alias("left"))
    right = met.select("key", "low", "high", F.col("block").alias("j"), F.col("own").alias("own_j"), F.col("other").alias("other_j"),
                       F.col("members").alias("right"))
    across = left.join(right, ["key", "low", "high"]).filter("i <= j and own_i = other_j and own_j = other_i")
    return across.select("band", "left", "right").mapInArrow(_links, "a long, b long")


def near_duplicates(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """One row per document: ``doc_id``, ``class_id`` (the smallest id of its class), ``class_size``, ``kept``, ``text_md5``."""
    rows = docs.select("doc_id", text_or_empty().alias("_text"), F.md5(text_or_empty().cast("binary")).alias("hash"))
    signed = scratch.save(rows.mapInArrow(_sign, "doc_id long, hash string, signature binary"), "signed")
    nodes = scratch.save(signed.groupBy("hash").agg(F.first("signature").alias("signature"))
                         .withColumn("node", F.monotonically_increasing_id()), "nodes")
    in_bands = nodes.filter("signature is not null").select("node", F.posexplode(F.array(*[
        F.xxhash64(F.substring("signature", 4 * ROWS * i + 1, 4 * ROWS)) for i in range(K // ROWS)])).alias("band", "value")) \
        .select(F.xxhash64("band", "value").alias("key"), "band", "node")
    banded = scratch.save(in_bands, "bands")
    buckets = scratch.save(banded.groupBy("key").agg(F.min("node").alias("a"), F.count(F.lit(1)).alias("n")).filter("n > 1"), "buckets")
    member = banded.join(buckets, "key")
    # equal texts are one node, so any of them will do
    wanted = member.select("node").distinct().join(nodes.select("node", "hash"), "node")
    found = docs.select(F.md5(text_or_empty().cast("binary")).alias("hash"), text_or_empty().alias("text"))
    texts = scratch.save(found.join(wanted, "hash").groupBy("node").agg(F.first("text").alias("text")), "texts")

    spokes = member.filter(F.col("band") < STAR_BANDS).filter("node <> a").select("a", F.col("node").alias("b"), "band")
    first = scratch.save(spokes.filter(F.col("band") < FIRST_BANDS).select("a", "b").distinct(), "star-first")
    first_links = scratch.save(_verified(first, texts), "links-first")
    labels = components(first_links, scratch, "star")
    label_of = labels.select(F.col("node").alias("a"), F.col("label").alias("label_a"))
    label_to = labels.select(F.col("node").alias("b"), F.col("label").alias("label_b"))
    open_spokes = spokes.filter(F.col("band") >= FIRST_BANDS).select("a", "b").distinct() \
        .join(label_of, "a", "left").join(label_to, "b", "left") \
        .filter(F.coalesce("label_a", "a") != F.coalesce("label_b", "b")).select("a", "b").join(first, ["a", "b"], "left_anti")
    second = scratch.save(open_spokes, "star-second")
    star = first.unionByName(second)
    links = first_links.unionByName(scratch.save(_verified(second, texts), "links-second"))
    labels = components(links, scratch, "first")
    member = member.drop("a").join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    several = member.groupBy("key").agg(F.min("label").alias("x"), F.max("label").alias("y")).filter("x <> y").select("key")
    open_ = scratch.save(member.join(several, "key").join(nodes.select("node", "signature"), "node"), "open")
    small = open_.filter(F.col("n") <= SMALL).groupBy("key", "band").agg(F.collect_list(F.struct("node", "label", "signature")).alias("members"))
    pairs = scratch.save(small.select("band", "members").mapInArrow(_across, "a long, b long").join(star, ["a", "b"], "left_anti"), "pairs")
    more = _verified(pairs, texts)
    large = open_.filter(F.col("n") > SMALL)
    if not large.isEmpty():
        more = more.unionByName(_large(large, texts, scratch))
    more = scratch.save(more, "more-links")
    if not more.isEmpty():
        # the links so far are in the labels already
        ends = more.join(labels.select(F.col("node").alias("a"), F.col("label").alias("label_a")), "a", "left") \
            .join(labels.select(F.col("node").alias("b"), F.col("label").alias("label_b")), "b", "left") \
            .select(F.coalesce("label_a", "a").alias("a"), F.coalesce("label_b", "b").alias("b"))
        merged = components(ends, scratch, "second").select(F.col("node").alias("label"), F.col("label").alias("last"))
        known = labels.unionByName(merged.select(F.col("label").alias("node"), "label").join(labels.select("node"), "node", "left_anti"))
        labels = scratch.save(known.join(merged, "label", "left").select("node", F.coalesce("last", "label").alias("label")), "labels")
    classed = scratch.save(signed.select("doc_id", "hash").join(nodes.select("hash", "node"), "hash").join(labels, "node", "left")
                           .select("doc_id", "hash", F.coalesce("label", "node").alias("label")), "classed")
    classes = scratch.save(classed.groupBy("label").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "hash")).alias("first"),
                                                        F.count(F.lit(1)).alias("class_size")), "classes")
    # a class of very many documents is dealt over chunks
    counts = classes.select("label", F.col("class_size").alias("n"))
    return split_join(classed, classes, ["label"], counts, "doc_id").select(
        "doc_id", F.col("first.doc_id").alias("class_id"), "class_size",
        (F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("hash") == F.col("first.hash"))).alias("kept"),
        F.col("hash").alias("text_md5"))
