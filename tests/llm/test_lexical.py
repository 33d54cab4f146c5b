"""Spelling variants, word BPE and importance resampling against plain Python and the tokenizer's own library."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from ripple.llm import importance, spelling, word_bpe
from ripple.llm.common import Scratch

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
CLASHES = ("word", "n", "form", "short", "part", "around", "block", "bucket", "ids", "weight", "rank", "score", "n_words")


def table(spark, rows):
    df = spark.createDataFrame([(i, t, "en", None, len(t or "")) for i, t in rows], SCHEMA)
    for name in CLASHES:
        df = df.withColumn(name, F.lit("clash"))
    return df.repartition(3)


def texts(seed=5):
    g = random.Random(seed)
    words = "station stations stationed statio nation nations motion motions caution café cafeteria façade facade naïveté Überfall überfall aaaaaa aaaaaaa".split()
    rows = [(i, " ".join(g.choice(words) + g.choice(["", ",", "'s", "1", " ", "\n"]) for _ in range(g.randint(0, 60)))) for i in range(60)]
    return rows + [(100, None), (101, ""), (102, " \t\n"), (103, "x"), (104, rows[3][1]), (104, rows[3][1]), (None, rows[4][1]), (None, None),
                   (105, "日本語 " * 30 + "Σίσυφος ΣΑΣ"), (106, "a" * 3000 + " " + "abcabd" * 300), (107, "stations " * 3000)]


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# -- 11

def brute_variants(rows, times=5, every=199):
    n = Counter()
    for i, t in rows:
        for w in re.findall("[a-zÀ-ÿ]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")):
            h = zlib.crc32(f"{'null' if i is None else i}:{w}".encode())
            if h % every == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            n[w] += 1
    n = {w: c for w, c in n.items() if len(w) >= 6 and c >= times}

    def near(a, b):
        if a == b or abs(len(a) - len(b)) > 1:
            return False
        a, b = sorted((a, b), key=len)
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        return any(b[:k] + b[k + 1:] == a for k in range(len(b)))
    links = {w: [v for v in n if near(w, v)] for w in n}
    form = {}
    for w, vs in links.items():
        best = min(vs, key=lambda v: (-n[v], v), default=None)
        form[w] = best if best and n[best] >= 5 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n[w], len(links[w]), n.get(form[w])))
    return sorted(out, key=repr)


@pytest.mark.parametrize("hot, segments, every", [(20_000, 3, 199), (3, 3, 7), (2, 1, 7), (5, 2, 7), (20_000, 6, 7)])
def test_variants(spark, hot, segments, every):
    got = spelling.variants(table(spark, texts()), Scratch(spark, "test"), hot=hot, segments=segments, every=every)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert rows_of(got) == brute_variants(texts(), every=every)


def test_variants_of_one_large_group_and_of_small_tiles(spark, monkeypatch):
    g = random.Random(3)
    words = sorted({"prefix" + "".join(g.choice("ab") for _ in range(g.randint(1, 6))) + "suffix" for _ in range(400)})
    rows = [(1, " ".join(words)), (2, " ".join(words[::2] * 6))]
    want = brute_variants(rows, times=1)
    for tile in (512, 7):
        monkeypatch.setattr(spelling, "TILE", tile)
        some = [w for w in words if len(w) in (15, 16)]     # as a group has them
        zeros = np.zeros(len(some), int)
        tiles = spelling.Tiles(some, np.ones(len(some)), zeros, zeros + 15, zeros, zeros - 1, 1)
        tiles.run()
        assert tiles.count.tolist() == [sum(a != b and min(len(a), len(b)) == 15 and _one_edit(a, b) for b in some) for a in some]
    for hot in (20_000, 40):
        assert rows_of(spelling.variants(table(spark, rows), Scratch(spark, "test"), times=1, hot=hot)) == want


def _one_edit(a, b):
    a, b = sorted((a, b), key=len)
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:k] + b[k + 1:] == a for k in range(len(b)))


def test_forms_are_followed_to_the_last(spark):
    forms = spark.createDataFrame([(f"w{i}", f"w{i + 1}") for i in range(9)] + [("x", "w4")], "word string, form string")
    assert rows_of(spelling.roots(forms, Scratch(spark, "test"))) == sorted([(f"w{i}", "w9") for i in range(9)] + [("x", "w9")], key=repr)


def test_long_texts_are_cut_between_runs(monkeypatch):
    text = "Straßenbahn café " * 50 + "z" * 90
    want = Counter(dict(spelling.noisy_words(7, text, every=1 << 40)))
    monkeypatch.setattr(spelling, "SLICE", 20)
    got = Counter()
    for w, n in spelling.noisy_words(7, text, every=1 << 40):
        got[w] += n
    assert got == want and got["z" * 90] == 1


def test_no_words(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert spelling.variants(empty, Scratch(spark, "test")).count() == 0
    assert spelling.variants(table(spark, [(1, None), (2, "short a b")]), Scratch(spark, "test")).count() == 0


# -- 12

@pytest.fixture(scope="module")
def bpe():
    return word_bpe.WordBpe()


def encoded(bpe, batch):
    out, pieces = [], []
    for found in bpe.encode([t.encode() for t in batch]):
        if found is None:
            out.append(np.concatenate(pieces).tolist())
            pieces = []
        else:
            pieces.append(found)
    return out


def test_ids_are_those_of_the_library(bpe, monkeypatch):
    g = random.Random(1)
    alphabet = "ab Z'sltrevmd 019.,!?\n\t éßñ–’ ΣσςİıſK日本語한글́̇‍👩🏽\x1c\x85\xa0  ²½ªº×÷Ǆﬁ"
    batch = ["".join(g.choice(alphabet) if g.random() < .97 else g.choice(["<|endoftext|>", "<|startoftext|>", "<|end"])
                     for _ in range(g.randint(0, 60))) for _ in range(1500)]
    batch += ["", " ", "a" * 3000, "ab" * 700, "the" * 300 + "日" * 500, "".join(g.choice("abcdefgh") for _ in range(2000)),
              "".join(chr(g.randint(0x21, 0x24F)) for _ in range(2000))]
    want = [bpe.library.encode(t, add_special_tokens=False).ids for t in batch]
    assert encoded(bpe, batch) == want
    assert [bpe.decode(np.array(w, np.int64)) for w in want] == [bpe.library.decode(w, skip_special_tokens=False) for w in want]
    assert bpe.decode(np.array([10, 10**6, 11])) == bpe.library.decode([10, 10**6, 11], skip_special_tokens=False)
    # cut into small pieces, and forgetting all the time
    monkeypatch.setattr(word_bpe, "TOGETHER", 30)
    monkeypatch.setattr(word_bpe, "REMEMBERED", 40)
    assert encoded(word_bpe.WordBpe(), batch) == want


def test_both_ways_of_merging_agree(bpe, monkeypatch):
    g = random.Random(2)
    words = ["".join(g.choice("aabthein") for _ in range(g.randint(1, 300))).encode() for _ in range(100)]
    found = []
    for long in (0, 5, 10**9):
        monkeypatch.setattr(word_bpe, "LONG", long)
        ids, begins = bpe.merge(words)
        found.append((ids.tolist(), begins.tolist()))
    assert found[0] == found[1] == found[2]


def test_round_trip(spark, bpe):
    want = []
    for i, t in texts():
        ids = bpe.library.encode(t or "", add_special_tokens=False).ids
        text = bpe.library.decode(ids, skip_special_tokens=False)
        want.append((i, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()))
    docs = table(spark, texts())
    assert rows_of(word_bpe.round_trip(docs)) == sorted(want, key=repr)
    ids = word_bpe.encode(docs)
    assert sorted(((r.doc_id, len(r.ids)) for r in ids.collect()), key=repr) == sorted(((i, n) for i, n, *_ in want), key=repr)
    shas = sorted(((r.doc_id, hashlib.sha256(r.text.encode()).hexdigest()) for r in word_bpe.decode(ids).collect()), key=repr)
    assert shas == sorted(((i, s) for i, _, _, s in want), key=repr)
    assert word_bpe.round_trip(spark.createDataFrame([], SCHEMA)).count() == 0
    assert word_bpe.decode(spark.createDataFrame([(1, None)], "doc_id long, ids array<int>")).collect() == [(1, "")]


def test_whole_table_against_the_library(spark, bpe):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = {r.doc_id: r.ids_sha256 for r in word_bpe.round_trip(docs).collect()}
    for r in docs.collect():
        ids = bpe.library.encode(r.text or "", add_special_tokens=False).ids
        assert got[r.doc_id] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()


# -- 13

def folded_words(t):
    t = "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
    return re.findall("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", t)


def features(t, most):
    w = folded_words(t)
    return [" ".join(w[i:i + n]) for n in range(1, most + 1) for i in range(len(w) - n + 1)]


def brute_resample(rows, target, most, buckets):
    def count(ts):
        c = Counter(zlib.crc32(f.encode()) % buckets for t in ts for f in features(t, most))
        return c, sum(c.values())
    (s, size_s), (t, size_t) = count([x for _, x in rows]), count(target)
    gain = [math.floor(1000 * math.log((t[b] + 1) * (size_s + buckets) / ((s[b] + 1) * (size_t + buckets)))) for b in range(buckets)]
    out = []
    for i, x in rows:
        f = features(x, most)
        weight = sum(gain[zlib.crc32(y.encode()) % buckets] for y in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"2024:{'null' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([i, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + .5) / 4294967296))), None, len(folded_words(x))])
    enough = sorted((r for r in out if r[5] >= 20), key=lambda r: (-r[3], 1 << 63 if r[0] is None else r[0]))
    for place, r in enumerate(enough[:len(enough) * 10 // 100], 1):
        r[4] = place
    return sorted((tuple(r[:5]) for r in out), key=repr)


@pytest.mark.parametrize("most, buckets", [(1, 10_000), (2, 50)])
def test_resample(spark, most, buckets):
    target = ["nations in motion", "caution caution", None, "日本語"]
    bench = spark.createDataFrame([(i, t) for i, t in enumerate(target)], "item_id long, text string")
    got = importance.resample(table(spark, texts()), bench, Scratch(spark, "test"), most=most, buckets=buckets)
    assert rows_of(got) == brute_resample(texts(), target, most, buckets)
    empty = spark.createDataFrame([], SCHEMA)
    assert importance.resample(empty, bench, Scratch(spark, "test")).count() == 0
    assert importance.resample(table(spark, texts()), empty, Scratch(spark, "test")).count() == len(texts())


def test_slices_of_long_texts_keep_all_ngrams():
    g = random.Random(4)
    batch = ["".join(g.choice("ab Zé日0.-_{x \n") for _ in range(g.randint(0, 80))) for _ in range(100)] + ["w" * 40 + " " + "日本語" * 20, "", None]
    column = pa.array([None if t is None else t.encode() for t in batch], pa.binary())
    for most in (1, 2, 3):
        want = Counter(f for t in batch for f in features(t, most))
        for limit in (10, 50, 1 << 20):
            got = Counter()
            for data, row, counted in importance.slices(column, limit, most):
                folded, start, size, _, _ = importance.grams(data, row, counted, most)
                found = importance.Interned(folded, start, size)
                for k, n in zip(found.holder.tolist(), found.count.tolist()):
                    got[folded[start[k]:start[k] + size[k]].tobytes().decode()] += n
                key = importance.hashes(folded, importance.aligned(folded), start, size)
                for k in range(0, len(start), 5):
                    assert int(key[k]) == xxhash.xxh64_intdigest(folded[start[k]:start[k] + size[k]].tobytes())
            assert got == want


def test_equal_keys_of_different_ngrams_get_slots_of_their_own(monkeypatch):
    monkeypatch.setattr(importance, "hashes", lambda data, words, start, size: np.full(len(start), 7, np.uint64))
    data = np.frombuffer(b"ab ab cd abcdefghij abcdefghik", np.uint8)
    start, size = np.array([0, 3, 6, 9, 20]), np.array([2, 2, 2, 10, 10])
    found = importance.Interned(data, start, size)
    assert found.slot[0] == found.slot[1] and len(set(found.slot.tolist())) == 4 and sorted(found.count.tolist()) == [1, 1, 1, 2]
