"""Each operator against plain Python on small tables with nulls, ties, repeats, empty and long texts."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ripple.llm import (bagminhash, blocks, exact_dedup, hashing, html_extraction, language_id, mixing, packing, spotsigs,
                        substring_dedup, suffix_dedup, token_counts)
from ripple.llm.bpe import encoder
from ripple.llm.common import Scratch

FOLDER = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
SPACE = " \t\n\x0b\f\r"
WORDS = "the of and house tree river stone light of the is bird in a cloud running walks deeply".split()


def sample(seed=1, n=40):
    g = random.Random(seed)
    base = [" ".join(g.choice(WORDS) + str(g.randint(0, 30)) for _ in range(g.randint(0, 120))) for _ in range(n)]
    rows = [(i, t) for i, t in enumerate(base)]
    rows += [(100, None), (101, ""), (102, " \t\n"), (103, "one"), (104, base[3]), (104, base[3]), (105, base[5] + "  "),
             (106, base[7].replace(" ", "\n")), (107, base[9][:-4] + "zzz"), (None, base[2]), (108, "naïve ß ééé 日本"), (109, "x " * 3000),
             (110, "the of " * 20_000 + "end")]
    return [(i, t, "en" if (i or 0) % 3 else "xx", ("s" + str((i or 0) % 4)) if (i or 0) % 5 else None, len(t or "")) for i, t in rows]


@pytest.fixture(scope="module")
def docs(spark):
    """Rows with further columns whose names the operators use inside."""
    df = spark.createDataFrame(sample(), SCHEMA)
    for name in ("key", "hash", "node", "label", "row", "block", "size", "taken", "before", "k", "h", "n", "rest", "_text", "words"):
        df = df.withColumn(name, F.lit("clash"))
    return df.repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture
def scratch(spark):
    return Scratch(spark, "test")


def as_rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


# -- 1

def test_token_counts_of_spliced_chunks(docs, empty, scratch, spark):
    want = sorted(((i, len((t or "").encode()), len(encoder().library.encode(t or "", add_special_tokens=False).ids))
                   for i, t, *_ in sample()), key=repr)
    for chunk, overlap in ((50, 40), (300, 100), (65_536, 1_024)):
        got = token_counts.count_tokens(docs, Scratch(spark, "test"), chunk=chunk, overlap=overlap)
        assert as_rows(got, "doc_id", "n_bytes", "n_tokens") == want
    odd = [(1, "a" * 700), (2, "x y'll  \n\n z <|endoftext|> " * 30), (3, " " * 500 + "b"), (4, "don't'll " * 90)]
    got = token_counts.count_tokens(spark.createDataFrame([(i, t, None, None, 0) for i, t in odd], SCHEMA), scratch, chunk=60, overlap=40)
    assert as_rows(got, "doc_id", "n_tokens") == [(i, len(encoder().library.encode(t).ids)) for i, t in odd]
    assert token_counts.count_tokens(empty, Scratch(spark, "test")).count() == 0


def test_fast_twin_gives_the_ids_of_the_library():
    e = encoder()
    g = random.Random(3)
    for _ in range(300):
        text = "".join(g.choice("ab Z'sltrevmd 019.,!?\n\t éßñ–’  ") for _ in range(g.randint(0, 60)))
        assert e.ids(text).tolist() == e.library.encode(text, add_special_tokens=False).ids
    assert not e.settled("a<|endoftext|>") and not e.settled("日") and not e.settled("a\x1cb")


# -- 2

def test_exact_groups(docs, empty):
    rows = sample()
    plain = ["".join(c for c in (t or "") if c not in SPACE) for _, t, *_ in rows]
    groups = {}
    for (i, t, *_), p in zip(rows, plain):
        groups.setdefault(p, []).append((-len(t or ""), (1 << 63) if i is None else i))
    want = []
    for (i, *_), p in zip(rows, plain):
        keep = min(groups[p])[1]
        keep = None if keep == 1 << 63 else keep
        want.append((i, keep, len(groups[p]), i == keep, hashlib.sha256(p.encode()).hexdigest()))
    got = exact_dedup.exact_groups(docs)
    assert as_rows(got, "doc_id", "keep_id", "group_size", "kept", "text_sha256") == sorted(want, key=repr)
    assert exact_dedup.exact_groups(empty).count() == 0


def test_exact_groups_with_extreme_ids(spark):
    rows = [(-(1 << 63), "a b"), (5, "ab"), (-7, "a b"), ((1 << 63) - 2, "ab "), (0, "q")]
    got = exact_dedup.exact_groups(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r.doc_id: r.keep_id for r in got.collect()} == {-(1 << 63): -(1 << 63), 5: -(1 << 63), -7: -(1 << 63),
                                                           (1 << 63) - 2: -(1 << 63), 0: 0}


# -- 3

def test_language_models_add_up_to_one():
    texts = ["the house of the tree", "a tree in the house"]
    model = language_id.merge({"en": language_id.fit_one(texts), "xx": language_id.fit_one(["zu dem haus", "das haus"])})
    alphabet = sorted({c for t in (*texts, "zu dem haus", "das haus") for c in language_id.codes(t).tolist()})
    for context in ("the", " a ", "hau", "zzz"):
        c = np.array([[*language_id.codes(context)[:3], a] for a in alphabet], np.uint64)
        p = np.stack([model.log_p(language_id.grams(row, 4), np.array([3]), 4)[0] for row in c])
        assert (np.exp(p).sum(axis=0) <= 1.001).all()


def test_held_out_accuracy(spark, scratch):
    table = spark.read.parquet(f"{FOLDER}/documents.parquet")
    found = language_id.identify(table, language_id.train(table, scratch)).join(table.select("doc_id", "lang", "text"), "doc_id").collect()
    held = [r for r in found if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in found)
    assert sum(r.lang == r.lang_pred for r in held) / len(held) > 0.97
    assert all(0 <= r.score <= 1 for r in found) and sum(r.rejected for r in found) <= 1


def test_language_of_odd_rows(docs, empty, scratch):
    model = language_id.train(docs, scratch)
    got = {r.doc_id: r for r in language_id.identify(docs, model).collect()}
    assert [got[i].lang_pred for i in (100, 101, 102)] == ["und"] * 3 and got[100].score == 0
    assert got[1].lang_pred in ("en", "xx") and not got[None].held_out
    assert language_id.identify(docs, language_id.train(empty, scratch)).filter("lang_pred <> 'und'").count() == 0
    assert language_id.identify(empty, model).count() == 0
    assert language_id.accepted(docs, model).columns == docs.columns


@pytest.mark.parametrize("odd", ["", "12", "a", "a b", " 1 x"])
def test_languages_of_next_to_nothing(spark, odd):
    """A labelled row with no letter or hardly any, beside a table and as the only row."""
    table = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars")
    taught = next(i for i in range(10**6, 10**6 + 99) if zlib.crc32(str(i).encode()) % 4 != 2)
    row = spark.createDataFrame([(taught, odd, "zz", None, len(odd))], table.schema)
    for rows in (table.unionByName(row), row):
        model = language_id.train(rows, Scratch(spark, "test"))
        assert ("zz" in model.languages) == any(c.isalpha() for c in odd)
        found = language_id.identify(rows, model).collect()
        assert len(found) == rows.count()
        assert {r.lang_pred for r in found} <= {"und", *model.languages}
        assert language_id.accepted(rows, model).columns == rows.columns


def test_thresholds_are_those_of_a_full_sort(spark):
    rows = spark.range(5_000).select("id", F.when(F.col("id") < 4_900, "big").otherwise(F.when(F.col("id") < 4_997, "some").otherwise("few")).alias("lang"))
    keys = {}
    for i in range(5_000):
        keys.setdefault("big" if i < 4_900 else "some" if i < 4_997 else "few", []).append(hashlib.md5(str(i).encode()).hexdigest())
    for sample in (1, 10, 400):
        assert language_id.thresholds(rows, F.md5(F.col("id").cast("string")), sample) == {x: sorted(k)[:sample][-1] for x, k in keys.items()}


def test_languages_of_long_documents_only(spark, scratch):
    """Every labelled row is longer than a piece of the sample."""
    g = random.Random(4)
    words = {"en": "the house of a tree and that river with stone", "de": "das haus und der baum mit einem fluss aus stein"}
    n = language_id.SAMPLE_CHARS // 4
    rows = [(i, " ".join(g.choice(words[x].split()) for _ in range(n)), x) for i in range(12) for x in [("en", "de")[i % 2]]]
    assert min(len(t) for _, t, _ in rows) > language_id.SAMPLE_CHARS
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language_id.train(table, scratch)
    assert model.languages == ["de", "en"]
    found = language_id.identify(table, model).collect()
    assert all(r.lang_pred == rows[r.doc_id][2] and not r.rejected for r in found)


def small_model():
    """Two languages, and sentences of each that the models did not see."""
    g = random.Random(5)
    words = {"en": "the house of a tree and that river with stone", "de": "das haus und der baum mit einem fluss aus stein"}
    sentences = {x: [" ".join(g.choice(w.split()) for _ in range(30)) for _ in range(60)] for x, w in words.items()}
    model = language_id.merge({x: language_id.fit_one(t[:30]) for x, t in sentences.items()})
    return model, [(t, x) for x, ts in sentences.items() for t in ts[30:]]


FOREIGN = ["это дом и дерево возле реки на которой стоит камень " * 4, "το σπίτι και το δέντρο δίπλα στο ποτάμι " * 4]


def test_rejection_despite_wrong_labels():
    model, held = small_model()
    noise = [(FOREIGN[0], "en"), (FOREIGN[1], "de"), ("qxzj wvkq xxqz " * 10, "en"), (held[0][0], "de")]
    texts, labels = zip(*held, *noise)
    language_id.calibrate(model, list(texts), list(labels))
    assert [x[2] for x in model.predict(FOREIGN)] == [True, True]
    assert not any(x[2] for x in model.predict([t for t, _ in held]))


def test_rejection_learned_from_short_rows():
    model, held = small_model()
    short = [(t[:24], x) for t, x in held]
    language_id.calibrate(model, [t for t, _ in short], [x for _, x in short])
    assert np.isfinite(model.highest).all()
    assert [x[2] for x in model.predict(FOREIGN)] == [True, True]
    assert not any(x[2] for x in model.predict([t for t, _ in short]))


# -- 4

def chains(text):
    words, out, mark = [x for x in re.split(r"[^\w]|_", text.lower()) if x], [], True
    for w in words:
        if w in spotsigs.ANCHORS:
            mark = True
        else:
            out.append(("~" if mark else "") + w)
            mark = False
    return {tuple(out[i:i + 3]) for i in range(len(out)) if out[i][0] == "~"}


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def test_fingerprints(docs, empty, scratch, spark):
    rows = [(i, t or "") for i, t, *_ in sample()]
    order = sorted(set(rows), key=lambda r: (-(-(1 << 63) if r[0] is None else r[0]), hashlib.md5(r[1].encode()).hexdigest()))
    after = dict(zip(order, order[1:] + order[:1]))
    want = []
    for r in rows:
        k = len(r[1]) // 3
        edited = r[1][:len(r[1]) - k] + after[r][1][:k]
        want.append((r[0], len(r[1]), hashlib.sha256(edited.encode()).hexdigest(), 8 * len(chains(r[1])),
                     round(jaccard(chains(r[1]), chains(edited)), 9), round(jaccard(chains(r[1]), chains(after[r][1])), 9)))
    got = spotsigs.fingerprints(docs, scratch)
    assert as_rows(got, "doc_id", "n_chars", "edited_sha256", F.length("fingerprint"), F.round("near_edited", 9),
                   F.round("near_next", 9)) == sorted(want, key=repr)
    same = {(r.text, r.fingerprint) for r in got.join(docs.select("doc_id", "text"), "doc_id").collect()}
    assert len({t for t, _ in same}) == len(same)
    assert spotsigs.fingerprints(empty, Scratch(spark, "test")).count() == 0


def test_fingerprints_of_other_languages(spark, scratch, tmp_path):
    """Documents without a word of ``ANCHORS`` that begin alike: chains along the text, and likeness follows its content."""
    from ripple.llm import queries
    g = random.Random(6)
    kinds = {"pl": (" ", "i w nie na się z"), "ru": (" ", "и в не на что с"), "zh": ("", "的 是 不 了 在 有"), None: ("; ", "def return if self")}
    letters = {"pl": "bcdłmńpr", "ru": "бвгджзкл", "zh": "".join(map(chr, range(0x5000, 0x50C8))), None: "bcfgjkmp"}
    rows = []
    for x, (blank, common) in kinds.items():
        words = ["".join(g.choice(letters[x]) for _ in range(1 if x == "zh" else 4)) for _ in range(400)]
        for _ in range(10):
            body = [w for _ in range(40) for w in (g.choice(common.split()), *g.choices(words, k=3))]
            rows.append((len(rows), blank.join([*words[:3], *body]), x))
    spark.createDataFrame(rows, "doc_id long, text string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    for r in queries.op4_document_fingerprints(spark, str(tmp_path)).collect():
        assert len(r.fingerprint) >= 8 * 25, rows[r.doc_id]
        assert 0.2 < r.near_edited < 0.9 and r.near_next < 0.6, rows[r.doc_id]


def test_near_pairs_of_fingerprints(spark, scratch):
    rows = [(i, t) for i, t, *_ in sample(2)] + [(200 + i, " ".join(f"the w{j} stone{j} river{j}" for j in range(40) if j != 5 * i)) for i in range(6)]
    members, pairs = spotsigs.near_pairs(spark.createDataFrame(rows, "doc_id long, text string"), scratch, 0.7)
    sets = {}
    for r in members.collect():
        sets[r.set_id] = frozenset(chains(dict((k, v) for k, v in rows)[r.doc_id]))
    want = {frozenset((a, b)) for a in sets for b in sets if a < b and jaccard(sets[a], sets[b]) >= 0.7}
    assert want and {frozenset((r.a, r.b)) for r in pairs.collect()} == want


def test_near_pairs_take_the_anchors_of_fingerprints(spark, scratch):
    rows = [(i, " ".join(f"og w{j} stein{j} elv{j}" for j in range(40) if j != 5 * i), None) for i in range(4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    members, pairs = spotsigs.near_pairs(docs, scratch, 0.7, anchors=("og",))
    prints = {r.doc_id: r.fingerprint for r in spotsigs.fingerprints(docs, scratch, ("og",)).collect()}
    assert {r.doc_id: r.set_id for r in members.collect()} == {i: hashlib.md5(x.encode()).hexdigest() for i, x in prints.items()}
    assert pairs.count() == 6


# -- 5

def check_pieces(pieces, rows, capacity):
    whole = {}
    for i, t in rows:
        ids = np.append(encoder().library.encode(t or "", add_special_tokens=False).ids, 0).astype("<u4")
        whole.setdefault(i, []).append(ids)
    for i, own in pieces.groupby("doc_id", dropna=False):
        ids = whole[None if i != i else i]
        assert own.length.sum() == sum(map(len, ids))
        for r in own.itertuples():
            assert r.ids_crc32 in {zlib.crc32(x[r.start:r.start + r.length].tobytes()) for x in ids if len(x) == r.doc_tokens}
    for _, own in pieces.groupby("sequence_id"):
        own = own.sort_values("offset")
        assert own.offset.tolist() == [0, *own.length.cumsum()[:-1]] and own.length.sum() <= capacity


def test_packing(docs, empty, scratch, spark):
    pieces = packing.pack(docs, scratch, capacity=64, unit=4).toPandas()
    check_pieces(pieces, [(i, t) for i, t, *_ in sample()], 64)
    assert packing.pack(empty, Scratch(spark, "test")).count() == 0


def test_column_generation_is_near_the_bound():
    g = np.random.default_rng(2)
    histogram = dict(Counter(g.integers(1, 64, 5000).tolist()))
    patterns = packing.rounded(packing.solve(histogram, 64), histogram, 64)
    held = Counter()
    for pattern, n in patterns:
        assert sum(length * times for length, times in pattern) <= 64
        for length, times in pattern:
            held[length] += times * n
    assert held == histogram
    assert sum(n for _, n in patterns) <= 1.01 * sum(k * v for k, v in histogram.items()) / 64 + 1


# -- 6

def test_signatures_estimate_the_overlap_of_multisets():
    g = np.random.default_rng(0)
    errors = []
    for _ in range(20):
        one = {int(x): int(c) for x, c in zip(g.integers(0, 2**62, 40), g.geometric(.15, 40))}
        two = {k: v + int(g.integers(-3, 4)) for k, v in one.items()}
        two = {k: v for k, v in two.items() if v > 0}
        truth = sum(min(v, two.get(k, 0)) for k, v in one.items()) / sum(max(v, two.get(k, 0)) for k, v in one.items())
        rows = np.array([0] * len(one) + [1] * len(two))
        s = bagminhash.signatures(rows, np.array([*one, *two], np.uint64), np.array([*one.values(), *two.values()]), 2, 1024)
        errors.append((s[0] == s[1]).mean() - truth)
    assert abs(np.mean(errors)) < 0.012 and np.std(errors) < 0.03


def bag(text):
    w = (text or "").split()
    return Counter(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else Counter()


def classes_of(rows):
    texts = sorted({t or "" for _, t in rows})
    up = {t: t for t in texts}

    def top(t):
        while up[t] != t:
            t = up[t]
        return t
    bags = {t: bag(t) for t in texts}
    for a in texts:
        for b in texts:
            if a < b and bags[a] and bags[b]:
                both = sum((bags[a] & bags[b]).values())
                if both >= 0.8 * (sum(bags[a].values()) + sum(bags[b].values()) - both):
                    up[top(b)] = top(a)
    first = {}
    for i, t in rows:
        key = (i is None, i or 0)       # a null id after all others
        first[top(t or "")] = min(first.get(top(t or ""), key), key)
    return [(i, None if first[top(t or "")][0] else first[top(t or "")][1]) for i, t in rows]


def test_components_of_paths_stars_and_random_links(spark):
    g = random.Random(9)
    order = list(range(300, 400))
    g.shuffle(order)
    links = list(zip(order, order[1:])) + [(500, i) for i in range(400, 430)] + [(g.randrange(80), g.randrange(80)) for _ in range(60)] + [(7, 7), (1, 2), (2, 1)]
    up = {n: n for pair in links for n in pair}

    def top(n):
        while up[n] != n:
            n = up[n]
        return n
    for a, b in links:
        one, two = top(a), top(b)
        up[max(one, two)] = min(one, two)
    linked = {n for a, b in links if a != b for n in (a, b)}
    got = bagminhash.components(spark.createDataFrame(links, "a long, b long"), Scratch(spark, "test"), "x")
    assert {r.node: r.label for r in got.collect()} == {n: top(n) for n in linked}
    assert bagminhash.components(spark.createDataFrame([], "a long, b long"), Scratch(spark, "test"), "x").count() == 0


def test_null_ids_come_last_in_a_class(spark, scratch):
    text = " ".join(f"w{i}" for i in range(60))
    rows = spark.createDataFrame([(None, text), (7, text + " x"), (8, text), (None, "alone")], "doc_id long, text string")
    got = bagminhash.near_duplicates(rows, scratch)
    assert as_rows(got, "doc_id", "class_id", "class_size", "kept") == sorted(
        [(None, 7, 3, False), (7, 7, 3, True), (8, 7, 3, False), (None, None, 1, True)], key=repr)


def test_near_duplicates(docs, empty, scratch, spark):
    assert as_rows(bagminhash.near_duplicates(docs, scratch), "doc_id", "class_id") == \
        sorted(classes_of([(i, t) for i, t, *_ in sample()]), key=repr)
    assert bagminhash.near_duplicates(empty, Scratch(spark, "test")).count() == 0


@pytest.mark.parametrize("small, block, spread, size", [(1000, 1000, 1000, 1 << 20), (4, 3, 1000, 1 << 20), (2, 16, 20, 1 << 20), (2, 100, 7, 4000)])
def test_chains_of_near_copies_beside_one_center(spark, scratch, monkeypatch, small, block, spread, size):
    """Links between texts that are both unlike the smallest node of their bucket are found."""
    monkeypatch.setattr(bagminhash, "BLOCK", block)
    monkeypatch.setattr(bagminhash, "SMALL", small)
    monkeypatch.setattr(bagminhash, "SPREAD", spread)
    monkeypatch.setattr(bagminhash, "BLOCK_BYTES", size)
    g = random.Random(5)
    words = [f"w{i}" for i in range(200)]
    rows = []
    for i in range(60):
        own = list(words)
        for _ in range(i % 6):
            own[g.randrange(200)] = f"x{g.randrange(10**6)}"
        rows.append((i, " ".join(own)))
    got = bagminhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), scratch)
    assert as_rows(got, "doc_id", "class_id") == sorted(classes_of(rows), key=repr)


# -- 7

def test_mixing(docs, empty, scratch, spark):
    got = mixing.mix(docs, scratch, keep=("source",)).collect()
    sizes = Counter()
    for i, t, _, s, _ in sample():
        sizes[s] += len((t or "").split())
    budget, cap = sum(sizes.values()), {s: 3 * n for s, n in sizes.items()}
    order = sorted((s for s in sizes if s is not None)) + [None]
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    target, full = {}, set()
    while True:
        left, over = budget - sum(cap[s] for s in full), sum(w for s, w in weight.items() if s not in full)
        target = {s: cap[s] if s in full else left * weight[s] / over for s in sizes}
        more = {s for s in sizes if target[s] > cap[s]}
        if not more:
            break
        full |= more
    taken = Counter()
    for r in got:
        assert r.target == pytest.approx(target[r.source]) and r.source_size == sizes[r.source] and r.taken <= 3 * r["size"]
        taken[r.source] += r.taken
    assert len(got) == len(sample()) and all(taken[s] == round(target[s]) for s in sizes)
    again = mixing.mix(docs.repartition(5), Scratch(spark, "test"), keep=("source",)).collect()
    assert sorted(map(repr, again)) == sorted(map(repr, got))
    assert mixing.mix(empty, Scratch(spark, "test")).count() == 0
    words = mixing.mixed(docs, Scratch(spark, "test"))
    assert words.columns == docs.columns
    assert sum(len(r.text.split()) for r in words.collect()) == sum(taken.values())


# -- 8, 9

def bytes_removed(rows, length):
    seen = Counter()
    for _, t in rows:
        b = (t or "").encode()
        seen.update(b[p:p + length] for p in range(len(b) - length + 1))
    out = []
    for i, t in rows:
        b = (t or "").encode()
        gone = np.zeros(len(b) + 1, bool)
        for p in range(len(b) - length + 1):
            if seen[b[p:p + length]] > 1:
                gone[p:p + length] = True
        runs = int((gone[1:] & ~gone[:-1]).sum() + gone[0])
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out.append((i, len(b), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("length", [1, 8, 40, 100])
def test_repeated_bytes(spark, length):
    g = random.Random(length)
    base = "".join(g.choice("abcd") for _ in range(1500))
    rows = [(i, t) for i, t, *_ in sample()] + [(300, "y" * 3 * length), (301, base[:700]), (302, base[100:900] + "é" + base[50:400])]
    rows += [(310 + i, base[(s := g.randint(0, 1200)):s + g.randint(1, 3 * length)]) for i in range(20)]
    got = suffix_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), Scratch(spark, "test"), length)
    assert as_rows(got, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == bytes_removed(rows, length)


@pytest.mark.parametrize("length", [1, 25, 26, 60, 146, 400, 1000])
def test_difference_cover(length):
    v, cover = suffix_dedup.difference_cover(length)
    assert {int(a - b) % v for a in cover for b in cover} == set(range(v)) and cover.max() < v <= max(1, length // 2)


@pytest.mark.parametrize("length", [1, 5, 16, 20, 64])
def test_repeated_words(spark, length):
    g = random.Random(length)
    rows = [(i, t) for i, t, *_ in sample() if i != 104] + [(400 + i, " ".join(g.choice("ab") for _ in range(g.randint(0, 90)))) for i in range(20)]
    seen, want = set(), []
    for i, t in sorted(rows, key=lambda r: (r[0] is None, r[0])):
        w = (t or "").encode().split()
        gone = np.zeros(len(w), bool)
        for p in range(len(w) - length + 1):
            key = tuple(w[p:p + length])
            gone[p:p + length] |= key in seen
            seen.add(key)
        kept = b" ".join(x for x, x_gone in zip(w, gone) if not x_gone)
        want.append((i, len(w), int(gone.sum()), hashlib.sha256(kept).hexdigest()))
    got = substring_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), Scratch(spark, "test"), length)
    assert as_rows(got, "doc_id", "n_words", "n_removed", "kept_sha256") == sorted(want, key=repr)


def test_repeats_in_small_slices_and_buckets(spark, docs, empty, monkeypatch):
    monkeypatch.setattr(blocks, "BUCKET_ENTRIES", 64)
    a = as_rows(substring_dedup.remove_repeats(docs, Scratch(spark, "test"), 8), "doc_id", "n_removed")
    b = as_rows(suffix_dedup.remove_repeats(docs, Scratch(spark, "test"), 60), "doc_id", "n_removed")
    assert a and b == sorted(((r[0], r[2]) for r in bytes_removed([(i, t) for i, t, *_ in sample()], 60)), key=repr)
    assert substring_dedup.remove_repeats(empty, Scratch(spark, "test")).count() == 0
    assert suffix_dedup.remove_repeats(empty, Scratch(spark, "test")).count() == 0
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("blocks_")]


def words_removed(rows, length):
    seen, want = set(), []
    for i, t in sorted(rows):
        w = t.split()
        gone = np.zeros(len(w), bool)
        for p in range(len(w) - length + 1):
            gone[p:p + length] |= tuple(w[p:p + length]) in seen
            seen.add(tuple(w[p:p + length]))
        want.append((i, int(gone.sum())))
    return sorted(want, key=repr)


def copied(n, seed=5):
    """Texts of shared and own passages; ids repeat nowhere."""
    g = random.Random(seed)
    letters = lambda: "".join(g.choice("abcdefgh") for _ in range(g.randint(1, 4)))     # noqa: E731
    shared = [" ".join(letters() for _ in range(30)) for _ in range(6)]
    return [(i, " ".join(g.choice(shared)[g.randint(0, 20):] if g.random() < 0.4 else letters() for _ in range(g.randint(0, 25))))
            for i in range(n)]


@pytest.mark.parametrize("fan", [1, 2, 3])
def test_repeats_over_several_hops(spark, monkeypatch, fan):
    for name, value in {"BUCKET_ENTRIES": 32, "FAN_BITS": fan, "BLOCK_BYTES": 700}.items():
        monkeypatch.setattr(blocks, name, value)
    rows = copied(80) + [(200 + i, "the same text of ten words, in many a document " * 3) for i in range(25)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    space = blocks.Space.of(20_000, 20_000)
    assert space.bits > 2 * fan      # three hops at least
    for length in (8, 16):
        got = as_rows(substring_dedup.remove_repeats(docs, Scratch(spark, "test"), length), "doc_id", "n_removed")
        assert got == words_removed(rows, length)
    got = suffix_dedup.remove_repeats(docs, Scratch(spark, "test"), 60)
    assert as_rows(got, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == bytes_removed(rows, 60)


def test_blocks_are_bounded_by_bytes(spark, monkeypatch):
    monkeypatch.setattr(blocks, "BLOCK_BYTES", 50_000)
    sizes = [10] * 300 + [40_000] * 6 + [0] * 100 + [200_000] + [3_000] * 60
    rows = [(i, "x" * n if n else None) for i, n in enumerate(sizes)]
    with blocks.BlockTable(spark.createDataFrame(rows, "doc_id long, text string").coalesce(2)) as placed:
        found = placed.groupBy("block").agg({"row": "count", "text": "max"}).collect()
        assert placed.count() == len(rows) and placed.select("row").distinct().count() == len(rows)
        size = {r.block: r.n for r in placed.selectExpr("block", "octet_length(text) + 256 AS n").groupBy("block").sum("n").toDF("block", "n").collect()}
        last = {r.block: r.n for r in placed.selectExpr("block", "row", "octet_length(text) + 256 AS n")
                .groupBy("block").agg({"n": "max"}).toDF("block", "n").collect()}
    assert len(found) > 8 and all(n <= 50_000 + last[b] for b, n in size.items())


def test_rows_sent_grow_with_the_input(spark, monkeypatch):
    for name, value in {"BUCKET_ENTRIES": 256, "FAN_BITS": 2, "BLOCK_BYTES": 4_000}.items():
        monkeypatch.setattr(blocks, name, value)

    class Counting(Scratch):
        rows = 0

        def save(self, df, name, options=None):
            saved = super().save(df, name, options)
            if "answer" in saved.columns:
                self.rows += saved.count()
            return saved

    sent = []
    for n in (60, 120, 240):
        scratch = Counting(spark, "test")
        substring_dedup.remove_repeats(spark.createDataFrame(copied(n), "doc_id long, text string").coalesce(1), scratch, 8)
        sent.append(scratch.rows)
    # twice the input may add a hop, never the square
    assert sent[1] < 3 * sent[0] and sent[2] < 3 * sent[1]


def test_packed_arrays_and_slices():
    a, b = np.arange(5, dtype=np.uint64) * 10**15, np.array([1, -2, 3, 4, 5])
    x, y = blocks.unpack(blocks.pack(a, b), "uint64", "int64")
    assert x.tolist() == a.tolist() and y.tolist() == b.tolist()
    column = pa.array(["ab c", None, "", "déf", " x"]).slice(1)
    parts = list(hashing.slices(column, 3))
    assert b"".join(d.tobytes() for _, d, _ in parts) == "déf x".encode() and parts[0][0] == 0
    for _, data, offsets in hashing.slices(pa.array(["a b", "b", "", " b\n"])):
        w = hashing.words(data, offsets)
        assert w.row.tolist() == [0, 0, 1, 3] and w.hashes[1] == w.hashes[2] == w.hashes[3] != w.hashes[0]


# -- 10

PAGE = """<html><head><title>t</title><script>var a="<p>no</p>"</script></head><body>
<div class="cookie-banner">We use cookies on this site.</div><header class="site-header"><p>The Daily News</p></header>
<nav><ul><li><a href="/">Home</a><li><a href="/b">World</a></ul></nav>
<main><h1>Great &amp; good</h1><div class="ad">Buy now for little money.</div><p>First  paragraph&nbsp;of the article, with <b>bold</b>
words.<br>And more of it here.<p>Second one, unclosed<div class="share"><a href="x">Share</a></div><p>End.</p></main>
<aside class="sidebar"><h3>Related</h3><p>Another story that is not here.</p></aside>
<section id="comments"><div class="comment"><p>I do not agree with this article at all.</p></div></section>
<form><label>Mail</label><input></form><footer>&copy; 2020 nobody</footer></body>"""


@pytest.fixture(scope="module")
def trees(spark):
    return html_extraction.train(spark.read.parquet(f"{FOLDER}/pages.parquet"))


def test_main_text_of_a_page(trees, spark):
    rows = [(1, "u", PAGE), (2, "u", None), (3, None, ""), (None, "u", "<p>unclosed <a href='x"), (5, "u", "<<<>>>&&& </p></div>"),
            (5, "u", "<p>" * 3000 + "deep")]
    got = html_extraction.extract(spark.createDataFrame(rows, "page_id long, url string, html string"), trees).collect()
    assert got[0].text == ("Great & good\n\nFirst paragraph of the article, with bold words. And more of it here.\n\n"
                           "Second one, unclosed\n\nEnd.")
    assert got[1].text == got[2].text == "" and len(got) == 6 and all(r.n_chars == len(r.text) for r in got)


def test_what_only_sounds_hidden_changes_nothing(trees, spark):
    """Styles and classes with the word in them; a hidden attribute is found."""
    sources = [r.html for r in spark.read.parquet(f"{FOLDER}/pages.parquet").limit(60).collect()]

    def texts(change):
        rows = [(i, "", change(s)) for i, s in enumerate(sources)]
        return {r.page_id: r.text for r in html_extraction.extract(spark.createDataFrame(rows, "page_id long, url string, html string"), trees).collect()}
    def around(attribute):
        return lambda s: re.sub(r"(<body[^>]*>)(.*)(</body>)", rf"\1<div{attribute}>\2</div>\3", s, flags=re.S | re.I)
    plain = texts(around(""))
    assert sum(map(len, plain.values())) > 1_000
    for attribute in (' style="overflow:hidden"', ' class="not-hidden"', ' class="overflow-hidden"', ' data-hidden="1"', " title='x hidden y'"):
        assert texts(around(attribute)) == plain
    words = html_extraction.attribute_words
    for attribute in (" hidden", ' hidden=""', ' style="color:red; display : none"', ' style="visibility:hidden"', " aria-hidden=true", ' class="a hidden"'):
        assert words(attribute)[1]
    assert not words(' aria-hidden="false"')[1]


def test_links_go_on_across_blocks():
    def links(source):
        return [(n.tag, n.own, n.links) for n in html_extraction.parse(source).nodes]
    assert links('<a href="/x"><div>text</div></a><div>more</div>') == [("body", 0, 0), ("div", 4, 4), ("div", 4, 0)]
    assert links('<p><a href=z>one<p>two</p>') == [("body", 0, 0), ("p", 3, 3), ("p", 3, 0)]
    assert links('<div><a href=z><p>one</div><p>two') == [("body", 0, 0), ("div", 0, 0), ("p", 3, 3), ("p", 3, 0)]
    assert links('<a name="here"><p>text</p></a>') == [("body", 0, 0), ("p", 4, 0)]


def test_articles_of_the_given_pages(trees, spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    for r in html_extraction.extract(pages, trees).join(pages.select("page_id", "html"), "page_id").collect():
        article = r.html[r.html.index("<article>"):r.html.index("</article>")]
        text = re.sub("<[^>]+>", "", re.sub("<br>", " ", re.sub("</?(p|h1)>", "\x00", article)))
        blocks_ = [re.sub(r"\s+", " ", html_extraction.html.unescape(b)).strip() for b in text.split("\x00")]
        assert r.text == "\n\n".join(b for b in blocks_ if b)


def test_layouts_not_trained_on(trees, spark):
    g = np.random.default_rng(1234)
    sources = [r.html for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").limit(40).collect()]
    texts = [p for p in map(html_extraction.paragraphs_of, sources) if p]
    other = [t for p in texts for t in p if t.count(" ") > 4]
    exact = 0
    for p in texts:
        page = html_extraction.parse(html_extraction.layout(p[:8], other, g))
        keep = html_extraction.decode(page, trees.log_odds(html_extraction.features(page)))
        exact += all(keep[node] == (html_extraction.MINE in t) for node, t in page.runs)
    assert exact >= 0.9 * len(texts)


def test_layouts_whose_names_are_in_no_list(trees, spark):
    """Every class and id replaced by a word that no layout has."""
    g = np.random.default_rng(99)
    sources = [r.html for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").limit(80).collect()]
    texts = [p for p in map(html_extraction.paragraphs_of, sources) if p]
    other = [t for p in texts for t in p if t.count(" ") > 4]
    right = total = 0
    for p in texts:
        source = re.sub('((?:class|id)=")([^"]*)"', lambda m: m[1] + " ".join("zq" + hashlib.md5(w.encode()).hexdigest()[:6] for w in m[2].split()) + '"',
                        html_extraction.layout(p[:8], other, g))
        page = html_extraction.parse(source)
        keep = html_extraction.decode(page, trees.log_odds(html_extraction.features(page)))
        right += sum(bool(keep[node]) == (html_extraction.MINE in t) for node, t in page.runs)
        total += len(page.runs)
    assert right >= 0.9 * total


def test_names_of_a_page():
    source = '<nav class="mainMenu x-1"><a href="y" class="menu">a</a></nav><div id=side-bar title="none">b</div>'
    assert set(html_extraction.names_of(source)) == {"main", "menu", "x", "1", "side", "bar"}
    assert len(html_extraction.names_of(source, 2)) == 2


def test_a_kept_node_has_kept_ancestors():
    page = html_extraction.parse("<div><div><p>a</p></div><div><p>b</p><p>c</p></div></div>")
    keep = html_extraction.decode(page, np.array([0, -1, -5, 3, -1, 2, 2], float))
    assert keep.tolist() == [True, True, False, False, True, True, True]


def test_sample_of_long_and_missing_pages(spark):
    """All pages but five have no html or more than 50,000 characters."""
    long = "<body>" + "<p>a river and a stone</p>" * 3_000 + "</body>"
    rows = [(i, None if i % 2 else "<body><p>short page</p></body>" if i % 100 == 0 else long) for i in range(500)]
    rows += [(1000, "<p>" + "word " * 100_000 + "</p>")]
    found, _ = html_extraction.drawn(spark.createDataFrame(rows, "page_id long, html string"), 251)
    assert len(found) == 251 and all(found)
    assert sorted({len(p) for p in found}) == [1, html_extraction.PARAGRAPHS]
    assert max(sum(map(len, p)) for p in found) == html_extraction.PAGE_CHARS


@pytest.mark.parametrize("source, want", [
    ('<nav><svg class="i"/></nav><article><p>Hello</p></article>', ["Hello"]),
    ('<video-js id="v"></video-js><p>Hello</p><video src="x">none</video>', ["Hello"]),
    ("<button-group><button>Go</button></button-group><p>Hello</p>", ["Hello"]),
    ('<div><video src="x">unseen</div><p>Hello</p>', ["Hello"]),
    ('<p>One <a href="x"><svg class="i"></a> two</p><p>Hello</p>', ["One two", "Hello"]),
    ("<ul><li><canvas>x<li>Hello</ul><p>There</p>", ["Hello", "There"]),
    ('<svg><style/><title>t</title><path d="m"/><svg></svg>x</svg><p>Hello</p>', ["Hello"]),
    ("<object>a<object>b</object>c</object><select><option>x<option>y</select><p>Hello</p>", ["Hello"]),
    ("<noscript><div><p>none</p></div></noscript><p>Hello</p><script>if (a < b) '</p>'</script >there", ["Hello", "there"]),
    ("<textarea><p>x</p>", []),
    ("<iframe src='x'/>y</iframe><p>Hello</p>", ["Hello"]),
])
def test_unseen_elements(source, want):
    assert [t for _, t in html_extraction.parse(source).runs] == want


@pytest.mark.parametrize("n", [10, 48, 49, 60, 500])
def test_siblings_that_look_alike_are_counted(n):
    page = html_extraction.parse("<article><h1>a</h1>" + "<p>b</p>" * n + "</article>")
    alike = html_extraction.features(page)[:, html_extraction.N_KINDS + 13]
    assert np.allclose(alike, [1, 1, 1 / (n + 1), *[n / (n + 1)] * n])
