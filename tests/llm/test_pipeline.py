"""The pipeline's stages against plain Python, stage by stage, on the smallest documents and on odd rows."""

import hashlib
from collections import Counter

import pytest

import corpus_pipeline
from ripple.llm import language_id
from ripple.llm.bpe import encoder
from ripple.llm.common import Scratch

from test_llm_operators import SCHEMA, SPACE, check_pieces, classes_of, sample

FOLDER = "/root/testdata/sf0.001"


def exact(rows):
    best = {}
    for r in rows:
        key = "".join(c for c in r[1] or "" if c not in SPACE)
        rank = (-len(r[1] or ""), (1 << 63) if r[0] is None else r[0])
        if key not in best or rank < best[key][0]:
            best[key] = (rank, r)
    return [r for _, r in best.values()]


def near(rows):
    first = {}
    for r, (_, c) in zip(rows, classes_of([(r[0], r[1]) for r in rows])):
        key = (r[0] is not None, r[0] or 0, hashlib.md5((r[1] or "").encode()).hexdigest())
        if c not in first or key < first[c][0]:
            first[c] = (key, r)
    return [r for _, r in first.values()]


def mixed(rows):
    size = {id(r): len((r[1] or "").split()) for r in rows}
    total = Counter()
    for r in rows:
        total[r[3]] += size[id(r)]
    order = sorted(s for s in total if s is not None) + [None] * (None in total)
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    full, budget = set(), sum(total.values())
    while True:
        left, over = budget - sum(3 * total[s] for s in full), sum(weight[s] for s in total if s not in full)
        more = {s for s in total if s not in full and left * weight[s] / over > 3 * total[s]} if over else set()
        if not more:
            break
        full |= more
    out = []
    for s in total:
        target = round(3 * total[s] if s in full else left * weight[s] / over)
        key = lambda r: hashlib.md5(f"mix-1:{'null' if r[0] is None else r[0]}".encode()).hexdigest()
        own = sorted((r for r in rows if r[3] == s), key=lambda r: (key(r), size[id(r)]))
        epochs, rest = divmod(target, total[s]) if total[s] else (0, 0)
        for r in own:
            n = size[id(r)]
            out += [(r[0], r[1])] * (epochs if n else 0)
            if n and rest > 0:
                out.append((r[0], r[1] if rest >= n else " ".join(r[1].split()[:rest])))
                rest -= min(n, rest)
    return out


@pytest.fixture(scope="module", params=["documents", "odd rows"])
def stages(request, spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet") if request.param == "documents" \
        else spark.createDataFrame([r for r in sample() if r[0] not in (109, 110)], SCHEMA)
    scratch, found = Scratch(spark, "test"), [docs]
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        found.append(scratch.save(stage(spark, found[-1], FOLDER), str(i)))
    return spark, found


def rows_of(df):
    return [tuple(r) for r in df.select(*corpus_pipeline.COLUMNS).collect()]


def test_language_stage_drops_what_the_model_rejects(stages):
    spark, (docs, kept, *_) = stages
    model = language_id.train(docs, Scratch(spark, "test"))
    rows = rows_of(docs)
    want = [r for r, (_, _, rejected, _) in zip(rows, model.predict([r[1] for r in rows])) if not rejected]
    assert Counter(rows_of(kept)) == Counter(want) and len(want) > 0.8 * len(rows) - 8


def test_dedup_stages(stages):
    _, (_, known, single, distinct, *_) = stages
    assert Counter(rows_of(single)) == Counter(exact(rows_of(known)))
    assert Counter(rows_of(distinct)) == Counter(near(rows_of(single)))


def test_mixing_stage(stages):
    _, (_, _, _, distinct, mix, _) = stages
    assert Counter((r[0], r[1]) for r in rows_of(mix)) == Counter(mixed(rows_of(distinct)))
    assert all(r[4] == len(r[1]) for r in rows_of(mix))


def test_packing_stage(stages):
    _, (*_, mix, pieces) = stages
    got = pieces.toPandas()
    check_pieces(got, [(r[0], r[1]) for r in rows_of(mix)], 1024)
    assert got.length.sum() == sum(len(encoder().ids(r[1] or "")) + 1 for r in rows_of(mix))


def test_empty_documents(spark):
    docs = spark.createDataFrame([], SCHEMA)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, FOLDER)
        assert docs.count() == 0
