"""Label propagation and ranks against hand-worked cases and a plain-Python model."""

import random
from collections import defaultdict

import pytest

from ripple.operators import edges, feeds, propagation, rank
from ripple.session import Scratch


def model(seeds, links, rounds=15, threshold=0.15):
    """The rules in plain Python: normalise what arrives, hold seeds at 1, stop before keeping the new state."""
    state = {(s, s): 1.0 for s in seeds}
    for i in range(rounds):
        got = defaultdict(float)
        for (node, label), w in state.items():
            for src, dst, share in links:
                if src == node:
                    got[dst, label] += w * share
        total = defaultdict(float)
        for (node, _), w in got.items():
            total[node] += w
        new = {k: w / total[k[0]] for k, w in got.items()}
        new.update({(s, s): 1.0 for s in seeds})
        both = state.keys() & new.keys()
        if i > 0 and all(abs(state[k] - new[k]) <= threshold for k in both):
            return state
        state = new
    return state


def frame(spark, links):
    return spark.createDataFrame(links, "src string, dst string, w double")


def seeds_of(spark, names):
    return spark.createDataFrame([(n,) for n in names], "node string")


def result(df):
    return {(r.node, r.label): r.w for r in df.collect()}


def random_graph(seed, n=14, m=45):
    rng = random.Random(seed)
    links = {(f"n{rng.randrange(n)}", f"n{rng.randrange(n)}") for _ in range(m)}
    # a hub with an edge to and from a third of all nodes
    links |= {("n0", f"n{i}") for i in range(1, n, 2)} | {(f"n{i}", "n0") for i in range(1, n, 2)}
    return [(a, b, rng.choice([0.1, 0.25, 0.3, 1.0])) for a, b in sorted(links)]


def one_hop(spark):
    friends = spark.createDataFrame([("a", "a"), ("b", "b")], "username string, friend string")
    likes = spark.createDataFrame([], "userid string, url string")
    interests = spark.createDataFrame([("a", "X"), ("b", "X")], "username string, interest string")
    news = spark.createDataFrame([("n1", "X", "2017-12-21")], "url string, category string, date string")
    return edges.weighted_edges(edges.friend_edges(friends), edges.like_edges(likes), edges.interest_edges(interests),
                                edges.article_edges(edges.news_for_date(news, "2017-12-21"))), news


def test_weights_by_hand(spark):
    graph, _ = one_hop(spark)
    assert {(r.src, r.dst): r.w for r in graph.collect()} == pytest.approx({
        ("a", "X"): 0.3, ("b", "X"): 0.3, ("X", "a"): 0.15, ("X", "b"): 0.15, ("n1", "X"): 1.0, ("X", "n1"): 1.0})


def test_stop_returns_the_state_before(spark):
    graph, news = one_hop(spark)
    labels = propagation.propagate(seeds_of(spark, ["a", "b"]), graph)
    assert result(labels) == pytest.approx({("X", "a"): 0.5, ("X", "b"): 0.5, ("a", "a"): 1.0, ("b", "b"): 1.0})
    assert propagation.recommendations(labels, news).count() == 0


def test_article_with_two_categories_sends_whole_weight_to_each(spark):
    none = spark.createDataFrame([], "src string, dst string")
    articles = spark.createDataFrame([("n", "X"), ("n", "Y")], "src string, dst string")
    graph = edges.weighted_edges(none, none, none, articles)
    assert {r.w for r in graph.filter("kind = 'article_category'").collect()} == {1.0}


# every state is replayed, none written
REPLAYED = {"state_bytes": 0, "labels": 2}


@pytest.mark.parametrize("seed, threshold, rounds", [(1, 0.15, 6), (2, 0.02, 6), (2, -1.0, 1), (2, -1.0, 0), (2, -1.0, 3)])
def test_replayed_states_same_as_the_model(spark, monkeypatch, seed, threshold, rounds):
    """States that are too large to be written: nothing of them is, and both states are those of the model."""
    saved = []
    save = Scratch.save
    monkeypatch.setattr(Scratch, "save", lambda self, df, name, *options: saved.append(name) or save(self, df, name, *options))
    links, seeds = random_graph(seed), ["n0", "n3", "n5", "alone"]
    before, after = propagation.last_two(seeds_of(spark, seeds), frame(spark, links), rounds, threshold, **REPLAYED)
    assert [x for x in saved if x.startswith("state-")] == ["state-0"]
    assert result(after) == pytest.approx(model(seeds, links, rounds, threshold))
    if threshold < 0:
        assert result(before) == pytest.approx(model(seeds, links, max(rounds - 1, 0), threshold))
    keep = spark.createDataFrame([("n2",), ("n4",), ("n99",)], "node string")
    some = result(propagation.propagate(seeds_of(spark, seeds), frame(spark, links), rounds, threshold, keep, **REPLAYED))
    assert some == pytest.approx({k: w for k, w in model(seeds, links, rounds, threshold).items() if k[0] in ("n2", "n4")})


def test_names_are_put_in_without_a_join(spark):
    """A join of the pairs with the names would shuffle a row per pair."""
    for sizes in ({}, REPLAYED):
        labels = propagation.propagate(seeds_of(spark, ["n0", "n1"]), frame(spark, random_graph(5)), **sizes)
        assert "Join" not in labels._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("sizes", [{}, REPLAYED, {"local_nodes": 0, "part_nodes": 4, "labels": 2}], ids=str)
@pytest.mark.parametrize("rounds", [0, 1, 3])
def test_packed_states_have_the_delta_of_their_pairs(spark, sizes, rounds):
    """Also where a seed has no name, whose pair is equal to none."""
    seeds = seeds_of(spark, ["n0", "n3", "n5", "alone", None])
    before, after = propagation.last_two(seeds, frame(spark, random_graph(9)), rounds=rounds, threshold=-1.0, packed=True, **sizes)
    for threshold in (-1.0, 0.05):
        packed = propagation.label_delta(before, after, threshold)
        want = propagation.label_delta(before.pairs(), after.pairs(), threshold)
        assert packed.dtypes == want.dtypes
        assert tuple(packed.first()) == pytest.approx(tuple(want.first()))


def test_delta_of_packed_states_without_pairs_is_null(spark):
    before, after = propagation.last_two(seeds_of(spark, []), frame(spark, []), rounds=2, threshold=-1.0, packed=True)
    assert tuple(propagation.label_delta(before, after).first()) == (0, None)


SPREAD = [{}, {"labels": 1}, {"local_nodes": 0, "part_nodes": 4, "labels": 2}, {"local_nodes": 0, "part_nodes": 100, "labels": 3}]


@pytest.mark.parametrize("seed, threshold", [(1, 0.15), (2, 0.02)])
@pytest.mark.parametrize("sizes", SPREAD, ids=str)
def test_same_as_the_model(spark, seed, threshold, sizes):
    """In one part and in several, with one block of labels and with several."""
    links = random_graph(seed)
    seeds = ["n0", "n3", "n5", "alone"]
    got = result(propagation.propagate(seeds_of(spark, seeds), frame(spark, links), rounds=6, threshold=threshold, **sizes))
    assert got == pytest.approx(model(seeds, links, 6, threshold))


@pytest.mark.parametrize("sizes", SPREAD[::2], ids=str)
def test_packed_rows_are_cut_without_changing_results(spark, monkeypatch, sizes):
    """Few edges to a packed row, few products at a time; repeated edges add up."""
    for module in ("PACKED_EDGES", "CELLS"):
        monkeypatch.setattr(propagation, module, 5)
    links = random_graph(3) + [("n0", "n1", 0.5), ("n0", "n1", 0.25)]
    seeds = ["n0", "n1", "n2"]
    got = result(propagation.propagate(seeds_of(spark, seeds), frame(spark, links), rounds=4, **sizes))
    assert got == pytest.approx(model(seeds, links, 4))


def test_last_two_states_and_nothing_to_do(spark):
    links, seeds = random_graph(6), ["n0", "n1"]
    before, after = propagation.last_two(seeds_of(spark, seeds), frame(spark, links), rounds=3, threshold=-1.0)
    assert result(before) == pytest.approx(model(seeds, links, 2, -1.0))
    assert result(after) == pytest.approx(model(seeds, links, 3, -1.0))
    assert result(propagation.propagate(seeds_of(spark, []), frame(spark, links))) == {}
    assert result(propagation.propagate(seeds_of(spark, ["a"]), frame(spark, []))) == {("a", "a"): 1.0}


def test_state_has_a_row_per_block_and_not_per_pair(spark):
    """A tenth and less of the rows that single pairs would be."""
    links = [(f"n{i}", f"n{(i * k + 1) % 400}", 0.5) for i in range(400) for k in (2, 3, 7)]
    seeds = [f"n{i}" for i in range(0, 400, 2)]
    run = Scratch(spark, "test")
    graph = propagation._Graph(run.save(frame(spark, links), "edges"), seeds_of(spark, seeds), run, propagation.LOCAL_NODES,
                               propagation.PART_NODES, propagation.LABELS)
    state = graph.first()
    for i in range(3):
        state = run.save(graph.next(state), f"state-{i}")
    assert state.count() * 10 < graph.pairs(state, None).count()


@pytest.mark.parametrize("sizes", [{}, {"local_nodes": 0, "part_nodes": 4, "labels": 2}], ids=str)
def test_standing_state_equals_the_full_run_after_each_batch(spark, sizes):
    """Four batches of changes: new seeds, new edges and nodes, changed weights, a seed that goes."""
    links = {(a, b): w for a, b, w in random_graph(8)}
    batches = [({}, {"n0", "n3"}), ({("n0", "new1"): 0.3, ("new1", "n2"): 0.5}, {"n0", "n3", "n5"}),
               ({("n0", "n1"): 0.9}, {"n0", "n3", "n5", "new1", "alone"}), ({}, {"n3", "n5", "new1"}), ({("n2", "x"): 1.0}, {"n3", "n5", "new1", "x"})]
    standing = propagation.Standing(rounds=5, threshold=0.05, **sizes)
    for changes, seeds in batches:
        links |= changes
        rows = [(a, b, w) for (a, b), w in links.items()]
        got = result(standing.update(seeds_of(spark, sorted(seeds)), frame(spark, rows)))
        assert got == pytest.approx(model(seeds, rows, 5, 0.05))


def test_standing_state_that_is_too_large_is_not_kept(spark, monkeypatch):
    """The same results as the full run after each batch, without a written state, also when states grow beyond the limit."""
    saved = []
    save = Scratch.save
    monkeypatch.setattr(Scratch, "save", lambda self, df, name, *options: saved.append(name) or save(self, df, name, *options))
    rows = random_graph(8)
    for limit, written in ((0, 0), (15 * 8 * 3, 5)):
        saved.clear()
        standing = propagation.Standing(rounds=5, threshold=-1.0, labels=2, state_bytes=limit)
        for seeds in (["n0", "n3"], ["n0", "n3", "n5", "n6"], ["n0", "n3", "n5", "n6", "n7"]):
            got = result(standing.update(seeds_of(spark, seeds), frame(spark, rows)))
            assert got == pytest.approx(model(seeds, rows, 5, -1.0))
        assert sum(x.startswith("state-") and x != "state-0" for x in saved) == written


def test_work_falls_with_what_a_change_reaches(spark):
    """Twenty groups without edges between them: a change in one leaves the nodes of the others alone."""
    rows = [(f"g{k}-{a[1:]}", f"g{k}-{b[1:]}", w) for k in range(20) for a, b, w in random_graph(k, n=8, m=15)]
    seeds = sorted({f"g{k}-{i}" for k in range(20) for i in (0, 3)})
    standing = propagation.Standing(rounds=4, threshold=-1.0)
    standing.update(seeds_of(spark, seeds), frame(spark, rows))
    assert all(done == all_ for done, all_ in standing.computed)
    for changed, more in (((rows[0][0], rows[0][1], 0.77), ["g5-4"]), ((rows[-1][0], rows[-1][1], 0.11), [])):
        rows, seeds = [changed if r[:2] == changed[:2] else r for r in rows], seeds + more
        got = result(standing.update(seeds_of(spark, seeds), frame(spark, rows)))
        assert got == pytest.approx(model(seeds, rows, 4, -1.0))
        assert all(done <= 2 * 8 < all_ / 5 for done, all_ in standing.computed)
    standing.update(seeds_of(spark, seeds), frame(spark, rows))
    assert [done for done, _ in standing.computed] == [0] * 4       # nothing has changed


def test_weights_add_up(spark):
    seeds = {"n0", "n3"}
    got = result(propagation.propagate(seeds_of(spark, seeds), frame(spark, random_graph(4)), rounds=3))
    for node in {n for n, _ in got}:
        total = sum(w for (n, label), w in got.items() if n == node and n != label)
        assert total <= 1 + 1e-9
        if node in seeds:
            assert got[node, node] == 1.0
        else:
            assert total == pytest.approx(1.0)


def test_keep_only_cuts_the_output(spark):
    links, seeds = random_graph(5), ["n0", "n1"]
    keep = spark.createDataFrame([("n2",), ("n4",), ("n99",)], "node string")
    got = result(propagation.propagate(seeds_of(spark, seeds), frame(spark, links), rounds=3, keep=keep))
    whole = model(seeds, links, 3)
    assert got == pytest.approx({k: w for k, w in whole.items() if k[0] in ("n2", "n4")})


def test_label_delta_looks_at_common_pairs_only(spark):
    schema = "node string, label string, w double"
    before = spark.createDataFrame([("a", "x", 0.5), ("b", "x", 0.1), ("c", "x", 0.9)], schema)
    after = spark.createDataFrame([("a", "x", 0.65), ("b", "x", 0.4), ("d", "x", 0.9)], schema)
    moved, largest = propagation.label_delta(before, after, 0.2).first()
    assert moved == 1 and largest == pytest.approx(0.3)


def test_news_feed_ties_go_by_url_and_missing_news_leave_a_slot(spark):
    recs = spark.createDataFrame([("u", x, w) for x, w in
                                  [("d", 1.0), ("b", 1.0), ("a", 0.5), ("c", 2.0), ("e", 0.1), ("f", 0.2)]],
                                 "username string, url string, weight double")
    news = spark.createDataFrame([("c", "h", "X", "2017-12-21")],
                                 "url string, headline string, category string, date string")
    out = feeds.news_feed(recs, news).orderBy("place").collect()
    assert [r.url for r in out] == ["c", "b", "d", "a", "f"]
    assert [r.headline for r in out] == ["h", None, None, None, None]


# -- ranks -------------------------------------------------------------------------

def network(spark, links):
    return spark.createDataFrame(links, "src bigint, dst bigint")


def test_rank_by_hand(spark):
    plain = network(spark, [(1, 2), (1, 3), (2, 3)])
    full = edges.add_backlinks(plain, edges.sinks(plain))
    assert sorted(map(tuple, full.collect())) == [(1, 2), (1, 3), (2, 3), (3, 1), (3, 2)]
    got = {r.v: r.r for r in rank.social_rank(full).collect()}
    assert got == pytest.approx({1: 0.575, 2: 1.0, 3: 1.425})


@pytest.mark.parametrize("chunk_rows", [1_000_000, 2])
def test_rank_same_as_the_model(spark, chunk_rows):
    rng = random.Random(7)
    links = sorted({(rng.randrange(12), rng.randrange(12)) for _ in range(30)} | {(0, i) for i in range(1, 12)})
    out = defaultdict(int)
    for src, _ in links:
        out[src] += 1
    ranks = dict.fromkeys(out, 1.0)
    for _ in range(25):
        got = defaultdict(float)
        for src, dst in links:
            if src in ranks:
                got[dst] += ranks[src] / out[src]
        new = {v: 0.15 + 0.85 * w for v, w in got.items()}
        moved = [abs(new[v] - ranks[v]) for v in new.keys() & ranks.keys()]
        ranks = new
        if not any(m >= 0.05 for m in moved):
            break
    result = {r.v: r.r for r in rank.social_rank(network(spark, links), dmax=0.05, chunk_rows=chunk_rows).collect()}
    assert result == pytest.approx(ranks)


@pytest.mark.parametrize("sizes", [{}, {"part_nodes": 3, "chunk_rows": 2}], ids=str)
def test_packed_ranks_equal_those_by_joins(spark, monkeypatch, sizes):
    """Repeated edges, vertices that are null, a vertex that all have an edge to; a round is one stage and shuffles nothing."""
    rng = random.Random(11)
    links = [(rng.randrange(20), rng.randrange(20)) for _ in range(60)] + [(i, 0) for i in range(20)] + [(3, None), (None, 4), (None, None), (3, None)]
    rounds = []
    monkeypatch.setattr(rank, "_round", lambda *a, f=rank._round: rounds.append(1) or f(*a))
    for most, dmax in ((0, 0.001), (1, 0.001), (3, 0.0), (25, 0.01)):
        want = {r.v: r.r for r in rank.social_rank(network(spark, links), most, dmax, local_nodes=0).collect()}
        assert bool(rounds) == bool(most)
        rounds.clear()
        got = {r.v: r.r for r in rank.social_rank(network(spark, links), most, dmax, **sizes).collect()}
        assert got == pytest.approx(want) and not rounds
    assert rank.social_rank(network(spark, []), dmax=0.1).collect() == []
    assert rank.social_rank(network(spark, [(None, None)]), dmax=0.1).collect() == []
    names = spark.createDataFrame([("a", "b"), ("b", "a"), ("a", "c")], "src string, dst string")
    assert rank.social_rank(names, 3).dtypes == [("v", "string"), ("r", "double")]


def test_top_ranks_break_ties_by_vertex(spark):
    ranks = spark.createDataFrame([(3, 1.0), (1, 1.0), (2, 5.0)], "v bigint, r double")
    assert [r.v for r in rank.top_ranks(ranks, 2).collect()] == [2, 1]


def test_degrees_and_stats(spark):
    plain = network(spark, [(1, 2), (1, 2), (2, 3)])
    assert sorted(map(tuple, edges.degree_table(plain).collect())) == [(1, 2, 0), (2, 1, 2), (3, 0, 1)]
    assert tuple(edges.graph_stats(plain).first()) == (3, 3)
    assert [r.v for r in edges.sinks(plain).collect()] == [3]


def test_shared_ids(spark):
    one, two = seeds_of(spark, ["a", "SPORTS"]), seeds_of(spark, ["SPORTS", "SPORTS", "x"])
    assert [r.node for r in edges.shared_ids(one, seeds_of(spark, ["u"]), two).collect()] == ["SPORTS"]
