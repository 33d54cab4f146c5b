"""Snapshots brought up to date against full folds, with late rows; one-key pages; many texts of people search."""

import random

import pytest
from pyspark.sql import functions as F

from ripple.operators import people, snapshots, state
from ripple.session import Scratch
from ripple.sources import tables


def room_log(spark, seed, late):
    """Rows in the order of event ids; some carry a time from long before."""
    g = random.Random(seed)
    rows = [(i, i * 10 - (g.randrange(600) if g.random() < late else 0), f"u{g.randrange(4)}", f"r{g.randrange(5)}", g.choice(["JOIN", "JOIN", "LEAVE"]))
            for i in range(150)]
    return spark.createDataFrame(rows, "event_id bigint, ts bigint, username string, room string, op string")


@pytest.mark.parametrize("late", [0.0, 0.1, 0.6])
def test_three_snapshots_of_rooms(spark, rows, late):
    log, keys = room_log(spark, 3, late), ["username", "room"]
    run = Scratch(spark, "test")
    cuts = snapshots.thirds(log)
    assert len(cuts) == 3 and cuts[-1] == 149
    snapshot, before = None, None
    for i, cut in enumerate(cuts):
        part = snapshots.up_to(log, cut)
        snapshot = snapshots.presences(part, keys, "JOIN") if snapshot is None else \
            snapshots.advance_presences(snapshot, part, before, keys, "JOIN")
        snapshot, before = run.save(snapshot, f"snapshot-{i}"), cut
        assert rows(snapshots.present(snapshot, keys)) == rows(state.room_state(part))
        # the snapshot itself is that of the whole log so far, so the next step starts right
        assert rows(snapshot) == rows(snapshots.presences(part, keys, "JOIN"))


def test_keys_without_late_rows_do_not_read_the_old_log(spark, rows):
    log, keys = room_log(spark, 4, 0.0), ["username", "room"]
    first, second, _ = snapshots.thirds(log)
    snapshot = Scratch(spark, "test").save(snapshots.presences(snapshots.up_to(log, first), keys, "JOIN"), "s")
    # old rows that nobody looks at any more
    spoiled = log.withColumn("op", F.when(F.col("event_id") <= first, "LEAVE").otherwise(F.col("op")))
    got = snapshots.advance_presences(snapshot, snapshots.up_to(spoiled, second), first, keys, "JOIN")
    assert rows(got) == rows(snapshots.presences(snapshots.up_to(log, second), keys, "JOIN"))


def test_snapshots_of_newest_values(spark, rows):
    g = random.Random(1)
    log = spark.createDataFrame([(i, g.randrange(50), f"u{g.randrange(5)}", g.choice("ab"), str(i)) for i in range(120)],
                                "event_id bigint, ts bigint, username string, field string, value string")
    keys, cuts = ["username", "field"], snapshots.thirds(log)
    snapshot = snapshots.newest_rows(snapshots.up_to(log, cuts[0]), keys, "value")
    for before, cut in zip(cuts, cuts[1:]):
        snapshot = snapshots.advance_newest(snapshot, snapshots.up_to(log, cut).filter(F.col("event_id") > before), keys, "value")
    assert rows(snapshot.select(*keys, "value")) == rows(state.profile_latest(log))
    assert snapshots.thirds(log.limit(0)) == []


def test_many_search_texts(spark, rows):
    names = [("Nation_1", "Building"), ("Nation_10", "Building"), ("Anna", "Lee"), ("Élodie", "Åberg"), ("Bo", "X"), ("Annabel", "Lee-smith"), (None, "Lee")]
    users = spark.createDataFrame([(f"u{i}", *names[i % len(names)]) for i in range(30)], "username string, firstname string, lastname string")
    texts = ["nation_1 build", "ANNA", "anna lee extra", "", " ", " lee", "bo x", "b", "zzz", "anna zzz", "élodie åb", "nation_10 building", "anna", "o "]
    got = people.people_search_each(users, spark.createDataFrame([(t,) for t in [*texts, texts[0]]], "text string"))
    want = [(t, r.username, r.firstname, r.lastname) for t in texts for r in people.people_search(users, t).collect()]
    assert rows(got) == sorted(want, key=repr)


def test_rows_of_a_few_keys_come_from_their_buckets(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(f"u{i % 90}", i) for i in range(900)], "name string, n int")
    tables.write_keyed(df, path, "name")
    keys = spark.createDataFrame([("u3",), ("u4",), ("u3",), ("none",)], "name string")
    found = tables.lookup_each(spark, path, "name", keys)
    assert rows(found) == rows(df.filter("name in ('u3', 'u4')").select(*found.columns))
