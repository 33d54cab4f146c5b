"""Every query that has SQL, on the smallest data folder, row for row."""

import sys
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1] / "tools"))

import __spark_entry__ as entry  # noqa: E402
from compare import TABLES, differences  # noqa: E402
from ripple.plans import oracles, registry  # noqa: E402

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    return connection


@pytest.mark.parametrize("name", list(entry.oracle_sql()))
def test_query(spark, duck, name):
    got = entry.queries()[name](spark, FOLDER).toArrow()
    assert differences(duck, got, entry.oracle_sql()[name]) == (0, 0)


def test_every_query_has_sql():
    assert set(registry.queries()) == set(oracles.oracle_sql())


def test_stems_in_sql(duck):
    """The SQL's stemmer against the Python one, on the words of the data and on all suffixes."""
    from ripple.functions.porter import STEP_2, STEP_3, STEP_4, stem
    from ripple.plans.porter_sql import stems
    words = {w for (t,) in duck.execute("SELECT lower(text) FROM documents").fetchall() for w in t.split()}
    words |= {a + b + c for a in ("", "st", "tro", "motiv", "yay", "happ", "cony", "sky", "fizz") for b in ("", "al", "y", "e", "ll")
              for c in ("", "s", "ed", "ing", "eed", *STEP_2, *STEP_3, *STEP_4)} - {""}
    duck.execute("CREATE OR REPLACE TEMP TABLE some_words AS SELECT unnest($1::VARCHAR[]) AS word", [sorted(words)])
    got = dict(duck.execute(f"WITH {', '.join(stems('some_words'))} SELECT word, stem FROM stems").fetchall())
    assert got == {w: stem(w) for w in words}


def test_entry(spark):
    assert entry.entry(spark).columns == ["username", "place", "url", "weight", "headline", "category", "date"]
