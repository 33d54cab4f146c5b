import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from ripple.session import prepare  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "4") \
        .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false") \
        .config("spark.driver.memory", "8g").getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield prepare(session)
    session.stop()


@pytest.fixture(scope="session")
def rows():
    """Rows of a DataFrame as sorted tuples."""
    return lambda df: sorted((tuple(r) for r in df.collect()), key=repr)
