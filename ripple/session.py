"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_SETTINGS = {
    # a token that is no number fails instead of turning into a null
    "spark.sql.ansi.enabled": "true",
    # parquet timestamps carry no zone; every epoch value is taken in UTC
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    # splits an oversized join partition; the forced variant also does so
    # where that costs one more shuffle after the join
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}

_shipped: set[str] = set()


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the run-time settings the operators rely on, and send this package to the Python workers."""
    for key, value in _SETTINGS.items():
        spark.conf.set(key, value)
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        package = Path(__file__).parent
        # one small upload per application, as --py-files would do
        folder = tempfile.mkdtemp(prefix="ripple-package-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        context.addPyFile(shutil.make_archive(f"{folder}/{package.name}", "zip", package.parent, package.name))
        _shipped.add(context.applicationId)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by the cluster.

    Without the setting it is a folder beside the tables of the warehouse, which all executors share too.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/ripple-scratch"


def delete(spark: SparkSession, path: str) -> None:
    """Delete a folder on whatever file system it is."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def subfolders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in a folder; none if it is absent."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not files.exists(place):
        return []
    return [s.getPath().getName() for s in files.listStatus(place) if s.isDirectory()]


def exists(spark: SparkSession, path: str) -> bool:
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(place)


_runs: list[tuple[SparkSession, str]] = []


@atexit.register
def _delete_runs() -> None:
    """What lazily read results still needed goes when the application ends."""
    for spark, root in _runs:
        if spark.sparkContext._jsc is not None:
            delete(spark, root)


class Scratch:
    """Written tables of one run, in a folder of their own under the shared folder.

    Writing a table cuts lineage and survives the loss of an executor. What is left of a run is deleted when
    the application ends.
    """

    def __init__(self, spark: SparkSession, purpose: str):
        self.spark = spark
        self.root = f"{shared_dir(spark)}/{purpose}-{uuid.uuid4().hex}"
        _runs.append((spark, self.root))

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def save(self, df: DataFrame, name: str, options: dict[str, str] | None = None) -> DataFrame:
        """Write ``df`` and return it as read back from the written files."""
        df.write.mode("overwrite").options(**(options or {})).parquet(self.path(name))
        return self.spark.read.schema(df.schema).parquet(self.path(name))

    def drop(self, name: str) -> None:
        """Delete one table of this run."""
        delete(self.spark, self.path(name))
