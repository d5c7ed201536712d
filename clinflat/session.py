"""Session settings the library relies on."""

from __future__ import annotations

import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# All of these can be changed on a running session, so ``prepare`` works on a session
# that somebody else created. Joins carry no broadcast hints: the size of a side is
# decided at run time by adaptive execution, which also splits skewed partitions.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # The JVM never compiles a method above this many bytes: wide projections of nested records
    # then run as split functions, not as one method in its interpreter.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # a bucket of one file, sorted when it was written, is not sorted again by a join or an aggregate
    "spark.sql.legacy.bucketedTableScan.outputOrdering": "true",
}

# Whether the files of an execution's shuffles go when it ends, not when the driver collects garbage.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the run-time settings to an existing session."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def get_session(app_name: str = "clinflat", **settings: str) -> SparkSession:
    """Build or fetch a session; ``settings`` use ``__`` for the dots of a Spark key."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in settings.items():
        builder = builder.config(key.replace("__", "."), value)
    return prepare(builder.getOrCreate())


def shared_folder(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir, which all executors share. Where that is unset, a folder
    is made, on a local master only."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="clinflat-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


def remove_folder(spark: SparkSession, path: str) -> None:
    """Remove a folder that this library has made, on whatever file system it lies."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


@contextmanager
def shuffles_cleared(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of what is written within go as soon as it is written.

    For tables that are written once and then read from their files: a DataFrame that is made
    within and executed twice would compute its shuffles again.
    """
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)
