"""Session settings and the shared working folder."""

from __future__ import annotations

import sys
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import cloudpickle
from pyspark.sql import SparkSession

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

SMALL_TASKS = {
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "512",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4m",
    "spark.sql.files.maxPartitionBytes": "16m",
}


def build(app: str = "cratedig", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings every job here relies on."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    for key, value in {**defaults, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ship_with_jobs(module_name: str) -> None:
    """Sends a module's functions along with the tasks that use them, so that executors need no installed copy."""
    cloudpickle.register_pickle_by_value(sys.modules[module_name])


def ensure_utc(spark: SparkSession) -> SparkSession:
    """All stored timestamps are UTC; pin the session zone when it differs."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def ensure_small_tasks(spark: SparkSession) -> SparkSession:
    """Files are read in small pieces, shuffles are cut fine and merged by size, so that a task's memory stays the same as tables grow.

    Ids and numbers shrink to a tenth in a shuffle file: the default of 64 MB is millions of rows to sort. A task that
    deals rows out holds all rows of its piece of a file: the default of 128 MB is ten million rows of ids. What the
    session sets itself is kept.
    """
    for key, value in SMALL_TASKS.items():
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, value)
    return spark


FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Within it, shuffle files go when the job that made them ends; otherwise they stay until the driver collects its garbage.

    For jobs that write a table whose rows are then read from there.
    """
    before = spark.conf.get(FREED, None)
    spark.conf.set(FREED, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(FREED)
        else:
            spark.conf.set(FREED, before)


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, as the cluster names it.

    Only a local session without that setting gets a temporary folder; on a
    cluster a machine-local folder would lose data with its executor.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    made = tempfile.mkdtemp(prefix="spark-")
    spark.conf.set("spark.checkpoint.dir", made)
    return made


def scratch(spark: SparkSession, label: str) -> str:
    """A fresh sub-folder of the shared folder for one run."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
