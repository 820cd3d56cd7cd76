"""Session settings and the shared working folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager
from functools import lru_cache

from pyspark.sql import SparkSession

# Runtime SQL settings the library relies on. The number of shuffle partitions
# is left to the cluster; adaptive execution coalesces or splits from there.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # a task that writes to few partitions, as after a rebalance, need not sort its rows by them
    "spark.sql.maxConcurrentOutputFileWriters": "16",
    # a raw record is written and read as the bytes it is: it is written once, and taking it apart into columns
    # and putting it together again costs more than that saves in the few reads it has
    "spark.sql.variant.inferShreddingSchema": "false",
    "spark.sql.variant.pushVariantIntoScan": "false",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


@contextmanager
def adaptive(spark: SparkSession):
    """Adaptive plans for the jobs of one micro-batch; Spark turns them off in the session of a stream with keyed state."""
    key = "spark.sql.adaptive.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        # the stream itself is planned without, as its state is tied to its partitions
        spark.conf.set(key, before)


@lru_cache(maxsize=1)
def _local_dir() -> str:
    return tempfile.mkdtemp(prefix="marketflow-")


_made: list[str] = []


def release(spark: SparkSession) -> None:
    """Remove the folders that ``work_dir`` named so far; call it when their readers are done."""
    while _made:
        location = spark._jvm.org.apache.hadoop.fs.Path(_made.pop())
        location.getFileSystem(spark._jsc.hadoopConfiguration()).delete(location, True)


def work_dir(spark: SparkSession, name: str, keep: bool = False) -> str:
    """A fresh folder for one job, below the folder shared by all executors.

    ``release`` leaves a folder that is to be kept for other jobs.

    The cluster names that folder in ``spark.checkpoint.dir``. A session without
    the setting gets a local folder when it runs on one machine, and an error
    when it does not: other executors could not see that folder.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        shared = _local_dir()
    location = os.path.join(shared, f"{name}-{uuid.uuid4().hex[:12]}")
    if not keep:
        _made.append(location)
    return location
