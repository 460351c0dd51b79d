"""Session defaults and the shared folder for tables a job writes on the way."""

from __future__ import annotations

import tempfile
from collections.abc import Iterator
from contextlib import contextmanager
from math import ceil

from pyspark.sql import SparkSession

_LOCAL_SCRATCH: dict[str, str] = {}

# A shuffle partition of this size is sorted or hashed in the memory of one task.
PARTITION_BYTES = 256 * 2**20
# Rows of snapshots in memory, unpivoted, take about so many times their size in compressed files.
FILE_EXPANSION = 32
# What adaptive execution merges partitions up to, in compressed bytes: some hundred megabytes as
# rows, however large the input, so that a task sorts and hashes in memory. Where all partitions of
# a join's side are smaller, it is hashed and the other side need not be sorted.
TASK_BYTES = 16 * 2**20


def build_session(app_name: str = "tidemark", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution on: it coalesces, splits skewed join and write
    partitions, and turns a join into a broadcast only after the side's size was measured."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
        # Dimensions of some million rows are broadcast rather than the fact table shuffled. The
        # limit is for rows in memory; text takes about four times its size in compressed files.
        "spark.sql.autoBroadcastJoinThreshold": "64MB",
        "spark.sql.sources.fileCompressionFactor": "4.0",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
    }
    for key, value in {**defaults, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shuffle_partitions(configured: int, input_bytes: int) -> int:
    """Partitions for shuffling about ``input_bytes``; never fewer than configured. Adaptive
    execution merges what turns out too small, but cannot divide an aggregation's partitions."""
    return max(configured, ceil(input_bytes / PARTITION_BYTES))


@contextmanager
def sized_shuffles(spark: SparkSession, input_bytes: int) -> Iterator[None]:
    """Within, shuffles are sized for ``input_bytes`` of input."""
    key = "spark.sql.shuffle.partitions"
    sized = {
        key: shuffle_partitions(int(spark.conf.get(key)), input_bytes),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": TASK_BYTES,
        "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": TASK_BYTES,
    }
    configured = {name: spark.conf.get(name) for name in sized}
    for name, value in sized.items():
        spark.conf.set(name, str(value))
    try:
        yield
    finally:
        for name, value in configured.items():
            spark.conf.set(name, value)


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local master may go without the setting; there a temporary folder serves."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_SCRATCH:
        _LOCAL_SCRATCH[app] = tempfile.mkdtemp(prefix="tidemark-")
    return _LOCAL_SCRATCH[app]
