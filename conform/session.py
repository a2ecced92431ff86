"""Session helpers: a tuned local session for tests/bench and a shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# A join whose measured smaller side is at most that large in every shuffle partition is done by hash: neither side is sorted.
# Larger ones stay sort-merge joins, so the memory of a task is bounded.
HASH_JOIN = ("spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold", "64m")

# Tables are packed to some six bytes a row: a split of that many bytes is millions of rows, which a task can still sort or group
# in memory.
SCAN_SPLIT = ("spark.sql.files.maxPartitionBytes", "16m")

# Bytes of rows in an Arrow batch. Each task holds several batches, in the JVM and in Python, and a Python worker keeps room for the
# largest it has seen: whole texts go in smaller batches than Spark's ten thousand rows or 64 MB.
TEXT_BATCH = ("spark.sql.execution.arrow.maxBytesPerBatch", "4m")

# A query's shuffle files go when it ends. By default they stay until the driver happens to collect its garbage, so a job of several
# writes holds the shuffles of all of them.
DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

# Settings every job relies on: UTC wall clock, AQE (runtime coalescing, skew-join
# splitting, broadcast and hash joins decided from measured sizes), no UI server.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    HASH_JOIN[0]: HASH_JOIN[1],
    SCAN_SPLIT[0]: SCAN_SPLIT[1],
    TEXT_BATCH[0]: TEXT_BATCH[1],
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
}


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, app: str = "conform") -> SparkSession:
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    for k, v in BASE_CONF.items():
        builder = builder.config(k, v)
    builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    builder = builder.config("spark.driver.memory", "16g")
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@contextmanager
def dropped_shuffles(spark: SparkSession) -> Iterator[None]:
    """Inside, every query of the session drops its shuffle files when it ends; afterwards the session's own setting holds again.

    For jobs whose results are all written: a frame that is collected twice would have to shuffle again.
    """
    own = spark.conf.get(DROP_SHUFFLES, None)
    spark.conf.set(DROP_SHUFFLES, "true")
    try:
        yield
    finally:
        if own is None:
            spark.conf.unset(DROP_SHUFFLES)
        else:
            spark.conf.set(DROP_SHUFFLES, own)


def scratch_root(spark: SparkSession) -> str:
    """The shared folder for written intermediate tables.

    Uses the cluster's ``spark.checkpoint.dir``. Only a session on a local master may leave it unset (tests): a fresh
    folder is created and registered with the context, which names it from then on (the setting itself can't be
    changed in a running session). On a cluster executors would write to their own disks, so an unset folder is an error there.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        master = spark.conf.get("spark.master", "")
        if not re.fullmatch(r"local(\[[^\]]*\])?", master):
            raise RuntimeError(f"spark.checkpoint.dir must name a folder that all executors share (master {master!r})")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="conform-ckpt-"))
        root = spark.sparkContext.getCheckpointDir()
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique folder below the scratch root (never reused between calls)."""
    return f"{scratch_root(spark)}/conform/{name}-{uuid.uuid4().hex[:12]}"
