"""Session settings the operators rely on, and the folder shared by all executors."""

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# AQE splits the hot partitions of joins at run time; forcing it keeps the split even when the
# join is followed by another exchange.  Casts must be ANSI, so that bad text fails, and of a
# repeated JSON key the last one counts.  Timestamps become dates by the UTC day.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.variant.allowDuplicateKeys": "true",
    # an overwrite replaces just the partitions that it has rows for
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # a Python worker holds a batch several times over; rows here may be whole documents
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    "spark.sql.execution.arrow.maxBytesPerBatch": "16m",
}


def configure(spark: SparkSession, shuffle_partitions: int | None = None) -> SparkSession:
    """Apply ``SETTINGS`` to a running session.

    AQE merges small shuffle partitions but never makes more of them, so at scale
    ``shuffle_partitions`` should be the largest shuffle divided by about 128 MB (some 100,000 for
    12 TB of points).  Left out, the number stays as the cluster sets it.
    """
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    if shuffle_partitions:
        spark.conf.set("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return spark


@contextmanager
def stored_partitioning(spark: SparkSession) -> Iterator[None]:
    """Let joins by video and something else use the buckets of the stored tables as they are.

    By itself Spark shuffles both sides of such a join by all of its keys.  That spreads a hot key; stored
    core tables have none, because their keys are numbered by SMALLINT inside a video.
    """
    name = "spark.sql.requireAllClusterKeysForCoPartition"
    before = spark.conf.get(name)
    spark.conf.set(name, "false")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``, or the checkpoint
    folder set on the context."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        raise ValueError("name a folder that all executors share in spark.checkpoint.dir")
    return named
