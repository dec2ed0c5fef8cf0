"""Sessions as the driver makes them, made ready for the library."""

import os
import tempfile

from pyspark.sql import SparkSession

from mediamart.session import configure

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the library's settings.  Only where no shared folder is named and all runs in one
    process (tests, bench) a local one is set."""
    configure(spark)
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not named and context.master.startswith("local["):
        context.setCheckpointDir(tempfile.mkdtemp(prefix="mediamart-checkpoint-"))
    # for workers that see this folder; a cluster gets the package by --py-files
    paths = context.environment.get("PYTHONPATH", "").split(os.pathsep)
    if ROOT not in paths:
        context.environment["PYTHONPATH"] = os.pathsep.join([ROOT, *filter(None, paths)])
    return spark
