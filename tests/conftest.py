import os
import sys
import uuid

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from driverdata.session import prepare  # noqa: E402
from mediamart.sources.tables import LAYERS, Tables  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .appName("mediamart-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield prepare(session)
    session.stop()


@pytest.fixture
def tables(spark, tmp_path):
    """An empty warehouse whose schemas go with the test."""
    layers = {layer: f"{layer}_{uuid.uuid4().hex[:8]}" for layer in LAYERS}
    yield Tables(spark, str(tmp_path / "warehouse"), layers, buckets=4)
    for schema in layers.values():
        spark.sql(f"DROP SCHEMA IF EXISTS {schema} CASCADE")
