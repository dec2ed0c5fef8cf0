"""How the driver's tables become stored raw rows."""

import os

import pytest

from driverdata import domain as D
from driverdata.queries import QUERIES, new_tables
from mediamart.session import shared_folder

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="driver tables are not there")


def folders(spark):
    found = os.path.join(shared_folder(spark).removeprefix("file:"), spark.sparkContext.applicationId)
    return set(os.listdir(found)) if os.path.isdir(found) else set()


def test_documents_and_not_raw_rows_are_shuffled(spark):
    lines = D.processed(spark, SF_DIR)._jdf.queryExecution().executedPlan().toString().splitlines()
    exchange = [i for i, line in enumerate(lines) if "Exchange hashpartitioning(doc_id" in line]
    assert len(exchange) == 1
    assert any("transform(" in line for line in lines[: exchange[0]])
    assert not any("transform(" in line for line in lines[exchange[0] :])


def test_models_store_no_text_first(spark, monkeypatch):
    monkeypatch.setattr(D, "_stored", {})
    before = folders(spark)
    assert QUERIES["p4_stg_classifications"](spark, SF_DIR).count() > 0
    assert [f.split("-")[0] for f in folders(spark) - before] == ["parsed"]
    parsed = D.parsed_videos(spark, SF_DIR).select("video_id", "process_status").collect()
    assert sorted(parsed) == sorted(D.raw_videos(spark, SF_DIR).select("video_id", "process_status").collect())


@pytest.mark.parametrize("rows, buckets", [(10, 8), (40_001, 9), (100_000, 20)])
def test_buckets_follow_the_rows(spark, rows, buckets):
    tables = new_tables(spark, "sized", spark.range(rows))
    try:
        assert tables.buckets == buckets
    finally:
        for schema in tables.layers.values():
            spark.sql(f"DROP SCHEMA IF EXISTS {schema} CASCADE")
