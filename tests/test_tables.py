import os
import uuid
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from mediamart.schemas import CONTRACTS, struct
from mediamart.sources import calendar, taxonomy
from mediamart.sources.raw import read_playlists, read_raw
from mediamart.sources.tables import Tables, check_contract, conform, upsert
from tests.rows import raw, tuples, video


def test_upsert_replaces_and_keeps(spark):
    old = spark.createDataFrame([("a", 1), ("b", 2)], "id string, v int")
    new = spark.createDataFrame([("b", 20), ("c", 30)], "id string, v int")
    once = upsert(old, new, ["id"])
    assert tuples(once) == tuples(upsert(once, new, ["id"])) == [("a", 1), ("b", 20), ("c", 30)]
    assert upsert(None, new, ["id"]) is new


def folders(tables, name):
    path = os.path.join(tables.root, tables.layer_of(name), name)
    return {f: sorted(os.listdir(os.path.join(path, f))) for f in os.listdir(path) if "=" in f}


def test_append_and_replace(spark, tables):
    one = spark.createDataFrame([("a", 1)], "id string, v int")
    two = spark.createDataFrame([("b", 2)], "id string, v int")
    assert tables.read("notes") is None and tables.last_number("notes") == 0
    tables.append("notes", one)
    tables.append("notes", two)
    assert tuples(tables.read("notes")) == [("a", 1), ("b", 2)]
    assert tuples(tables.read_after("notes", 1)) == [("b", 2)]
    assert tables.read_after("notes", 2).count() == 0
    tables.append("notes", one.limit(0))
    assert tables.last_number("notes") == 2  # no rows, no load
    tables.replace("notes", tables.read("notes").withColumn("v", F.col("v") + 1))  # reads itself
    assert tuples(tables.read("notes")) == [("a", 2), ("b", 3)]
    tables.upsert("notes", spark.createDataFrame([("b", 9)], "id string, v int"), ["id"])  # laid out anew
    assert tuples(tables.read("notes")) == [("a", 2), ("b", 9)] and tables.laid_out_by("notes") == "_bucket"
    before = folders(tables, "notes")
    tables.upsert("notes", spark.createDataFrame([], "id string, v int"), ["id"])
    assert folders(tables, "notes") == before  # nothing to do
    tables.append("notes", spark.createDataFrame([("c", 5)], "id string, v int"))
    tables.upsert("notes", spark.createDataFrame([("c", 6)], "id string, v int"), ["id"])
    assert tuples(tables.read("notes")) == [("a", 2), ("b", 9), ("c", 6)]


def test_read_after_opens_only_later_loads(spark, tables):
    for v in range(3):
        tables.append("notes", spark.createDataFrame([(f"k{v}", v)], "id string, v int"))
    later = tables.read_after("notes", 2)
    assert all("_load=3" in f for f in later.inputFiles()) or "PartitionFilters: [isnotnull(_load" in later._jdf.queryExecution().toString()
    assert tuples(later) == [("k2", 2)]


def test_upsert_rewrites_only_touched_buckets(spark, tables):
    tables.buckets = 8
    rows = spark.createDataFrame([(f"k{n}", n) for n in range(100)], "id string, v int")
    tables.upsert("notes", rows, ["id"])
    before = folders(tables, "notes")
    tables.upsert("notes", spark.createDataFrame([("k7", -7), ("new", 1)], "id string, v int"), ["id"])
    after = folders(tables, "notes")
    assert len(before) == 8 and 1 <= len([b for b in before if before[b] != after[b]]) <= 2
    want = sorted([(f"k{n}", n if n != 7 else -7) for n in range(100)] + [("new", 1)])
    assert tuples(tables.read("notes")) == want


def fact(video, day, share=1.0):
    return (video, day, "c", "p", 1, 1, 0.0, 5.0, Decimal("5.00"), Decimal(str(share)))


def test_facts_are_overwritten_month_by_month(spark, tables):
    schema, keys = CONTRACTS["fact_video_chapters"], ["video_id", "subcategory_id", "start_s"]
    load = lambda *rows: tables.upsert("fact_video_chapters", spark.createDataFrame(list(rows), schema), keys)
    load(fact("a", 20240115), fact("b", 20240116), fact("c", 20240201))
    before = folders(tables, "fact_video_chapters")
    assert sorted(before) == ["_month=202401", "_month=202402"]
    load(fact("a", 20240117, 2.0))
    after = folders(tables, "fact_video_chapters")
    assert before["_month=202402"] == after["_month=202402"] and before["_month=202401"] != after["_month=202401"]
    load(fact("c", 20240301), fact("b", 20240302))  # the keys move; one of the months they leave has no other row
    assert sorted(folders(tables, "fact_video_chapters")) == ["_month=202401", "_month=202403"]
    assert tuples(tables.read("fact_video_chapters"), "video_id", "date_id") == [("a", 20240117), ("b", 20240302), ("c", 20240301)]


def test_bad_load_is_not_published(spark, tables):
    good = spark.createDataFrame([(1, "one")], "category_id short, main_category string")
    tables.replace("core_categories", good)
    rules = {"repeated category_id: 2 rows": [(2, "a"), (2, "b")], "category_id is null: 1 rows": [(None, "a")], "main_category is null": [(3, None)]}
    for rule, bad in rules.items():
        for load in (tables.append, tables.replace):
            with pytest.raises(ValueError, match=f"core_categories: load refused, .*{rule}"):
                load("core_categories", spark.createDataFrame(bad, good.schema))
        assert tuples(tables.read("core_categories")) == [(1, "one")]
    tables.append("core_categories", spark.createDataFrame([(2, "a")], good.schema))
    assert tables.read("core_categories").count() == 2
    dims = spark.createDataFrame([("c1", "x"), ("c1", "y")], CONTRACTS["dim_channels"])
    tables.upsert("dim_channels", dims.limit(1), ["channel_id"])
    with pytest.raises(ValueError, match="dim_channels: load refused, repeated channel_id: 2 rows"):
        tables.upsert("dim_channels", dims, ["channel_id"])
    assert tables.read("dim_channels").count() == 1


def test_other_errors_pass_through(spark, tables):
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        tables.append("core_categories", spark.createDataFrame([("x", "a")], "category_id string, main_category string"))


def jobs_of(spark, work):
    """Jobs that ``work`` starts and that read or write rows."""
    group = f"jobs-{uuid.uuid4().hex}"
    spark.sparkContext.setJobGroup(group, "counted")
    work()
    spark.sparkContext.setJobGroup("other", "")
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))


def test_a_load_is_checked_by_the_job_that_writes_it(spark, tables):
    rows = spark.createDataFrame([("a", 1, "t", 0.0, 1.0), ("a", 2, "t", 1.0, 2.0)], CONTRACTS["core_transcript_segments"])
    tables.append("core_transcript_segments", rows)
    more = rows.withColumn("video_id", F.lit("b"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # else a job for each stage
    try:
        assert jobs_of(spark, lambda: tables.append("core_transcript_segments", more)) == 1
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_core_tables_are_bucketed_by_video(spark, tables):
    rows = spark.createDataFrame([(f"v{i}", n, "t", 0.0, 1.0) for i in range(40) for n in range(3)], CONTRACTS["core_transcript_segments"])
    tables.append("core_transcript_segments", rows.repartition(5))
    files = [f for f in folders(tables, "core_transcript_segments")["_load=1"] if f.endswith(".parquet")]
    assert len(files) == 4  # one per bucket
    text = tables.read("core_transcript_segments").groupBy("video_id").count()._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in text and "Bucketed: true" in text


def test_adopted_by_a_new_catalog(spark, tables):
    tables.append("core_transcript_segments", spark.createDataFrame([("a", 1, "t", 0.0, 1.0)], CONTRACTS["core_transcript_segments"]))
    tables.upsert("fact_video_chapters", spark.createDataFrame([fact("a", 20240115)], CONTRACTS["fact_video_chapters"]), ["video_id"])
    again = Tables(spark, f"{tables.root}", {k: v for k, v in tables.layers.items()}, buckets=4)
    assert again.adopt() == []  # known already
    for layer, schema in tables.layers.items():  # a catalog that has lost them; the files stay
        os.rename(f"{tables.root}/{schema}", f"{tables.root}/kept_{layer}")
        spark.sql(f"DROP SCHEMA {schema} CASCADE")
        os.rename(f"{tables.root}/kept_{layer}", f"{tables.root}/{schema}")
    new = Tables(spark, tables.root, tables.layers, buckets=4)
    assert new.read("core_transcript_segments") is None
    assert sorted(new.adopt()) == ["core_transcript_segments", "fact_video_chapters"]
    assert tuples(new.read("core_transcript_segments")) == [("a", 1, "t", 0.0, 1.0)] and new.last_number("core_transcript_segments") == 1
    assert new.partitions("fact_video_chapters") == ["202401"]
    new.append("core_transcript_segments", spark.createDataFrame([("b", 1, "t", 0.0, 1.0)], CONTRACTS["core_transcript_segments"]))
    assert new.read("core_transcript_segments").count() == 2


def test_schema_elsewhere_is_refused(spark, tables, tmp_path):
    with pytest.raises(ValueError, match="name another one in layers"):
        Tables(spark, str(tmp_path / "other"), tables.layers)


def test_intermediates_have_names_of_their_own(spark, tables):
    one, two = (tables.stage("x", spark.range(n)) for n in (1, 2))
    tables.stage("x_y", spark.range(3))
    assert (one.count(), two.count()) == (1, 2)
    tables.clear("x")
    left = lambda: [t.name.rsplit("_", 1)[0] for t in spark.catalog.listTables(tables.layers["staging"]) if not t.isTemporary]
    assert left() == ["stg_x_y"]
    Tables(spark, tables.root, tables.layers).sweep()
    assert left() == []


def test_columns_may_be_added(spark, tables):
    tables.append("notes", spark.createDataFrame([("a", 1)], "id string, v int"))
    tables.append("notes", spark.createDataFrame([("b", "x")], "id string, w string"))
    assert tuples(tables.read("notes"), "id", "v", "w") == [("a", 1, None), ("b", None, "x")]
    tables.upsert("notes", spark.createDataFrame([("a", True)], "id string, z boolean"), ["id"])
    assert tuples(tables.read("notes"), "id", "v", "w", "z") == [("a", None, None, True), ("b", None, "x", None)]


def test_contract(spark, tables):
    contract = struct(a="short", b="string")
    df = spark.createDataFrame([("x", 5)], "b string, a int")
    assert check_contract(df, contract) == ["column a is int, not smallint"]
    assert conform(df, contract).schema.simpleString() == "struct<a:smallint,b:string>"
    with pytest.raises(Exception, match="CAST_OVERFLOW"):
        conform(df.withColumn("a", F.lit(40000)), contract).collect()
    with pytest.raises(ValueError, match="undeclared column c"):
        conform(df.withColumn("c", F.lit(1)), contract)
    with pytest.raises(ValueError, match="missing column a"):
        conform(df.drop("a"), contract)
    with pytest.raises(ValueError):
        tables.append("dim_videos", df)


def test_layers(spark, tables):
    """A layer's name is used as it stands, and is a schema of the catalog."""
    for name, layer in {"core_videos": "core", "dim_date": "marts", "stg_chapters": "staging", "process_video": "raw", "notes": "reporting"}.items():
        schema = tables.layers[layer]
        assert tables.layer_of(name) == schema and tables.full(name) == f"`{schema}`.`{name}`"
        assert spark.catalog.getDatabase(schema).locationUri.endswith(f"{tables.root}/{schema}")


def test_raw_and_playlist_sources(spark, tmp_path):
    raw(spark, video("a")).write.parquet(f"{tmp_path}/raw")
    assert read_raw(spark, f"{tmp_path}/raw").count() == 1
    (tmp_path / "lists.json").write_text('{"id":"p","title":"t","entries":[{"id":"v"}]}\n')
    assert read_playlists(spark, f"{tmp_path}/lists.json").first().entries[0].id == "v"


def test_calendar(spark):
    days = calendar.calendar(spark, "2015-01-01", "2024-12-31")
    assert days.count() == 3653 and days.schema.simpleString() == CONTRACTS["dim_date"].simpleString()
    assert tuple(days.filter("date_id = 20200101").first())[2:] == (2020, 1, 1, "January", 1, 3, "Wednesday", False)
    assert days.filter("date_id = 20210103").first().week_of_year == 53
    assert days.filter("is_weekend").count() == days.filter("day_of_week in (6, 7)").count()


def test_taxonomy(spark):
    assert taxonomy.categories(spark).count() == 10 and taxonomy.subcategories(spark).count() == 50
    pets = taxonomy.subcategories(spark).filter("subcategory = 'Animals & pets'").first()
    assert tuple(pets) == (40, 8, "Animals & pets")
    nested = dict(tuples(taxonomy.taxonomy_json(spark)))
    assert nested["Health, Body & Mind"] == (
        '{"main_category":"Health, Body & Mind","subcategories":["Physical health & fitness",'
        '"Mental health & therapy","Addictions & substance use","Aging & body image"]}'
    )
