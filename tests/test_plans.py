"""The shape of the plans that decides about scale."""

import datetime as dt
import os
import re

import pytest
from pyspark.sql import functions as F

from mediamart.operators import detections, joins, windows
from mediamart.plans import build, core, marts, reporting, staging
from mediamart.schemas import CONTRACTS
from mediamart.session import stored_partitioning
from mediamart.sources import taxonomy
from mediamart.sources.calendar import calendar
from tests.rows import raw, video


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(df):
    return re.findall(r"Exchange hashpartitioning\((.*?), 4\)", re.sub(r"#\d+L?", "", plan(df)))


def stored(tables, name, *rows):
    return tables.append(name, tables.spark.createDataFrame(list(rows), CONTRACTS[name]))


def test_first_row_is_limited_before_the_shuffle(spark):
    df = spark.range(10).select((F.col("id") % 2).alias("k"), "id")
    for ranked in (windows.dedupe_first(df, ["k"], ["id"]), windows.latest(df, ["k"], "id")):
        assert "row_number(), 1, Partial" in plan(ranked)


def test_stored_videos_are_left_out_before_parsing(no_broadcast, tables, tmp_path):
    raw(no_broadcast, video("a")).write.parquet(f"{tmp_path}/raw")
    df = no_broadcast.read.parquet(f"{tmp_path}/raw")
    old = stored(tables, "core_transcript_segments", ("a", 1, "x", 0.0, 1.0))
    text = plan(core.core_transcript_segments(df, old))
    assert text.index("Generate") < text.index("LeftAnti")  # the join is below the explode


def test_new_ids_are_broadcast_and_raw_rows_stay_in_place(spark, tables, tmp_path):
    raw(spark, video("a"), video("b")).write.parquet(f"{tmp_path}/raw")
    df = spark.read.parquet(f"{tmp_path}/raw")
    stored(tables, "core_transcript_segments", ("a", 1, "x", 0.0, 1.0))
    new = core.core_transcript_segments(build.new_videos(tables, df, "core_transcript_segments"))
    assert exchanges(new) == [] and "BroadcastHashJoin" in plan(new)
    assert {r.video_id for r in new.collect()} == {"b"}


def test_scan_reads_only_what_a_model_needs(spark, tmp_path):
    raw(spark, video("a")).write.parquet(f"{tmp_path}/raw")
    text = plan(staging.stg_chapters(spark.read.parquet(f"{tmp_path}/raw")))
    assert "ReadSchema: struct<video_id:string,llm_chapter_json:string,process_status:string>" in text
    assert "EqualTo(process_status,finished)" in text and "Exchange" not in text


def test_points_are_spread_over_time_buckets(no_broadcast):
    points = no_broadcast.createDataFrame([("v", 1.0, 0.5)], "video_id string, t double, confidence double")
    assert exchanges(detections.gap_clusters(points)) == ["video_id, _lane", "video_id, _bucket"]


def test_clusters_are_computed_once_for_numbering(spark):
    points = spark.range(1000).select(
        F.lit("v").alias("video_id"), (F.col("id") / 10).alias("t"), F.lit(0.5).alias("confidence")
    )
    events = detections.cluster_points(points)
    events.collect()
    assert "ReusedExchange" in plan(events)


def clustered(df):
    """How often the clusters of a frame are computed: exchanges of their pieces that reuse no other."""
    df.collect()
    final = re.sub(r"#\d+L?", "", plan(df).split("== Initial Plan ==")[0])
    return len([line for line in final.splitlines() if "- Exchange hashpartitioning(video_id, _lane" in line])


def test_numbering_and_payload_compute_the_clusters_once(no_broadcast):
    points = no_broadcast.range(1000).select(
        F.floor(F.col("id") / 400).cast("string").alias("video_id"), (F.col("id") / 10).alias("t"), F.lit(0.5).alias("confidence")
    )
    assert clustered(detections.cluster_points(points)) == 1
    named = detections.cluster_points(points.filter("video_id IS NOT NULL"))
    assert clustered(detections.events_payload(named, points.select("video_id").distinct())) == 1


def test_range_join_is_an_equality_join_on_key_and_slot(no_broadcast):
    ranges = no_broadcast.createDataFrame([("v", 0.0, 1.0)], "k string, s double, e double")
    points = no_broadcast.createDataFrame([("v", 0.5, 1)], "k string, t double, n int")
    df = joins.sum_in_ranges(ranges, points, ["k"], "t", "s", "e", F.sum("n"), "total")
    text = plan(df)
    assert "SortMergeJoin [_slot" in text and "CartesianProduct" not in text and "NestedLoop" not in text
    assert "partial_sum" in text


def test_points_and_ranges_are_shuffled_once(no_broadcast):
    ranges = no_broadcast.createDataFrame([("v", 0.0, 1.0)], "k string, s double, e double")
    points = no_broadcast.createDataFrame([("v", 0.5, 1)], "k string, t double, n int")
    df = joins.points_in_ranges(ranges, points, ["k"], "t", "s", "e")
    df.collect()
    final = plan(df).split("== Initial Plan ==")[0]
    lines = [line for line in final.splitlines() if "Exchange hashpartitioning" in line]
    assert len([line for line in lines if "ReusedExchange" not in line]) == 3


def test_taxonomy_is_broadcast_by_its_size(spark, tables):
    core_rows = core.core_chapters(stored(tables, "process_video"), taxonomy.subcategories(spark))
    assert "Exchange hash" not in plan(core_rows) and "BroadcastHashJoin" in plan(core_rows)
    for made, rows in ((taxonomy.categories, taxonomy.CATEGORY_ROWS), (taxonomy.subcategories, taxonomy.SUBCATEGORY_ROWS)):
        assert sorted(map(tuple, made(spark).collect())) == sorted(rows)


def test_chapters_meet_their_classes_without_a_shuffle(no_broadcast, tables):
    subs = F.broadcast(no_broadcast.createDataFrame([(40, 8, "x")], CONTRACTS["core_subcategories"]))  # as Spark does by size
    core_rows = core.core_chapters(stored(tables, "process_video"), subs)
    assert "Exchange hash" not in plan(core_rows)


def some_core(tables):
    return {
        "core_videos": stored(tables, "core_videos", ("a", "c", "p", "t", 1, dt.date(2024, 1, 1), dt.datetime(2024, 2, 1))),
        "core_videos_meta": stored(tables, "core_videos_meta", ("a", dt.date(2024, 2, 1), 1, 1, 1)),
        "core_transcript_segments": stored(tables, "core_transcript_segments", ("a", 1, "x", 0.0, 1.0)),
        "core_sound_features": stored(tables, "core_sound_features", ("a", 1, 1, 1.5, 0.5, 1.5, 0.5, 0.5)),
        "core_chapters": stored(tables, "core_chapters", ("a", 1, 1, "s", 40)),
    }


def small(spark, name, *rows):
    return F.broadcast(spark.createDataFrame(list(rows), CONTRACTS[name]))  # as Spark does by size


DAY = (20240101, dt.date(2024, 1, 1), 2024, 1, 1, "January", 1, 1, "Monday", False)


def test_segments_are_read_once_for_both_bounds(no_broadcast, tables):
    t = some_core(tables)
    df = marts.chapter_times(t["core_chapters"], small(no_broadcast, "core_subcategories", (40, 8, "x")), t["core_transcript_segments"])
    assert len(re.findall(r"FileScan parquet [^\[]*core_transcript_segments\[video_id#\d+,segment_id", plan(df))) == 1


def test_facts_of_stored_tables_need_no_exchange(no_broadcast, tables):
    """All three facts are joined and grouped where the buckets lie."""
    t = some_core(tables)
    days = small(no_broadcast, "dim_date", DAY)
    with stored_partitioning(no_broadcast):
        snapshots = marts.fact_video_daily_snapshot(t["core_videos_meta"], t["core_videos"], days)
        metrics = marts.fact_video_metrics(t["core_videos"], t["core_videos_meta"], t["core_sound_features"], days)
        chapters = marts.fact_video_chapters(
            t["core_chapters"], small(no_broadcast, "core_subcategories", (40, 8, "x")),
            t["core_transcript_segments"], t["core_sound_features"], t["core_videos"], days,
        )
        for fact, rows in ((snapshots, 0), (metrics, 1), (chapters, 1)):
            assert exchanges(fact) == [] and "Bucketed: true" in plan(fact)
            assert fact.count() == rows
    assert "partial_sum" in plan(metrics)
    assert "hashpartitioning" in plan(chapters.select("*"))  # without it Spark shuffles by all keys of a join


def test_month_of_a_fact_is_pruned_through_the_calendar(no_broadcast, tables):
    """A filter on the calendar decides at run time which months of the fact are opened."""
    spark = no_broadcast
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10MB")
    rows = [(f"v{m}", 20240001 + m * 100, "c", "p", 1, 1, 0.0, 5.0, None, None) for m in range(1, 13)]
    fact = spark.createDataFrame(rows, CONTRACTS["fact_video_chapters"]).withColumns({"duration": F.lit(5).cast("decimal(18,2)"), "laughter_percent": F.lit(1).cast("decimal(18,1)")})
    tables.upsert("fact_video_chapters", fact, ["video_id", "subcategory_id", "start_s"])
    tables.replace("dim_date", calendar(spark, "2024-01-01", "2024-12-31"))
    tables.upsert("dim_category", spark.createDataFrame([(1, "m")], CONTRACTS["dim_category"]), ["category_id"])
    tables.upsert("dim_subcategory", spark.createDataFrame([(1, "s")], CONTRACTS["dim_subcategory"]), ["subcategory_id"])
    tables.upsert("dim_videos", spark.createDataFrame([(f"v{m}", f"t{m}") for m in range(1, 13)], CONTRACTS["dim_videos"]), ["video_id"])
    tables.upsert("dim_channels", spark.createDataFrame([("c", "C")], CONTRACTS["dim_channels"]), ["channel_id"])
    tables.upsert("dim_playlists", spark.createDataFrame([("p", "P")], CONTRACTS["dim_playlists"]), ["playlist_id"])
    t = tables.read
    args = [t(n) for n in ("dim_category", "dim_subcategory", "dim_date", "dim_videos", "dim_channels", "dim_playlists")]
    view = reporting.chapters_metrics(tables.scan("fact_video_chapters"), *args)
    quarter = view.filter("year = 2024 and quarter = 2")
    assert {r.video_title for r in quarter.collect()} == {"t4", "t5", "t6"}
    assert re.search(r"PartitionFilters: \[[^\]]*dynamicpruning", plan(quarter))
    folder = os.path.join(tables.root, tables.layer_of("fact_video_chapters"), "fact_video_chapters")
    for month in [m for m in os.listdir(folder) if "=" in m and m[-2:] not in ("04", "05", "06")]:
        for file in os.listdir(os.path.join(folder, month)):
            with open(os.path.join(folder, month, file), "wb") as f:
                f.write(b"no parquet")
    spark.catalog.refreshTable(tables.full("fact_video_chapters"))
    view = reporting.chapters_metrics(tables.scan("fact_video_chapters"), *args)
    assert view.filter("year = 2024 and quarter = 2").count() == 3  # the other months are not opened
    with pytest.raises(Exception):
        view.filter("year = 2024").collect()


def test_hot_key_join_is_split_at_run_time(no_broadcast):
    """A key with most of the rows: the adaptive plan cuts its partition."""
    spark = no_broadcast
    tuned = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
        "spark.sql.shuffle.partitions": "20",
    }
    before = {k: spark.conf.get(k) for k in tuned}
    for k, v in tuned.items():
        spark.conf.set(k, v)
    try:
        many = spark.range(0, 60000, 1, 8).select(
            F.when(F.col("id") % 3 < 2, 0).otherwise(F.col("id")).cast("string").alias("video_id"), F.col("id").alias("n")
        )
        one = spark.range(60000).select(F.col("id").cast("string").alias("video_id"), (F.col("id") * 2).alias("m"))
        joined = many.join(one, "video_id")
        assert joined.count() == 60000
        joined.collect()
        assert "skew=true" in plan(joined)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_hot_video_is_spread_over_tasks(spark):
    """Nine tenths of the points belong to one video; by (video, bucket) no task gets most."""
    points = spark.range(200000).select(
        F.when(F.col("id") % 10 < 9, "hot").otherwise(F.col("id").cast("string")).alias("video_id"),
        (F.col("id") / 20.0).alias("t"),
    )

    def largest_share(*keys):
        placed = points.repartition(8, *keys).groupBy(F.spark_partition_id()).count()
        return placed.agg(F.max("count") / F.sum("count")).first()[0]

    assert largest_share("video_id") > 0.8
    assert largest_share("video_id", F.floor(F.col("t") / 600.0)) < 0.4
