import datetime as dt
import os
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from mediamart.operators.quality import ChecksFailed
from mediamart.plans import build, core, marts, reporting
from mediamart.schemas import CONTRACTS
from mediamart.sources import taxonomy
from mediamart.sources.calendar import calendar
from mediamart.sources.tables import Tables
from tests.rows import CHAPTERS, CLASSES, EVENTS, META, event, raw, tuples, video

NOW = dt.datetime(2030, 1, 1)


def now():
    return F.lit(NOW)


def frame(spark, name, *rows):
    return spark.createDataFrame(list(rows), CONTRACTS[name])


def days(spark):
    return calendar(spark, "2024-01-01", "2024-12-31")


def test_core_channels_takes_unseen_ids(spark):
    df = raw(spark, video("a"), video("b", channel_name="Other"), video("c", channel_id="c2"), video("d", channel_id=""))
    first = core.core_channels(df, now())
    assert tuples(first) == [("c1", "Channel", NOW), ("c1", "Other", NOW), ("c2", "Channel", NOW)]
    assert core.core_channels(df, now(), first).count() == 0
    assert tuples(core.core_playlists(df, now()), "playlist_id") == [("p1",)]


def test_core_videos_duration_must_fit(spark):
    df = raw(spark, video("a", video_meta_json={**META, "duration": 32768}))
    with pytest.raises(Exception, match="CAST_OVERFLOW"):
        core.core_videos(df, now()).collect()


def test_core_videos_meta_high_water_mark(spark):
    df = raw(spark, video("a"), video("b", meta_updated_at=dt.datetime(2024, 3, 1)), video("c"))
    stored = frame(
        spark, "core_videos_meta",
        ("a", dt.date(2024, 2, 1), 1, 1, 1), ("b", dt.date(2024, 2, 1), 1, 1, 1), ("b", dt.date(2024, 1, 1), 1, 1, 1),
    )
    got = tuples(core.core_videos_meta(df, stored), "video_id", "snapshot_date")
    assert got == [("b", dt.date(2024, 3, 1)), ("c", dt.date(2024, 2, 1))]


def test_stored_videos_are_frozen(spark):
    df = raw(spark, video("a"), video("b"))
    stored = frame(spark, "core_transcript_segments", ("a", 99, "old", 0.0, 1.0))
    assert {r.video_id for r in core.core_transcript_segments(df, stored).collect()} == {"b"}
    events = frame(spark, "core_sound_features", ("b", 1, 1, 1.0, 1.0, 1.0, 0.5, 0.5))
    assert {r.video_id for r in core.core_sound_features(df, events).collect()} == {"a"}


def test_core_chapters(spark):
    subs = taxonomy.subcategories(spark)
    bad_end = CHAPTERS + [{"id": 5, "end_id": 4, "theme": "t", "summary": "s"}]
    classes = CLASSES + [{"id": 5, "subcategory": "Parenting"}]
    df = raw(
        spark,
        video("a"),
        video("invalid", llm_chapter_json={"chapters": bad_end}, llm_classifier_json={"classifications": classes}),
        video("unknown", llm_classifier_json={"classifications": [{"id": 0, "subcategory": "Nothing"}, CLASSES[1]]}),
    )
    got = tuples(core.core_chapters(df, subs))
    assert got == [
        ("a", 0, 1, "one", 40),
        ("a", 2, 3, "two", 29),
        ("invalid", 0, 1, "one", 40),
        ("invalid", 2, 3, "two", 29),
        ("invalid", 5, 4, "s", 29),
        ("unknown", 2, 3, "two", 29),
    ]


def facts_input(spark, df):
    subs = taxonomy.subcategories(spark)
    return (
        core.core_chapters(df, subs), subs, core.core_transcript_segments(df),
        core.core_sound_features(df), core.core_videos(df, now()), days(spark),
    )


def test_fact_video_chapters(spark):
    df = raw(
        spark,
        video("a"),
        video("silent", laugh_events_json={"events": [event(1, 500.0, 3.0)]}),
        video("undated", video_meta_json={**META, "upload_date": "20230101"}),
        video("cut", transcribe_json={"0": {"text": "a", "start": 0, "end": 4}, "1": {"text": "b", "start": 4, "end": 9}}),
    )
    fact = marts.fact_video_chapters(*facts_input(spark, df))
    assert fact.schema.simpleString() == CONTRACTS["fact_video_chapters"].simpleString()
    got = tuples(fact, "video_id", "subcategory_id", "category_id", "date_id", "start_s", "end_s", "duration", "laughter_percent")
    # the event at 9.0 is on the boundary of both chapters and counts in both
    assert got == [
        ("a", 29, 5, 20240115, 9.0, 30.0, Decimal("21.00"), Decimal("9.5")),
        ("a", 40, 8, 20240115, 0.0, 9.0, Decimal("9.00"), Decimal("38.9")),
        ("cut", 40, 8, 20240115, 0.0, 9.0, Decimal("9.00"), Decimal("38.9")),
        ("silent", 29, 5, 20240115, 9.0, 30.0, Decimal("21.00"), Decimal("0.0")),
        ("silent", 40, 8, 20240115, 0.0, 9.0, Decimal("9.00"), Decimal("0.0")),
    ]


def test_fact_video_metrics(spark):
    df = raw(spark, video("a"), video("short", laugh_events_json={"events": [event(1, 1.0, 1.0)]}))
    videos, features = core.core_videos(df, now()), core.core_sound_features(df)
    meta = frame(
        spark, "core_videos_meta",
        ("a", dt.date(2024, 2, 1), 1, 10, 100), ("a", dt.date(2024, 2, 3), 2, 20, 200), ("short", dt.date(2024, 2, 1), 1, 1, 1),
    )
    got = tuples(marts.fact_video_metrics(videos, meta, features, days(spark)))
    assert got == [("a", "p1", "c1", 20240115, 20, 2, 200, 600, Decimal("0.6"))]


def test_fact_video_daily_snapshot(spark):
    videos = core.core_videos(raw(spark, video("a"), video("b")), now())
    meta = frame(
        spark, "core_videos_meta",
        ("a", dt.date(2024, 2, 1), 1, 10, 100), ("a", dt.date(2024, 2, 9), 3, 5, 100), ("a", dt.date(2025, 1, 1), 9, 9, 9),
        ("b", dt.date(2024, 2, 1), None, 1, 1), ("b", dt.date(2024, 2, 2), 5, 2, 1),
    )
    got = tuples(marts.fact_video_daily_snapshot(meta, videos, days(spark)), "video_id", "date_id", "prev_day_view", "prev_day_like", "prev_day_comment")
    assert got == [
        ("a", 20240201, None, None, None), ("a", 20240209, -5, 2, 0),
        ("b", 20240201, None, None, None), ("b", 20240202, 1, None, 0),
    ]


def snapshot(tables):
    names = [n for n in CONTRACTS if n not in ("dim_date", "process_video")]
    return {n: tuples(tables.read(n)) for n in names}


def batches(spark):
    first = raw(spark, video("a"), video("b", channel_id="c2", channel_name="Two"), video("wait", process_status="new"))
    second = raw(
        spark,
        video("a", meta_updated_at=dt.datetime(2024, 2, 5), video_meta_json={**META, "view_count": 150}),
        video("b", channel_id="c2", channel_name="Two", laugh_events_json={"events": EVENTS[:1]}),
        video("wait", playlist_id="p2", playlist_title="Second"),
    )
    return first, second


def test_build_twice_changes_nothing(spark, tables):
    first, _ = batches(spark)
    report = build.run(tables, first, days(spark), now())
    assert report.filter("failures > 0").count() == 0
    before = snapshot(tables)
    build.build_all(tables, first, days(spark), F.lit(dt.datetime(2031, 1, 1)))
    assert snapshot(tables) == before
    assert len(before["core_videos"]) == 2 and len(before["fact_video_chapters"]) == 4
    check_views(spark)


def check_views(spark):
    assert tuples(spark.table("dwh_statistics")) == sorted(
        [
            (reporting.TOTAL_CHANNELS, 2), (reporting.TOTAL_PLAYLISTS, 1),
            (reporting.TOTAL_VIDEOS, 2), (reporting.TOTAL_HOURS, 0),
        ],
        key=repr,
    )
    by_chapter = spark.table("video_metrics").filter("video_title = 'Video a'")
    assert tuples(by_chapter, "subcategory", "view_count", "duration_hms", "date") == [
        ("Animals & pets", 100, "00:10:00", dt.date(2024, 1, 15)), ("Parenting", 100, "00:10:00", dt.date(2024, 1, 15)),
    ]
    assert spark.table("chapters_metrics").count() == 4
    assert spark.table("video_daily_snapshot").columns[:2] == ["date_id", "date"]


def test_incremental_full_and_interrupted_builds_agree(spark, tables, tmp_path):
    first, second = batches(spark)
    build.build_all(tables, first, days(spark), now())
    build.build_core(tables, second, now())  # dies before the marts
    build.build_all(tables, second, days(spark), now())
    got = snapshot(tables)
    build.build_all(tables, second, days(spark), now(), full=True)
    assert snapshot(tables) == got
    assert [r[0] for r in got["core_videos"]] == ["a", "b", "wait"]
    assert [r for r in got["fact_video_daily_snapshot"] if r[0] == "a"] == [
        ("a", 20240201, "c1", "p1", None, None, None), ("a", 20240205, "c1", "p1", 50, 0, 0),
    ]
    assert [r[4] for r in got["fact_video_metrics"] if r[0] == "a"] == [150]
    assert len([r for r in got["core_sound_features"] if r[0] == "b"]) == 3  # frozen


def test_bad_batch_is_refused(spark, tables):
    two_names = raw(spark, video("a"), video("b", channel_name="Other"))
    with pytest.raises(ValueError, match="core_channels: load refused, repeated channel_id: 2 rows"):
        build.run(tables, two_names, days(spark), now())
    assert tables.read("core_channels") is None
    report = build.run(tables, raw(spark, video("a"), video("b")), days(spark), now())
    assert report.filter("failures > 0").count() == 0
    assert tables.read("core_channels").count() == 1


def test_failed_checks_stop_the_run(spark, tables):
    names = [video("a"), video("b", llm_classifier_json={"classifications": CLASSES[:1]})]
    with pytest.raises(ChecksFailed) as failed:
        build.run(tables, raw(spark, *names), days(spark), now())
    assert str(failed.value) == "core_chapters: equal_rowcount(stg_chapters): 1"


def test_a_wider_calendar_brings_its_facts(spark, tables):
    first, _ = batches(spark)
    facts = list(build.FACT_INPUTS)
    narrow = days(spark).filter("date < '2000-01-01'")
    build.build_all(tables, first, narrow, now())
    assert all(tables.read(f).count() == 0 for f in facts)
    build.build_all(tables, first, days(spark), now())
    got = snapshot(tables)
    assert all(got[f] for f in facts)
    build.build_all(tables, first, days(spark), now(), full=True)
    assert snapshot(tables) == got


def test_intermediates_do_not_stay(spark, tables):
    first, second = batches(spark)
    for rows in (first, second, second):
        build.build_all(tables, rows, days(spark), now())
    assert not [t.name for t in spark.catalog.listTables(tables.layers["staging"]) if not t.isTemporary]
    assert tables.partitions("core_chapters") == ["1", "2"]  # nothing new, no load
