import datetime as dt
import json

from pyspark.sql import functions as F

from mediamart.operators import ingest
from mediamart.schemas import PLAYLISTS, RAW
from tests.rows import raw, tuples, video

NOW = dt.datetime(2030, 1, 1)


def now():
    return F.lit(NOW)


def test_flatten_playlists(spark):
    rows = [
        ("p1", "List", [("a", "A", "u", "c", "C"), ("b", "B", "u", None, None)]),
        ("p2", "Empty", []),
        ("p3", "Missing", None),
    ]
    got = ingest.flatten_playlists(spark.createDataFrame(rows, PLAYLISTS))
    assert tuples(got, "playlist_id", "playlist_title", "video_id", "channel_name", "position") == [
        ("p1", "List", "a", "C", 0),
        ("p1", "List", "b", None, 1),
    ]


def test_new_raw_rows(spark):
    listed = [("a", "A", "u", "c", "C"), ("a", "A again", "u", "c", "C"), (None, "?", "u", "c", "C"), ("b", "B", "u", "c", "C")]
    entries = ingest.flatten_playlists(spark.createDataFrame([("p", "List", listed)], PLAYLISTS))
    first = ingest.new_raw_rows(None, entries, now())
    assert first.schema == RAW or first.schema.simpleString() == RAW.simpleString()
    assert tuples(first, "video_id", "video_title", "created_at") == [("a", "A", NOW), ("b", "B", NOW)]
    assert first.filter("video_meta_json is not null or process_status is not null").count() == 0
    again = ingest.new_raw_rows(first, entries, now())
    assert again.count() == 0


def test_fill_and_update(spark):
    table = spark.createDataFrame([("a", "old"), ("b", None), ("c", None)], "id string, v string")
    values = spark.createDataFrame([("a", "new"), ("b", "new"), ("z", "new")], "id string, v string")
    nulls = spark.createDataFrame([("a", None)], "id string, v string")
    assert tuples(ingest.fill(table, values, "id", "v")) == [("a", "old"), ("b", "new"), ("c", None)]
    assert tuples(ingest.fill(table, values, "id", "v", force=True)) == [("a", "new"), ("b", "new"), ("c", None)]
    assert tuples(ingest.fill(table, nulls, "id", "v", force=True))[0] == ("a", "old")
    assert tuples(ingest.update(table, nulls, "id", "v"))[0] == ("a", None)


def test_stamp_moves_only_on_change(spark):
    old_stamp = dt.datetime(2024, 1, 1)
    columns = "video_id string, video_meta_json string, meta_updated_at timestamp"
    old = spark.createDataFrame(
        [(v, '{"duration":1,"view_count":2}', old_stamp) for v in "abc"]
        + [("d", None, None), ("e", '{"duration":1}', old_stamp)],
        columns,
    )
    new = spark.createDataFrame(
        [
            ("a", '{"view_count": 2, "duration": 1}', None),
            ("b", '{"view_count":3,"duration":1}', None),
            ("c", None, None),
            ("d", '{"duration":1}', None),
            ("new", '{"duration":1}', None),
            ("e", '{"duration":1,"view_count":null}', None),
        ],
        columns,
    )
    got = dict(tuples(ingest.stamp_changes(old, new, now()), "video_id", "meta_updated_at"))
    assert got == {"a": old_stamp, "b": NOW, "c": NOW, "d": NOW, "new": None, "e": NOW}


def test_status_needs_all_six_artefacts(spark):
    df = raw(
        spark,
        video("all", process_status="new"),
        video("nopoints", process_status="new", sound_classifier_json={}),
        video("noevents", process_status="new", laugh_events_json={"events": []}),
        video("missing", process_status=None, llm_chapter_json=None),
        video("done", transcribe_json={}),
    )
    assert dict(tuples(ingest.set_status(df), "video_id", "process_status")) == {
        "all": "finished", "nopoints": "new", "noevents": "finished", "missing": None, "done": "finished",
    }


def test_work_flags(spark):
    df = raw(
        spark,
        video("done"),
        video("stale", meta_updated_at=dt.datetime(2023, 12, 31)),
        video("never", meta_updated_at=None, transcribe_json=None),
        video("nourl", video_url="", video_meta_json=None, transcribe_json=None),
        video("nochapters", llm_chapter_json=None, llm_classifier_json=None),
        video("emptychapters", llm_chapter_json={}, llm_classifier_json=None),
        video("noclasses", llm_classifier_json=None),
    )
    flagged = ingest.work_flags(df, F.lit(dt.date(2024, 1, 1)))
    flags = [c for c in flagged.columns if c.startswith("needs_")]
    got = {r.video_id: {f[6:] for f in flags if r[f]} for r in flagged.collect()}
    assert got == {
        "done": set(),
        "stale": {"meta"},
        "never": {"meta", "audio", "transcript"},
        "nourl": set(),
        "nochapters": {"chapters"},
        "emptychapters": set(),
        "noclasses": {"classes"},
    }


def test_changed_rows(spark):
    old = raw(spark, video("a"), video("b", process_status="new"))
    new = raw(spark, video("a"), video("b"), video("c"))
    assert tuples(ingest.changed_rows(old, new), "video_id") == [("b",), ("c",)]


def test_project_meta_keeps_present_keys(spark):
    df = spark.range(1).select(
        ingest.project_meta({"duration": F.lit(5), "view_count": F.lit(None).cast("int"), "fps": F.lit(25)}).alias("j")
    )
    assert json.loads(df.first().j) == {"duration": 5, "view_count": None}


def test_object_keys(spark):
    wanted = spark.createDataFrame([("a",), ("b",)], "id string").select(ingest.audio_key(F.col("id"), "data/audio").alias("object_name"))
    listing = spark.createDataFrame([("data/audio/a.opus",)], "object_name string")
    assert tuples(ingest.missing_objects(wanted, listing)) == [("data/audio/b.opus",)]
    ids = spark.createDataFrame([("x",), ("x",), (None,)], "playlist_id string")
    assert tuples(ingest.playlist_urls(ids)) == [("x", "https://www.youtube.com/playlist?list=x")]
    assert ingest.lookup(raw(spark, video("a"), video("b")), spark.createDataFrame([("b",), ("b",)], "video_id string")).count() == 1
