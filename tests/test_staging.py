import datetime as dt
import os
import sys

import pytest

from mediamart.plans import staging
from mediamart.sources.raw import id_slices, parse_artefacts, read_raw
from tests import rows
from tests.rows import CHAPTERS, event, raw, tuples, video


@pytest.fixture(params=["text", "variant"], autouse=True)
def form(request, monkeypatch, tmp_path):
    """Every test reads the artefacts as text and as stored VARIANT."""
    if request.param == "variant":

        def parsed(spark, *videos):
            path = str(tmp_path / f"parsed{len(os.listdir(tmp_path))}")
            parse_artefacts(rows.raw(spark, *videos)).write.parquet(path)
            return read_raw(spark, path, parsed=True)

        monkeypatch.setattr(sys.modules[__name__], "raw", parsed)
    return request.param


def test_unfinished_and_missing_artefacts_give_no_rows(spark):
    df = raw(
        spark,
        video("new", process_status="new"),
        video("null", **{c: None for c in ("transcribe_json", "llm_chapter_json", "llm_classifier_json", "laugh_events_json")}),
        video("hollow", transcribe_json={}, llm_chapter_json={}, llm_classifier_json={}, laugh_events_json={"events": []}),
    )
    for name in ("stg_transcripts", "stg_chapters", "stg_classifications", "stg_sound_features"):
        assert staging.STAGING[name](df).count() == 0
    assert tuples(staging.stg_videos_base(df), "video_id") == [("hollow",), ("null",)]


def test_videos_base(spark):
    df = raw(
        spark,
        video("v"),
        video("blank", channel_id=""),
        video("noplaylist", playlist_id=None),
        video("partial", video_meta_json={"duration": "61", "upload_date": "20240229"}),
    )
    rows = {r.video_id: r for r in staging.stg_videos_base(df).collect()}
    v = rows["v"]
    assert (v.video_title, v.channel_name, v.duration, v.upload_date, v.meta_updated_at, v.is_valid) == (
        "Video v", "Channel", 600, dt.date(2024, 1, 15), dt.date(2024, 2, 1), True,
    )
    assert not rows["blank"].is_valid and not rows["noplaylist"].is_valid
    p = rows["partial"]
    assert (p.duration, p.view_count, p.upload_date) == (61, None, dt.date(2024, 2, 29))


def test_malformed_text_fails(spark):
    row = video("v")
    row["llm_chapter_json"] = '{"chapters":['
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        staging.stg_chapters(raw(spark, row)).collect()


def test_variants_are_read_without_parsing(spark, form):
    df = raw(spark, video("v"))
    for model in staging.STAGING.values():
        text = model(df)._jdf.queryExecution().analyzed().toString()
        assert ("from_json" in text) == (form == "text") and ("variant_get" in text) == (form == "variant"), text


def test_bad_number_fails(spark):
    df = raw(spark, video("v", video_meta_json={"duration": "5.0"}))
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        staging.stg_videos_base(df).collect()


def test_transcripts(spark):
    segments = {
        "0": {"text": "", "start": 0, "end": 1},
        "1": {"text": "  ", "start": 0, "end": 1},
        "2": {"text": " a ", "start": 2.0, "end": 2.0},
        "3": {"text": "b", "start": None, "end": 2.0},
        "10": {"text": None, "start": 0, "end": 1},
    }
    got = tuples(staging.stg_transcripts(raw(spark, video("v", transcribe_json=segments))), "segment_id", "segment_text", "is_valid")
    assert got == [(0, "", False), (1, "", True), (10, None, False), (2, "a", False), (3, "b", True)]


def test_duplicate_json_keys_last_wins(spark):
    text = '{"0":{"text":"old","start":0,"end":1},"0":{"text":"new","start":0,"end":1}}'
    rows = video("v")
    rows["transcribe_json"] = text
    assert tuples(staging.stg_transcripts(raw(spark, rows)), "segment_text") == [("new",)]


def test_chapters(spark):
    listed = CHAPTERS + [
        {"id": 5, "end_id": 4, "theme": "t", "summary": "s"},
        {"id": 6, "end_id": 7},
        {"id": 8, "theme": "open"},
    ]
    got = tuples(
        staging.stg_chapters(raw(spark, video("v", llm_chapter_json={"chapters": listed}))),
        "start_segment_id", "end_segment_id", "chapter_theme", "chapter_summary", "is_valid",
    )
    assert got == [
        (0, 1, "Pets", "one", True),
        (2, 3, None, "two", True),
        (5, 4, "t", "s", False),
        (6, 7, None, None, False),
        (8, None, "open", None, True),
    ]


def test_lone_object_is_an_error(spark):
    df = raw(spark, video("v", llm_chapter_json={"chapters": CHAPTERS[0]}))
    with pytest.raises(Exception):
        staging.stg_chapters(df).collect()


def test_classifications(spark):
    classes = [{"id": 1}, {"id": 2, "reason": " r "}, {"id": "3", "subcategory": "Parenting "}]
    got = tuples(
        staging.stg_classifications(raw(spark, video("v", llm_classifier_json={"classifications": classes}))),
        "start_segment_id", "reason", "subcategory", "is_valid",
    )
    assert got == [(1, None, None, False), (2, "r", None, True), (3, None, "Parenting", True)]


def test_sound_features(spark):
    events = [event(i, 1.0, d, a) for i, (d, a) in enumerate([(1, 0), (1, 1), (1, 1.01), (0, 0.5), (-1, 0.5)], 1)]
    events += [{"sequence": 9}, {"sequence": 10, "points": 3}]
    got = tuples(staging.stg_sound_features(raw(spark, video("v", laugh_events_json={"events": events}))), "sequence", "is_valid")
    assert dict(got) == {1: False, 2: True, 3: False, 4: False, 5: False, 9: False, 10: True}


def test_slices_of_ids_hold_each_row_once(spark):
    rows = spark.createDataFrame([(x,) for x in (None, "a", "b'c", "b'd", "m", "z")], "video_id string")
    for bounds in ([], ["m"], ["m", "b'd", "a", "m"]):
        found = [r.video_id for c in id_slices(bounds) for r in rows.filter(c).collect()]
        assert sorted(found, key=repr) == sorted((r.video_id for r in rows.collect()), key=repr)
