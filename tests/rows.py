"""Small raw rows for the tests."""

import datetime as dt
import json

from mediamart.schemas import RAW

META = {"duration": 600, "like_count": 10, "view_count": 100, "comment_count": 1, "upload_date": "20240115"}
SEGMENTS = [("a", 0.0, 4.5), ("b", 4.5, 9.0), ("c", 9.0, 20.0), ("d", 20.0, 30.0)]
CHAPTERS = [
    {"id": 0, "end_id": 1, "theme": "Pets", "summary": " one "},
    {"id": "2", "end_id": "3", "theme": None, "summary": "two"},
]
CLASSES = [
    {"id": "0", "main_category": "whatever", "subcategory": "Animals & pets ", "reason": "r"},
    {"id": 2, "main_category": "Relationships & Social Life", "subcategory": "Parenting", "reason": "r"},
]


def event(sequence, start, duration, avg=0.5):
    return {
        "sequence": sequence,
        "start_seconds": start,
        "end_seconds": start + duration,
        "duration_seconds": duration,
        "points": 9,
        "avg_confidence": avg,
        "max_confidence": 0.9,
    }


EVENTS = [event(1, 1.0, 2.0), event(2, 9.0, 1.5), event(3, 25.0, 0.5)]


def video(video_id, **changes):
    row = {
        "channel_id": "c1",
        "channel_name": " Channel ",
        "playlist_id": "p1",
        "playlist_title": "List",
        "video_id": video_id,
        "video_title": f" Video {video_id} ",
        "video_url": f"https://media.example/{video_id}",
        "video_meta_json": META,
        "transcribe_json": {str(i): {"text": t, "start": s, "end": e} for i, (t, s, e) in enumerate(SEGMENTS)},
        "llm_chapter_json": {"chapters": CHAPTERS},
        "llm_classifier_json": {"classifications": CLASSES},
        "sound_classifier_json": {"0.05": 0.41},
        "laugh_events_json": {"events": EVENTS},
        "process_status": "finished",
        "created_at": dt.datetime(2024, 2, 1),
        "meta_updated_at": dt.datetime(2024, 2, 1, 13),
    }
    row.update(changes)
    return {k: json.dumps(v) if isinstance(v, (dict, list)) else v for k, v in row.items()}


def raw(spark, *videos):
    return spark.createDataFrame([tuple(v[c] for c in RAW.names) for v in videos], RAW)


def tuples(df, *columns):
    return sorted((tuple(r) for r in (df.select(*columns) if columns else df).collect()), key=repr)
