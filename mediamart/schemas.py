"""Declared schemas, keys and references of every table.  Nothing is inferred."""

from pyspark.sql import types as T

TYPES = {
    "string": T.StringType(),
    "short": T.ShortType(),
    "int": T.IntegerType(),
    "long": T.LongType(),
    "double": T.DoubleType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
    "boolean": T.BooleanType(),
    "variant": T.VariantType(),
    "seconds": T.DecimalType(18, 2),
    "share": T.DecimalType(18, 1),
}


def struct(**columns: str) -> T.StructType:
    return T.StructType([T.StructField(name, TYPES[kind]) for name, kind in columns.items()])


ARTEFACTS = [
    "video_meta_json",
    "transcribe_json",
    "llm_chapter_json",
    "llm_classifier_json",
    "sound_classifier_json",
    "laugh_events_json",
]

RAW = struct(
    channel_id="string",
    channel_name="string",
    playlist_id="string",
    playlist_title="string",
    video_id="string",
    video_title="string",
    video_url="string",
    **{name: "string" for name in ARTEFACTS},
    process_status="string",
    created_at="timestamp",
    meta_updated_at="timestamp",
)

# The raw table with its artefacts parsed.
RAW_PARSED = T.StructType([T.StructField(f.name, T.VariantType()) if f.name in ARTEFACTS else f for f in RAW])

PLAYLISTS = (
    "id string, title string, "
    "entries array<struct<id: string, title: string, url: string, channel_id: string, channel: string>>"
)

META_KEYS = ["duration", "like_count", "view_count", "comment_count", "upload_date"]
META_FIELDS = ", ".join(f"{key} string" for key in META_KEYS)
SEGMENT_FIELDS = "text: string, start: string, end: string"
CHAPTER_FIELDS = "id: string, end_id: string, theme: string, summary: string"
CLASSIFICATION_FIELDS = "id: string, main_category: string, subcategory: string, reason: string"
EVENT_FIELDS = (
    "sequence: string, start_seconds: string, end_seconds: string, duration_seconds: string, "
    "points: string, avg_confidence: string, max_confidence: string"
)

CALENDAR = struct(
    date_id="int",
    date="date",
    year="int",
    quarter="int",
    month="int",
    month_name="string",
    week_of_year="int",
    day_of_week="int",
    day_name="string",
    is_weekend="boolean",
)

CONTRACTS = {
    "process_video": RAW,
    "dim_date": CALENDAR,
    "core_channels": struct(channel_id="string", channel_name="string", created_at="timestamp"),
    "core_playlists": struct(playlist_id="string", playlist_title="string", created_at="timestamp"),
    "core_videos": struct(
        video_id="string",
        channel_id="string",
        playlist_id="string",
        video_title="string",
        duration="short",
        upload_date="date",
        created_at="timestamp",
    ),
    "core_videos_meta": struct(
        video_id="string",
        snapshot_date="date",
        like_count="int",
        view_count="int",
        comment_count="int",
    ),
    "core_transcript_segments": struct(
        video_id="string",
        segment_id="short",
        segment_text="string",
        start_s="double",
        end_s="double",
    ),
    "core_sound_features": struct(
        video_id="string",
        sequence="short",
        points="short",
        duration_seconds="double",
        start_seconds="double",
        end_seconds="double",
        avg_confidence="double",
        max_confidence="double",
    ),
    "core_chapters": struct(
        video_id="string",
        start_segment_id="short",
        end_segment_id="short",
        chapter_summary="string",
        subcategory_id="short",
    ),
    "core_categories": struct(category_id="short", main_category="string"),
    "core_subcategories": struct(subcategory_id="short", category_id="short", subcategory="string"),
    "dim_channels": struct(channel_id="string", channel_name="string"),
    "dim_playlists": struct(playlist_id="string", playlist_title="string"),
    "dim_videos": struct(video_id="string", video_title="string"),
    "dim_category": struct(category_id="short", main_category="string"),
    "dim_subcategory": struct(subcategory_id="short", subcategory="string"),
    "fact_video_chapters": struct(
        video_id="string",
        date_id="int",
        channel_id="string",
        playlist_id="string",
        subcategory_id="short",
        category_id="short",
        start_s="double",
        end_s="double",
        duration="seconds",
        laughter_percent="share",
    ),
    "fact_video_daily_snapshot": struct(
        video_id="string",
        date_id="int",
        channel_id="string",
        playlist_id="string",
        prev_day_view="long",
        prev_day_like="long",
        prev_day_comment="long",
    ),
    "fact_video_metrics": struct(
        video_id="string",
        playlist_id="string",
        channel_id="string",
        date_id="int",
        view_count="int",
        like_count="int",
        comment_count="int",
        duration="int",
        laughter_percent="share",
    ),
}

# Rows are replaced on these columns when a table is upserted.
UPSERT_KEYS = {
    "dim_channels": ["channel_id"],
    "dim_playlists": ["playlist_id"],
    "dim_videos": ["video_id"],
    "dim_category": ["category_id"],
    "dim_subcategory": ["subcategory_id"],
    "fact_video_chapters": ["video_id", "subcategory_id", "start_s"],
    "fact_video_daily_snapshot": ["video_id", "date_id"],
    "fact_video_metrics": ["video_id"],
}

# Layouts of stored tables, see ``mediamart.sources.tables``.
BY_VIDEO = ["core_videos", "core_videos_meta", "core_transcript_segments", "core_sound_features", "core_chapters"]
MONTHLY = ["fact_video_chapters", "fact_video_daily_snapshot", "fact_video_metrics"]
KEYED = {"process_video": ["video_id"], **{name: key for name, key in UPSERT_KEYS.items() if name not in MONTHLY}}

PRIMARY_KEYS = {
    "process_video": ["video_id"],
    "core_channels": ["channel_id"],
    "core_playlists": ["playlist_id"],
    "core_videos": ["video_id"],
    "core_videos_meta": ["video_id", "snapshot_date"],
    "core_transcript_segments": ["video_id", "segment_id"],
    "core_sound_features": ["video_id", "sequence"],
    "core_chapters": ["video_id", "start_segment_id", "end_segment_id"],
    "core_categories": ["category_id"],
    "core_subcategories": ["subcategory_id"],
    **UPSERT_KEYS,
    "fact_video_metrics": ["video_id", "date_id"],
}

# Combinations that must be unique in staging, where no primary key is declared.
UNIQUE = {
    "stg_transcripts": ["video_id", "segment_id"],
    "stg_sound_features": ["video_id", "sequence"],
    "stg_chapters": ["video_id", "start_segment_id", "end_segment_id"],
    "stg_classifications": ["video_id", "start_segment_id"],
}

NOT_NULL = {
    "core_channels": ["channel_name", "created_at"],
    "core_playlists": ["playlist_title", "created_at"],
    "core_videos": ["channel_id", "playlist_id", "video_title", "duration", "upload_date", "created_at"],
    "core_videos_meta": ["video_id", "view_count", "like_count", "comment_count"],
    "core_transcript_segments": ["start_s", "end_s", "segment_text"],
    "core_sound_features": [
        "points",
        "start_seconds",
        "end_seconds",
        "duration_seconds",
        "avg_confidence",
        "max_confidence",
    ],
    "core_chapters": ["subcategory_id", "start_segment_id", "end_segment_id"],
    "core_categories": ["main_category"],
    "core_subcategories": ["category_id", "subcategory"],
    "fact_video_chapters": ["start_s", "end_s", "duration"],
    "chapters_metrics": ["main_category", "subcategory", "video_title", "channel_name", "date"],
    "video_metrics": ["channel_name", "video_title", "subcategory", "date"],
    "video_daily_snapshot": ["video_title", "channel_name", "date_id"],
    "dwh_statistics": ["label"],
}

_FACT_PARENTS = [
    (["video_id"], "dim_videos", ["video_id"]),
    (["channel_id"], "dim_channels", ["channel_id"]),
    (["playlist_id"], "dim_playlists", ["playlist_id"]),
]

# child table -> (child columns, parent table, parent columns)
FOREIGN_KEYS = {
    "core_videos": [
        (["channel_id"], "core_channels", ["channel_id"]),
        (["playlist_id"], "core_playlists", ["playlist_id"]),
    ],
    "core_videos_meta": [(["video_id"], "core_videos", ["video_id"])],
    "core_transcript_segments": [(["video_id"], "core_videos", ["video_id"])],
    "core_sound_features": [(["video_id"], "core_videos", ["video_id"])],
    "core_chapters": [
        (["video_id", "start_segment_id"], "core_transcript_segments", ["video_id", "segment_id"]),
        (["video_id", "end_segment_id"], "core_transcript_segments", ["video_id", "segment_id"]),
        (["subcategory_id"], "core_subcategories", ["subcategory_id"]),
    ],
    "core_subcategories": [(["category_id"], "core_categories", ["category_id"])],
    "fact_video_chapters": [
        *_FACT_PARENTS,
        (["subcategory_id"], "dim_subcategory", ["subcategory_id"]),
        (["category_id"], "dim_category", ["category_id"]),
    ],
    "fact_video_daily_snapshot": _FACT_PARENTS,
    "fact_video_metrics": _FACT_PARENTS,
}
