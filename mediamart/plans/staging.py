"""Staging models: JSON artefacts of finished videos as typed rows with a validity flag.

The artefacts may be JSON text or VARIANT (``mediamart.sources.raw.parse_artefacts``); of a VARIANT only the paths that a
model names are read, and no model parses text again."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mediamart.functions.json import compact_date, entries_of, number, parse_of, records_of
from mediamart.operators.ingest import FINISHED
from mediamart.schemas import CHAPTER_FIELDS, CLASSIFICATION_FIELDS, EVENT_FIELDS, META_FIELDS, SEGMENT_FIELDS


def _finished(raw: DataFrame) -> DataFrame:
    return raw.filter(F.col("process_status") == FINISHED)


def _exploded(raw: DataFrame, artefact: str, items: Column, *kept: str) -> DataFrame:
    """One row per element, with ``kept`` columns of its video; videos without elements vanish."""
    some = _finished(raw).filter(F.col(artefact).isNotNull())
    return some.select("video_id", *kept, F.explode(items).alias("item")).select("video_id", *kept, "item.*")


def _blank(c: str) -> Column:
    return F.col(c).isNull() | (F.col(c) == "")


def valid_video() -> Column:
    """Ids and status present."""
    return (
        F.when(_blank("video_id"), False)
        .when(_blank("channel_id"), False)
        .when(_blank("playlist_id"), False)
        .when(F.col("process_status").isNull() | (F.col("process_status") != FINISHED), False)
        .otherwise(True)
    )


def valid_segment() -> Column:
    """Text present before trimming, end after start; unknown times pass."""
    return F.when(_blank("segment_text"), False).when(F.col("end_s") <= F.col("start_s"), False).otherwise(True)


def valid_chapter() -> Column:
    """A theme or a summary, end not before start; unknown ends pass."""
    return (
        F.when(F.coalesce("chapter_theme", "chapter_summary").isNull(), False)
        .when(F.col("end_segment_id") < F.col("start_segment_id"), False)
        .otherwise(True)
    )


def valid_classification() -> Column:
    """Any of the three texts."""
    return F.coalesce("reason", "subcategory", "main_category").isNotNull()


def valid_event() -> Column:
    """Any measure, a positive duration, a mean confidence above 0 and up to 1."""
    measures = ["duration_seconds", "avg_confidence", "max_confidence", "start_seconds", "end_seconds", "points"]
    return (
        F.when(F.coalesce(*measures).isNull(), False)
        .when(F.col("duration_seconds") <= 0, False)
        .when((F.col("avg_confidence") <= 0) | (F.col("avg_confidence") > 1), False)
        .otherwise(True)
    )


def stg_videos_base(raw: DataFrame) -> DataFrame:
    meta = parse_of(raw, "video_meta_json", META_FIELDS)
    return _finished(raw).withColumn("meta", meta).select(
        "video_id",
        "channel_id",
        "playlist_id",
        F.trim("video_title").alias("video_title"),
        F.trim("channel_name").alias("channel_name"),
        F.trim("playlist_title").alias("playlist_title"),
        number(F.col("meta.duration"), "int").alias("duration"),
        number(F.col("meta.like_count"), "int").alias("like_count"),
        number(F.col("meta.view_count"), "int").alias("view_count"),
        number(F.col("meta.comment_count"), "int").alias("comment_count"),
        compact_date(F.col("meta.upload_date")).alias("upload_date"),
        "process_status",
        F.to_date("meta_updated_at").alias("meta_updated_at"),
        valid_video().alias("is_valid"),
    )


def stg_transcripts(raw: DataFrame) -> DataFrame:
    segments = entries_of(raw, "transcribe_json", SEGMENT_FIELDS)
    return (
        _exploded(raw, "transcribe_json", segments)
        .select(
            "video_id",
            number(F.col("key"), "int").alias("segment_id"),
            number(F.col("value.start"), "double").alias("start_s"),
            number(F.col("value.end"), "double").alias("end_s"),
            F.col("value.text").alias("segment_text"),
        )
        .withColumn("is_valid", valid_segment())
        .withColumn("segment_text", F.trim("segment_text"))
    )


def stg_chapters(raw: DataFrame, *kept: str) -> DataFrame:
    chapters = records_of(raw, "llm_chapter_json", "chapters", CHAPTER_FIELDS)
    return (
        _exploded(raw, "llm_chapter_json", chapters, *kept)
        .select(
            "video_id",
            *kept,
            number(F.col("id"), "int").alias("start_segment_id"),
            number(F.col("end_id"), "int").alias("end_segment_id"),
            F.col("theme").alias("chapter_theme"),
            F.col("summary").alias("chapter_summary"),
        )
        .withColumn("is_valid", valid_chapter())
        .withColumn("chapter_theme", F.trim("chapter_theme"))
        .withColumn("chapter_summary", F.trim("chapter_summary"))
    )


def classes_of(raw: DataFrame) -> Column:
    """The classes of a video, as they are in its row."""
    return records_of(raw, "llm_classifier_json", "classifications", CLASSIFICATION_FIELDS)


def stg_classifications(raw: DataFrame) -> DataFrame:
    return (
        _exploded(raw, "llm_classifier_json", classes_of(raw))
        .select(
            "video_id",
            number(F.col("id"), "int").alias("start_segment_id"),
            F.trim("reason").alias("reason"),
            F.trim("subcategory").alias("subcategory"),
            F.trim("main_category").alias("main_category"),
        )
        .withColumn("is_valid", valid_classification())
    )


def stg_sound_features(raw: DataFrame) -> DataFrame:
    events = records_of(raw, "laugh_events_json", "events", EVENT_FIELDS)
    ints, doubles = ["sequence", "points"], [
        "duration_seconds",
        "start_seconds",
        "end_seconds",
        "avg_confidence",
        "max_confidence",
    ]
    return (
        _exploded(raw, "laugh_events_json", events)
        .select(
            "video_id",
            *[number(F.col(c), "int").alias(c) for c in ints],
            *[number(F.col(c), "double").alias(c) for c in doubles],
        )
        .withColumn("is_valid", valid_event())
    )


STAGING = {
    "stg_videos_base": stg_videos_base,
    "stg_transcripts": stg_transcripts,
    "stg_chapters": stg_chapters,
    "stg_classifications": stg_classifications,
    "stg_sound_features": stg_sound_features,
}
