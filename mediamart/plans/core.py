"""Core models: rows to append.  ``existing`` is the stored table, None on the first run.

Tables keyed by video leave out stored videos in the raw rows, before any JSON is parsed: a
raw row is one video, so a video with very many segments or events is one row in that join.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mediamart.functions.json import number
from mediamart.operators.joins import newer_rows
from mediamart.operators.states import above_marks
from mediamart.plans import staging
from mediamart.schemas import CONTRACTS
from mediamart.sources.tables import conform


def unseen(rows: DataFrame, existing: DataFrame | None, keys: list[str]) -> DataFrame:
    """Rows whose key has no stored row; the stored keys are made distinct first."""
    if existing is None:
        return rows
    return rows.join(existing.select(*keys).distinct(), keys, "left_anti")


def _valid(staged: DataFrame) -> DataFrame:
    return staged.filter("is_valid")


def _named(name: str, rows: DataFrame) -> DataFrame:
    return conform(rows.select(*CONTRACTS[name].names), CONTRACTS[name])


def _names(raw: DataFrame, name: str, now: Column, existing: DataFrame | None) -> DataFrame:
    """Distinct (id, name) pairs of unseen ids.  Two names for one id give two rows, which the
    primary-key check reports."""
    key, title, _ = CONTRACTS[name].names
    pairs = _valid(staging.stg_videos_base(raw)).select(key, title).distinct()
    return _named(name, unseen(pairs, existing, [key]).withColumn("created_at", now))


def core_channels(raw: DataFrame, now: Column, existing: DataFrame | None = None) -> DataFrame:
    return _names(raw, "core_channels", now, existing)


def core_playlists(raw: DataFrame, now: Column, existing: DataFrame | None = None) -> DataFrame:
    return _names(raw, "core_playlists", now, existing)


def core_videos(raw: DataFrame, now: Column, existing: DataFrame | None = None) -> DataFrame:
    rows = _valid(staging.stg_videos_base(unseen(raw, existing, ["video_id"])))
    return _named("core_videos", rows.withColumn("created_at", now))


def core_videos_meta(raw: DataFrame, existing: DataFrame | None = None, marks: DataFrame | None = None) -> DataFrame:
    """Snapshots newer than every stored snapshot of their video, told by the stored rows or by their ``marks``."""
    rows = _valid(staging.stg_videos_base(raw)).withColumnRenamed("meta_updated_at", "snapshot_date")
    rows = above_marks(rows, marks, ["video_id"], "snapshot_date")
    return _named("core_videos_meta", newer_rows(rows, existing, ["video_id"], "snapshot_date"))


def core_transcript_segments(raw: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    rows = staging.stg_transcripts(unseen(raw, existing, ["video_id"]))
    return _named("core_transcript_segments", _valid(rows))


def core_sound_features(raw: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    rows = staging.stg_sound_features(unseen(raw, existing, ["video_id"]))
    return _named("core_sound_features", _valid(rows))


def core_chapters(
    raw: DataFrame, core_subcategories: DataFrame, existing: DataFrame | None = None
) -> DataFrame:
    """Chapters with the id of their class.  Invalid chapters stay in; a label that the
    taxonomy does not know drops the chapter; the main category is not compared.

    A video's chapters and classes are in one raw row and meet there, each chapter with every class of
    its segment, so nothing is shuffled.
    """
    new = unseen(raw, existing, ["video_id"])
    chapters = staging.stg_chapters(new.withColumn("_classes", staging.classes_of(new)), "_classes")
    own = F.filter("_classes", lambda k: number(k["id"], "int") == F.col("start_segment_id"))
    rows = chapters.withColumn("_class", F.explode(own)).join(
        core_subcategories, F.trim(F.col("_class.subcategory")) == F.col("subcategory")
    )
    return _named("core_chapters", rows)
