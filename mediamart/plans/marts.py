"""Marts: dimensions and facts, computed from the core tables."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mediamart.functions.numbers import exact_decimal, percent, round_half_up
from mediamart.operators.joins import bound_lookup, sum_in_ranges
from mediamart.operators.windows import deltas, latest
from mediamart.schemas import CONTRACTS
from mediamart.sources.tables import conform


def dimension(core: DataFrame, name: str) -> DataFrame:
    """The declared columns of the dimension ``name``."""
    return core.select(*CONTRACTS[name].names)


def _named(name: str, rows: DataFrame) -> DataFrame:
    return conform(rows.select(*CONTRACTS[name].names), CONTRACTS[name])


def chapter_times(
    core_chapters: DataFrame, core_subcategories: DataFrame, core_transcript_segments: DataFrame
) -> DataFrame:
    """Start and end of each chapter in seconds, from its first and last segment."""
    chapters = core_chapters.select("video_id", "subcategory_id", "start_segment_id", "end_segment_id")
    timed = bound_lookup(
        chapters,
        core_transcript_segments,
        ["video_id"],
        "start_segment_id",
        "end_segment_id",
        "segment_id",
        "start_s",
        "end_s",
    )
    return timed.join(core_subcategories.select("subcategory_id", "category_id"), "subcategory_id").select(
        "video_id",
        "subcategory_id",
        "category_id",
        "start_s",
        "end_s",
        round_half_up(F.col("end_s") - F.col("start_s"), 2).alias("duration"),
    )


def fact_video_chapters(
    core_chapters: DataFrame,
    core_subcategories: DataFrame,
    core_transcript_segments: DataFrame,
    core_sound_features: DataFrame,
    core_videos: DataFrame,
    dim_date: DataFrame,
) -> DataFrame:
    """Chapters with the share of their time taken by events that start inside them, 0 when
    there are none.  An event on a shared boundary counts in both chapters."""
    times = chapter_times(core_chapters, core_subcategories, core_transcript_segments)
    events = core_sound_features.select("video_id", "start_seconds", "duration_seconds")
    shared = sum_in_ranges(
        times,
        events,
        ["video_id"],
        "start_seconds",
        "start_s",
        "end_s",
        F.sum(exact_decimal(F.col("duration_seconds"))),
        "laughter",
    )
    share = F.when(F.col("laughter").isNotNull(), percent(F.col("laughter"), F.col("duration")))
    videos = core_videos.select("video_id", "channel_id", "playlist_id", "upload_date")
    rows = (
        shared.withColumn("laughter_percent", F.coalesce(share, F.lit(0)))
        .join(videos, "video_id")
        .join(dim_date.select("date_id", "date"), F.col("upload_date") == F.col("date"))
    )
    return _named("fact_video_chapters", rows)


def fact_video_daily_snapshot(
    core_videos_meta: DataFrame, core_videos: DataFrame, dim_date: DataFrame
) -> DataFrame:
    """Change of each metric since the previous snapshot; NULL for the first one.

    Window, join and grouping all work on video_id, so the snapshots are shuffled once.
    """
    changes = deltas(
        core_videos_meta,
        ["video_id"],
        "snapshot_date",
        {
            "view_count": "prev_day_view",
            "like_count": "prev_day_like",
            "comment_count": "prev_day_comment",
        },
    )
    videos = core_videos.select("video_id", "channel_id", "playlist_id")
    rows = (
        changes.join(videos, "video_id")
        .join(dim_date.select("date_id", "date"), F.col("snapshot_date") == F.col("date"))
        .groupBy("date_id", "video_id", "channel_id", "playlist_id")
        .agg(
            *[F.sum(c).alias(c) for c in ("prev_day_view", "prev_day_like", "prev_day_comment")]
        )
    )
    return _named("fact_video_daily_snapshot", rows)


def laughter_seconds(core_sound_features: DataFrame) -> DataFrame:
    """Total length per video of the events longer than one second.  Durations are added up
    before any join, so a join with it sees one row per video."""
    return (
        core_sound_features.filter("duration_seconds > 1")
        .groupBy("video_id")
        .agg(F.sum(exact_decimal(F.col("duration_seconds"))).alias("laughter"))
    )


def fact_video_metrics(
    core_videos: DataFrame,
    core_videos_meta: DataFrame,
    core_sound_features: DataFrame,
    dim_date: DataFrame,
) -> DataFrame:
    """Latest metrics and laughter share per video; a video without an event longer than one
    second is absent."""
    newest = latest(core_videos_meta, ["video_id"], "snapshot_date")
    rows = (
        core_videos.join(newest, "video_id")
        .join(laughter_seconds(core_sound_features), "video_id")
        .join(dim_date.select("date_id", "date"), F.col("upload_date") == F.col("date"))
        .withColumn("laughter_percent", percent(F.col("laughter"), F.col("duration")))
    )
    return _named("fact_video_metrics", rows).distinct()
