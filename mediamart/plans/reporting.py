"""Dashboard views: denormalised reads over facts and dimensions.

How they are joined is left to Spark, which measures the tables at run time and splits hot keys.  A fact
that comes with its partition column ``_month`` is joined to the calendar by month and day, so a filter on the
calendar's columns leaves out months at run time, before their files are opened.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mediamart.functions.dates import clock
from mediamart.schemas import CALENDAR

DAY_COLUMNS = [c for c in CALENDAR.names if c != "date_id"]

# The labels of the summary report.
TOTAL_CHANNELS = "1. Всего каналов"
TOTAL_PLAYLISTS = "2. Всего плейлистов"
TOTAL_VIDEOS = "3. Всего видео"
TOTAL_HOURS = "4. Всего часов"


def with_days(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    """The fact with the calendar's columns; days that the calendar lacks are dropped."""
    if "_month" not in fact.columns:
        return fact.join(dim_date, "date_id")
    days = dim_date.withColumn("_month", F.expr("date_id div 100").cast("int"))
    return fact.join(days, ["_month", "date_id"]).drop("_month")


def chapters_metrics(
    fact_video_chapters: DataFrame,
    dim_category: DataFrame,
    dim_subcategory: DataFrame,
    dim_date: DataFrame,
    dim_videos: DataFrame,
    dim_channels: DataFrame,
    dim_playlists: DataFrame,
) -> DataFrame:
    """Chapters with the names of everything they refer to."""
    return (
        with_days(fact_video_chapters, dim_date)
        .join(dim_category, "category_id")
        .join(dim_subcategory, "subcategory_id")
        .join(dim_videos, "video_id")
        .join(dim_channels, "channel_id")
        .join(dim_playlists, "playlist_id")
        .select(
            "main_category",
            "subcategory",
            "video_title",
            "channel_name",
            "playlist_title",
            "duration",
            "laughter_percent",
            *DAY_COLUMNS,
        )
    )


def video_metrics(
    fact_video_metrics: DataFrame,
    fact_video_chapters: DataFrame,
    dim_category: DataFrame,
    dim_subcategory: DataFrame,
    dim_date: DataFrame,
    dim_videos: DataFrame,
    dim_channels: DataFrame,
    dim_playlists: DataFrame,
) -> DataFrame:
    """Video metrics with the topics of the video: one row per chapter, metrics repeated, so
    they must not be added up over it."""
    topics = (
        fact_video_chapters.select("video_id", "subcategory_id", "category_id")
        .join(dim_subcategory, "subcategory_id")
        .join(dim_category, "category_id")
    )
    return (
        with_days(fact_video_metrics, dim_date)
        .join(dim_videos, "video_id")
        .join(dim_channels, "channel_id")
        .join(dim_playlists, "playlist_id")
        .join(topics, "video_id")
        .select(
            "channel_name",
            "playlist_title",
            "video_title",
            "subcategory",
            "main_category",
            "view_count",
            "laughter_percent",
            "like_count",
            "comment_count",
            "duration",
            *DAY_COLUMNS,
            clock(F.col("duration")).alias("duration_hms"),
        )
    )


def video_daily_snapshot(
    fact_video_daily_snapshot: DataFrame,
    dim_date: DataFrame,
    dim_videos: DataFrame,
    dim_channels: DataFrame,
    dim_playlists: DataFrame,
) -> DataFrame:
    """Daily changes with all calendar columns first."""
    return (
        with_days(fact_video_daily_snapshot, dim_date)
        .join(dim_videos, "video_id")
        .join(dim_channels, "channel_id")
        .join(dim_playlists, "playlist_id")
        .select(
            *CALENDAR.names,
            "video_title",
            "channel_name",
            "playlist_title",
            "prev_day_view",
            "prev_day_like",
            "prev_day_comment",
        )
    )


def dwh_statistics(
    dim_channels: DataFrame, dim_playlists: DataFrame, dim_videos: DataFrame, fact_video_metrics: DataFrame
) -> DataFrame:
    """Four labelled totals; hours are whole."""

    def total(df: DataFrame, label: str, value: str) -> DataFrame:
        return df.agg(F.expr(value).alias("total")).select(F.lit(label).alias("label"), "total")

    return (
        total(dim_channels, TOTAL_CHANNELS, "count(channel_id)")
        .union(total(dim_playlists, TOTAL_PLAYLISTS, "count(playlist_id)"))
        .union(total(dim_videos, TOTAL_VIDEOS, "count(video_id)"))
        .union(total(fact_video_metrics, TOTAL_HOURS, "sum(duration) div 3600"))
        .distinct()
    )
