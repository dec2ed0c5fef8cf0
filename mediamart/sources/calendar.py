"""Generated calendar dimension."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mediamart.functions.dates import date_key, is_weekend, iso_day
from mediamart.schemas import CALENDAR


def describe_days(days: DataFrame, date: str = "date") -> DataFrame:
    """Calendar attributes of each date in ``days``."""
    d = F.col(date)
    return days.select(
        date_key(d).alias("date_id"),
        d.alias("date"),
        F.year(d).alias("year"),
        F.quarter(d).alias("quarter"),
        F.month(d).alias("month"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.weekofyear(d).alias("week_of_year"),
        iso_day(d).alias("day_of_week"),
        F.date_format(d, "EEEE").alias("day_name"),
        is_weekend(d).alias("is_weekend"),
    ).select(*[F.col(f.name).cast(f.dataType) for f in CALENDAR])


def calendar(spark: SparkSession, start: str, end: str) -> DataFrame:
    """One row per day from ``start`` to ``end`` (ISO dates, both inclusive).

    Its size is bounded by the number of days, so joins to it may be broadcast.
    """
    bounds = spark.range(1).select(F.lit(start).cast("date").alias("a"), F.lit(end).cast("date").alias("b"))
    return describe_days(bounds.select(F.explode(F.sequence("a", "b")).alias("date")))


def calendar_between(df: DataFrame, date: str) -> DataFrame:
    """Calendar from the first to the last ``date`` found in ``df``, without leaving Spark."""
    bounds = df.agg(F.min(date).cast("date").alias("a"), F.max(date).cast("date").alias("b"))
    return describe_days(bounds.select(F.explode(F.sequence("a", "b")).alias("date")))
