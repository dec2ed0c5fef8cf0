"""Calendar and clock expressions."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def date_key(d: Column) -> Column:
    return F.date_format(d, "yyyyMMdd").cast("int")


def iso_day(d: Column) -> Column:
    """Day of week, Monday = 1."""
    return F.weekday(d) + 1


def is_weekend(d: Column) -> Column:
    return F.weekday(d) >= 5


def clock(seconds: Column) -> Column:
    """Whole seconds as HH:MM:SS; the hours may exceed 24."""
    return F.when(
        seconds.isNotNull(),
        F.format_string(
            "%02d:%02d:%02d",
            F.floor(seconds / 3600),
            F.floor(seconds % 3600 / 60),
            seconds % 60,
        ),
    )
