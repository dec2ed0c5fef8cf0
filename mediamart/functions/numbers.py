"""Rounding rules and shares.  Three different rules coexist in the data, see each docstring."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def exact_decimal(x: Column) -> Column:
    """A double as DECIMAL(28,18), so that sums do not depend on the order of the rows."""
    return x.cast("decimal(28,18)")


def round_half_even(x: Column, places: int = 2) -> Column:
    """Round the exact binary value half to even, as Python's ``round`` does."""
    return F.replace(F.format_number(x, places), F.lit(","), F.lit("")).cast("double")


def round_half_up(x: Column, places: int) -> Column:
    """Round a double half away from zero after keeping 15 significant digits.

    This is how PostgreSQL rounds ``float8::numeric``.  The result is DECIMAL(18, places).
    """
    kept = F.when(x.isNotNull(), F.format_string("%.15g", x)).cast("decimal(38,18)")
    return F.round(kept, places).cast(f"decimal(18,{places})")


def round_hundredths(x: Column) -> Column:
    """``round(x * 100) / 100`` in double arithmetic, half away from zero."""
    return F.round(x * 100.0) / 100.0


def percent(part: Column, whole: Column) -> Column:
    """Share in percent with one decimal; a zero ``whole`` is an error under ANSI mode."""
    return round_half_up(part.cast("double") / whole.cast("double") * 100.0, 1)
