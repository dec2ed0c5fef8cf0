"""Range and boundary joins."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _slots(start: Column, end: Column, width: float) -> Column:
    """Numbers of the time slots a range touches; NULL for an empty or unbounded range."""
    first, last = F.floor(start / width), F.floor(end / width)
    return F.when(start <= end, F.sequence(first, last))


def spread_ranges(ranges: DataFrame, start: str, end: str, width: float) -> DataFrame:
    """One row per (range, time slot it touches), in column ``_slot``; a range that touches
    none keeps one row with a NULL slot.

    A range becomes length / width rows.  Chapters are bounded by their video, whose duration
    is a SMALLINT of seconds, so with 300 s slots a chapter touches 110 of them at most.
    """
    return ranges.withColumn("_slot", F.explode_outer(_slots(F.col(start), F.col(end), width)))


def _sides(
    ranges: DataFrame, points: DataFrame, keys: list[str], t: str, start: str, end: str, width: float
) -> tuple[DataFrame, DataFrame, Column]:
    """Ranges ``r`` and points ``p`` with their slots, and the condition that joins them."""
    spread = spread_ranges(ranges, start, end, width).alias("r")
    slotted = points.withColumn("_slot", F.floor(F.col(t) / width)).alias("p")
    same = F.col("r._slot") == F.col("p._slot")
    for key in keys:
        same = same & (F.col(f"r.{key}") == F.col(f"p.{key}"))
    return spread, slotted, same & F.col(f"p.{t}").between(F.col(f"r.{start}"), F.col(f"r.{end}"))


def points_in_ranges(
    ranges: DataFrame,
    points: DataFrame,
    keys: list[str],
    t: str,
    start: str,
    end: str,
    width: float = 300.0,
    how: str = "left",
) -> DataFrame:
    """Join each point to the ranges of the same key that contain it, both ends included.

    The equality part of the join is (keys, time slot), so a key that holds much of the data
    is spread over as many tasks as it has slots, and a point is only compared with ranges
    that touch its slot.  ``how="left"`` keeps ranges without any point, each copy of them.
    """
    spread, slotted, inside = _sides(ranges, points, keys, t, start, end, width)
    own = [c for c in points.columns if c not in keys]
    kept = [F.col(f"r.{c}") for c in ranges.columns]
    if how == "inner":
        return spread.join(slotted, inside).select(*kept, *[F.col(f"p.{c}") for c in own])
    # a match is told by a null-safe comparison of both sides and both uses read all columns, so that
    # the left join stays the same in both and its sides are shuffled once
    point = F.struct(*[F.col(f"p.{c}") for c in own])
    hit = F.coalesce(F.col("p._slot"), F.lit(-(2**62))).eqNullSafe(F.col("r._slot"))
    joined = spread.join(slotted, inside, "left").select(*kept, hit.alias("_hit"), point.alias("_point"))
    matches = joined.filter("_hit").select(*ranges.columns, *[F.col(f"_point.{c}").alias(c) for c in own])
    # a range without any point has one row per slot and copy
    slots = F.greatest(F.lit(1), F.coalesce(F.size(_slots(F.col(start), F.col(end), width)), F.lit(1)))
    empty = (
        joined.groupBy(*ranges.columns)
        .agg(F.max(F.when(F.col("_hit"), F.col("_point"))).alias("_point"), F.count("*").alias("_rows"))
        .filter("_point IS NULL")
        .select(*ranges.columns, F.explode(F.sequence(F.lit(1), (F.col("_rows") / slots).cast("int"))).alias("_copy"))
        .drop("_copy")
    )
    return matches.unionByName(empty, allowMissingColumns=True)


def sum_in_ranges(
    ranges: DataFrame,
    points: DataFrame,
    keys: list[str],
    t: str,
    start: str,
    end: str,
    total: Column,
    name: str,
    width: float = 300.0,
) -> DataFrame:
    """Every distinct range with the aggregate ``total`` over the points inside it.

    A left join over the slots followed by one grouping: a slot without points adds NULLs,
    which aggregates ignore, so ranges without points keep a NULL total.
    """
    spread, slotted, inside = _sides(ranges, points, keys, t, start, end, width)
    return (
        spread.join(slotted, inside, "left")
        .groupBy(*[F.col(f"r.{c}") for c in ranges.columns])
        .agg(total.alias(name))
    )


def newer_rows(rows: DataFrame, existing: DataFrame | None, keys: list[str], order: str) -> DataFrame:
    """Rows later in ``order`` than every stored row of their key; a row whose ``order`` is NULL
    is never held back.  The stored rows are reduced to one per key before the join."""
    if existing is None:
        return rows
    newest = existing.groupBy(*keys).agg(F.max(order).alias("_newest"))
    kept = rows.join(newest, keys, "left").filter(~F.coalesce(F.col("_newest") >= F.col(order), F.lit(False)))
    return kept.select(*rows.columns)


def bound_lookup(
    ranges: DataFrame,
    lookup: DataFrame,
    keys: list[str],
    start_id: str,
    end_id: str,
    lookup_id: str,
    start_value: str,
    end_value: str,
) -> DataFrame:
    """Replace the two ids of a range by ``start_value`` of the row named by ``start_id`` and
    ``end_value`` of the row named by ``end_id``; a range with an unknown id is dropped.

    The lookup table is read and shuffled once for both roles: the ranges are stacked into
    two rows each, joined on (keys, id) and folded back.  (keys, lookup_id) must be unique.
    """
    marks = F.explode(
        F.array(
            F.struct(F.col(start_id).alias("_id"), F.lit(True).alias("_is_start")),
            F.struct(F.col(end_id).alias("_id"), F.lit(False).alias("_is_start")),
        )
    )
    stacked = ranges.select("*", marks.alias("_mark")).select("*", "_mark.*").drop("_mark")
    values = lookup.select(*keys, F.col(lookup_id).alias("_id"), start_value, end_value)
    found = stacked.join(values, [*keys, "_id"])
    return (
        found.groupBy(*ranges.columns)
        .agg(
            F.max(F.when(F.col("_is_start"), F.col(start_value))).alias(start_value),
            F.max(F.when(~F.col("_is_start"), F.col(end_value))).alias(end_value),
            F.count_if("_is_start").alias("_starts"),
            F.count_if(~F.col("_is_start")).alias("_ends"),
        )
        .filter("_starts > 0 and _ends > 0")
        .drop("_starts", "_ends")
    )
