"""Per-key ordering operators that stay balanced when one key holds much of the data."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def dedupe_first(df: DataFrame, keys: list[str], order: list[str | Column]) -> DataFrame:
    """First row per key by ``order``; rows with a NULL key are dropped.

    Spark limits each key to one row per task before the shuffle (WindowGroupLimit), so a
    key with very many copies does not land in one task.
    """
    ranked = df.dropna(subset=keys).withColumn(
        "_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    )
    return ranked.filter("_rank = 1").drop("_rank")


def latest(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Row with the highest ``order`` per key; a NULL ``order`` counts as the highest."""
    newest_first = Window.partitionBy(*keys).orderBy(F.col(order).desc_nulls_first())
    return (
        df.withColumn("_rank", F.row_number().over(newest_first)).filter("_rank = 1").drop("_rank")
    )


def deltas(df: DataFrame, keys: list[str], order: str, columns: dict[str, str]) -> DataFrame:
    """Change of each column against the previous row of its key: ``{source: result}``.

    All columns share one window.  ``keys`` + ``order`` must be unique; with ``order`` a date
    a key then has at most one row per calendar day, which bounds the window.
    """
    previous = Window.partitionBy(*keys).orderBy(order)
    return df.select(
        *keys,
        order,
        *[(F.col(c) - F.lag(c).over(previous)).alias(name) for c, name in columns.items()],
    )


def patched_deltas(
    stored: DataFrame, late: DataFrame, keys: list[str], order: str, columns: dict[str, str]
) -> DataFrame:
    """Deltas of ``late`` rows and of the rows that follow them: what ``deltas`` over all rows would give for these.

    A late row changes its own delta and that of its successor, no other.  Each late row looks up its neighbours
    in ``stored`` (the last row before and the first row after it), and the window runs over late rows and
    neighbours alone.  A late row with the key and ``order`` of a stored row takes its place.  The result is to be upserted
    by (keys, order).
    """
    carried = [order, *columns]
    asked = late.select(*keys, F.col(order).alias("_at"))
    near = stored.select(*keys, F.struct(*carried).alias("_row")).join(asked, keys)
    before = F.max(F.when(F.col("_row")[order] < F.col("_at"), F.col("_row")))
    after = F.min(F.when(F.col("_row")[order] > F.col("_at"), F.col("_row")))
    pairs = near.groupBy(*keys, "_at").agg(before.alias("_before"), after.alias("_after"))
    neighbour = lambda c, changes: F.struct(F.lit(changes).alias("changes"), F.col(c).alias("row"))
    neighbours = (
        pairs.select(*keys, F.explode(F.array(neighbour("_before", False), neighbour("_after", True))).alias("_n"))
        .filter("_n.row IS NOT NULL")
        .groupBy(*keys, F.col("_n.row").alias("_row"))
        .agg(F.max("_n.changes").alias("_changes"))
        .select(*keys, "_row.*", "_changes")
        .join(late.select(*keys, order), [*keys, order], "left_anti")
    )
    few = late.select(*keys, *carried, F.lit(True).alias("_changes")).unionByName(neighbours)
    previous = Window.partitionBy(*keys).orderBy(order)
    changed = few.select(
        *keys, order, *[(F.col(c) - F.lag(c).over(previous)).alias(name) for c, name in columns.items()], "_changes"
    )
    return changed.filter("_changes").drop("_changes")


def number_rows(
    df: DataFrame, keys: list[str], order: str, bucket: Column, name: str = "sequence"
) -> DataFrame:
    """Number the rows of each key from 1 by ``order``.

    ``bucket`` must not decrease along ``order``.  Rows are numbered inside (key, bucket) and
    shifted by the number of rows in the key's earlier buckets, so that no task sees more than
    one bucket of rows; only the counts, one row per bucket, meet per key.  A NULL key is a key
    like others, and a NULL ``order`` (with its NULL bucket) comes first, as in ``row_number()``.
    """
    lanes = df.withColumn("_bucket", bucket)
    local = Window.partitionBy(*keys, "_bucket").orderBy(order)
    numbered = lanes.withColumn("_local", F.row_number().over(local))
    # the counts read all columns of the numbered rows, so that both uses share one exchange and ``df`` is computed once
    every = F.when(F.col("_local") > 0, F.struct(*[F.col(c) for c in df.columns]))
    counts = numbered.groupBy(*keys, "_bucket").agg(F.count(every).alias("_rows"))
    earlier = (
        Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    )
    shifts = counts.select(
        *keys, "_bucket", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_shift")
    ).alias("s")
    numbered = numbered.alias("n")
    same = F.lit(True)
    for column in [*keys, "_bucket"]:
        same = same & F.col(f"n.{column}").eqNullSafe(F.col(f"s.{column}"))
    return numbered.join(shifts, same).select(
        *[F.col(f"n.{c}") for c in df.columns], (F.col("_local") + F.col("_shift")).cast("int").alias(name)
    )
