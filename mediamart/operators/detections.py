"""Detector points to events.

Two forms of the same computation: ``cluster_points`` for tables of points, where one key may
hold very many rows, and ``add_events`` for the JSON artefact, where all points of a video sit
in one cell and no shuffle is needed.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mediamart.functions.arrays import let
from mediamart.functions.json import entries
from mediamart.functions.numbers import exact_decimal, round_half_even, round_hundredths
from mediamart.operators.windows import number_rows

EVENT_COLUMNS = [
    "sequence",
    "start_seconds",
    "end_seconds",
    "duration_seconds",
    "points",
    "avg_confidence",
    "max_confidence",
]


def select_points(
    points: DataFrame,
    label: str = "laughter",
    min_confidence: float = 0.2,
    keys: list[str] = ["video_id"],
    t: str = "t",
    label_column: str = "label",
    confidence: str = "confidence",
    order: str = "seq",
) -> DataFrame:
    """Points of one label at or above the threshold; the last write per timestamp wins."""
    wanted = (F.col(label_column) == label) & (F.col(confidence) >= min_confidence)
    rounded = round_hundredths(F.col(confidence))
    return (
        points.filter(wanted).groupBy(*keys, t).agg(F.max_by(rounded, F.col(order)).alias(confidence))
    )


def explode_points(
    raw: DataFrame, json_column: str, keys: list[str] = ["video_id"], t: str = "t", confidence: str = "confidence"
) -> DataFrame:
    """Rows of a ``{"<seconds>": confidence}`` artefact; NULL and ``{}`` give no rows."""
    members = F.explode(entries(F.col(json_column), "double"))
    return raw.select(*keys, members.alias("_point")).select(
        *keys, F.col("_point.key").cast("double").alias(t), F.col("_point.value").alias(confidence)
    )


def sort_points(points: DataFrame, keys: list[str] = ["video_id"], t: str = "t") -> DataFrame:
    """Time order inside each key: range partitions by (key, time), each sorted, so that a key
    with many points is cut at sampled times instead of filling one task."""
    return points.repartitionByRange(*keys, t).sortWithinPartitions(*keys, t)


def gap_clusters(
    points: DataFrame,
    keys: list[str] = ["video_id"],
    t: str = "t",
    confidence: str = "confidence",
    max_gap: float = 0.2,
    bucket_seconds: float = 600.0,
) -> DataFrame:
    """Runs of points in which no step is longer than ``max_gap``, with their aggregates.

    The points are first clustered inside time buckets of each key.  Only the first and the
    last piece of a bucket can continue into a neighbouring bucket, so only these two meet per
    key; the pieces between them are final and stay where they are.  No task ever holds more
    than one bucket of points, or two rows per bucket of one key.  A point without a time belongs
    to no cluster and is left out.
    """
    bucketed = points.select(
        *keys,
        F.col(t).alias("_t"),
        F.col(confidence).alias("_c"),
        F.floor(F.col(t) / bucket_seconds).alias("_bucket"),
    ).filter("_t is not null")

    in_bucket = Window.partitionBy(*keys, "_bucket").orderBy("_t")
    last = bucketed.withColumn("_last", F.lead("_t").over(in_bucket).isNull())
    pieces = (
        _run_numbers(last, in_bucket, F.col("_t"), F.col("_t"), max_gap)
        .groupBy(*keys, "_bucket", "_run")
        .agg(
            F.min("_t").alias("start"),
            F.max("_t").alias("end"),
            F.count("*").alias("points"),
            F.sum(exact_decimal(F.col("_c"))).alias("total"),
            F.max("_c").alias("max_confidence"),
            F.max("_last").alias("_last"),
        )
    )

    at_edge = (F.col("_run") == 0) | F.col("_last")
    lanes = pieces.withColumn("_lane", F.when(~at_edge, F.col("_bucket"))).drop("_run", "_bucket", "_last")

    in_lane = Window.partitionBy(*keys, "_lane").orderBy("start")
    return (
        _run_numbers(lanes, in_lane, F.col("start"), F.col("end"), max_gap)
        .groupBy(*keys, "_lane", "_run")
        .agg(
            F.min("start").alias("start"),
            F.max("end").alias("end"),
            F.sum("points").alias("points"),
            F.sum("total").alias("_total"),
            F.max("max_confidence").alias("max_confidence"),
        )
        .select(
            *keys,
            "start",
            "end",
            (F.col("end") - F.col("start")).alias("duration"),
            "points",
            (F.col("_total").cast("double") / F.col("points")).alias("avg_confidence"),
            "max_confidence",
        )
    )


def _run_numbers(df: DataFrame, window, start: Column, end: Column, max_gap: float) -> DataFrame:
    """Running number of the cluster, raised where the step from the previous row is too long."""
    is_new = F.coalesce((start - F.lag(end).over(window) > max_gap).cast("int"), F.lit(0))
    frame = window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return df.withColumn("_new", is_new).withColumn("_run", F.sum("_new").over(frame)).drop("_new")


def keep_events(clusters: DataFrame, min_duration: float = 0.4, min_avg: float = 0.3) -> DataFrame:
    """Clusters that are long enough and sure enough, both tested before rounding."""
    return clusters.filter((F.col("duration") >= min_duration) & (F.col("avg_confidence") >= min_avg))


def number_events(
    events: DataFrame, keys: list[str] = ["video_id"], bucket_seconds: float = 6000.0
) -> DataFrame:
    """Number the kept events of each key from 1 in time order, then round to two places."""
    numbered = number_rows(events, keys, "start", F.floor(F.col("start") / bucket_seconds))
    return numbered.select(
        *keys,
        "sequence",
        round_half_even(F.col("start")).alias("start_seconds"),
        round_half_even(F.col("end")).alias("end_seconds"),
        round_half_even(F.col("duration")).alias("duration_seconds"),
        F.col("points").cast("int").alias("points"),
        round_half_even(F.col("avg_confidence")).alias("avg_confidence"),
        round_half_even(F.col("max_confidence")).alias("max_confidence"),
    )


def cluster_points(
    points: DataFrame,
    keys: list[str] = ["video_id"],
    t: str = "t",
    confidence: str = "confidence",
    max_gap: float = 0.2,
    min_duration: float = 0.4,
    min_avg: float = 0.3,
    bucket_seconds: float = 600.0,
) -> DataFrame:
    """Numbered, rounded events of a table of points."""
    clusters = gap_clusters(points, keys, t, confidence, max_gap, bucket_seconds)
    return number_events(keep_events(clusters, min_duration, min_avg), keys, bucket_seconds * 10)


def events_payload(
    events: DataFrame, all_keys: DataFrame, keys: list[str] = ["video_id"], name: str = "laugh_events_json"
) -> DataFrame:
    """One ``{"events": [...]}`` cell per key; a key without events gets an empty array.

    A cell holds the events of one video, which is the artefact's own unit: it is smaller than
    the cell of points it was made from.  Take the points of rows without a NULL key: the join wants none
    and pushes that down on one of the two ways by which ``number_rows`` reads its rows, which are then
    computed twice.
    """
    gathered = events.groupBy(*keys).agg(
        F.sort_array(F.collect_list(F.struct(*EVENT_COLUMNS))).alias("events")
    )
    empty = F.from_json(F.lit("[]"), gathered.schema["events"].dataType)
    return all_keys.join(gathered, keys, "left").select(
        *keys, F.to_json(F.struct(F.coalesce("events", empty).alias("events"))).alias(name)
    )


def events_json(
    points: Column, max_gap: float = 0.2, min_duration: float = 0.4, min_avg: float = 0.3
) -> Column:
    """The events artefact made from the points artefact of the same row, without a shuffle.

    NULL or ``{}`` gives ``{"events":[]}``.
    """
    members = entries(F.coalesce(points, F.lit("{}")), "double")
    ordered = F.array_sort(
        F.transform(members, lambda e: F.struct(e["key"].cast("double").alias("t"), e["value"].alias("c")))
    )
    zero = F.lit(0).cast("decimal(38,18)")
    empty = F.array().cast("array<int>")

    def first_places(pts: Column) -> Column:
        """Places at which a run starts, ending with the number of points."""
        inner = F.filter(
            F.sequence(F.lit(1), F.size(pts) - 1), lambda i: pts[i]["t"] - pts[i - 1]["t"] > max_gap
        )
        return F.concat(
            F.when(F.size(pts) > 0, F.array(F.lit(0))).otherwise(empty),
            F.when(F.size(pts) > 1, inner).otherwise(empty),
            F.array(F.size(pts)),
        )

    def run(members: Column) -> Column:
        total = F.aggregate(members, zero, lambda a, p: (a + exact_decimal(p["c"])).cast("decimal(38,18)"))
        return F.struct(
            members[0]["t"].alias("start"),
            F.element_at(members, -1)["t"].alias("end"),
            F.size(members).alias("points"),
            (total.cast("double") / F.size(members)).alias("avg_confidence"),
            F.array_max(F.transform(members, lambda p: p["c"])).alias("max_confidence"),
        )

    def runs(pts: Column) -> Column:
        return let(
            first_places(pts),
            lambda places: F.zip_with(
                F.slice(places, 1, F.size(places) - 1),
                F.slice(places, 2, F.size(places) - 1),
                lambda first, after: let(F.slice(pts, first + 1, after - first), run),
            ),
        )

    kept = F.filter(
        let(ordered, runs),
        lambda e: (e["end"] - e["start"] >= min_duration) & (e["avg_confidence"] >= min_avg),
    )
    numbered = F.transform(
        kept,
        lambda e, i: F.struct(
            (i + 1).alias("sequence"),
            round_half_even(e["start"]).alias("start_seconds"),
            round_half_even(e["end"]).alias("end_seconds"),
            round_half_even(e["end"] - e["start"]).alias("duration_seconds"),
            e["points"].alias("points"),
            round_half_even(e["avg_confidence"]).alias("avg_confidence"),
            round_half_even(e["max_confidence"]).alias("max_confidence"),
        ),
    )
    return F.to_json(F.struct(numbered.alias("events")))


def add_events(
    raw: DataFrame,
    points_column: str = "sound_classifier_json",
    name: str = "laugh_events_json",
    **limits: float,
) -> DataFrame:
    """``raw`` with the events artefact derived from the points artefact."""
    return raw.withColumn(name, events_json(F.col(points_column), **limits))
