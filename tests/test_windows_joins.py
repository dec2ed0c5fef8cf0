import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from mediamart.operators import joins, windows
from tests.rows import tuples


def test_dedupe_first_keeps_list_order_and_drops_null(spark):
    df = spark.createDataFrame([("a", 1), ("a", 0), (None, 2), ("b", 3)], "id string, place int")
    assert tuples(windows.dedupe_first(df, ["id"], ["place"])) == [("a", 0), ("b", 3)]


def test_latest_null_counts_as_highest(spark):
    df = spark.createDataFrame([("a", 1), ("a", None), ("b", 1), ("b", 2)], "id string, o int")
    assert tuples(windows.latest(df, ["id"], "o")) == [("a", None), ("b", 2)]


def test_deltas_use_previous_row(spark):
    day = lambda d: dt.date(2024, 1, d)
    df = spark.createDataFrame([("a", day(1), 10), ("a", day(5), 7), ("b", day(2), 1)], "id string, d date, n int")
    got = tuples(windows.deltas(df, ["id"], "d", {"n": "change"}), "id", "d", "change")
    assert got == [("a", day(1), None), ("a", day(5), -3), ("b", day(2), None)]


@pytest.mark.parametrize("width", [1, 10, 10000])
def test_number_rows_over_buckets(spark, width):
    rng = random.Random(3)
    rows = [("hot", i) for i in rng.sample(range(5000), 3000)] + [("b", 7), ("b", 3)]
    df = spark.createDataFrame(rows, "id string, t int")
    got = windows.number_rows(df, ["id"], "t", F.floor(F.col("t") / width))
    want = {}
    for key, t in sorted(rows):
        want.setdefault(key, []).append(t)
    expected = sorted((k, t, i) for k, ts in want.items() for i, t in enumerate(ts, 1))
    assert sorted(map(tuple, got.select("id", "t", "sequence").collect())) == expected


RANGES = [("v", 0.0, 10.0, "a"), ("v", 10.0, 25.0, "b"), ("v", 40.0, 30.0, "inverted"), ("v", None, 5.0, "open"), ("w", 0.0, 99.0, "w")]
POINTS = [("v", 0.0, 1), ("v", 10.0, 2), ("v", 25.0, 4), ("v", 25.1, 8), ("x", 1.0, 16)]


def brute_force():
    for key, start, end, name in RANGES:
        hits = [n for k, t, n in POINTS if k == key and start is not None and start <= t <= end]
        yield name, hits


@pytest.mark.parametrize("width", [0.7, 5.0, 1000.0])
def test_points_in_ranges(spark, width):
    ranges = spark.createDataFrame(RANGES, "k string, s double, e double, name string")
    points = spark.createDataFrame(POINTS, "k string, t double, n int")
    want = sorted(((name, n) for name, hits in brute_force() for n in (hits or [None])), key=repr)
    got = joins.points_in_ranges(ranges, points, ["k"], "t", "s", "e", width)
    assert tuples(got, "name", "n") == want
    inner = joins.points_in_ranges(ranges, points, ["k"], "t", "s", "e", width, how="inner")
    assert tuples(inner, "name", "n") == [w for w in want if w[1] is not None]


@pytest.mark.parametrize("width", [0.7, 5.0, 1000.0])
def test_sum_in_ranges(spark, width):
    ranges = spark.createDataFrame(RANGES, "k string, s double, e double, name string")
    points = spark.createDataFrame(POINTS, "k string, t double, n int")
    got = joins.sum_in_ranges(ranges, points, ["k"], "t", "s", "e", F.sum("n"), "total", width)
    want = sorted(((name, sum(hits) if hits else None) for name, hits in brute_force()), key=repr)
    assert tuples(got, "name", "total") == want


def test_random_ranges_agree_with_brute_force(spark):
    rng = random.Random(5)
    ranges = [("hot", s, s + rng.uniform(0, 40), i) for i in range(60) for s in [rng.uniform(0, 500)]]
    points = [("hot", rng.uniform(0, 550), 1) for _ in range(500)]
    got = joins.sum_in_ranges(
        spark.createDataFrame(ranges, "k string, s double, e double, i int"),
        spark.createDataFrame(points, "k string, t double, n int"),
        ["k"], "t", "s", "e", F.sum("n"), "total", 10.0,
    )
    want = sorted((i, sum(s <= t <= e for _, t, _ in points) or None) for _, s, e, i in ranges)
    assert sorted(map(tuple, got.select("i", "total").collect()), key=lambda r: r[0]) == want


def test_newer_rows(spark):
    rows = spark.createDataFrame([("a", 1), ("a", 5), ("b", 1), ("c", None)], "id string, o int")
    stored = spark.createDataFrame([("a", 1), ("a", 4), ("c", 9)], "id string, o int")
    assert tuples(joins.newer_rows(rows, stored, ["id"], "o")) == [("a", 5), ("b", 1), ("c", None)]
    assert joins.newer_rows(rows, None, ["id"], "o") is rows


def test_bound_lookup_drops_unknown_ids(spark):
    ranges = spark.createDataFrame([("v", 0, 2), ("v", 1, 1), ("v", 0, 9), ("w", 0, 0)], "k string, a int, b int")
    lookup = spark.createDataFrame([("v", 0, 0.0, 1.0), ("v", 1, 1.0, 2.0), ("v", 2, 2.0, 3.0)], "k string, id int, s double, e double")
    got = joins.bound_lookup(ranges, lookup, ["k"], "a", "b", "id", "s", "e")
    assert tuples(got, "k", "a", "b", "s", "e") == [("v", 0, 2, 0.0, 3.0), ("v", 1, 1, 1.0, 2.0)]
