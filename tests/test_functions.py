import datetime as dt
import random
from decimal import ROUND_HALF_UP, Decimal

import pytest
from pyspark.sql import functions as F

from mediamart.functions import dates, json, numbers
from mediamart.functions.arrays import let


def test_rounding_rules(spark):
    rng = random.Random(1)
    values = [0.125, 2.675, 0.005, 1.005, -0.125, 1234567.885, 0.0, 1e-7]
    values += [rng.uniform(0, 5000) for _ in range(3000)] + [rng.randrange(100000) / 1000 for _ in range(3000)]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    x = F.col("x")
    got = df.select(
        "x",
        numbers.round_half_even(x).alias("even"),
        numbers.round_half_up(x, 1).alias("up"),
        numbers.round_hundredths(x).alias("hundredths"),
    ).collect()
    for r in got:
        assert r.even == round(r.x, 2)
        assert r.up == Decimal(f"{r.x:.15g}").quantize(Decimal("0.1"), ROUND_HALF_UP)
        assert abs(r.hundredths - r.x) <= 0.0051


def test_rounding_null(spark):
    df = spark.range(1).select(F.lit(None).cast("double").alias("x"))
    row = df.select(numbers.round_half_even(F.col("x")), numbers.round_half_up(F.col("x"), 1)).first()
    assert tuple(row) == (None, None)


def test_percent_of_zero_is_an_error(spark):
    df = spark.createDataFrame([(1.0, 0.0)], "a double, b double")
    with pytest.raises(Exception, match="DIVIDE_BY_ZERO"):
        df.select(numbers.percent(F.col("a"), F.col("b"))).collect()


def test_exact_sums_do_not_depend_on_order(spark):
    df = spark.createDataFrame([(0.1,)] * 10 + [(0.7,), (1e6,)], "x double")
    assert df.agg(F.sum(numbers.exact_decimal(F.col("x"))).cast("double")).first()[0] == 1000001.7


def test_json_non_empty(spark):
    cases = [("{}", False), ('{"events":[]}', True), (None, False), ("[1]", False), ('{"a":1}', True)]
    df = spark.createDataFrame(cases, "j string, want boolean")
    assert all(r.got == r.want for r in df.select("want", json.non_empty(F.col("j")).alias("got")).collect())


def test_malformed_json_is_an_error(spark):
    df = spark.createDataFrame([('{"a":',)], "j string")
    with pytest.raises(Exception):
        df.select(json.parse(F.col("j"), "a string")).collect()


def test_records_need_an_array(spark):
    read = lambda text: spark.createDataFrame([(text,)], "j string").select(
        json.records(F.col("j"), "items", "id: string").alias("r")
    ).first().r
    assert [r.id for r in read('{"items":[{"id":"5"},{"id":5}]}')] == ["5", "5"]
    assert [r.id for r in read('{"items":[{"id":7}]}')] == ["7"]
    assert read('{"items":[]}') == []
    assert read('{"other":1}') is None
    with pytest.raises(Exception, match="CANNOT_PARSE|MALFORMED"):
        read('{"items":{"id":5}}')


def test_bad_numbers_are_errors(spark):
    df = spark.createDataFrame([("5.0",)], "x string")
    with pytest.raises(Exception):
        df.select(json.number(F.col("x"), "int")).collect()
    assert df.select(json.number(F.col("x"), "double")).first()[0] == 5.0


def test_dates(spark):
    df = spark.createDataFrame([("20240107",), ("2024-01-07",)], "x string")
    days = df.select(json.compact_date(F.col("x")).alias("d"))
    for r in days.select("d", dates.date_key(F.col("d")), dates.iso_day(F.col("d")), dates.is_weekend(F.col("d"))).collect():
        assert tuple(r) == (dt.date(2024, 1, 7), 20240107, 7, True)


def test_clock_may_exceed_a_day(spark):
    df = spark.createDataFrame([(90061,), (0,), (None,)], "s int")
    assert [r[0] for r in df.select(dates.clock(F.col("s"))).collect()] == ["25:01:01", "00:00:00", None]


def test_let_binds_once(spark):
    df = spark.range(3).select(let(F.col("id") + 1, lambda x: x * x).alias("y"))
    assert [r.y for r in df.orderBy("y").collect()] == [1, 4, 9]
