import pytest

from mediamart.operators import quality
from tests.rows import tuples


def failures(report):
    return {r.check: r.failures for r in report.collect()}


def test_checks(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, None), (None, "b"), (3, "c")], "k int, v string")
    parent = spark.createDataFrame([(1, "a"), (3, "x")], "pk int, pv string")
    report = quality.run_checks(
        [
            quality.not_null(df, ["k", "v"], "t"),
            quality.unique(df, ["k", "v"], "t"),
            quality.primary_key(df, ["k"], "t"),
            quality.equal_rowcount(df, parent, "t", "parent"),
            quality.foreign_key(df, ["k"], parent, ["pk"], "t", "parent"),
            quality.foreign_key(df, ["k", "v"], parent, ["pk", "pv"], "t", "parent"),
        ],
        fail=False,
    )
    assert failures(report) == {
        "not_null(k)": 1,
        "not_null(v)": 1,
        "unique(k, v)": 1,
        "primary_key(k)": 2,
        "equal_rowcount(parent)": 3,
        "foreign_key(k -> parent)": 1,
        "foreign_key(k, v -> parent)": 1,
    }


def test_empty_tables_pass(spark):
    df = spark.createDataFrame([], "k int")
    report = quality.run_checks([quality.not_null(df, ["k"]), quality.unique(df, ["k"]), quality.primary_key(df, ["k"]), quality.foreign_key(df, ["k"], df, ["k"])])
    assert set(failures(report).values()) == {0}


def test_failures_raise(spark):
    df = spark.createDataFrame([(1,), (1,)], "k int")
    with pytest.raises(quality.ChecksFailed, match=r"t: unique\(k\): 1"):
        quality.run_checks([quality.unique(df, ["k"], "t"), quality.not_null(df, ["k"], "t")])


def test_contract_report(spark):
    df = spark.createDataFrame([("a",)], "video_id string")
    assert tuples(quality.contract(df, "dim_videos")) == [("contract", "dim_videos", 1)]
