import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from mediamart.llm import sharding


def pmf(total, marked, drawn):
    low, high = max(0, drawn + marked - total), min(drawn, marked)
    return {z: math.comb(marked, z) * math.comb(total - marked, drawn - z) / math.comb(total, drawn) for z in range(low, high + 1)}


@pytest.mark.parametrize("case", [(10, 4, 5), (400, 100, 60), (60, 59, 30), (2000, 1000, 700), (50, 3, 47), (30, 1, 1)])
def test_draws_follow_the_distribution(spark, case):
    n = 20_000
    total, marked, drawn = case
    drawn_by = sharding.hypergeometric(F.lit(total), F.lit(marked), F.lit(drawn), 7, F.col("id"))
    got = Counter(r[0] for r in spark.range(n).select(drawn_by).collect())
    want = pmf(*case)
    assert set(got) <= set(want)
    likely = {z: p * n for z, p in want.items() if p * n >= 5}
    chi = sum((got[z] - e) ** 2 / e for z, e in likely.items())
    free = max(len(likely) - 1, 1)
    assert chi < free + 5 * math.sqrt(2 * free)


def test_draws_of_large_numbers(spark):
    total, marked, drawn = 10**10, 4 * 10**9, 10**9
    drawn_by = sharding.hypergeometric(F.lit(total), F.lit(marked), F.lit(drawn), 3, F.col("id"))
    got = [r[0] for r in spark.range(4_000).select(drawn_by).collect()]
    mean, sd = drawn * 0.4, math.sqrt(drawn * 0.4 * 0.6 * 0.9)
    z = [(x - mean) / sd for x in got]
    assert abs(sum(z) / len(z)) < 0.08 and 0.92 < sum(x * x for x in z) / len(z) < 1.08


def test_edges_of_a_draw(spark):
    cases = [(0, 0, 0), (5, 0, 3), (5, 5, 3), (5, 2, 0), (5, 2, 5), (1, 1, 1)]
    rows = spark.createDataFrame(cases, "t long, m long, d long")
    got = rows.select("t", "m", "d", sharding.hypergeometric(F.col("t"), F.col("m"), F.col("d"), 1).alias("x")).collect()
    assert all(r.x == (min(r.d, r.m) if r.t else 0) for r in got if r.t == 0 or r.m in (0, r.t) or r.d in (0, r.t))


def test_matrix_has_the_margins(spark):
    sizes = {p: (p * 37) % 101 for p in range(0, 300, 2)}  # gaps, more than one level, empty partitions
    n = sum(sizes.values())
    shards = [n // 7 + (s < n % 7) for s in range(7)]
    counts = spark.createDataFrame(list(sizes.items()), "part int, n long")
    got = {r.part: r.seats for r in sharding.matrix(counts, shards, 5).collect()}
    assert {p: sum(x) for p, x in got.items()} == sizes
    assert [sum(x[s] for x in got.values()) for s in range(7)] == shards
    assert all(x >= 0 for seats in got.values() for x in seats)


def held(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_shards_are_exact_and_gapless(documents):
    rows = [(i, f"text {i % 40}") for i in range(1003)] + [(None, None), (None, ""), (5, "x" * 200_000), (5, "x" * 200_000)]
    docs = documents(rows)
    out = sharding.shard(docs, 8, slice_rows=30)
    assert out.columns == [*docs.columns, "shard", "slot"]
    assert held(out.select(*docs.columns)) == held(docs)
    by = {}
    for r in out.select("shard", "slot").collect():
        by.setdefault(r.shard, []).append(r.slot)
    assert sorted(by) == list(range(8)) and all(sorted(x) == list(range(len(x))) for x in by.values())
    assert max(map(len, by.values())) - min(map(len, by.values())) <= 1
    plan = out._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


def test_small_and_empty_tables(documents):
    assert sharding.shard(documents([]), 8).count() == 0
    out = sharding.shard(documents([(1, "a"), (2, "b")]), 8)
    assert sorted((r.shard, r.slot) for r in out.collect()) == [(0, 0), (1, 0)]


def test_clashing_columns_are_replaced(spark):
    docs = spark.createDataFrame([(1, "a", 9, 8), (2, "b", 9, 8)], "doc_id long, text string, shard int, slot int")
    out = sharding.shard(docs, 2)
    assert out.columns == ["doc_id", "text", "shard", "slot"] and {r.shard for r in out.collect()} == {0, 1}


def test_each_row_reaches_each_place(spark):
    """Over several seeds every row is as often in either shard, whatever its partition."""
    n, runs = 300, 8
    docs = spark.range(n).select(F.col("id").alias("doc_id"), F.lit("t").alias("text")).repartition(3).cache()
    seen = Counter()
    for seed in range(runs):
        seen.update(r.doc_id for r in sharding.shard(docs, 2, seed, slice_rows=60).filter("shard = 1").collect())
    docs.unpersist()
    assert sum(seen.values()) == n * runs // 2
    chi = sum((seen[i] - runs / 2) ** 2 / (runs / 4) for i in range(n))
    assert abs(chi - n) < 5 * math.sqrt(2 * n)
