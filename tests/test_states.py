import datetime as dt
import random
import time

import pytest
from pyspark.sql import functions as F

from mediamart.operators import enrich, states, windows
from mediamart.schemas import CONTRACTS
from tests.rows import tuples

DAY = dt.date(2024, 1, 1)


def snapshots(spark, *rows):
    return spark.createDataFrame([(v, DAY + dt.timedelta(d), 1, n, 1) for v, d, n in rows], CONTRACTS["core_videos_meta"])


def test_marks_follow_the_loads(spark, tables):
    name, keys, order = "core_videos_meta", ["video_id"], "snapshot_date"

    def run(*rows):
        marks = states.marks_of(tables, name, keys, order)
        tables.append(name, states.above_marks(snapshots(spark, *rows), marks, keys, order))

    assert states.marks_of(tables, name, keys, order) is None
    run(("a", 1, 1), ("b", 5, 1))
    run(("a", 1, 9), ("a", 2, 9), ("b", 4, 9), ("c", 0, 9))  # only later days, and a new video
    run(("a", 2, 7), ("c", 0, 7))  # nothing new
    assert tuples(tables.read(name), "video_id", "snapshot_date", "view_count") == tuples(
        snapshots(spark, ("a", 1, 1), ("a", 2, 9), ("b", 5, 1), ("c", 0, 9)), "video_id", "snapshot_date", "view_count"
    )
    assert tables.partitions(name) == ["1", "2"]
    # a run that dies between its load and its marks: the next one reads the load it has not seen
    tables.append(name, snapshots(spark, ("a", 9, 1)))
    run(("a", 8, 1))
    assert tables.read(name).count() == 5
    marks = states.marks_of(tables, name, keys, order)
    assert tuples(marks.select("video_id", "newest")) == tuples(states.newest(tables.read(name), keys, order))


def test_marks_are_read_instead_of_the_history(spark, tables):
    name, keys = "core_videos_meta", ["video_id"]
    tables.append(name, snapshots(spark, ("a", 1, 1)))
    states.marks_of(tables, name, keys, "snapshot_date")
    marks = states.marks_of(tables, name, keys, "snapshot_date")  # up to date
    text = states.above_marks(snapshots(spark, ("a", 2, 1)), marks, keys, "snapshot_date")._jdf.queryExecution().executedPlan().toString()
    assert f"process_marks_{name}" in text and f".{name}[" not in text and "HashAggregate" not in text


def test_filter_holds_every_stored_key(spark):
    keys = ["a", "b"]
    stored = spark.range(40_000).select(F.col("id").alias("a"), (F.col("id") % 7).cast("string").alias("b"))
    size = states.filter_size(40_000)
    half = F.col("a") % 2 == 0
    bits = states.merged_bits(states.key_bits(stored.filter(half), keys, size), states.key_bits(stored.filter(~half), keys, size))
    assert states.perhaps_stored(stored, bits, keys, size).count() == 40_000
    others = stored.withColumn("a", -F.col("a") - 1)
    passed = states.perhaps_stored(others, bits, keys, size).count()
    assert passed < 40_000 / 8
    mixed = others.limit(500).unionByName(stored.limit(5)).unionByName(spark.createDataFrame([(None, "1"), (1, None)], "a long, b string"))
    assert states.repeats_of_stored(mixed, stored, bits, keys, size).count() == 5


def test_guard_refuses_stored_keys(spark, tables):
    guard = states.KeyGuard(tables, "notes", ["id"])
    rows = lambda *ids: spark.createDataFrame([(i, "x") for i in ids], "id long, v string")
    assert guard.repeats(rows(1)).count() == 0  # no table yet
    guard.append(rows(*range(10)))
    with pytest.raises(ValueError, match="notes: load refused, id stored already: 2 rows"):
        guard.append(rows(3, 4, 77))
    assert tables.read("notes").count() == 10
    guard.append(rows(77))
    with pytest.raises(ValueError, match="1 rows"):
        guard.append(rows(77, 78))
    guard.append(rows(*range(100, 6000)))  # the filter grows with the table
    with pytest.raises(ValueError, match="2 rows"):
        guard.append(rows(5, 5999, 6001))
    again = states.KeyGuard(tables, "notes", ["id"])  # the state is stored
    assert tuples(again.repeats(rows(9, 10_000)), "id") == [(9,)]


def test_totals_of_partitions(spark, tables):
    measures = {"n": "count(id)", "s": "sum(v)"}
    rows = spark.range(100).select("id", (F.col("id") * 2).alias("v"))

    def full():
        return tables.read("notes").agg(F.count("id"), F.sum("v")).first()

    for batch in (rows.filter("id < 60"), rows.filter("id >= 60"), spark.createDataFrame([(7, 1000), (200, 5)], "id long, v long")):
        tables.upsert("notes", batch, ["id"])
        before = tables.read("process_totals_notes").count() if tables.exists("process_totals_notes") else 0
        states.refresh_totals(tables, "notes", measures, tables.touched["notes"])
        assert tuple(states.totals(tables, "notes", ["n", "s"]).first()) == tuple(full())
    assert before == 4 and len(tables.touched["notes"]) <= 2  # the correction reads the buckets it has touched
    text = tables.scan("notes").filter(F.col("_bucket").isin(tables.touched["notes"]))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(_bucket" in text or "PartitionFilters: [_bucket" in text


@pytest.mark.parametrize("seed", range(3))
def test_late_rows_patch_only_their_successors(spark, seed):
    rng = random.Random(seed)
    rows = [(v, d, rng.randint(0, 99)) for v in "abcd" for d in range(12) if rng.random() < 0.7] + [("new", 3, 1), ("new", 4, 5)]
    is_late = [v == "new" or rng.random() < 0.3 for v, _, _ in rows]
    late = [r for r, x in zip(rows, is_late) if x]
    early = [r for r, x in zip(rows, is_late) if not x] + [(v, d, n + 50) for v, d, n in late[:2]]  # corrections
    columns = {"view_count": "views"}
    want = {(r.video_id, r.snapshot_date): r.views for r in windows.deltas(snapshots(spark, *rows), ["video_id"], "snapshot_date", columns).collect()}
    had = {(r.video_id, r.snapshot_date): r.views for r in windows.deltas(snapshots(spark, *early), ["video_id"], "snapshot_date", columns).collect()}
    patch = windows.patched_deltas(snapshots(spark, *early), snapshots(spark, *late), ["video_id"], "snapshot_date", columns).collect()
    assert len({(r.video_id, r.snapshot_date) for r in patch}) == len(patch) <= 2 * len(late)
    assert had | {(r.video_id, r.snapshot_date): r.views for r in patch} == want


def make_slow():
    def answer(prompt):
        with open(prompt.split("|")[1], "a") as log:
            log.write(prompt.split("|")[0] + "\n")
        time.sleep(0.05)
        if prompt.startswith("k13|") and not prompt.endswith("mended"):
            raise RuntimeError("the service is down")
        return "{}"

    return answer


def asked(path):
    return sorted(open(path).read().split()) if path.exists() else []


def test_answers_survive_a_run_that_dies(spark, tables, tmp_path):
    log = tmp_path / "log"
    rows = spark.createDataFrame([(f"k{i}", f"k{i}|{log}") for i in range(40)], "k string, p string")
    with pytest.raises(Exception, match="service is down"):
        enrich.enrich_stored(tables, "x", rows, make_slow, "k", "p", round_calls=5)
    kept = {r.k for r in tables.read("process_answers_x").collect()} if tables.exists("process_answers_x") else set()
    first = asked(log)
    mended = rows.withColumn("p", F.when(F.col("k") == "k13", F.concat("p", F.lit("|mended"))).otherwise(F.col("p")))
    got = enrich.enrich_stored(tables, "x", mended, make_slow, "k", "p", round_calls=5)
    assert got.count() == 40 and got.filter("result = '{}'").count() == 40
    second = asked(log)
    again = [k for k in kept if second.count(k) > first.count(k)]
    assert again == []  # what was stored is not asked twice
    assert enrich.enrich_stored(tables, "x", mended, make_slow, "k", "p").count() == 40 and asked(log) == second


def test_a_budget_holds_for_all_tasks(spark, tables, tmp_path):
    log = tmp_path / "log"
    rows = spark.createDataFrame([(f"k{i}", f"k{i}|{log}") for i in range(20, 50)], "k string, p string").repartition(6)
    got = enrich.enrich_stored(tables, "y", rows, make_slow, "k", "p", budget=12, round_calls=4)
    assert 1 <= got.count() <= 12 and len(asked(log)) <= 12
    assert enrich.enrich_stored(tables, "y", rows, make_slow, "k", "p").count() == 30 and len(asked(log)) == 30


def test_calls_run_side_by_side(spark, tmp_path):
    rows = spark.createDataFrame([(f"k{i}", f"k{i}|{tmp_path / 'log'}") for i in range(20, 60)], "k string, p string").coalesce(1)
    alone = enrich.enrich(rows, make_slow, "k", "p")
    together = enrich.enrich(rows, make_slow, "k", "p", side_by_side=20)
    alone.count()
    took = []
    for df in (alone, together):
        start = time.perf_counter()
        df.write.format("noop").mode("overwrite").save()
        took.append(time.perf_counter() - start)
    assert took[1] < took[0] / 2 and tuples(alone) == tuples(together)


def make_parts():
    def parts(text):
        if text == "gone":
            raise enrich.Unavailable()
        return [{"part": p, "n": i} for i, p in enumerate((text or "").split())]

    return parts


def test_functions_of_many_rows(spark):
    rows = spark.createDataFrame([("a", "x y"), ("b", ""), ("c", "gone"), ("d", None), ("a", "x y")], "k string, p string")
    got = enrich.explode_with(rows, make_parts, "k", "p", "part string, n int")
    assert tuples(got) == [("a", "x", 0, None), ("a", "x", 0, None), ("a", "y", 1, None), ("a", "y", 1, None), ("c", None, None, "Unavailable")]
    with pytest.raises(Exception):
        enrich.explode_with(rows, lambda: lambda text: 1 / 0, "k", "p", "part string").collect()
