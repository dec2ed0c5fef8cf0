"""A uniform shuffle into shards of exact size: hypergeometric communication matrix, local permutations.

1. Every partition puts its rows into a random order (a sort without an exchange) and numbers them; that is
   stored, so partition and place of a row no longer depend on what is run again.
2. How many rows of each partition go to each shard is drawn without replacement from the shards' sizes.  The
   draws go down a tree with 64 children per node: a node holds the seats that its partitions have in each
   shard and deals them out among its children.  What a partition gets is its row of the matrix.
3. A partition's first rows go to shard 0, the next to shard 1 and so on, as many as its row of the matrix says.
4. The rows are exchanged by (shard, random slice of the shard) and put into a random order again; the
   sizes of the slices before give the slot.

Any order of all rows over all slots is as likely as any other, and sizes are exact whatever is drawn.
DataFrame functions only.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mediamart.functions.arrays import let
from mediamart.llm.common import store

FAN_OUT = 64
#: Candidates of one rejection draw; each is accepted with a probability over one half.
TRIES = 64
#: Width of the ratio-of-uniforms region for discrete bell-shaped distributions (Stadlober 1989).
SPREAD, MARGIN = 2 * math.sqrt(2 / math.e), 3 - 2 * math.sqrt(3 / math.e)
PLACES = (1 << 33) - 1


def uniform(*of: Column | int) -> Column:
    """A number in (0, 1), fixed by the values ``of``."""
    h = F.xxhash64(*[F.lit(x) if isinstance(x, int) else x for x in of])
    return (F.shiftrightunsigned(h, 11) + F.lit(0.5)) / F.lit(float(1 << 53))


def log_factorial(n: Column) -> Column:
    x = F.greatest(n, F.lit(1)).cast("double")
    series = 1 / (12 * x) - 1 / (360 * x * x * x) + 1 / (1260 * x * x * x * x * x)
    stirling = (x + 0.5) * F.log(x) - x + F.lit(0.5 * math.log(2 * math.pi)) + series
    return F.when(n <= 20, F.log(F.factorial(n.cast("int")))).otherwise(stirling)


def hypergeometric(total: Column, marked: Column, drawn: Column, *seed: Column | int) -> Column:
    """How many of ``drawn`` items out of ``total`` are among the ``marked`` ones; a draw by ratio of uniforms."""

    def draw(p: Column) -> Column:
        total, marked, drawn = p["total"], p["marked"], p["drawn"]
        low, high = F.greatest(F.lit(0), drawn + marked - total), F.least(drawn, marked)
        share = marked / F.greatest(total, F.lit(1))
        mean = drawn * share
        variance = mean * (1 - share) * (total - drawn) / F.greatest(total - 1, F.lit(1))
        bell = F.struct(
            low.alias("low"),
            high.alias("high"),
            (mean + 0.5).alias("centre"),
            (SPREAD * F.sqrt(variance + 0.5) + MARGIN).alias("width"),
            F.floor((drawn + 1).cast("double") * (marked + 1) / (total + 2)).cast("long").alias("mode"),
        )

        def weight(z: Column) -> Column:
            return -sum((log_factorial(x) for x in (z, marked - z, drawn - z)), log_factorial(total - marked - drawn + z))

        def tried(b: Column, i: Column) -> Column:
            u, v = uniform(*seed, i, 1), uniform(*seed, i, 2)
            value = F.floor(b["centre"] + b["width"] * (v - 0.5) / u).cast("long")
            return let(
                F.struct(value.alias("z"), u.alias("u")),
                lambda c: F.when(
                    c["z"].between(b["low"], b["high"]) & (2 * F.log(c["u"]) <= weight(c["z"]) - b["top"]), c["z"]
                ),
            )

        def found(b: Column) -> Column:
            tries = F.sequence(F.lit(1), F.lit(TRIES))
            first = F.aggregate(tries, F.lit(None).cast("long"), lambda got, i: F.coalesce(got, tried(b, i)))
            return F.when(b["low"] == b["high"], b["low"]).otherwise(F.coalesce(first, b["mode"]))

        return let(let(bell, lambda b: b.withField("top", weight(b["mode"]))), found)

    given = F.struct(*[c.cast("long").alias(n) for c, n in ((total, "total"), (marked, "marked"), (drawn, "drawn"))])
    return let(given, draw)


def _seats(left: Column, n: Column, *seed: Column | int) -> Column:
    """Deal ``n`` seats out of ``left`` (an array, seats per shard) without replacement."""
    start = F.struct(
        F.aggregate(left, F.lit(0).cast("long"), lambda a, x: a + x).alias("total"),
        n.cast("long").alias("need"),
        F.array().cast("array<long>").alias("got"),
    )

    def one(state: Column, s: Column) -> Column:
        of = F.get(left, s)
        x = hypergeometric(state["total"], of, state["need"], *seed, s)
        return let(
            F.struct(x.alias("x"), of.alias("of"), state.alias("state")),
            lambda d: F.struct(
                (d["state"]["total"] - d["of"]).alias("total"),
                (d["state"]["need"] - d["x"]).alias("need"),
                F.concat(d["state"]["got"], F.array(d["x"])).alias("got"),
            ),
        )

    shards = F.sequence(F.lit(0), F.size(left) - 1)
    return F.aggregate(shards, start, one, lambda state: state["got"])


def _minus(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: x - y)


def _dealt(seed: int, level: int) -> Column:
    """The seats of a node, dealt out among its ``children``."""

    def deal(state: Column, c: Column) -> Column:
        seats = _seats(state["left"], c["n"], seed, level, c["child"])
        return let(
            F.struct(seats.alias("seats"), state.alias("state"), c["child"].alias("child")),
            lambda d: F.struct(
                _minus(d["state"]["left"], d["seats"]).alias("left"),
                F.concat(d["state"]["dealt"], F.array(F.struct(d["child"].alias("child"), d["seats"].alias("seats")))).alias("dealt"),
            ),
        )

    none = F.array().cast("array<struct<child: long, seats: array<long>>>")
    start = F.struct(F.col("seats").alias("left"), none.alias("dealt"))
    return F.aggregate("children", start, deal, lambda state: state["dealt"])


def matrix(counts: DataFrame, sizes: list[int], seed: int) -> DataFrame:
    """(part, seats): how many rows of each partition go to each shard.

    ``counts``: (part, n), parts numbered from 0, gaps allowed; their sum is the sum of ``sizes``.
    """
    spark = counts.sparkSession
    last = counts.agg(F.max("part")).first()[0] or 0
    levels = 1
    while FAN_OUT**levels <= last:
        levels += 1
    nodes = spark.createDataFrame([(0, sizes)], "node long, seats array<long>")
    for level in reversed(range(levels)):
        child = F.floor(F.col("part") / FAN_OUT**level).cast("long")
        children = (
            counts.groupBy(child.alias("child"))
            .agg(F.sum("n").cast("long").alias("n"))
            .groupBy(F.floor(F.col("child") / FAN_OUT).cast("long").alias("node"))
            .agg(F.sort_array(F.collect_list(F.struct("child", "n"))).alias("children"))  # 64 at most
        )
        nodes = nodes.join(children, "node").select(F.explode(_dealt(seed, level)).alias("d"))
        nodes = nodes.select(F.col("d.child").alias("node"), "d.seats")
    return nodes.withColumnRenamed("node", "part")


def shard(docs: DataFrame, shards: int = 8, seed: int = 12, slice_rows: int = 50_000, slice_bytes: int = 64 << 20) -> DataFrame:
    """``docs`` with ``shard`` (0 to ``shards`` - 1) and ``slot`` (gapless from 0 in each shard).

    Shard sizes are at most one row apart.  Rows are dealt one by one: a row with null columns, an empty
    or a very long text and each of several equal rows is a row like any other, and equal texts are not kept
    together.  An empty table gives an empty result; with fewer rows than shards the last shards are
    empty.  Columns of ``docs`` named ``shard`` or ``slot`` are replaced.  The same stored files, session
    settings and seed give the same shards.

    Rows move once, in slices of about ``slice_rows`` rows or ``slice_bytes``.
    """
    rows = docs.select(F.struct("*").alias("row"), F.spark_partition_id().alias("part"), F.rand(seed).alias("_order"))
    placed = rows.sortWithinPartitions("_order").select(
        "row", "part", F.monotonically_increasing_id().bitwiseAND(F.lit(PLACES)).alias("place")
    )
    heavy = [f.name for f in docs.schema if f.dataType.typeName() in ("string", "binary")]
    size = sum((F.coalesce(F.octet_length(F.col("row")[c]), F.lit(0)) for c in heavy), F.lit(8))
    stored = store(placed.withColumn("bytes", size.cast("long")), "sharding-placed")
    counts = store(stored.groupBy("part").agg(F.count("*").alias("n"), F.sum("bytes").alias("bytes")), "sharding-counts")
    n, total = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("bytes"), F.lit(0))).first()
    sizes = [n // shards + (s < n % shards) for s in range(shards)]
    slices = max(1, math.ceil(max(n / slice_rows, total / slice_bytes) / shards))

    seats = store(matrix(counts.select("part", "n"), sizes, seed), "sharding-matrix")
    ends = F.transform("seats", lambda x, i: F.aggregate(F.slice("seats", 1, i + 1), F.lit(0).cast("long"), lambda a, y: a + y))
    dealt = stored.join(seats.select("part", ends.alias("ends")), "part").withColumn(
        "shard", F.size(F.filter("ends", lambda e: e <= F.col("place")))
    )
    again = uniform(seed, 99, F.col("part"), F.col("place"))
    dealt = dealt.withColumn("_order", again).withColumn("slice", F.floor(F.col("_order") * slices).cast("int"))

    before = Window.partitionBy("shard").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        dealt.groupBy("shard", "slice")
        .agg(F.count("*").alias("n"))
        .select("shard", "slice", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    )
    inside = Window.partitionBy("shard", "slice").orderBy("_order", "part", "place")
    ranked = dealt.select("row", "shard", "slice", (F.row_number().over(inside) - 1).alias("rank"))
    out = ranked.join(starts, ["shard", "slice"])
    kept = [F.col("row")[c].alias(c) for c in docs.columns if c not in ("shard", "slot")]
    return out.select(*kept, "shard", (F.col("start") + F.col("rank")).cast("long").alias("slot"))
