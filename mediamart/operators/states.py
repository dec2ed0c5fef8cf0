"""States that are merged with each batch, so that a run's cost follows the batch and not the history.

* high-water marks: the newest value per key;
* key bits: a membership filter of the stored keys;
* partial totals: aggregates per partition, added up when they are read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mediamart.sources.tables import Tables

# high-water marks


def newest(rows: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The highest ``order`` per key as ``newest``; NULL only where all are."""
    return rows.groupBy(*keys).agg(F.max(order).alias("newest"))


def above_marks(rows: DataFrame, marks: DataFrame | None, keys: list[str], order: str) -> DataFrame:
    """Rows later in ``order`` than the mark of their key; unknown keys and a NULL ``order`` pass.

    ``marks``: one row per key, so each row meets one at most.
    """
    if marks is None:
        return rows
    held = rows.join(marks.select(*keys, F.col("newest").alias("_newest")), keys, "left")
    return held.filter(~F.coalesce(F.col("_newest") >= F.col(order), F.lit(False))).select(*rows.columns)


def marks_of(tables: Tables, name: str, keys: list[str], order: str) -> DataFrame | None:
    """Marks of the stored table ``name``, brought up to date with the loads they have not seen.

    They lie in ``process_marks_<name>``, one row per key with the load that set it.  A mark only rises
    and every load raises some, so the highest load among them is the last one merged: a run that died between
    its load and the marks loses nothing, and only loads after that one are read.
    """
    if not tables.exists(name):
        return None
    state = f"process_marks_{name}"
    last = tables.last_number(name)
    stored = tables.read(state)
    seen = 0 if stored is None else stored.agg(F.max("load")).first()[0] or 0
    if seen < last:
        later = tables.scan(name).filter(F.col("_load") > seen)
        marks = later.groupBy(*keys).agg(F.max(order).alias("newest"), F.max("_load").alias("load"))
        return tables.upsert(state, marks, keys)
    return stored


# membership of stored keys

#: Bits for each stored key: about one key in sixteen that is not stored passes the filter.
BITS_PER_KEY = 16
PER_SLOT = 32768  # what one bitmap of ``bitmap_construct_agg`` holds


def filter_size(keys: int) -> int:
    """Bits of a filter for so many keys: a power of two, so that a filter of its half can be told."""
    return max(PER_SLOT, 2 ** math.ceil(math.log2(max(1, keys * BITS_PER_KEY))))


def _bit(keys: list[str], size: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(size))


def key_bits(rows: DataFrame, keys: list[str], size: int) -> DataFrame:
    """(slot, bits): the keys of ``rows`` as bitmaps of 32,768 bits, ``size`` bits in all."""
    bit = rows.dropna(subset=keys).select(_bit(keys, size).alias("bit"))
    return bit.groupBy(F.bitmap_bucket_number("bit").alias("slot")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("bits")
    )


def merged_bits(a: DataFrame, b: DataFrame) -> DataFrame:
    """The filter that holds the keys of both."""
    return a.unionByName(b).groupBy("slot").agg(F.bitmap_or_agg("bits").alias("bits"))


def perhaps_stored(rows: DataFrame, bits: DataFrame, keys: list[str], size: int) -> DataFrame:
    """Rows whose key the filter holds: all that are stored, and a few that are not."""
    marked = rows.withColumn("_bit", _bit(keys, size))
    marked = marked.withColumns({"slot_": F.bitmap_bucket_number("_bit"), "at_": F.bitmap_bit_position("_bit")})
    joined = marked.join(bits.select(F.col("slot").alias("slot_"), F.col("bits").alias("bits_")), "slot_")
    byte = F.conv(F.hex(F.expr("substring(bits_, cast(at_ div 8 as int) + 1, 1)")), 16, 10).cast("int")
    is_set = F.expr("shiftright(byte_, cast(at_ % 8 as int)) & 1") == 1
    return joined.withColumn("byte_", byte).filter(is_set).select(*rows.columns)


def repeats_of_stored(batch: DataFrame, stored: DataFrame, bits: DataFrame, keys: list[str], size: int) -> DataFrame:
    """Rows of ``batch`` whose key is stored.

    The filter leaves few rows to look for; only if there are any, the stored keys are read.  Keys with a NULL are
    never stored ones.
    """
    hits = perhaps_stored(batch.dropna(subset=keys), bits, keys, size)
    return hits.join(stored.select(*keys), keys, "left_semi")


class KeyGuard:
    """Refuses a batch that repeats a stored key, by a filter that is kept beside the table."""

    def __init__(self, tables: Tables, name: str, keys: list[str]):
        self.tables, self.name, self.keys = tables, name, keys
        self.state = f"process_bits_{name}"

    def _filter(self) -> tuple[DataFrame, int] | None:
        """The filter of what is stored; built anew when it has become too small, else merged with new loads."""
        tables = self.tables
        if not tables.exists(self.name):
            return None
        last, stored = tables.last_number(self.name), tables.read(self.state)
        head = stored.select("size", "load").first() if stored is not None else None
        if head is not None and head.load == last:
            return stored.select("slot", "bits"), head.size
        size = filter_size(tables.read(self.name).count())  # from the files' footers
        if head is not None and head.size == size:
            later = key_bits(tables.read_after(self.name, head.load), self.keys, size)
            bits = merged_bits(stored.select("slot", "bits"), later)
        else:
            bits = key_bits(tables.read(self.name), self.keys, size)
        new = tables.replace(self.state, bits.withColumns({"size": F.lit(size).cast("long"), "load": F.lit(last)}))
        return new.select("slot", "bits"), size

    def repeats(self, batch: DataFrame) -> DataFrame:
        """Rows of ``batch`` whose key is stored."""
        found = self._filter()
        if found is None:
            return batch.limit(0)
        return repeats_of_stored(batch, self.tables.read(self.name), found[0], self.keys, found[1])

    def append(self, batch: DataFrame) -> DataFrame:
        """Append ``batch``, or raise when it repeats a stored key."""
        held = self.tables.stage(f"guarded_{self.name}", batch)
        n = self.repeats(held).count()
        if n:
            self.tables.clear(f"guarded_{self.name}")
            raise ValueError(f"{self.name}: load refused, {', '.join(self.keys)} stored already: {n} rows")
        out = self.tables.append(self.name, held)
        self.tables.clear(f"guarded_{self.name}")
        return out


# partial totals


def refresh_totals(tables: Tables, name: str, measures: dict[str, str], parts: list[int] | None = None) -> DataFrame:
    """(part, one column per measure): ``measures`` (name: SQL aggregate) of each partition of a stored table.

    ``parts``: the partitions that a load has rewritten (None: all); the others keep their state and are not read.  A
    partition that is gone loses its state.
    """
    state, by = f"process_totals_{name}", tables.laid_out_by(name)
    there = [int(p) for p in tables.partitions(name)]
    rows = tables.scan(name)
    wanted = there if parts is None or not tables.exists(state) else sorted(set(parts))
    found = rows.filter(F.col(by).isin(wanted)).groupBy(F.col(by).alias("part"))
    found = found.agg(*[F.expr(e).alias(n) for n, e in measures.items()])
    if tables.exists(state):
        kept = tables.read(state).filter(F.col("part").isin(sorted(set(there) - set(wanted))))
        found = kept.unionByName(found)
    return tables.replace(state, found)


def totals(tables: Tables, name: str, columns: list[str]) -> DataFrame:
    """The partial counts and sums of a table added up: one row."""
    return tables.read(f"process_totals_{name}").agg(*[F.sum(c).alias(c) for c in columns])
