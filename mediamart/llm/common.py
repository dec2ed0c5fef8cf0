"""What several of the training-data operators need."""

from __future__ import annotations

import unicodedata
import uuid

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mediamart.session import shared_folder

MASK = (1 << 64) - 1
PART = 32_768  # bits of one row of a bitmap
#: ASCII characters that part words.
_PARTING = bytes(c for c in range(128) if not (chr(c).isalnum() or c == 95))
_TO_SPACE = bytes.maketrans(_PARTING, b" " * len(_PARTING))


class _Parted(dict):
    """Code point to itself, and to a space where it is beyond ASCII and no letter, digit or mark."""

    def __missing__(self, point: int) -> int:
        self[point] = value = point if point < 128 or unicodedata.category(chr(point))[0] in "LNM" else 32
        return value


_PARTED = _Parted()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(column: str = "text") -> Column:
    """The text, with null as the empty text."""
    return F.coalesce(F.col(column), F.lit(""))


def store(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage: a lost executor costs the tasks it ran, not what led up to this table.  The
    tables of one application lie under its id and can go when it has ended.
    """
    spark = df.sparkSession
    folder = f"{shared_folder(spark)}/llm/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


def words(text: str) -> list[bytes]:
    """Lower-case words in UTF-8: runs of letters, digits, marks and ``_``."""
    if not text.isascii():
        text = text.translate(_PARTED)
    return text.lower().encode("utf-8", "surrogatepass").translate(_TO_SPACE).split()


class Hashes(dict):
    """Word to 64-bit hash, remembered.  Emptied when it holds ``most`` words, so memory is bounded."""

    def __init__(self, most: int = 200_000):
        super().__init__()
        self.most = most

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.most:
            self.clear()
        self[word] = value = xxhash.xxh64_intdigest(word)
        return value

    def of(self, found: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, found), np.uint64, len(found))


def mixed(h: np.ndarray) -> np.ndarray:
    """64-bit finaliser, element by element."""
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def shingles(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of each run of ``size`` words; a shorter text is one shingle, an empty one has none."""
    n = len(hashes)
    if n == 0:
        return hashes
    size = min(size, n)
    out = np.zeros(n - size + 1, np.uint64)
    for k in range(size):
        out = out * np.uint64(0x9E3779B97F4A7C15) + hashes[k : n - size + 1 + k]
    return mixed(out + np.uint64(size))


def row_key(doc_id: str = "doc_id", text: str = "text") -> Column:
    """Names a row by its id and whole text, for tables whose ids may be null or repeat."""
    return F.sha2(F.concat(F.coalesce(F.col(doc_id).cast("string"), F.lit("-")), F.lit("\n"), text_of(text)), 256)


def slots_for(keys: int) -> int:
    """Slots of a bitmap: sixteen to thirty-two a key, from 2^20 up to 2^30 (128 MB), so its size is bounded."""
    return 1 << min(max((16 * keys).bit_length(), 20), 30)


def marked(rows: DataFrame, keys: DataFrame, *key: str, slots: int | None = None) -> DataFrame:
    """``rows`` with ``hit``: true for each row whose ``key`` is in ``keys``, and for few others.

    ``keys`` must be stored, since it is counted first.  Its bitmap is broadcast (``slots`` / 8 bytes; a
    multiple of 32768 slots); a bitmap that is too full only marks more rows, so what follows has to join
    the hits by the key itself.
    """
    slots = slots or slots_for(keys.count())
    slot = F.pmod(F.xxhash64(*key), F.lit(slots))
    bits = (
        keys.select(slot.alias("slot"))
        .groupBy((F.col("slot") / PART).cast("long").alias("part"))
        .agg(F.bitmap_construct_agg(F.col("slot") % PART).alias("bits"))
    )
    bit = F.col("slot") % PART
    byte = F.conv(F.hex(F.substring("bits", (bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    hit = F.coalesce(F.getbit(byte, (bit % 8).cast("int")) == 1, F.lit(False))
    return (
        rows.withColumn("slot", slot)
        .join(F.broadcast(bits), (F.col("slot") / PART).cast("long") == F.col("part"), "left")
        .withColumn("hit", hit)
        .drop("slot", "part", "bits")
    )


def _keyed(docs: DataFrame, keys: DataFrame) -> DataFrame:
    """(row, row_key, hit).  The rows travel as one struct, so that no column name can clash."""
    return marked(docs.select(F.struct("*").alias("row"), row_key().alias("row_key")), keys, "row_key")


def keep_rows(docs: DataFrame, decided: DataFrame) -> DataFrame:
    """Rows of ``docs`` that ``decided`` (row_key, kept) does not drop, each key once; all columns as they were.

    Only rows that are dropped or repeated, and the few that share their bits, are stored and shuffled.
    """
    keys = store(
        decided.groupBy("row_key").agg(F.bool_or("kept").alias("kept"), F.count("*").alias("n")).filter("NOT kept OR n > 1"),
        "keys-decided",
    )
    rows = _keyed(docs, keys)
    hit = store(rows.filter("hit").select("row", "row_key"), "rows-hit")
    once = hit.dropDuplicates(["row_key"]).join(keys.filter("kept"), "row_key", "left_semi")
    passed = rows.filter("NOT hit").unionByName(hit.join(keys, "row_key", "left_anti"), allowMissingColumns=True)
    return passed.select("row.*").union(once.select("row.*"))


def drop_rows(docs: DataFrame, keys: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose ``row_key`` is not in ``keys``; all columns as they were.  Only the dropped
    rows, and the few that share their bits, are shuffled."""
    keys = store(keys.select("row_key").distinct(), "keys-dropped")
    rows = _keyed(docs, keys)
    left = rows.filter("hit").join(keys, "row_key", "left_anti")
    return rows.filter("NOT hit").select("row.*").union(left.select("row.*"))
