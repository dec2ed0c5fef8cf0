"""Exact dedup by progressive refinement: length, then prefix hash, then hash of the whole text.

A text whose (length, prefix hash) no other text shares is settled without its content being hashed.
The shared ones are marked in a bitmap whose size follows their number up to 128 MB (``common.marked``);
the second read of the texts hashes those whose bit is set.  Two groups that fall on one bit only mean a
hash that was not needed, never a wrong group.

``assign`` shuffles no text; ``deduplicated`` shuffles texts of shared groups alone, one of each group
from a task.  A group may hold any share of the rows: it is counted by partial aggregation, and the join
that hands the result back to its rows is split by AQE.

Null texts count as empty.  Of equal texts the row with the largest doc_id stays (null ids come last);
of rows that repeat both doc_id and text one stays.  An empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mediamart.llm.common import marked, store, text_of


def shared_keys(light: DataFrame) -> DataFrame:
    """(length, prefix) that more than one text has; the prefix is looked at only where the length
    is shared."""
    lengths = light.groupBy("length").count().filter("count > 1").drop("count")
    pairs = light.groupBy("length", "prefix").count()  # one row per pair: no hot length in the join
    return pairs.join(lengths, "length", "left_semi").filter("count > 1").drop("count")


def refined(docs: DataFrame, prefix: int, slots: int | None, *columns: Column) -> DataFrame:
    """``columns`` of ``docs`` with text and ``hit``: whether another text may share length and prefix."""
    text = text_of()
    length, start = F.octet_length(text).alias("length"), F.xxhash64(F.substring(text, 1, prefix)).alias("prefix")
    light = store(docs.select(length, start), "exact-light")
    shared = store(shared_keys(light), "exact-shared")
    rows = docs.select(*columns, text.alias("text"), length, start)
    return marked(rows, shared, "length", "prefix", slots=slots).drop("length", "prefix")


def deduplicated(docs: DataFrame, prefix: int = 256, slots: int | None = None) -> DataFrame:
    """The rows that stay, all columns as they were (``row`` is one struct, so that no name can clash)."""
    rows = refined(docs, prefix, slots, F.struct("*").alias("row"))
    last = F.max_by("row", F.struct("row.doc_id")).alias("row")
    picked = rows.filter("hit").groupBy(F.sha2("text", 256).alias("sha256")).agg(last)
    return rows.filter("NOT hit").select("row.*").union(picked.select("row.*"))


def assign(docs: DataFrame, prefix: int = 256, slots: int | None = None, hash_all: bool = False) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, sha256.

    ``sha256`` is null for settled texts unless ``hash_all``.  ``slots`` must be a multiple of 32768; it
    follows the number of shared keys if not given.
    """
    digest = F.sha2("text", 256)
    hashed = store(
        refined(docs, prefix, slots, F.col("doc_id")).select(
            "doc_id",
            F.monotonically_increasing_id().alias("row"),
            F.col("hit").alias("shared"),
            (digest if hash_all else F.when(F.col("hit"), digest)).alias("sha256"),
        ),
        "exact-hashed",
    )
    rest = hashed.filter("shared")
    groups = store(  # stored, so that the join with the rows has an exchange of its own, which AQE can split
        rest.groupBy("sha256").agg(F.count("*").alias("group_size"), F.max(F.struct("doc_id", "row")).alias("winner")),
        "exact-groups",
    )
    settled = hashed.filter("NOT shared").select(
        "doc_id",
        F.col("doc_id").alias("keep_id"),
        F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"),
        "sha256",
    )
    return settled.unionByName(
        rest.join(groups, "sha256").select(
            "doc_id",
            F.col("winner.doc_id").alias("keep_id"),
            "group_size",
            F.col("winner.row").eqNullSafe(F.col("row")).alias("kept"),
            "sha256",
        )
    )
