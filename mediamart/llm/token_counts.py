"""Token counts of flat, unindexed token files by a separator scan.

A flat file is the ids of its documents in a row, each document followed by the end id, as little-endian
unsigned integers of two or four bytes.  Files are read as blocks; a block's ends are found by one
vectorised comparison, without regard to its neighbours.  A prefix scan over the blocks of a file then gives
each block the ids before it, the documents before it and the last end before it, and so the document
that crosses into it.  The scan has two levels, runs of 1,024 blocks and blocks, so a file of any length is no
single task's work.

An empty file has no documents.  Ids after the last end of a file are a document with ``ended`` false.  The
ids are whole: a file whose length is no multiple of ``width`` is an error.
"""

from __future__ import annotations

import functools
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from mediamart.llm.common import store, text_of
from mediamart.session import shared_folder

RUN = 1_024
BLOCK = 4 << 20
PER_TASK = 16  # blocks
#: Stores whose files Arrow reads in ranges, by the name Spark has for them.
STORES = {"file": "file", "hdfs": "hdfs", "s3a": "s3", "s3": "s3", "gs": "gs"}


@functools.lru_cache(maxsize=2)
def _processor(path: str):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path)


def write_flat(docs: DataFrame, vocabulary: str, end_id: int = 2, width: int = 2) -> str:
    """Tokenize whole texts into flat files in the shared folder, one per task, and return their folder.

    The file system is Spark's own: a document's ids are written as a line whose line end is the end
    id, so that id's bytes must be text (ids under 128).  The vocabulary's control id never comes out
    of a text.  Null texts count as empty: the end id alone.
    """
    kind = f"<u{width}"

    def ids(texts: pd.Series) -> pd.Series:
        encode = _processor(vocabulary).encode
        return pd.Series([np.asarray(encode(t), kind).tobytes() for t in texts], dtype=object)

    spark = docs.sparkSession
    folder = f"{shared_folder(spark)}/llm/{spark.sparkContext.applicationId}/flat-{uuid.uuid4().hex}"
    encoded = F.pandas_udf(ids, "binary")(text_of()).cast("string")
    docs.select(encoded.alias("value")).write.text(folder, lineSep=end_id.to_bytes(width, "little").decode("ascii"))
    return folder


def _opened(path: str):
    """A seekable file of a store that Arrow knows; ``path`` as Spark writes it."""
    from pyarrow import fs

    scheme, rest = path.split(":", 1)
    if scheme == "file":
        return fs.LocalFileSystem().open_input_file("/" + rest.lstrip("/"))
    system, name = fs.FileSystem.from_uri(f"{STORES[scheme]}:{rest}")
    return system.open_input_file(name)


def blocks(spark: SparkSession, folder: str, width: int, block: int = BLOCK) -> DataFrame:
    """(file, block, bytes) of the flat files under ``folder``.

    Files are cut by their lengths alone, and a task reads the byte ranges of its blocks, one at a time.  In
    stores that only Spark reads a file is one cell, so it must be under 2 GiB there.
    """
    if block % width:
        raise ValueError("a block must hold whole ids")
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(folder).filter("length > 0")
    last = (F.ceil(F.col("length") / block) - 1).cast("int")
    found = files.agg(F.sum(last + 1).alias("n"), F.min("path").alias("path")).first()
    if found["path"] and found["path"].split(":", 1)[0] not in STORES:
        part = F.transform(
            F.sequence(F.lit(0), last), lambda i: F.substring(F.col("content"), i * block + 1, F.lit(block))
        )
        return files.select(F.col("path").alias("file"), F.posexplode(part).alias("block", "bytes"))

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for df in frames:
            for path, length, k in zip(df["file"], df["length"], df["block"]):
                size = min(block, length - k * block)
                with _opened(path) as file:
                    file.seek(k * block)
                    got = file.read(size)
                if len(got) != size:
                    raise OSError(f"{path} has become shorter")
                yield pd.DataFrame({"file": [path], "block": [k], "bytes": [got]})

    tasks = max(spark.sparkContext.defaultParallelism, -(-(found["n"] or 0) // PER_TASK))
    return (
        files.select(F.col("path").alias("file"), "length", F.explode(F.sequence(F.lit(0), last)).alias("block"))
        .repartition(tasks, "file", "block")
        .mapInPandas(read, "file string, block int, bytes binary")
    )


def scanned(parts: DataFrame, end_id: int, width: int) -> DataFrame:
    """(file, block, ids, ends): the number of ids and the places of the ends, for each block."""

    def scan(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for df in frames:
            found = [np.frombuffer(b, f"<u{width}") for b in df["bytes"]]
            yield pd.DataFrame(
                {
                    "file": df["file"],
                    "block": df["block"],
                    "ids": [len(x) for x in found],
                    "ends": [np.flatnonzero(x == end_id) for x in found],
                }
            )

    return parts.mapInPandas(scan, "file string, block int, ids long, ends array<long>")


def _before(df: DataFrame, what: str, name: str, add) -> DataFrame:
    """``add`` (F.sum or F.max) of ``what`` over the blocks of a file before each block: over the runs
    before, one row each, then within the run."""
    runs = df.groupBy("file", "run").agg(add(what).alias("value"))
    by_run = Window.partitionBy("file").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    in_run = Window.partitionBy("file", "run").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    carried = runs.select("file", "run", add("value").over(by_run).alias("_carried"))
    both = F.array_compact(F.array("_carried", add(what).over(in_run)))
    total = F.aggregate(both, F.lit(0).cast("long"), lambda a, b: a + b) if add is F.sum else F.array_max(both)
    return df.join(carried, ["file", "run"]).withColumn(name, total).drop("_carried")


def counts(parts: DataFrame, end_id: int, width: int) -> DataFrame:
    """One row per document: file, document (from 0), start (ids before it in its file), tokens
    (without the end id), ended."""
    found = store(
        scanned(parts, end_id, width).withColumn("run", (F.col("block") / RUN).cast("int")), "flat-scanned"
    )
    sums = found.select(
        "file",
        "run",
        "block",
        "ids",
        F.size("ends").cast("long").alias("n"),
        F.try_element_at("ends", F.lit(-1)).alias("last"),
    )
    placed = _before(_before(sums, "ids", "base", F.sum), "n", "documents", F.sum)
    placed = _before(placed.withColumn("end", F.col("base") + F.col("last")), "end", "carry", F.max)
    placed = placed.select("file", "block", "base", "documents", F.coalesce(F.col("carry") + 1, F.lit(0)).alias("open"))
    whole = (
        found.join(placed, ["file", "block"])
        .select("file", "documents", "base", "open", "ends", F.posexplode("ends").alias("k", "end"))
        .select(
            "file",
            (F.col("documents") + F.col("k")).alias("document"),
            F.when(F.col("k") == 0, F.col("open"))
            .otherwise(F.col("base") + F.try_element_at("ends", F.col("k")) + 1)
            .alias("start"),
            (F.col("base") + F.col("end")).alias("end"),
        )
        .select("file", "document", "start", (F.col("end") - F.col("start")).alias("tokens"), F.lit(True).alias("ended"))
    )
    totals = sums.join(placed.select("file", "block", "base"), ["file", "block"]).groupBy("file").agg(
        F.sum("ids").alias("ids"), F.sum("n").alias("document"), F.max(F.col("base") + F.col("last") + 1).alias("start")
    )
    rest = totals.withColumn("start", F.coalesce("start", F.lit(0))).filter("start < ids")
    return whole.unionByName(
        rest.select("file", "document", "start", (F.col("ids") - F.col("start")).alias("tokens"), F.lit(False).alias("ended"))
    )
