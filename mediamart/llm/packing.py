"""Packing documents into sequences: shortest pack first, over the histogram of piece lengths.

A document's ids, with the end id, are cut into pieces of ``length`` ids and a rest.  Only the histogram
of piece lengths (at most ``length`` numbers) comes to the driver.  There lengths are placed longest
first, each into the packs with the most room left, as counts of packing patterns: a pattern is a list
of lengths, and one step moves as many packs as have the same pattern.  Each slot of a pattern is a
range of ranks among the pieces of its length, and the pieces find theirs by rank.  Pieces are ranked
inside their task while they are made; the tasks' counts per length shift them to ranks over all.

Null texts count as empty; a document without ids is the end id alone.  An empty table gives an
empty table.  Repeated ids or rows are packed each for itself.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mediamart.llm.common import store, text_of
from mediamart.llm.tokens import encoder


def pieces(docs: DataFrame, vocabulary: str, end_id: int, length: int, keep_ids: bool) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens, chunk, place[, ids]): ``place`` ranks the pieces of
    one length within the task ``chunk``."""
    end = end_id.to_bytes(4, "little")

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode, places, chunk = encoder(vocabulary).encode_all, Counter(), TaskContext.get().partitionId()
        for df in frames:
            rows, kept = [], []
            for doc_id, ids in zip(df["doc_id"].astype("Int64"), encode(df["text"].to_list())):
                ids += end
                for at in range(0, len(ids), 4 * length):
                    piece = ids[at : at + 4 * length]
                    n = len(piece) // 4
                    rows.append((doc_id, at // 4, n, zlib.crc32(piece), len(ids) // 4, chunk, places[n]))
                    places[n] += 1
                    kept.append(piece)
            out = pd.DataFrame(rows, columns=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "chunk", "place"])
            out["doc_id"] = out["doc_id"].astype("Int64")
            if keep_ids:
                out["ids"] = kept
            yield out

    kinds = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, chunk int, place long"
    return docs.select("doc_id", text_of().alias("text")).mapInPandas(cut, kinds + ", ids binary" * keep_ids)


def shortest_pack_first(histogram: dict[int, int], length: int) -> list[tuple[int, tuple[int, ...]]]:
    """Patterns as (number of packs, piece lengths), for ``histogram`` of piece length to count."""
    room: list[list[list]] = [[] for _ in range(length + 1)]  # by room left: [count, lengths]
    top = 0  # no pack has more room than this
    for size in sorted(histogram, reverse=True):
        left = histogram[size]
        while left:
            while top and not room[top]:
                top -= 1
            if top < size:  # no open pack takes it
                room[length - size].append([left, (size,)])
                top = max(top, length - size)
                break
            packs = room[top][-1]
            n = min(left, packs[0])
            grown = [n, (*packs[1], size)]
            packs[0] -= n
            if not packs[0]:
                room[top].pop()
            room[top - size].append(grown)
            left -= n
    return [(n, lengths) for packs in room for n, lengths in packs]


def slots(patterns: list[tuple[int, tuple[int, ...]]]) -> dict[int, np.ndarray]:
    """For each piece length its slots in order of rank: first rank, first sequence, offset."""
    found: dict[int, list[tuple[int, int, int]]] = {}
    ranks: Counter = Counter()
    sequence = 0
    for n, lengths in patterns:
        offset = 0
        for size in lengths:
            found.setdefault(size, []).append((ranks[size], sequence, offset))
            ranks[size] += n
            offset += size
        sequence += n
    return {size: np.array(rows, np.int64) for size, rows in found.items()}


def pack(
    docs: DataFrame, vocabulary: str, end_id: int = 1, length: int = 2048, keep_ids: bool = False
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset[, ids].

    ``vocabulary`` is the path of a tokenizer file that every worker can read.
    """
    made = store(pieces(docs, vocabulary, end_id, length, keep_ids), "pack-pieces")
    counts = made.groupBy("chunk", "length").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("length").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    shifts = counts.select("chunk", "length", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("shift"))
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    table = slots(shortest_pack_first(histogram, length))

    def place(sizes: pd.Series, ranks: pd.Series) -> pd.DataFrame:
        sequence, offset = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
        size, rank = sizes.to_numpy(), ranks.to_numpy()
        for one in np.unique(size):
            rows = np.flatnonzero(size == one)
            found = table[one][np.searchsorted(table[one][:, 0], rank[rows], "right") - 1]
            sequence[rows] = found[:, 1] + rank[rows] - found[:, 0]
            offset[rows] = found[:, 2]
        return pd.DataFrame({"sequence_id": sequence, "offset": offset})

    placed = F.pandas_udf(place, "sequence_id long, offset long")
    return made.join(shifts, ["chunk", "length"]).select(
        "doc_id",
        "start",
        "length",
        "ids_crc32",
        "doc_tokens",
        placed("length", F.col("place") + F.col("shift")).alias("at"),
        *(["ids"] if keep_ids else []),
    ).select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "at.sequence_id", "at.offset", *(["ids"] if keep_ids else []))


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, ids, documents) from ``pack(..., keep_ids=True)``; a sequence has a bounded length.

    ``ids`` holds the pieces' ids in order, as little-endian unsigned 32-bit integers, unpadded.
    """
    parts = F.sort_array(F.collect_list(F.struct("offset", "doc_id", "ids")))
    return packed.groupBy("sequence_id").agg(parts.alias("parts")).select(
        "sequence_id",
        F.aggregate("parts.ids", F.lit(b""), lambda a, b: F.concat(a, b)).alias("ids"),
        F.col("parts.doc_id").alias("documents"),
    )
