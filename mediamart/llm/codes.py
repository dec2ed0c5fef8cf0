"""Vector codes by product quantisation; entries are looked up over memoised grid cells.

A vector is cut into parts, and each part position has a small codebook that integer k-means refines.  The
nearest entry of a part is found over the grid cell (a box of side ``1 << shift``) in which it lies: of the entries
only those are kept for a cell that no other entry dominates over the whole box, which is so when an entry's least
distance to the box exceeds another's greatest.  A cell's kept entries are remembered by the hash of the cell,
and only they are evaluated exactly.  Everything is integer arithmetic, so results do not depend on how rows are spread.

Each round is one job over the stored integer vectors that returns sums per part, entry and component.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mediamart.llm.common import mixed, store

#: Components beyond this magnitude could overflow the distances.
LARGEST = 1 << 28
FAR = np.iinfo(np.int64).max


class Cells:
    """Entries that can be nearest in a grid cell, for one part position; at most ``most`` cells are remembered."""

    def __init__(self, entries: np.ndarray, shift: int, most: int = 200_000):
        self.entries, self.shift, self.most = entries, shift, most
        self._forget()

    def _forget(self) -> None:
        self.keys = np.empty(0, np.uint64)
        self.cells = np.empty((0, self.entries.shape[1]), np.int64)
        self.masks = np.empty((0, len(self.entries)), bool)

    @staticmethod
    def key(cells: np.ndarray) -> np.ndarray:
        h = np.zeros(len(cells), np.uint64)
        for column in cells.T:
            h = mixed(h * np.uint64(0x9E3779B97F4A7C15) + column.astype(np.uint64))
        return h

    def undominated(self, cells: np.ndarray) -> np.ndarray:
        """(cells, entries): False where another entry is nearer everywhere in the box."""
        low = (cells << self.shift)[:, None, :]
        high = low + ((1 << self.shift) - 1)
        outside = np.maximum(np.maximum(low - self.entries, self.entries - high), 0)
        farthest = np.maximum(np.abs(self.entries - low), np.abs(high - self.entries))
        least, most = (outside**2).sum(2), (farthest**2).sum(2)
        return least <= most.min(1, keepdims=True)

    def candidates(self, vectors: np.ndarray) -> np.ndarray:
        """(vectors, entries): which entries are to be evaluated."""
        cells = vectors >> self.shift
        keys = self.key(cells)
        at = np.minimum(np.searchsorted(self.keys, keys), max(len(self.keys) - 1, 0))
        known = (self.keys[at] == keys) if len(self.keys) else np.zeros(len(keys), bool)
        if not known.all():
            fresh, first = np.unique(keys[~known], return_index=True)
            if len(self.keys) + len(fresh) > self.most:
                self._forget()
                fresh, first = np.unique(keys, return_index=True)
                new = cells[first]
            else:
                new = cells[~known][first]
            order = np.argsort(keys_now := np.concatenate([self.keys, fresh]))
            self.cells = np.concatenate([self.cells, new])[order]
            self.masks = np.concatenate([self.masks, self.undominated(new)])[order]
            self.keys = keys_now[order]
            at = np.searchsorted(self.keys, keys)
        masks = self.masks[at]
        masks[(self.cells[at] != cells).any(1)] = True  # two cells of one hash: evaluate all entries
        return masks

    def nearest(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of the nearest entry, the lower one on ties, and the squared distance."""
        row, entry = np.nonzero(self.candidates(vectors))
        distances = np.full((len(vectors), len(self.entries)), FAR)
        distances[row, entry] = ((vectors[row] - self.entries[entry]) ** 2).sum(1)
        index = distances.argmin(1)
        return index, distances[np.arange(len(vectors)), index]


def integers(column: str, scale: int) -> F.Column:
    return F.transform(column, lambda x: F.floor(x.cast("double") * scale))


def usable(column: str) -> F.Column:
    """Not null, not empty, all components finite numbers."""
    finite = F.forall(column, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(F.col(column).isNotNull() & (F.size(column) > 0) & finite, F.lit(False))


def _matrix(batch: pa.RecordBatch, parts: int) -> np.ndarray:
    """(vectors, parts, components)."""
    flat = batch.column("_v").flatten().to_numpy(zero_copy_only=False).astype(np.int64, copy=False)
    if len(flat) and max(-flat.min(), flat.max()) >= LARGEST:
        raise ValueError(f"vector components of {LARGEST} and more, scaled, are not supported")
    return flat.reshape(len(batch), parts, -1)


def refined(stored: DataFrame, books: np.ndarray, shift: int) -> np.ndarray:
    """The codebooks (parts, entries, components) after one round; entries that no part is nearest to stay."""
    parts, entries, width = books.shape

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = [Cells(book, shift) for book in books]
        n = np.zeros((parts, entries), np.int64)
        total = np.zeros((parts, entries, width), np.int64)
        for batch in batches:
            vectors = _matrix(batch, parts)
            for p in range(parts):
                index, _ = cells[p].nearest(vectors[:, p])
                np.add.at(n[p], index, 1)
                np.add.at(total[p], index, vectors[:, p])
        part, entry = np.nonzero(n)
        yield pa.RecordBatch.from_pydict(
            {"part": part, "entry": entry, "n": n[part, entry], "total": list(total[part, entry])},
            pa.schema([("part", pa.int64()), ("entry", pa.int64()), ("n", pa.int64()), ("total", pa.list_(pa.int64()))]),
        )

    found = (
        stored.select("_v")
        .mapInArrow(sums, "part long, entry long, n long, total array<long>")
        .select("part", "entry", "n", F.posexplode("total").alias("component", "x"))
        .groupBy("part", "entry", "component")
        .agg(F.sum("n").alias("n"), F.sum("x").alias("x"))
    )
    books = books.copy()
    for r in found.collect():  # parts x entries x components numbers
        books[r.part, r.entry, r.component] = r.x // r.n
    return books


def compress(
    vectors: DataFrame,
    column: str = "embedding",
    key: str = "vec_id",
    parts: int = 8,
    entries: int = 16,
    rounds: int = 6,
    scale: int = 4096,
    shift: int = 10,
) -> tuple[DataFrame, np.ndarray]:
    """Rows of ``vectors`` with ``code`` (entry numbers, two hex digits each) and ``error``, and the codebooks.

    Rows whose vector is null, empty or holds null or non-finite components are dropped, and so are vectors of
    another length than that of the least key.  Codebooks start from the vectors of the least keys; null
    keys come last, equal keys by their vector, so repeated rows can give equal entries, of which the lower one
    is used.  With fewer vectors than entries there are fewer entries, with none there are no rows and the
    codebooks are empty.  Other columns pass unchanged; those named ``code`` or ``error`` are replaced.
    A length that ``parts`` does not divide is an error, and so are scaled components of 2^28 and more.
    """
    spark = vectors.sparkSession
    passed = [c for c in vectors.columns if c not in (column, "code", "error", "_v")]
    stored = store(vectors.filter(usable(column)).select(*passed, integers(column, scale).alias("_v")), "codes-integers")
    order = [F.col(key).asc_nulls_last(), "_v"]
    schema = stored.drop("_v").schema.add("code", "string").add("error", "long")
    first = stored.orderBy(*order).limit(1).collect()
    if not first:
        return spark.createDataFrame([], schema), np.zeros((parts, 0, 0), np.int64)
    length = len(first[0]["_v"])
    if length % parts:
        raise ValueError(f"vectors of {length} components cannot be cut into {parts} equal parts")
    stored = stored.filter(F.size("_v") == length)
    start = [r["_v"] for r in stored.orderBy(*order).limit(entries).select("_v").collect()]
    books = np.array(start, np.int64).reshape(len(start), parts, -1).swapaxes(0, 1).copy()
    for _ in range(rounds):
        books = refined(stored, books, shift)
    digits = np.array([f"{i:02x}" for i in range(entries)])

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = [Cells(book, shift) for book in books]
        for batch in batches:
            vectors = _matrix(batch, parts)
            error = np.zeros(len(batch), np.int64)
            names = []
            for p in range(parts):
                index, distance = cells[p].nearest(vectors[:, p])
                error += distance
                names.append(digits[index])
            code = ["".join(x) for x in zip(*names, strict=True)]
            kept = [batch.column(c) for c in passed]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(code, pa.string()), pa.array(error)], [*passed, "code", "error"])

    return stored.mapInArrow(coded, schema), books


def digest(books: np.ndarray) -> str:
    """SHA-256 of all components in decimal by part, entry and position."""
    return hashlib.sha256(",".join(map(str, books.reshape(-1).tolist())).encode()).hexdigest()


def group_errors(coded: DataFrame, by: str) -> DataFrame:
    """``coded`` with ``<by>_error``: the error summed over equal values of ``by``, nulls together.

    Sums are made before the join, so a value that most rows have is one row there.
    """
    total = coded.groupBy(F.col(by).alias("_of")).agg(F.sum("error").alias(f"{by}_error"))
    return coded.join(total, F.col(by).eqNullSafe(F.col("_of"))).drop("_of")
