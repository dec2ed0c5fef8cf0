"""Hard negatives by threshold joins over an inverted index with suffix-norm bounds (after L2AP).

Rows are dealt into slices and anchors into blocks; each (slice, block) pair is one bounded task.  In a task

* the index of a row omits its leading components as long as the norms of what is omitted, times the anchor's
  norm there, stay below every threshold: a pair that meets only in omitted components cannot reach it;
* the components are walked from the last to the first in runs; partial scores are accumulated, and a
  pair goes when its partial score plus the product of the norms that remain is below the anchor's threshold;
* what is left is scored exactly, and the best of each window are returned.

Thresholds start where the corpus moments let one expect enough rows and are lowered, for the windows that
are not full, until all windows are full or at their lower end.  A threshold only decides how much is looked at, never
what is returned.  First the positives of each anchor are found (window: all scores, rows of its label), then the
negatives of each (anchor, positive) (window: the allowed share of the positive's score, rows of other labels).
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from statistics import NormalDist

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mediamart.llm.codes import integers, usable
from mediamart.llm.common import store

LEAST = -(1 << 62)
#: Stands for a null key, which comes last.
NO_KEY = (1 << 63) - 1
#: Components up to this magnitude have inner products that doubles hold exactly, over up to 2^9 components.
LARGEST = 1 << 21
RUN = 8
#: Rows expected above a threshold, times what is wanted; after each round that did not fill a window, sixteen times more.
SPARE, MORE = 4, 16
BELL = NormalDist()


def survivors(
    anchors: np.ndarray, rows: np.ndarray, thresholds: np.ndarray, allowed: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All pairs (anchor, row) that are ``allowed`` and reach the anchor's threshold, with their scores.

    ``allowed``: (anchors, rows), True where the pair may count.
    """
    width = rows.shape[1]
    norms = lambda m: np.sqrt(np.concatenate([np.zeros((len(m), 1)), np.cumsum(m * m, 1)], 1))
    of_anchors, of_rows = norms(anchors), norms(rows)
    least = thresholds.min(initial=math.inf)
    # omitted[r]: so many leading components of the row are not in the index
    covered = of_rows * of_anchors.max(0, initial=0.0) < least
    omitted = np.where(covered.all(1), width, np.maximum(covered.argmin(1) - 1, 0)) // RUN * RUN
    index = np.where(np.arange(width) < omitted[:, None], 0.0, rows)
    alive = allowed & (omitted < width)
    partial = np.zeros(alive.shape)
    need = thresholds - 1e-6 * np.abs(thresholds) - 0.5  # scores are integers
    for start in reversed(range(0, width, RUN)):
        if np.count_nonzero(alive) <= alive.size // 16:
            break
        partial += anchors[:, start : start + RUN] @ index[:, start : start + RUN].T
        rest = np.maximum(omitted, start)  # components before this one have not been counted
        bound = partial + of_anchors[:, rest] * of_rows[np.arange(len(rows)), rest]
        alive &= bound >= need[:, None]
    a, r = np.nonzero(alive)
    score = np.empty(len(a))
    for part in range(0, len(a), 1 << 16):  # exact, all components
        s = slice(part, part + (1 << 16))
        score[s] = np.einsum("ij,ij->i", anchors[a[s]], rows[r[s]])
    keep = score >= thresholds[a]
    return a[keep], r[keep], score[keep].astype(np.int64)


def _matrix(column: pd.Series) -> np.ndarray:
    m = np.stack(column.to_numpy()) if len(column) else np.zeros((0, 0))
    if m.size and np.abs(m).max() >= LARGEST:
        raise ValueError(f"scaled components of {LARGEST} and more are not supported")
    return m.astype(np.float64)


def _best(a: np.ndarray, window: np.ndarray, score: np.ndarray, vec: np.ndarray, k: int) -> np.ndarray:
    """Positions of the first ``k`` of each (anchor, window)."""
    order = np.lexsort((vec, -score, window, a))
    a, window = a[order], window[order]
    new = np.r_[True, (a[1:] != a[:-1]) | (window[1:] != window[:-1])] if len(order) else np.zeros(0, bool)
    starts = np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))
    return order[np.arange(len(order)) - starts < k]


def scan(rows: DataFrame, windows: DataFrame, k: int, same_label: bool, slice_rows: int, block_rows: int) -> DataFrame:
    """The first ``k`` rows of each slice for each window: (anchor, window, score, vec_id, row).

    ``rows``: (row, vec_id, label, v).  ``windows``: one row per anchor: (anchor, label, v, found array<struct<
    window, low, high>>), bounds inclusive.  The first k of all rows are among those of the slices.
    """
    n, anchors = rows.count(), windows.count()
    slices, blocks = max(1, math.ceil(n / slice_rows)), max(1, math.ceil(anchors / block_rows))
    own = lambda c, m: F.pmod(F.xxhash64(c), F.lit(m)).cast("int")
    each = lambda m: F.explode(F.sequence(F.lit(0), F.lit(m - 1)))
    left = rows.select("row", "vec_id", "label", "v", own("row", slices).alias("slice"), each(blocks).alias("block"))
    right = windows.select("anchor", "label", "v", "found", own("anchor", blocks).alias("block"), each(slices).alias("slice"))
    columns = "anchor long, window int, score long, vec_id long, row long"

    def cell(rows: pd.DataFrame, anchors: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(rows) and len(anchors):
            x, labels = _matrix(rows["v"]), rows["label"].to_numpy()
            ids, vecs = rows["row"].to_numpy(), rows["vec_id"].to_numpy()
            for start in range(0, len(anchors), 128):
                part = anchors.iloc[start : start + 128]
                names = part["anchor"].to_numpy()
                allowed = (part["label"].to_numpy()[:, None] == labels) == same_label
                allowed &= names[:, None] != ids
                found = [(i, w["window"], w["low"], w["high"]) for i, f in enumerate(part["found"]) for w in f]
                of, window, low, high = (np.array(c, np.int64) for c in zip(*found, strict=True))
                least = np.full(len(part), np.iinfo(np.int64).max)
                np.minimum.at(least, of, low)
                a, r, score = survivors(_matrix(part["v"]), x, least.astype(np.float64), allowed)
                picked = []
                for w in np.unique(window):  # a few windows per anchor
                    bounds = np.full((len(part), 2), [1, 0])
                    bounds[of[window == w]] = np.stack([low, high], 1)[window == w]
                    inside = np.flatnonzero((score >= bounds[a, 0]) & (score <= bounds[a, 1]))
                    best = inside[_best(a[inside], np.zeros(len(inside)), score[inside], vecs[r[inside]], k)]
                    picked.append((names[a[best]], np.full(len(best), w), score[best], r[best]))
                for name, w, s, at in picked:
                    out.append(pd.DataFrame({"anchor": name, "window": w, "score": s, "vec_id": vecs[at], "row": ids[at]}))
        if not out:
            return pd.DataFrame({c.split()[0]: pd.Series(dtype="int64") for c in columns.split(", ")})
        return pd.concat(out)

    keys = ["slice", "block"]
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(cell, columns)


def first(found: DataFrame, k: int) -> DataFrame:
    """The first ``k`` of each (anchor, window), with their ``rank``."""
    order = Window.partitionBy("anchor", "window").orderBy(F.desc("score"), "vec_id", "row")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


class Moments:
    """Mean and covariance of all vectors, by which the scores of an anchor are expected to lie."""

    def __init__(self, rows: DataFrame, width: int):
        def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros((width + 1, width + 1))
            for batch in batches:
                flat = batch.column("v").flatten().to_numpy(zero_copy_only=False).astype(np.float64)
                x = np.concatenate([np.ones((len(batch), 1)), flat.reshape(len(batch), width)], 1)
                total += x.T @ x
            yield pa.RecordBatch.from_pydict({"at": np.arange(total.size), "x": total.reshape(-1)})

        found = rows.select("v").mapInArrow(sums, "at long, x double").groupBy("at").agg(F.sum("x").alias("x"))
        second = np.zeros((width + 1) ** 2)
        for r in found.collect():  # (components + 1)^2 numbers
            second[r["at"]] = r["x"]
        second = second.reshape(width + 1, width + 1) / max(second[0], 1.0)
        self.mean = second[0, 1:]
        self.covariance = second[1:, 1:] - np.outer(self.mean, self.mean)

    def expected(self, v: np.ndarray, high: int | None, wanted: float, n: int) -> int:
        """A threshold with ``wanted`` of ``n`` rows expected between it and ``high``."""
        m = float(v @ self.mean)
        sd = math.sqrt(max(float(v @ self.covariance @ v), 0.0))
        if sd == 0.0 or n <= 0:
            return LEAST
        top = 1.0 if high is None else BELL.cdf((high - m) / sd)
        share = top - wanted / n
        return LEAST if share <= 1e-12 else math.floor(m + sd * BELL.inv_cdf(min(share, 1 - 1e-12)))


def _with_thresholds(windows: DataFrame, moments: Moments, k: int, effort: int) -> DataFrame:
    """``windows`` with ``low`` of each window raised to where enough rows are expected; ``floor`` is the real one."""

    def raised(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for v, found, n in zip(batch["v"], batch["found"], batch["n"], strict=True):
                v = np.asarray(v, np.float64)
                new = []
                for w in found:
                    high = None if w["high"] == -LEAST else w["high"]
                    at = moments.expected(v, high, k * SPARE * MORE**effort, int(n))
                    new.append({**w, "low": max(int(w["floor"]), min(at, int(w["high"])))})
                out.append(new)
            yield batch.assign(found=out)

    return windows.mapInPandas(raised, windows.schema)


WINDOW = "array<struct<window: int, low: long, high: long, floor: long>>"


def fill(
    rows: DataFrame, windows: DataFrame, k: int, same_label: bool, moments: Moments, slice_rows: int, block_rows: int
) -> DataFrame:
    """The first ``k`` rows of each window between its ``floor`` and ``high``; thresholds are lowered until windows fill.

    ``windows``: (anchor, label, v, n, found), n being how many rows have the label asked for.
    """
    done = []
    effort = 0
    pending = windows
    while True:
        raised = pending if effort > 2 else _with_thresholds(pending, moments, k, effort)
        lowered = F.transform("found", lambda w: F.when(F.lit(effort > 2), w.withField("low", w["floor"])).otherwise(w))
        asked = store(raised.withColumn("found", lowered), "negatives-asked")
        found = store(first(scan(rows, asked, k, same_label, slice_rows, block_rows), k), "negatives-found")
        one = asked.select("anchor", F.explode("found").alias("w")).select("anchor", "w.*")
        full = found.filter(F.col("rank") == k).select("anchor", "window")
        # a window at its lower end is complete whatever it holds
        short = one.filter("low > floor").join(full, ["anchor", "window"], "left_anti")
        short = store(short.groupBy("anchor").agg(F.collect_list("window").alias("short")), "negatives-short")
        left = one.select("anchor", "window").join(
            short.select("anchor", F.explode("short").alias("window")), ["anchor", "window"], "left_anti"
        )
        done.append(found.join(left, ["anchor", "window"], "left_semi"))
        if short.isEmpty():
            break
        kept = F.filter("found", lambda w: F.array_contains("short", w["window"]))
        pending = asked.join(short, "anchor").select(*windows.columns[:-1], kept.alias("found"))
        effort += 1
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out


def mine(
    vectors: DataFrame,
    is_anchor: Column,
    label: Column,
    column: str = "embedding",
    key: str = "vec_id",
    scale: int = 256,
    positives: int = 5,
    negatives: int = 10,
    share: tuple[int, int] = (30, 90),
    slice_rows: int = 4096,
    block_rows: int = 4096,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    Rows with a null label or a vector that is null, empty or holds null or non-finite components take no part; of
    the others only those with the length of the least vector count.  ``label`` may change the label.  A
    score is the integer inner product of the scaled, floored vectors; higher ones come first, ties by
    smaller key, null keys last.  Repeated rows are rows of their own, also as anchors and as positives.  A
    positive at or below zero has only the negatives that the two bounds still let through.  Extra columns
    are ignored.  No rows, no anchors or one label give an empty result.

    Work grows with anchors times rows: each pair of a slice and a block is one task, and a slice is sent
    once per block of anchors.
    """
    low, high = share
    known = vectors.filter(usable(column)).select(
        F.coalesce(F.col(key).cast("long"), F.lit(NO_KEY)).alias("vec_id"),
        label.cast("long").alias("label"),
        integers(column, scale).alias("v"),
        F.coalesce(is_anchor, F.lit(False)).alias("is_anchor"),
    )
    numbered = store(known.filter("label IS NOT NULL").withColumn("row", F.monotonically_increasing_id()), "negatives-rows")
    width = numbered.agg(F.min(F.size("v"))).first()[0] or 1
    rows = numbered.filter(F.size("v") == width)
    moments = Moments(rows, width)
    of_label = rows.groupBy("label").agg(F.count("*").alias("same"))
    whole = of_label.select(F.sum("same").alias("total")).first()[0] or 0
    anchors = rows.filter("is_anchor").join(of_label, "label")
    anchors = store(anchors.select(F.col("row").alias("anchor"), F.col("vec_id").alias("anchor_id"), "label", "v", "same"), "negatives-anchors")
    every = F.struct(F.lit(0).alias("window"), F.lit(LEAST).alias("low"), F.lit(-LEAST).alias("high"), F.lit(LEAST).alias("floor"))
    ask = anchors.select("anchor", "label", "v", F.col("same").alias("n"), F.array(every).cast(WINDOW).alias("found"))
    near = fill(rows, ask, positives, True, moments, slice_rows, block_rows)
    near = store(near.select("anchor", F.col("rank").alias("window"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")), "negatives-positives")

    score = F.col("positive_score")
    bound = F.struct(
        "window",
        F.ceil(score * low / F.lit(100)).cast("long").alias("low"),
        F.floor(score * high / F.lit(100)).cast("long").alias("high"),
        F.ceil(score * low / F.lit(100)).cast("long").alias("floor"),
    )
    spans = near.select("anchor", bound.alias("w")).filter("w.low <= w.high").groupBy("anchor")
    spans = spans.agg(F.collect_list("w").cast(WINDOW).alias("found"))  # at most ``positives`` windows
    ask = anchors.join(spans, "anchor").select("anchor", "label", "v", (F.lit(whole) - F.col("same")).alias("n"), "found")
    far = fill(rows, ask, negatives, False, moments, slice_rows, block_rows)
    key_of = lambda c: F.nullif(F.col(c), F.lit(NO_KEY)).alias(c)
    return (
        far.join(near, ["anchor", "window"])
        .join(anchors.select("anchor", "anchor_id"), "anchor")
        .select(
            key_of("anchor_id"),
            key_of("positive_id"),
            "rank",
            F.nullif(F.col("vec_id"), F.lit(NO_KEY)).alias("negative_id"),
            "positive_score",
            F.col("score").alias("negative_score"),
        )
    )
