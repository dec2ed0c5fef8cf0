"""N-gram Jaccard join with Bayesian candidate pruning, and the near-duplicate groups it forms.

Texts are sets of word shingles (five words).  Documents with one shingle set form a *class*; all
further work is on one representative per class, so copies are never expanded into pairs.

1. A sketch of 128 MinHash values per document.
2. Classes that agree on five values of one of 25 bands meet in a bucket.  Buckets with the same
   members are looked at once, in their lowest band.
3. Buckets are cut into blocks of about 256 classes and each pair of blocks is one task.  A task
   compares the MinHash values of its pairs step by step, and drops a pair once the posterior
   probability (uniform prior) that its similarity reaches the threshold is under the tolerance.
   A pair is looked at only in the first band in which it meets.
4. The pairs left are verified on the whole shingle sets.  Pairs stay inside the task's row, as
   packed indices: a group of n near copies makes n * n / 256 rows, not n * n.
5. Each task returns its classes' link counts and one edge per class; the groups are the connected
   components (alternating large and small stars).

A pair of similarity s is missed with probability (1 - s^5)^25 in step 2, 5e-5 at s = 0.8 and 1e-8 at
s = 0.87, and with the tolerance in step 3.  Every link returned is exact.

Words are lower-case runs of letters, digits, marks and ``_``, in any script.  A text of fewer than five words is one shingle; a
text without words (null and empty ones too) has no links and is a group of its own.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mediamart.llm.common import Hashes, marked, mixed, row_key, shingles, store, text_of, words

HASHES, BANDS, ROWS, BLOCK = 128, 25, 5, 256
SETS, PAIRS = 2048, 1 << 18  # of one verifying task, on average
MOST_TASKS = 20_000  # beyond it a task verifies more units, one at a time
_CHUNK = 512


def _permutations() -> tuple[np.ndarray, np.ndarray]:
    numbers = np.random.default_rng(20).integers(0, 2**63, (2, HASHES), dtype=np.uint64)
    return (numbers[0] * np.uint64(2) + np.uint64(1))[:, None], numbers[1][:, None]


def minhash(found: np.ndarray) -> np.ndarray:
    """The smallest of the permuted shingle hashes, for each permutation."""
    times, plus = _PERMUTATIONS
    best = np.full(HASHES, 0xFFFFFFFF, np.uint64)
    for at in range(0, len(found), _CHUNK):
        permuted = times * found[at : at + _CHUNK]
        permuted += plus
        permuted >>= np.uint64(32)
        np.minimum(best, permuted.min(1), out=best)
    return best


_PERMUTATIONS = _permutations()


def least_matches(threshold: float, tolerance: float) -> list[int]:
    """For n compared values: the fewest matches at which the pair is still looked at.

    With a uniform prior, P(J >= t | m of n match) is the upper tail of Beta(m + 1, n - m + 1), which is
    P(Binomial(n + 1, t) <= m).
    """
    out = []
    for n in range(HASHES + 1):
        total, m = 0.0, -1
        while total < tolerance:
            m += 1
            total += math.comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
        out.append(m)
    return out


def sketches(docs: DataFrame, size: int) -> DataFrame:
    """(row_key, doc_id, fp1, fp2, n, sketch): the fingerprint of the shingle set, its size, and the
    MinHash values; null and 0 for texts without words."""

    def sketch(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes = Hashes()
        for df in frames:
            rows = []
            for text in df["text"]:
                found = np.unique(shingles(hashes.of(words(text)), size))
                if len(found):
                    second = mixed(found ^ np.uint64(0x5851F42D4C957F2D))
                    fps = (int(found.sum().astype(np.int64)), int(second.sum().astype(np.int64)))
                    rows.append((*fps, len(found), minhash(found).astype("<u4").tobytes()))
                else:
                    rows.append((0, 0, 0, None))
            out = pd.DataFrame(rows, columns=["fp1", "fp2", "n", "sketch"])
            out.insert(0, "row_key", df["row_key"].to_numpy())
            out.insert(1, "doc_id", df["doc_id"].astype("Int64").to_numpy())
            yield out

    kinds = "row_key string, doc_id long, fp1 long, fp2 long, n int, sketch binary"
    return docs.select("doc_id", text_of().alias("text"), row_key().alias("row_key")).mapInPandas(sketch, kinds)


def candidates(classes: DataFrame, threshold: float, tolerance: float) -> DataFrame:
    """One row per task with pairs left: unit, reps, pairs (two int16 places in ``reps`` each)."""
    bands = classes.select(
        "rep",
        F.posexplode(
            F.transform(
                F.sequence(F.lit(0), F.lit(BANDS - 1)),
                lambda b: F.xxhash64(b, F.substring(F.col("sketch"), b * (4 * ROWS) + 1, F.lit(4 * ROWS))),
            )
        ).alias("band", "key"),
    )
    buckets = (
        bands.groupBy("band", "key")
        .agg(
            F.count("*").alias("size"),
            F.bit_xor(F.xxhash64("rep")).alias("members1"),
            F.bit_xor(F.xxhash64("rep", F.lit(1))).alias("members2"),
        )
        .filter("size > 1")
        .groupBy("size", "members1", "members2")
        .agg(F.min(F.struct("band", "key")).alias("first"))
        .select("first.band", "first.key", F.ceil(F.col("size") / BLOCK).cast("int").alias("blocks"))
    )
    block = F.pmod(F.xxhash64("rep", F.lit(2)), F.col("blocks")).cast("int")
    placed = (
        bands.join(buckets, ["band", "key"])
        .withColumn("block", block)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select(
            "rep",
            "band",
            "key",
            "block",
            F.least("block", "other").alias("low"),
            F.greatest("block", "other").alias("high"),
        )
        .join(classes.select("rep", "n", "sketch"), "rep")
    )
    least = least_matches(threshold, tolerance)

    def compare(key: tuple, df: pd.DataFrame) -> pd.DataFrame:
        band, _, low, high = key
        sketch = np.frombuffer(b"".join(df["sketch"]), "<u4").reshape(-1, HASHES)
        block, n = df["block"].to_numpy(), df["n"].to_numpy(np.int64)
        if low == high:
            i, j = np.triu_indices(len(df), 1)
        else:
            left, right = np.flatnonzero(block == low), np.flatnonzero(block == high)
            i, j = np.repeat(left, len(right)), np.tile(right, len(left))
        fits = np.minimum(n[i], n[j]) >= threshold * np.maximum(n[i], n[j]) - 1e-9
        i, j = i[fits], j[fits]
        for b in range(band):  # met before: that band's task has the pair
            part = slice(b * ROWS, (b + 1) * ROWS)
            new = (sketch[i, part] != sketch[j, part]).any(1)
            i, j = i[new], j[new]
        matches = np.zeros(len(i), np.int64)
        for at in range(0, HASHES, 16):
            matches += (sketch[i, at : at + 16] == sketch[j, at : at + 16]).sum(1)
            likely = matches >= least[at + 16]
            i, j, matches = i[likely], j[likely], matches[likely]
        if not len(i):
            return pd.DataFrame({"reps": [], "pairs": []}, dtype=object)
        used, places = np.unique(np.concatenate([i, j]), return_inverse=True)
        pairs = places.reshape(2, -1).T.astype("<i2").tobytes()
        return pd.DataFrame({"reps": [df["rep"].to_numpy()[used]], "pairs": [pairs]})

    found = placed.groupBy("band", "key", "low", "high").applyInPandas(compare, "reps array<long>, pairs binary")
    return store(found.withColumn("unit", F.monotonically_increasing_id()), "near-candidates")


def verified(docs: DataFrame, classes: DataFrame, found: DataFrame, threshold: float, size: int) -> DataFrame:
    """(rep, root, texts, copies) per task: how many other classes, and documents in them, a class is
    linked to, and the smallest class that its links in this task reach."""

    def sets(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes = Hashes()
        for df in frames:
            held = [np.unique(shingles(hashes.of(words(t)), size)).astype("<u8").tobytes() for t in df["text"]]
            yield pd.DataFrame({"rep": df["rep"], "copies": df["copies"], "shingles": held})

    wanted = store(
        classes.join(found.select(F.explode("reps").alias("rep")).distinct(), "rep").select(
            "rep", "copies", F.col("chosen.row_key").alias("row_key")
        ),
        "near-wanted",
    )
    texts = marked(docs.select(text_of().alias("text"), row_key().alias("row_key")), wanted, "row_key")
    held = store(
        texts.filter("hit")
        .dropDuplicates(["row_key"])  # before the join: a row may repeat any number of times
        .join(wanted, "row_key")
        .select("rep", "copies", "text")
        .mapInPandas(sets, "rep long, copies long, shingles binary"),
        "near-sets",
    )
    work = found.agg(F.sum(F.size("reps")).alias("reps"), F.sum(F.length("pairs")).alias("bytes")).first()
    wished = max(math.ceil((work["reps"] or 0) / SETS), math.ceil((work["bytes"] or 0) / (4 * PAIRS)))
    tasks = min(max(wished, 1), MOST_TASKS)

    def verify(df: pd.DataFrame) -> pd.DataFrame:
        df = df.sort_values("place")
        one = [np.frombuffer(x, "<u8") for x in df["shingles"]]
        ends = np.cumsum([len(x) for x in one])
        _, flat = np.unique(np.concatenate(one), return_inverse=True)
        place = np.split(flat, ends[:-1])
        pairs = np.frombuffer(df["pairs"].dropna().iloc[0], "<i2").reshape(-1, 2).astype(np.int64)
        pairs = pairs[np.argsort(pairs[:, 0], kind="stable")]
        mark = np.zeros(flat.max() + 1, bool)
        rep, copies = df["rep"].to_numpy(), df["copies"].to_numpy(np.int64)
        n = np.array([len(x) for x in one], np.int64)
        texts, others, root = np.zeros(len(df), np.int64), np.zeros(len(df), np.int64), np.arange(len(df))

        def top(x: int) -> int:
            while root[x] != x:
                root[x] = root[root[x]]
                x = root[x]
            return x

        starts = np.flatnonzero(np.r_[True, pairs[1:, 0] != pairs[:-1, 0]])
        for a, b in zip(starts, np.r_[starts[1:], len(pairs)]):
            left, right = pairs[a, 0], pairs[a:b, 1]
            mark[place[left]] = True
            both = np.array([np.count_nonzero(mark[place[r]]) for r in right])
            mark[place[left]] = False
            linked = right[both >= threshold * (n[left] + n[right] - both) - 1e-9]
            texts[left] += len(linked)
            others[left] += copies[linked].sum()
            np.add.at(texts, linked, 1)
            np.add.at(others, linked, copies[left])
            for r in linked:
                x, y = top(left), top(r)
                if rep[x] > rep[y]:
                    x, y = y, x
                root[y] = x
        roots = np.array([rep[top(x)] for x in range(len(df))])
        out = pd.DataFrame({"rep": rep, "root": roots, "texts": texts, "copies": others})
        return out[out["texts"] > 0]

    parts = found.select("unit", "pairs", F.posexplode("reps").alias("place", "rep")).withColumn(
        "pairs", F.when(F.col("place") == 0, F.col("pairs"))
    )
    return store(
        parts.join(held, "rep")
        .repartition(tasks, "unit")  # by the work: its bytes say little, and AQE would merge by them
        .groupBy("unit")
        .applyInPandas(verify, "rep long, root long, texts long, copies long"),
        "near-links",
    )


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node of each node's connected component, for ``edges`` (u, v).

    Alternates large stars (larger neighbours move to the smallest neighbour) and small stars (smaller
    ones do), until every edge leads to a root.
    """
    edges = store(edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = store(both.groupBy("u").agg(F.min("v").alias("low")), "edges-low")  # stored: the join can be split
        large = (
            both.filter("v > u")
            .join(low, "u")
            .select(F.col("v").alias("u"), F.least("u", "low").alias("v"))
            .distinct()
        )
        large = store(large, "edges-large")
        low = store(large.groupBy("u").agg(F.min("v").alias("low")), "edges-low")
        small = (
            large.join(low, "u")
            .select(F.explode(F.array(F.struct("u", F.col("low").alias("v")), F.struct(F.col("v").alias("u"), F.col("low").alias("v")))).alias("e"))
            .select("e.*")
            .filter("u <> v")
            .distinct()
        )
        edges = store(small, "edges")
        # done when no node has two parents and no parent has one
        state = edges.groupBy("u").agg(F.count("*").alias("n"))
        split = state.filter("n > 1").limit(1).count()
        if not split and not edges.join(edges.select(F.col("u").alias("v")).distinct(), "v", "left_semi").limit(1).count():
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))


def group(docs: DataFrame, threshold: float = 0.8, size: int = 5, tolerance: float = 1e-6) -> DataFrame:
    """One row per document: doc_id, row_key, class_id, group_size, n_links, n_texts, kept.

    ``class_id`` is the smallest doc_id of the document's group (null only if all its ids are null),
    ``n_links`` counts the other documents whose similarity to this one reaches the threshold, copies
    among them, and ``n_texts`` those of them with another shingle set, copies once.  One document of
    each group, the one with the largest doc_id, is ``kept``.
    """
    made = store(sketches(docs, size), "near-sketches")
    classes = store(
        made.filter("n > 0")
        .groupBy("fp1", "fp2", "n")
        .agg(
            F.count("*").alias("copies"),
            F.min("doc_id").alias("least_id"),
            F.max(F.struct("doc_id", "row_key")).alias("chosen"),
            F.first("sketch").alias("sketch"),
        )
        .withColumn("rep", F.monotonically_increasing_id()),
        "near-classes",
    )
    found = candidates(classes, threshold, tolerance)
    links = verified(docs, classes, found, threshold, size)
    counts = links.groupBy("rep").agg(F.sum("texts").alias("texts"), F.sum("copies").alias("linked"))
    roots = components(links.select(F.col("rep").alias("u"), F.col("root").alias("v")))
    placed = store(
        classes.drop("sketch")
        .join(counts, "rep", "left")
        .join(roots, F.col("rep") == F.col("node"), "left")
        .select(
            "fp1",
            "fp2",
            "n",
            "copies",
            "least_id",
            "chosen",
            F.coalesce("root", "rep").alias("root"),
            F.coalesce("texts", F.lit(0)).alias("texts"),
            F.coalesce("linked", F.lit(0)).alias("linked"),
        ),
        "near-placed",
    )
    groups = placed.groupBy("root").agg(
        F.min("least_id").alias("class_id"),
        F.sum("copies").alias("group_size"),
        F.max("chosen").alias("winner"),
    )
    of_class = placed.join(groups, "root").select("fp1", "fp2", "n", "class_id", "group_size", "winner", "texts", (F.col("linked") + F.col("copies") - 1).alias("n_links"))
    alone = made.filter("n = 0").select(
        "doc_id",
        "row_key",
        F.col("doc_id").alias("class_id"),
        F.lit(1).cast("long").alias("group_size"),
        F.lit(0).cast("long").alias("n_links"),
        F.lit(0).cast("long").alias("n_texts"),
        F.lit(True).alias("kept"),
    )
    return (
        made.filter("n > 0")
        .select("doc_id", "row_key", "fp1", "fp2", "n")
        .join(of_class, ["fp1", "fp2", "n"])
        .select(
            "doc_id",
            "row_key",
            "class_id",
            "group_size",
            "n_links",
            F.col("texts").alias("n_texts"),
            (F.col("winner.row_key") == F.col("row_key")).alias("kept"),
        )
        .unionByName(alone)
    )
