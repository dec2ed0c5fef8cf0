"""Toxicity: maximal scoring segments over token log-odds, calibrated by extreme values.

1. ``fit`` learns a log-odds weight per word from labelled texts, with a Dirichlet prior that follows
   the word's share of all labelled texts.  Every word whose split between the labels is significant (by the signed
   root of its likelihood ratio, which holds for rare words too) scores its weight, whether it speaks for toxicity or
   against it; every other word scores a small negative drift.
2. ``segments`` finds all maximal scoring segments of a text in linear time (Ruzzo and Tompa).
3. Under the null model of harmless texts the best segment of m words follows an extreme-value law,
   P(S >= x) = 1 - exp(-K m exp(-lambda x)) (Karlin and Altschul).  A segment is significant by its
   expected number under that law, whatever the length of its text.
4. The document's evidence adds up its segments' evidence; a logistic curve, fitted on labelled texts
   that took no part in the weights, turns it into a probability.

Nulls and empty texts have no segments and get the curve's value at no evidence.  Copies of a labelled
text count once, and its near copies mostly so, so groups of copies do not weigh in.  Without both labels nothing can be learned:
every score is then the share of label 1 (0 with no labels).
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mediamart.llm.common import Hashes, shingles, store, text_of, words

#: A word is a run of letters.
LETTERS = re.compile(r"[^\W\d_]+")


@dataclass(frozen=True)
class Model:
    """Everything a task needs to score a text."""

    weights: dict = field(repr=False)
    drift: float = 0.1
    decay: float = 1.0  # lambda
    density: float = 0.1  # K
    curve: tuple = (0.0, 0.0)  # logistic intercept and slope

    def hits(self, text: str) -> tuple[list[tuple[int, int, int, float]], int]:
        """(word number, start, end, weight) of the weighted words, and the number of words."""
        found, n, weights = [], 0, self.weights
        for n, m in enumerate(LETTERS.finditer(text.lower()), 1):
            if (w := weights.get(m.group())) is not None:
                found.append((n - 1, m.start(), m.end(), w))
        return found, n

    def expected(self, score: float, words: int) -> float:
        """Number of segments of this score that a harmless text of so many words has by chance."""
        return self.density * max(words, 1) * math.exp(-self.decay * score)

    def evidence(self, text: str) -> float:
        found, n = self.quick_hits(text)
        return sum(
            max(0.0, -math.log(max(self.expected(s, n), 1e-300))) for *_, s in segments(found, self.drift)
        )

    def quick_hits(self, text: str) -> tuple[list[tuple[int, float]], int]:
        """As ``hits`` without places in the text; most words are looked up and passed over."""
        weights = self.weights
        found = LETTERS.findall(text.lower())
        return [(k, weights[w]) for k, w in enumerate(found) if w in weights], len(found)

    def score(self, text: str) -> float:
        a, b = self.curve
        return 1 / (1 + math.exp(-max(-700.0, min(700.0, a + b * math.log1p(self.evidence(text))))))


def segments(hits: list[tuple], drift: float) -> list[tuple[int, int, float]]:
    """All maximal scoring segments as (first hit, last hit, score), in linear time.

    ``hits`` are (word number, ..., weight); each word between two hits scores ``-drift``.
    """
    stack: list[list] = []  # first hit, last hit, sum before, sum after, place of the last smaller start
    total, at = 0.0, None
    for k, hit in enumerate(hits):
        if at is not None:
            total -= drift * (hit[0] - at - 1)
        at = hit[0]
        if hit[-1] <= 0:
            total += hit[-1]
            continue
        left, right, first = total, total + hit[-1], k
        total = right
        while True:
            j = len(stack) - 1
            while j >= 0 and stack[j][2] >= left:
                j = stack[j][4]
            if j < 0 or stack[j][3] >= right:
                stack.append([first, k, left, right, j])
                break
            first, left = stack[j][0], stack[j][2]
            del stack[j:]
    return [(first, last, right - left) for first, last, left, right, _ in stack]


def _sampled(train: DataFrame, most: int) -> DataFrame:
    """At most about ``most`` labelled rows, chosen by a hash of the id; all when there are no more."""
    n = train.count()
    share = min(1.0, most / max(n, 1))
    return train if share >= 1 else train.filter(F.abs(F.xxhash64("doc_id") % 1_000_003) < int(share * 1_000_003))


def labelled_texts(docs: DataFrame, labels: DataFrame, most: int) -> DataFrame:
    """(text, label) of the labelled rows, each distinct text once; at most about ``most`` rows.

    The sampled ids are broadcast: their number is bounded by ``most``.
    """
    chosen = _sampled(labels.select("doc_id", "label").filter("label IS NOT NULL").dropDuplicates(["doc_id"]), most)
    return (
        docs.select("doc_id", text_of().alias("text"))
        .join(F.broadcast(chosen), "doc_id")
        .groupBy("text")
        .agg(F.max("label").cast("long").alias("label"))
    )


def without_near_copies(texts: DataFrame) -> DataFrame:
    """(text, label): one text of each label and least hash of its runs of five words.

    Texts that share a share s of their runs fall together with probability s.  Else a text of one label and its
    many near copies would make each of its words look significant.
    """

    def least(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes = Hashes()
        for df in frames:
            runs = (shingles(hashes.of(words(t)), 5) for t in df["text"])
            yield df.assign(least=[int(r.min() >> np.uint64(1)) if len(r) else -1 for r in runs])

    return (
        texts.mapInPandas(least, "text string, label long, least long")
        .groupBy("label", "least")
        .agg(F.min("text").alias("text"))
        .select("text", "label")
    )


def word_counts(texts: DataFrame) -> DataFrame:
    """Texts of either label that hold each word: (word, n1, n0)."""
    found = F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(r"(\p{L}+)"), F.lit(1)))
    return (
        texts.select("label", F.explode(found).alias("word"))
        .groupBy("word")
        .agg(F.sum("label").alias("n1"), F.sum(1 - F.col("label")).alias("n0"))
    )


def fit(
    docs: DataFrame,
    labels: DataFrame,
    most_rows: int = 40_000,
    least_z: float = 3.5,
    prior: float = 1.0,
    drift: float = 0.1,
) -> Model:
    """Learn from ``labels`` (doc_id, label 0 or 1).

    ``most_rows`` bounds the labelled rows that are read, and with them the words that can get a weight, which
    are sent to the tasks; ``least_z`` is the significance asked of them.  A fifth of the texts, by hash, is kept
    back for the calibration.
    """
    texts = store(
        without_near_copies(labelled_texts(docs, labels, most_rows)).withColumn("back", F.abs(F.xxhash64("text") % 5) == 0), "toxic-texts"
    )
    counted = {r["label"]: r["n"] for r in texts.filter("NOT back").groupBy("label").agg(F.count("*").alias("n")).collect()}
    n1, n0 = counted.get(1, 0), counted.get(0, 0)
    if not n1 or not n0:
        p = min(max(n1 / max(n1 + n0, 1), 1e-9), 1 - 1e-9)
        return Model({}, drift, curve=(math.log(p / (1 - p)), 0.0))
    # Dirichlet prior: `prior` pseudo-texts spread as the word is over all texts, and half a text
    a = F.lit(0.5) + prior * (F.col("n1") + F.col("n0")) / (n1 + n0)
    odds = F.log((F.col("n1") + a) / (n1 + 1.5 - F.col("n1"))) - F.log((F.col("n0") + a) / (n0 + 1.5 - F.col("n0")))
    # signed root of the likelihood ratio against a word that is as common in texts of either label
    n, rate = F.col("n1") + F.col("n0"), n1 / (n1 + n0)
    part = lambda k, p: F.when(k > 0, k * F.log(k / (n * p))).otherwise(0.0)
    ratio = part(F.col("n1"), rate) + part(F.col("n0"), 1 - rate)
    z = F.signum(F.col("n1") - n * rate) * F.sqrt(2 * F.greatest(ratio, F.lit(0.0)))
    chosen = (
        word_counts(texts.filter("NOT back"))
        .withColumn("odds", odds)
        .withColumn("z", z)
        .filter(F.abs("z") >= least_z)
        .select("word", "odds")
        .collect()
    )
    model = Model({r["word"]: r["odds"] for r in chosen}, drift)
    seen = _summary(texts, model)
    return _calibrated(model, seen)


def _summary(texts: DataFrame, model: Model) -> pd.DataFrame:
    """Segment scores and length of the labelled texts, rounded and counted; no more rows than the
    labelled texts that ``fit`` may read."""

    def best(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for df in frames:
            rows = []
            for text, label, back in zip(df["text"], df["label"], df["back"]):
                found, n = model.quick_hits(text)
                scores = sorted((s for *_, s in segments(found, model.drift)), reverse=True)
                up = sum(w > 0 for _, w in found)
                down = model.drift * (n - len(found)) - sum(w for _, w in found if w <= 0)
                size = round(1.25 ** round(math.log(max(n, 1), 1.25)))
                rows.append((int(label), bool(back), size, n, up, down, [round(4 * s) / 4 for s in scores]))
            yield pd.DataFrame(rows, columns=["label", "back", "size", "n", "up", "down", "scores"])

    kinds = "label int, back boolean, size long, n long, up long, down double, scores array<double>"
    return (
        texts.mapInPandas(best, kinds)
        .groupBy("label", "back", "size", "scores")
        .agg(F.count("*").alias("texts"), F.sum("n").alias("words"), F.sum("up").alias("hits"), F.sum("down").alias("down"))
        .toPandas()
    )


def _calibrated(model: Model, seen: pd.DataFrame) -> Model:
    """Extreme-value law from harmless texts, and the logistic curve from the texts kept back."""
    back = seen[seen["back"]]
    if not (len(back) and (back["label"] == 1).any() and (back["label"] == 0).any()):
        back = seen
    null = back[back["label"] == 0]
    # lambda: the root of sum p(s) exp(lambda s) = 1 over the token scores of harmless texts, with
    # toxic words of the mean score of segments, and the other words of their mean
    n, h = null["words"].sum(), null["hits"].sum()
    fall = float((null["down"].sum() + model.drift) / (n - h + 1))
    flat = np.concatenate([np.asarray(s, float) for s in null["scores"]] + [np.zeros(0)])
    p = (h + 1) / (n + 2)
    mean = float(flat.mean()) if len(flat) else 3.0
    low, high = 1e-4, 20.0
    for _ in range(60):
        mid = (low + high) / 2
        value = p * math.exp(min(mid * mean, 600)) + (1 - p) * math.exp(-mid * fall)
        low, high = (mid, high) if value < 1 else (low, mid)
    decay = max(low, 0.05)
    # K: maximum likelihood given lambda, over the best scores of harmless texts
    best = np.array([s[0] if len(s) else 0.0 for s in null["scores"]])
    weight = null["texts"].to_numpy(float)
    density = float(weight.sum() / max((weight * null["size"] * np.exp(-decay * best)).sum(), 1e-9))
    model = Model(model.weights, model.drift, decay, density)

    x = np.array(
        [
            math.log1p(sum(max(0.0, -math.log(max(model.expected(s, m), 1e-300))) for s in scores))
            for scores, m in zip(back["scores"], back["size"])
        ]
    )
    return Model(model.weights, model.drift, decay, density, logistic(x, back["label"].to_numpy(float), back["texts"].to_numpy(float)))


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 0.1) -> tuple[float, float]:
    """Intercept and slope by Newton's method; the ridge keeps a parted sample finite."""
    beta, design = np.zeros(2), np.stack([np.ones_like(x), x], 1)
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        slope = design.T @ (weight * (y - p)) - ridge * beta
        curve = (design * (weight * p * (1 - p))[:, None]).T @ design + ridge * np.eye(2)
        step = np.linalg.solve(curve, slope)
        beta = beta + step * min(1.0, 2.0 / max(np.abs(step).max(), 1e-12))
        if np.abs(step).max() < 1e-8:
            break
    return float(beta[0]), float(beta[1])


def scored(model: Model, text: Column | None = None) -> Column:
    """Probability that the text is toxic, as a column; a pure function of the text."""

    def of(texts: pd.Series) -> pd.Series:
        return texts.map(model.score).astype("float64")

    return F.pandas_udf(of, "double")(text_of() if text is None else text)


def passages(docs: DataFrame, model: Model, most_expected: float = 0.01) -> DataFrame:
    """Every significant toxic passage: doc_id, start, end (code points), score, expected.

    Significant: fewer than ``most_expected`` such segments are expected in a harmless text of
    that length.
    """

    def find(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for df in frames:
            rows = []
            for doc_id, text in zip(df["doc_id"], df["text"]):
                hits, n = model.hits(text)
                for first, last, s in segments(hits, model.drift):
                    if (e := model.expected(s, n)) < most_expected:
                        rows.append((doc_id, hits[first][1], hits[last][2], s, e))
            out = pd.DataFrame(rows, columns=["doc_id", "start", "end", "score", "expected"])
            out["doc_id"] = out["doc_id"].astype("Int64")
            yield out

    return docs.select("doc_id", text_of().alias("text")).mapInPandas(
        find, "doc_id long, start long, end long, score double, expected double"
    )
