"""Quality: a regularised quadratic discriminant over transformed document statistics.

Each class is a normal law over the statistics.  Its covariance is shrunk towards the pooled one and
that towards its diagonal (a share that falls as the class has more texts).  A text's log-density
under a class is a Mahalanobis distance through the class's Cholesky factor, which is inverted once, when the
model is made.  The log-density difference goes through a logistic curve, fitted on labelled texts
that took no part in the covariances, so that scores are probabilities.

Fitting adds up sums and products of the statistics (a fixed number of them) over the labelled texts,
each distinct text once; only those sums come to the driver.  Null texts count as empty; empty texts
have all statistics 0 and get the score these have.  With one class only, or none, every score is the
share of label 1 (0 with no labels).
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mediamart.llm.common import store, text_of
from mediamart.llm.toxicity import logistic

STATISTICS = [
    "words", "word_length", "word_spread", "distinct", "top_word", "top_three", "repeated_next", "letters", "digits",
    "symbols", "capitals", "spaces", "stops", "commas", "bars", "odd_ends", "plain_words", "lines", "line_words",
    "line_spread", "repeated_lines", "short_lines", "entropy", "compressed", "longest_word", "stop_words", "lone_marks",
]
_LETTER = re.compile(r"[^\W\d_]+")


def _share(part: float, whole: float) -> float:
    """Logit of a share, kept finite."""
    p = (part + 0.5) / (whole + 1)
    return math.log(p / (1 - p)) if p < 1 else math.log((part + 0.5) / 0.5)


def statistics(text: str) -> list[float]:
    """Transformed statistics of the whole text: logs of amounts, logits of shares."""
    words = text.split()
    n, size = len(words), len(text)
    if not n:
        return [0.0] * len(STATISTICS)
    lengths = np.fromiter(map(len, words), np.int64, n)
    counts = Counter(words)
    top = [c for _, c in counts.most_common(3)]
    letters, capitals = 0, 0
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    by = np.bincount(raw, minlength=256)
    letters = int(by[65:91].sum() + by[97:123].sum() + by[192:].sum())
    capitals, digits = int(by[65:91].sum()), int(by[48:58].sum())
    spaces = int(by[32] + by[10] + by[9] + by[13])
    marks = max(0, size - letters - digits - spaces)
    lines = [x for x in text.split("\n") if x.strip()]
    held = np.array([len(x) for x in lines] or [0], float)
    p = by[by > 0] / len(raw)
    stop_count = int(by[46] + by[33] + by[63])
    odd = sum(c for w, c in counts.items() if not w[-1].isalnum() and w[-1] not in ".,;:!?\"')")
    plain = sum(c for w, c in counts.items() if w.isalpha())
    lone = sum(c for w, c in counts.items() if not any(map(str.isalnum, w)))
    short = sum(c for w, c in counts.items() if len(w) <= 3)
    repeated = sum(a == b for a, b in zip(words, words[1:]))
    return [
        math.log1p(n),
        math.log(lengths.mean()),
        math.log1p(lengths.std()),
        _share(len(counts), n),
        _share(top[0], n),
        _share(sum(top), n),
        _share(repeated, n),
        _share(letters, size),
        _share(digits, size),
        _share(marks, size),
        _share(capitals, size),
        _share(spaces, size),
        _share(min(stop_count, n), n),
        _share(min(int(by[44]), n), n),
        _share(min(int(by[124]), n), n),
        _share(odd, n),
        _share(plain, n),
        math.log1p(len(lines)),
        math.log1p(n / max(len(lines), 1)),
        math.log1p(held.std()),
        _share(len(lines) - len(set(lines)), len(lines)),
        _share(int((held < 30).sum()), len(lines)),
        float(-(p * np.log2(p)).sum()),
        math.log(len(zlib.compress(raw.tobytes(), 1)) / len(raw)),
        math.log(lengths.max()),
        _share(short, n),
        _share(lone, n),
    ]


@dataclass(frozen=True)
class Model:
    """Class means, inverted Cholesky factors and constants; index 0 and 1 by label."""

    means: np.ndarray
    factors: np.ndarray
    constants: np.ndarray
    curve: tuple

    def difference(self, x: np.ndarray) -> np.ndarray:
        """Log-density of class 1 less that of class 0, for rows of statistics."""
        out = []
        for mean, factor, constant in zip(self.means, self.factors, self.constants):
            z = (x - mean) @ factor.T
            out.append(constant - 0.5 * (z * z).sum(1))
        return out[1] - out[0]

    def score(self, x: np.ndarray) -> np.ndarray:
        a, b = self.curve
        d = self.difference(x) if len(self.means) else np.zeros(len(x))
        return 1 / (1 + np.exp(-np.clip(a + b * squashed(d), -700, 700)))


def squashed(d: np.ndarray) -> np.ndarray:
    """Signed log: far-off texts have differences in the thousands."""
    return np.sign(d) * np.log1p(np.abs(d))


def measured(texts: DataFrame, *kept: str) -> DataFrame:
    """``kept`` columns (all long) and ``x``, the statistics of the whole ``text``."""

    def measure(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for df in frames:
            out = pd.DataFrame({c: df[c].astype("Int64") for c in kept})
            out["x"] = [statistics(t) for t in df["text"]]
            yield out

    kinds = "".join(f"{c} long, " for c in kept) + "x array<double>"
    return texts.select(*kept, "text").mapInPandas(measure, kinds)


def _moments(made: DataFrame) -> dict[int, tuple[int, np.ndarray, np.ndarray]]:
    """By label: number, sums and products of the statistics; one small row per task."""

    def add(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[int, list] = {}
        for df in frames:
            for label, part in df.groupby("label"):
                x = np.stack(part["x"].to_numpy())
                one = sums.setdefault(int(label), [0, 0.0, 0.0])
                one[0] += len(x)
                one[1] = one[1] + x.sum(0)
                one[2] = one[2] + x.T @ x
        rows = [(k, n, np.concatenate([s, p.ravel()]).tolist()) for k, (n, s, p) in sums.items()]
        yield pd.DataFrame(rows, columns=["label", "n", "sums"])

    parts = made.select("label", "x").mapInPandas(add, "label long, n long, sums array<double>")
    rows = (
        parts.select("label", "n", F.posexplode("sums").alias("place", "value"))
        .groupBy("label", "place")
        .agg(F.sum("value").alias("value"), F.sum("n").alias("n"))
        .collect()
    )
    d, out = len(STATISTICS), {}
    for label in {r["label"] for r in rows}:
        own = sorted((r["place"], r["value"], r["n"]) for r in rows if r["label"] == label)
        flat = np.array([v for _, v, _ in own])
        out[label] = (own[0][2], flat[:d], flat[d:].reshape(d, d))
    return out


def fit(made: DataFrame, pooled: float = 0.2, ridge: float = 1e-3) -> Model:
    """Learn from (label, back, x): rows with ``back`` calibrate, the others give the class laws.

    ``pooled`` is the share of the pooled covariance in each class's own, at least; a class of n texts
    takes d / (d + n) of it when that is more.
    """
    found = _moments(made.filter("back = 0"))
    if set(found) != {0, 1}:
        n1, n0 = (found.get(k, (0,))[0] for k in (1, 0))
        p = min(max(n1 / max(n1 + n0, 1), 1e-9), 1 - 1e-9)
        return Model(np.zeros((0, 0)), np.zeros((0, 0, 0)), np.zeros(0), (math.log(p / (1 - p)), 0.0))
    d, total = len(STATISTICS), found[0][0] + found[1][0]
    means = np.stack([found[k][1] / found[k][0] for k in (0, 1)])
    own = [found[k][2] / found[k][0] - np.outer(means[k], means[k]) for k in (0, 1)]
    common = sum(found[k][0] * own[k] for k in (0, 1)) / total
    factors, constants = [], []
    for k in (0, 1):
        share = max(pooled, d / (d + found[k][0]))
        flat = d / (d + found[k][0])
        covariance = (1 - share) * own[k] + share * common
        covariance = (1 - flat) * covariance + flat * np.diag(np.diag(covariance))
        covariance += ridge * (np.trace(common) / d + 1e-6) * np.eye(d)
        lower = np.linalg.cholesky(covariance)
        factors.append(np.linalg.inv(lower))
        constants.append(math.log(found[k][0] / total) - np.log(np.diag(lower)).sum())
    model = Model(means, np.stack(factors), np.array(constants), (0.0, 1.0))
    return Model(model.means, model.factors, model.constants, _curve(made, model))


def _curve(made: DataFrame, model: Model) -> tuple[float, float]:
    """Logistic curve over a histogram of the differences (steps of 0.05, so a bounded table)."""

    def differ(x: pd.Series) -> pd.Series:
        return pd.Series(np.round(squashed(model.difference(np.stack(x.to_numpy()))) * 20) / 20)

    seen = (
        made.select("label", "back", F.pandas_udf(differ, "double")("x").alias("d"))
        .groupBy("label", "back", "d")
        .agg(F.count("*").alias("n"))
        .toPandas()
    )
    back = seen[seen["back"] == 1]
    seen = back if set(back["label"]) == {0, 1} else seen
    return logistic(seen["d"].to_numpy(float), seen["label"].to_numpy(float), seen["n"].to_numpy(float))


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, score) of every row of ``docs``, learned from ``labels`` (doc_id, label 0 or 1).

    Texts are read once: their statistics are stored, and labels meet the statistics only.
    """
    key = F.xxhash64("text", F.length("text"))
    texts = docs.select("doc_id", text_of().alias("text")).select("doc_id", key.alias("key"), "text")
    made = store(measured(texts, "doc_id", "key"), "quality-measured")
    once = labels.select("doc_id", F.col("label").cast("long").alias("label")).filter("label IS NOT NULL")
    learned = (
        made.join(once.dropDuplicates(["doc_id"]), "doc_id")
        .groupBy("key")  # each distinct text once; a quarter, by hash, is kept back
        .agg(F.max("label").alias("label"), F.first("x").alias("x"))
        .select("label", F.when(F.pmod("key", F.lit(4)) == 0, 1).otherwise(0).alias("back"), "x")
    )
    model = fit(store(learned, "quality-learned"))

    def of(x: pd.Series) -> pd.Series:
        return pd.Series(model.score(np.stack(x.to_numpy())) if len(x) else [], dtype="float64")

    return made.select("doc_id", F.pandas_udf(of, "double")("x").alias("score"))
