import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from mediamart.llm import negatives

SCHEMA = "vec_id long, embedding array<double>, label int, row string, score string, n int"


def brute(rows, positives=5, negatives_=10):
    known = [
        (i, lab, [math.floor(256 * x) for x in v])
        for i, v, lab in rows
        if lab is not None and v and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for a, (i, lab, v) in enumerate(known):
        if i is None or i % 10:
            continue
        scored = [(-sum(x * y for x, y in zip(v, w)), j if j is not None else 1 << 62, other == lab) for b, (j, other, w) in enumerate(known) if b != a]
        scored.sort()
        for p, j, _ in [s for s in scored if s[2]][:positives]:
            found = [(n, m) for n, m, same in scored if not same and 30 * -p <= 100 * -n <= 90 * -p][:negatives_]
            out += [(i, j, k + 1, m, -p, -n) for k, (n, m) in enumerate(found)]
    return sorted(out)


def mined(spark, rows, **how):
    df = spark.createDataFrame([(i, v, lab, "r", "s", 1) for i, v, lab in rows], SCHEMA).repartition(3)
    got = negatives.mine(df, F.col("vec_id") % 10 == 0, F.col("label"), **how).collect()
    return sorted((r.anchor_id, r.positive_id if r.positive_id is not None else 1 << 62, r["rank"], r.negative_id if r.negative_id is not None else 1 << 62, r.positive_score, r.negative_score) for r in got)


def made(n, width=20, seed=1, labels=3, values=None):
    rng = random.Random(seed)
    draw = (lambda: rng.choice(values)) if values else (lambda: rng.gauss(0, 0.3))
    return [(i, [draw() for _ in range(width)], rng.randrange(labels)) for i in range(n)]


@pytest.mark.parametrize("slice_rows", [4096, 60])
def test_like_brute_force(spark, slice_rows):
    rows = made(400)
    assert mined(spark, rows, slice_rows=slice_rows, block_rows=16) == brute(rows)


def test_ties_and_odd_rows(spark):
    rows = made(150, width=6, values=[-0.5, 0.0, 0.5, 1.0])  # many equal scores
    rows += [(1000, None, 1), (1010, [], 1), (1020, [1.0, None] * 3, 1), (1030, [float("nan")] * 6, 1), (1040, rows[0][1], None)]
    rows += [(None, rows[10][1], 0), (None, rows[11][1], 1)]
    assert mined(spark, rows) == brute(rows)


def test_repeated_rows(spark):
    rows = made(60, width=9, labels=2)
    rows += [rows[10], rows[10], rows[11]]
    assert mined(spark, rows) == brute(rows)


def test_windows_that_the_first_threshold_does_not_fill(spark):
    """Scores far from a normal distribution: one cluster per label, few rows in the windows."""
    rng = random.Random(4)
    rows = []
    for i in range(300):
        label = i % 4
        v = [0.01 * rng.gauss(0, 1) for _ in range(16)]
        v[label] += 1.0
        v[(label + 1) % 4] += 0.4 if i % 50 == 0 else 0.0
        rows.append((i, v, label))
    got = mined(spark, rows)
    assert got == brute(rows) and got


def test_few_rows(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(1, [1.0, 2.0], 0)]) == []  # no anchor
    assert mined(spark, [(0, [1.0, 2.0], 0), (1, [1.0, 2.0], 0)]) == []  # one label
    rows = [(0, [1.0, 0.0], 0), (1, [1.0, 0.1], 0), (2, [0.5, 0.0], 1)]
    assert mined(spark, rows) == brute(rows) and len(brute(rows)) == 1


def test_index_loses_no_pair_and_prunes():
    rng = np.random.default_rng(0)
    rows = np.floor(rng.normal(0, 30, (500, 40)) * np.linspace(0.1, 2.0, 40))
    anchors = rows[:20] + 0.0
    full = anchors @ rows.T
    allowed = rng.random(full.shape) < 0.9
    for share in (0.3, 0.999, 1.0):
        thresholds = np.quantile(full, share, axis=1)
        a, r, s = negatives.survivors(anchors, rows, thresholds, allowed)
        want = set(zip(*np.nonzero(allowed & (full >= thresholds[:, None]))))
        assert set(zip(a, r)) == want and (s == full[a, r]).all()
    none = negatives.survivors(anchors, rows, np.full(20, 1e9), allowed)  # all components omitted
    assert len(none[0]) == 0


def test_components_too_large_are_refused(spark):
    with pytest.raises(Exception, match="not supported"):
        mined(spark, [(i, [1e6, 1.0], i % 2) for i in range(20)])
