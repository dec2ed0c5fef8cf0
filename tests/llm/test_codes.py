import hashlib
import math
import random

import numpy as np
import pytest

from mediamart.llm import codes

SCHEMA = "vec_id long, embedding array<float>, label int, code string, part int"


def brute(rows, parts, entries, rounds):
    """Codes by comparing every part with every entry, in plain Python."""
    kept = [(i, [math.floor(x * 4096) for x in v], lab) for i, v, lab in rows if v and all(x is not None and math.isfinite(x) for x in v)]
    if not kept:
        return [], []
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    width = len(kept[0][1]) // parts
    cut = lambda v, p: v[p * width : (p + 1) * width]
    books = [[cut(v, p) for _, v, _ in kept[:entries]] for p in range(parts)]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    near = lambda v, p: min((far(cut(v, p), e), k) for k, e in enumerate(books[p]))
    for _ in range(rounds):
        found = {}
        for _, v, _ in kept:
            for p in range(parts):
                found.setdefault((p, near(v, p)[1]), []).append(cut(v, p))
        for (p, k), members in found.items():
            books[p][k] = [sum(x) // len(members) for x in zip(*members)]
    out = []
    for i, v, lab in kept:
        best = [near(v, p) for p in range(parts)]
        out.append((i, "".join(f"{k:02x}" for _, k in best), sum(d for d, _ in best), lab))
    return out, [x for book in books for e in book for x in e]


def made(n, seed=3, spread=1.0):
    rng = random.Random(seed)
    return [(i, [rng.gauss(0, spread) for _ in range(16)], rng.choice([0, 1, None])) for i in range(n)]


def frame(spark, rows):
    return spark.createDataFrame([(i, v, lab, "c", 7) for i, v, lab in rows], SCHEMA).repartition(3)


@pytest.mark.parametrize("shift", [6, 10, 13])
def test_like_brute_force(spark, shift):
    rows = [(i, [float(np.float32(x)) for x in v], lab) for i, v, lab in made(300)]
    rows += [(300 + i, rows[i % 5][1], 1) for i in range(40)]  # repeated vectors
    rows += [(3, rows[3][1], 0), (None, rows[9][1], None)]  # repeated and missing keys
    rows += [(900, None, 1), (901, [], 1), (902, [float("nan")] * 16, 1), (903, [1.0, None] * 8, 1), (904, [float("inf")] * 16, 1)]
    got, books = codes.compress(frame(spark, rows), parts=4, entries=16, rounds=3, shift=shift)
    want, flat = brute(rows, 4, 16, 3)
    assert got.columns == ["vec_id", "label", "part", "code", "error"]
    assert sorted((r.vec_id or -1, r.code, r.error) for r in got.collect()) == sorted((i or -1, c, e) for i, c, e, _ in want)
    assert books.reshape(-1).tolist() == flat
    assert codes.digest(books) == hashlib.sha256(",".join(map(str, flat)).encode()).hexdigest()
    sums = {}
    for _, _, e, lab in want:
        sums[lab] = sums.get(lab, 0) + e
    assert {r.label: r.label_error for r in codes.group_errors(got, "label").collect()} == sums


def test_few_rows_and_none(spark):
    got, books = codes.compress(frame(spark, []))
    assert got.count() == 0 and books.size == 0 and codes.group_errors(got, "label").count() == 0
    got, books = codes.compress(frame(spark, made(3)), parts=2)
    assert books.shape == (2, 3, 8) and {r.error for r in got.collect()} == {0}


def test_other_lengths_are_dropped_and_odd_ones_refused(spark):
    rows = [*made(20), (50, [1.0] * 8, 0)]
    assert codes.compress(frame(spark, rows), parts=4)[0].count() == 20
    with pytest.raises(ValueError, match="equal parts"):
        codes.compress(frame(spark, rows), parts=5)


def test_kept_entries_hold_the_nearest():
    rng = np.random.default_rng(1)
    entries = rng.integers(-2000, 2000, (16, 4))
    vectors = rng.integers(-3000, 3000, (5000, 4))
    for shift in (3, 8, 11):
        cells = codes.Cells(entries, shift, most=700)  # forgets now and then
        found = [cells.nearest(part) for part in np.array_split(vectors, 9)]
        index, error = (np.concatenate(x) for x in zip(*found))
        full = ((vectors[:, None] - entries) ** 2).sum(2)
        assert (index == full.argmin(1)).all() and (error == full.min(1)).all()
        assert len(cells.keys) <= 700 or shift == 3
        assert codes.Cells(entries, shift).candidates(vectors).mean() < (0.2 if shift == 3 else 1.01)


def test_two_cells_of_one_hash(monkeypatch):
    monkeypatch.setattr(codes.Cells, "key", staticmethod(lambda cells: np.zeros(len(cells), np.uint64)))
    entries = np.array([[0, 0], [5000, 5000]])
    index, _ = codes.Cells(entries, 4).nearest(np.array([[1, 1], [4999, 4999], [2, 0]]))
    assert index.tolist() == [0, 1, 0]


def test_pruning_pays_on_crowded_cells():
    """Vectors close to few centres share cells; each cell keeps few entries."""
    rng = np.random.default_rng(2)
    entries = rng.integers(-20_000, 20_000, (16, 8))
    vectors = entries[rng.integers(0, 16, 4000)] + rng.integers(-300, 300, (4000, 8))
    cells = codes.Cells(entries, 10)
    assert cells.candidates(vectors).sum(1).mean() < 2
