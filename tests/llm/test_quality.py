import numpy as np
import pytest

from mediamart.llm import quality


@pytest.fixture(scope="module")
def corpus(words):
    rows, labels = [], []
    for k in range(400):
        text = words(80 + k % 50, k)
        good = k % 4 != 0
        if not good:
            text = [w + " |" for w in text] if k % 8 else [w + "%%%" for w in text]
        else:
            text[::12] = [w + ".\n" for w in text[::12]]
        rows.append((k, " ".join(text)))
        labels.append((k, int(good)))
    return rows, labels


def test_held_out_accuracy(spark, documents, corpus):
    rows, labels = corpus
    got = {r.doc_id: r.score for r in quality.score(documents(rows), spark.createDataFrame(labels[:300], "doc_id long, label int")).collect()}
    assert len(got) == 400
    assert np.mean([(got[k] >= 0.3) == bool(y) for k, y in labels[300:]]) >= 0.97


def test_scores_are_log_density_differences():
    rng = np.random.default_rng(1)
    d = len(quality.STATISTICS)
    means, covariances = rng.normal(size=(2, d)), []
    for _ in range(2):
        a = rng.normal(size=(d, d))
        covariances.append(a @ a.T + np.eye(d))
    lowers = [np.linalg.cholesky(c) for c in covariances]
    model = quality.Model(
        means, np.stack([np.linalg.inv(x) for x in lowers]), np.array([-np.log(np.diag(x)).sum() for x in lowers]), (0.0, 1.0)
    )
    x = rng.normal(size=(5, d))
    for row, got in zip(x, model.difference(x)):
        dens = [
            -0.5 * (row - m) @ np.linalg.solve(c, row - m) - 0.5 * np.linalg.slogdet(c)[1] for m, c in zip(means, covariances)
        ]
        assert got == pytest.approx(dens[1] - dens[0])


def test_statistics_read_the_whole_text():
    base = "word " * 5_000
    assert quality.statistics(base) != quality.statistics(base + "%%% " * 50)
    for text in ("", " \n", "a", "|", "é" * 10, "x" * 300_000, "\ud83d"):
        assert len(quality.statistics(text)) == len(quality.STATISTICS)
        assert np.isfinite(quality.statistics(text)).all()


def test_nulls_repeats_and_empty(spark, documents, corpus):
    rows, labels = corpus
    table = spark.createDataFrame(labels + labels[:5] + [(None, 1), (3, None)], "doc_id long, label int")
    odd = rows + [(None, None), (None, "text"), (1000, ""), (1000, "")]
    got = quality.score(documents(odd), table).collect()
    assert len(got) == len(odd) and all(0 <= r.score <= 1 for r in got)
    assert quality.score(documents([]), table).count() == 0


@pytest.mark.parametrize("labels", [[], [(1, 1)], [(1, 0)]])
def test_one_class_or_none(spark, documents, labels):
    table = spark.createDataFrame(labels, "doc_id long, label int")
    got = [r.score for r in quality.score(documents([(1, "a b"), (2, None)]), table).collect()]
    assert len(got) == 2 and all(np.isfinite(got))
    assert all(p > 0.9 if labels == [(1, 1)] else p < 0.1 for p in got)
