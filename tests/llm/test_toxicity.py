import itertools
import math
import random

from mediamart.llm import toxicity


def brute_segments(scores):
    """Maximal scoring segments by definition: split at the best one, again and again."""

    def best(lo, hi):
        top = None
        for a in range(lo, hi):
            total = 0
            for b in range(a, hi):
                total += scores[b]
                if total > 0 and (top is None or total > top[0] + 1e-12):
                    top = (total, a, b)
        if top is None:
            return []
        return best(lo, top[1]) + [top] + best(top[2] + 1, hi)

    return best(0, len(scores))


def test_segments_against_brute_force():
    rng = random.Random(3)
    for _ in range(300):
        n = rng.randint(0, 30)
        scores = [rng.choice([2.5, 1.25, 0.71]) if rng.random() < 0.3 else -0.37 for _ in range(n)]
        hits = [(k, s) for k, s in enumerate(scores) if s > 0]
        got = [(hits[a][0], hits[b][0], round(s, 9)) for a, b, s in toxicity.segments(hits, 0.37)]
        assert got == [(a, b, round(s, 9)) for s, a, b in brute_segments(scores)]


def corpus(words, n=400):
    bad = ["zzbad", "zzugly", "zzvile"]
    rows, labels = [], []
    for k in range(n):
        text = words(60, k)
        toxic = k % 5 == 0
        if toxic:
            for at in (5, 9, 30):
                text[at] = bad[(k + at) % 3]
        rows.append((k, " ".join(text)))
        labels.append((k, int(toxic)))
    return rows, labels


def test_learns_and_finds_passages(spark, documents, words):
    rows, labels = corpus(words)
    docs = documents(rows)
    model = toxicity.fit(docs, spark.createDataFrame(labels[:300], "doc_id long, label int"))
    got = {r.doc_id: r.p for r in docs.select("doc_id", toxicity.scored(model).alias("p")).collect()}
    for k, toxic in labels[300:]:
        assert (got[k] >= 0.7) == bool(toxic)
    found = toxicity.passages(documents(rows[300:]), model).collect()
    assert {r.doc_id for r in found} == {k for k, t in labels[300:] if t}
    text = dict(rows)
    assert all("zz" in text[r.doc_id][r.start : r.end] for r in found)
    # one more passage makes the score no lower
    assert model.score("zzbad") <= model.score("zzbad zzugly zzvile")


def test_bounded_and_odd_texts(spark, documents, words):
    rows, labels = corpus(words)
    model = toxicity.fit(documents(rows), spark.createDataFrame(labels, "doc_id long, label int"))
    odd = documents([(None, None), (1, ""), (1, ""), (2, " \n"), (3, "zzbad " * 200_000), (4, "퟿\U0001f600")])
    got = [r.p for r in odd.select("doc_id", toxicity.scored(model).alias("p")).collect()]
    assert len(got) == 6 and all(0 <= p <= 1 for p in got)
    assert toxicity.passages(documents([]), model).count() == 0


def test_without_labels(spark, documents):
    docs = documents([(1, "a b"), (2, None)])
    for labels, low, high in (([], 0, 0.01), ([(1, 1)], 0.9, 1), ([(1, 0)], 0, 0.01), ([(1, None)], 0, 0.01)):
        model = toxicity.fit(docs, spark.createDataFrame(labels, "doc_id long, label int"))
        assert all(low <= model.score(t) <= high for t in ("", "a b"))


def test_expected_number_falls_with_score_and_grows_with_length():
    model = toxicity.Model({}, decay=1.5, density=0.2)
    for s, n in itertools.product((1.0, 4.0), (10, 1000)):
        assert math.isclose(model.expected(s, n), 0.2 * n * math.exp(-1.5 * s))


def test_segments_with_words_that_speak_against():
    rng = random.Random(4)
    for _ in range(300):
        n = rng.randint(0, 30)
        scores = [rng.uniform(-2.1, 2.5) if rng.random() < 0.5 else -0.37 for _ in range(n)]
        hits = [(k, s) for k, s in enumerate(scores) if s != -0.37]
        got = [(hits[a][0], hits[b][0], round(s, 9)) for a, b, s in toxicity.segments(hits, 0.37)]
        assert got == [(a, b, round(s, 9)) for s, a, b in brute_segments(scores)]


def test_weights_against_brute_force(spark, documents):
    rng = random.Random(6)
    rows, labels = [], []
    for k in range(900):
        toxic = k % 6 == 0
        text = [f"w{rng.choice('abcdefghij')}{rng.choice('abcdefghij')}" for _ in range(30)]
        text += [w for w, p in (("foul", 0.3), ("vile", 0.05), ("grim", 0.2)) if toxic and rng.random() < p]
        text += [w for w, p in (("mild", 0.7), ("grim", 0.1)) if not toxic and rng.random() < p]
        rows.append((k, " ".join(text)))
        labels.append((k, int(toxic)))
    docs = documents(rows)
    model = toxicity.fit(docs, spark.createDataFrame(labels, "doc_id long, label int"))
    assert toxicity.without_near_copies(docs.selectExpr("text", "0L AS label")).count() == 900
    keys = {r.doc_id: r.back for r in docs.selectExpr("doc_id", "abs(xxhash64(text) % 5) = 0 AS back").collect()}
    held = [(set(t.split()), y) for (k, t), (_, y) in zip(rows, labels) if not keys[k]]
    n1, n0 = sum(y for _, y in held), sum(1 - y for _, y in held)
    want = {}
    for word in set().union(*(w for w, _ in held)):
        k1, k0 = (sum(1 for w, y in held if word in w and y == label) for label in (1, 0))
        n, p = k1 + k0, n1 / (n1 + n0)
        g = sum(k * math.log(k / (n * q)) for k, q in ((k1, p), (k0, 1 - p)) if k)
        if math.sqrt(2 * max(g, 0)) >= 3.5:
            a = 0.5 + n / (n1 + n0)
            want[word] = math.log((k1 + a) / (n1 + 1.5 - k1)) - math.log((k0 + a) / (n0 + 1.5 - k0))
    # words of letters alone; the made-up words are letters too
    assert set(model.weights) == set(want) and want["foul"] > 0 > want["mild"]
    assert all(math.isclose(model.weights[w], want[w], rel_tol=1e-9) for w in want)


def test_near_copies_of_a_label_count_once(spark, words):
    text = words(200, 1)
    copies = [" ".join(text[:k] + ["new"] + text[k:]) for k in range(60)]
    rows = [(t, 1) for t in copies] + [(copies[0], 0), ("", 1), ("one two", 1)]
    got = toxicity.without_near_copies(spark.createDataFrame(rows, "text string, label long")).collect()
    near = [t for t, label in got if label == 1 and len(t) > 10]
    assert 1 <= len(near) <= 20 and set(near) <= set(copies)
    assert {(copies[0], 0), ("", 1), ("one two", 1)} <= set(map(tuple, got))
