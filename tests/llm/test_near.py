import math
from itertools import combinations

import pytest

from mediamart.llm import near
from mediamart.llm.common import keep_rows, words as split


def shingled(text):
    w = split(text or "")
    n = min(5, len(w))
    return frozenset(tuple(w[k : k + n]) for k in range(len(w) - n + 1)) if w else frozenset()


def brute(rows):
    sets = [shingled(t) for _, t in rows]
    root, links = list(range(len(rows))), [0] * len(rows)
    for a, b in combinations(range(len(rows)), 2):
        if sets[a] and sets[b] and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]) - 1e-9:
            links[a] += 1
            links[b] += 1
            old, new = root[b], root[a]
            root = [new if r == old else r for r in root]
    least = {r: min(i for i, q in zip([i for i, _ in rows], root) if q == r) for r in set(root)}
    return sorted((rows[k][0], least[root[k]], links[k]) for k in range(len(rows)))


@pytest.fixture(scope="module")
def rows(words):
    rows, n = [], 0
    for family in range(6):
        base = words(150, family)
        for copy in range(25):
            text = list(base)
            for k in range(copy % 6):
                text[(13 * k + 7 * copy) % 150] = words(1, 1000 * family + 10 * copy + k)[0]
            rows.append((n, " ".join(text) + "!" * (copy % 2)))
            n += 1
    for k in range(60):
        rows.append((n, " ".join(words(40, 7_000 + k))))
        n += 1
    extra = ["", None, "...", "one two", "One, two!", "one two three", " ".join(words(20_000, 3)), " ".join(words(20_000, 3) + ["x"])]
    return rows + [(n + k, t) for k, t in enumerate(extra)]


def test_against_all_pairs(documents, rows, monkeypatch):
    monkeypatch.setattr(near, "BLOCK", 16)
    got = near.group(documents(rows)).collect()
    assert sorted((r.doc_id, r.class_id, r.n_links) for r in got) == brute(rows)
    assert sum(r.kept for r in got) == len({r.class_id for r in got})
    assert all(r.n_texts <= r.n_links for r in got)


def test_nulls_and_repeats(documents, words):
    text = " ".join(words(30, 1))
    docs = documents([(None, text), (None, text + " more"), (3, text), (3, text), (None, None), (None, "")])
    got = near.group(docs).collect()
    assert len(got) == 6
    assert {r.class_id for r in got if r.n_links} == {3}
    assert keep_rows(docs, near.group(docs)).count() == 2


def test_empty(documents):
    assert near.group(documents([])).count() == 0


def test_least_matches_follows_the_posterior():
    table = near.least_matches(0.8, 1e-6)
    for n in (16, 64, 128):
        m = table[n]
        # posterior by integrating the density, uniform prior
        step = 1e-4
        xs = [step * (k + 0.5) for k in range(10_000)]
        dens = [math.exp(m * math.log(x) + (n - m) * math.log(1 - x)) for x in xs]
        above = sum(d for x, d in zip(xs, dens) if x >= 0.8) / sum(dens)
        assert above >= 0.9e-6
        if m:
            dens = [math.exp((m - 1) * math.log(x) + (n - m + 1) * math.log(1 - x)) for x in xs]
            assert sum(d for x, d in zip(xs, dens) if x >= 0.8) / sum(dens) < 1.1e-6


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(k, k + 1) for k in range(40)] + [(100, 101)], "u long, v long")
    got = {r.node: r.root for r in near.components(edges).collect()}
    assert got == {k: 0 for k in range(1, 41)} | {101: 100}


def test_words_beyond_ascii():
    assert [w.decode() for w in split("Don\u2019t\u00a0say \u201cÉté\u201d\u2014now\u3000日本。東京、x_1 हिन्दी\u2026 e\u0301a ½")] == [
        "don", "t", "say", "été", "now", "日本", "東京", "x_1", "हिन्दी", "e\u0301a", "½",
    ]


def test_typography_makes_no_difference(documents, words):
    plain = " ".join(words(40, 1))
    copies = [plain, plain.replace(" ", "\u00a0"), plain.replace(" ", "\u3000"), plain.replace(" ", "\u201d \u2014 ")]
    got = near.group(documents(list(enumerate(copies)))).collect()
    assert {r.class_id for r in got} == {0} and sum(r.kept for r in got) == 1
