import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from mediamart.llm import pii


def luhn(digits):
    total = 0
    for k, c in enumerate(reversed(digits)):
        n = int(c) * (1 + k % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def digits(value):
    return re.sub("[^0-9]", "", value)


RULES = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda v: True),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda v: all(int(p) <= 255 for p in v.split("."))),
    ("card", r"[0-9]([\x20-]?[0-9])+", lambda v: 16 <= len(digits(v)) <= 19 and luhn(digits(v))),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda v: 8 <= len(digits(v)) <= 15),
]


def expected(text):
    return ",".join(
        f"{kind}:{m.start()}:{m.end()}" for kind, rule, ok in RULES for m in re.finditer(rule, text or "") if ok(m.group())
    )


TEXTS = [
    "", None, "a@b.c", "a@b.c%x@y.z", "a@@b.c d@e f@g.", ".%+@a-b.c-d.e..f", "é a.b@c.d 😀 x@y.zz", "1.2.3.4.5.6.7.8", "256.1.1.1 0255.1.1.1",
    "1.2.3 4.5.6.7", "4111 1111 1111 1111", "4111-1111-1111-1111 4111111111111112", "1 2  3 4", "4111 1111 1111 1111 0",
    "+1 (377) 555-0271", "+1 (377) 555-0271 and +44 20.7946-0958.", "+1234567 +12345678", "+1+22222222", "+4 " + "1" * 30,
    "9" * 20_000, "a" * 20_000, "a." * 5_000 + "@x.y", "x@" + "y." * 5_000 + "z", "+1 " + " " * 5_000 + "2", "1." * 5_000,
    "00000000000000000000 0.0.0.0 00000.1.2.3",
]


def test_base_spans_against_the_rules(spark):
    rows = spark.createDataFrame(list(enumerate(TEXTS)), "k int, text string")
    text = F.coalesce("text", F.lit(""))
    got = {r.k: r.s for r in rows.select("k", pii.written(pii.base_spans(text)).alias("s")).collect()}
    for k, t in enumerate(TEXTS):
        assert got[k] == expected(t), t


@given(st.lists(st.text(alphabet="a1.@+- ()é%", max_size=40), min_size=20, max_size=60))
@settings(max_examples=8, deadline=None)
def test_base_spans_on_any_text(spark, texts):
    rows = spark.createDataFrame(list(enumerate(texts)), "k int, text string")
    got = {r.k: r.s for r in rows.select("k", pii.written(pii.base_spans(F.col("text"))).alias("s")).collect()}
    assert [got[k] for k in range(len(texts))] == [expected(t) for t in texts]


@pytest.fixture(scope="module")
def corpus(words):
    rows = []
    for k in range(60):
        rows.append((k, "the " + " ".join(words(40, k))))
    for k in range(5):  # one person, one telling term, common words around
        rows.append((100 + k, " ".join(words(12, 200 + k)) + " quartzling person@mail.org the the " + " ".join(words(12, 300 + k))))
    rows += [(200, "quartzling alone"), (201, "Quartzling: person@mail.org"), (None, None), (202, "")]
    return rows


def test_terms(documents, corpus):
    found = pii.find(documents(corpus), support=3, generalise=0.8, remove=0.999)
    got = {r.doc_id: r for r in found.collect()}
    assert len(got) == len(corpus)
    # brute force: share of information of the pair
    import math

    total = len(corpus)
    pair = entity = 6
    term = 7
    share = math.log(pair * total / (term * entity)) / -math.log(entity / total)
    assert 0.8 < share < 0.999
    for k in (100, 101, 201):
        text = dict(corpus)[k]
        assert [text[s.start : s.end].lower() for s in got[k].terms] == ["quartzling"]
        assert [s.kind for s in got[k].base] == ["email"] and got[k].removed == []
    assert got[200].terms == [] and got[200].text is None
    clean = {r.doc_id: r.text for r in pii.sanitised(found).collect()}
    assert clean[201] == "[TERM]: [EMAIL]"
    gone = pii.find(documents(corpus), support=3, generalise=0.5, remove=0.6)
    assert {r.doc_id: r.text for r in pii.sanitised(gone).collect()}[201] == ": [EMAIL]"


def test_terms_of_values_that_never_repeat(documents, words):
    plain = [(k, " ".join(words(40, k))) for k in range(400)]
    cards = ["4111 1111 1111 1111", "4111-1111-1111-1111", "4111111111111111"]
    rows = plain + [(1000 + k, f"{' '.join(words(5, 500 + k))} quartzling user{k}@host{k}.org") for k in range(6)]
    rows += [(2000 + k, f"velvetine u{k}@same.org {' '.join(words(5, 600 + k))}") for k in range(4)]
    rows += [(3000 + k, f"{' '.join(words(5, 700 + k))} bramblet {card}") for k, card in enumerate(cards)]
    got = {r.doc_id: [r.text[s.start : s.end] for s in r.terms] for r in pii.find(documents(rows)).collect() if r.text}
    for k in range(6):  # the kind gathers them
        assert "quartzling" in got[1000 + k]
    for k in range(4):  # the domain does
        assert "velvetine" in got[2000 + k]
    for k in range(3):  # one card, three ways to write it
        assert "bramblet" in got[3000 + k]


def test_chance_pairs_of_a_common_kind(documents, words):
    rows = [(k, " ".join(words(12, k)) + (f" u{k}@h{k}.org" if k % 2 else "")) for k in range(400)]
    assert all(r.terms == [] for r in pii.find(documents(rows)).collect())


def test_entities(spark):
    values = [("email", "A@b.C"), ("card", "4111-1111 1111 1111"), ("phone", "+1 (377) 555-0271"), ("ip", "010.2.3.4")]
    rows = spark.createDataFrame(values, "kind string, value string")
    got = rows.select("kind", pii.entities(F.struct("kind", "value")).alias("e")).collect()
    assert {r.kind: r.e for r in got} == {
        "email": ["email:value:a@b.c", "email:domain:b.c", "email"],
        "card": ["card:value:4111111111111111", "card:issuer:411111", "card"],
        "phone": ["phone:value:13775550271", "phone:prefix:1377", "phone"],
        "ip": ["ip:value:10.2.3.4", "ip:net:10.2.3", "ip:net:10.2", "ip"],
    }


def test_empty_and_without_entities(documents):
    assert pii.find(documents([])).count() == 0
    got = pii.find(documents([(1, "nothing"), (1, "nothing")])).collect()
    assert [(r.doc_id, r.base, r.terms) for r in got] == [(1, [], [])] * 2


def test_no_python_in_the_plan(documents):
    plan = pii.find(documents([(1, "a@b.c")]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan


def test_scan(spark):
    rows = spark.createDataFrame([(k, list(range(k))) for k in range(19)], "k int, a array<bigint>")
    got = {r.k: (r.s, r.m) for r in rows.select("k", pii.scan(F.col("a"), lambda x, y: x + y).alias("s"), pii.scan(F.reverse("a"), F.greatest).alias("m")).collect()}
    assert got == {k: ([sum(range(j + 1)) for j in range(k)], [k - 1] * k) for k in range(19)}


def test_apart_and_near_against_brute_force(spark):
    import random

    rng = random.Random(5)
    rows = []
    for k in range(60):
        text = "".join(rng.choice("ab é😀") for _ in range(rng.randint(1, 4000)))
        cuts = [sorted(rng.sample(range(len(text) + 1), 2)) for _ in range(rng.randint(0, 12) if len(text) > 1 else 0)]
        made = [("email" if rng.random() < 0.5 else "term", a, b, text[a:b]) for a, b in sorted(cuts)]
        rows.append((k, text, [m for m in made if m[0] != "term"], [m for m in made if m[0] == "term"]))
    df = spark.createDataFrame(rows, f"k int, text string, spans {pii.SPAN}, terms {pii.SPAN}")
    near = pii.near_each(F.col("text"), F.col("spans"), 80)
    got = df.select("k", pii.apart(F.col("terms"), F.col("spans")).alias("apart"), near.alias("near")).collect()
    for r, (_, text, spans, terms) in zip(sorted(got), rows):
        free = [t for t in terms if not any(s[1] < t[2] and t[1] < s[2] for s in spans)]
        assert sorted(map(tuple, r.apart)) == sorted(free)
        assert [n.near for n in r.near] == [f"{text[max(0, a - 80) : a]} {text[b : b + 80]}" for _, a, b, _ in spans]


def test_many_matches_in_one_text(documents):
    import time

    many = " ".join(f"user{k}@host{k % 977}.org quartzling" for k in range(100_000))
    numbers = ",".join(str(100_000 + k) for k in range(200_000))
    start = time.time()
    got = {r.doc_id: r for r in pii.find(documents([(1, many), (2, numbers), (3, "none")])).collect()}
    assert time.time() - start < 120
    assert len(got[1].base) == 100_000 and got[2].base == [] and got[3].base == []
    assert all(many[s.start : s.end] == s.value for s in got[1].base[::997])


def test_disclosures_against_brute_force(documents, words):
    """Every document's terms by counting pairs in plain Python."""
    import math

    rows = [(k, " ".join(words(10, k % 25)) + (f" lumenary u{k}@h{k % 3}.org" if k % 4 == 0 else "")) for k in range(120)]
    rows += [(500 + k, f"gravelle +1 377 555 {1000 + k} lumenary") for k in range(5)]
    rows += [(600, "lumenary"), (601, None), (1, rows[1][1])]
    kinds, pairs, term_docs, entity_docs, texts = {}, {}, {}, {}, {}
    letters = re.compile(r"[a-z]{3,}")

    def named(kind, value):
        value = value.lower()
        if kind == "email":
            return [f"email:value:{value}", f"email:domain:{value.split('@')[-1]}", "email"]
        return [f"phone:value:{digits(value)}", f"phone:prefix:{digits(value)[:-7]}", "phone"]

    for at, (_, text) in enumerate(rows):
        text = text or ""
        for term in set(letters.findall(text.lower())):
            term_docs.setdefault(term, set()).add(at)
        for kind, rule, ok in RULES:
            for m in re.finditer(rule, text):
                if ok(m.group()):
                    near = f"{text[max(0, m.start() - 80) : m.start()]} {text[m.end() : m.end() + 80]}".lower()
                    for e in named(kind, m.group()):
                        kinds.setdefault(at, set()).add(e)
                        entity_docs.setdefault(e, set()).add(at)
                        for term in set(letters.findall(near)):
                            pairs.setdefault((e, term), set()).add(at)
                            texts.setdefault((e, term), set()).add(text)
    n, told = len(rows), set()
    for (e, term), held in pairs.items():
        n_e, n_t, n_p, distinct = len(entity_docs[e]), len(term_docs[term]), len(held), len(texts[e, term])
        pmi = math.log(n_p * n / (n_t * n_e))
        share, rate = n_p / n_t, n_e / n
        without = (1 - share) / share * math.log((1 - share) / (1 - rate)) if share < 1 else 0
        if distinct >= 3 and n_e < n and (":value:" in e or distinct * (pmi + without) >= -math.log(1e-4)):
            if pmi / -math.log(n_e / n) >= 0.5:
                told.add((e, term))
    assert told
    want = []
    for at, (doc_id, text) in enumerate(rows):
        base = [(m.start(), m.end()) for _, rule, ok in RULES for m in re.finditer(rule, text or "") if ok(m.group())]
        terms = {t for e, t in told if e in kinds.get(at, ())}
        want.append((doc_id, [m.group() for m in letters.finditer(text or "") if m.group() in terms and all(b <= m.start() or m.end() <= a for a, b in base)]))
    got = [(r.doc_id, [s.value for s in r.terms]) for r in pii.find(documents(rows), generalise=0.5).collect()]
    assert sorted(got) == sorted(want)
