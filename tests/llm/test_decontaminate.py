import math
import random
import time

import numpy as np
import pytest

from mediamart.llm import decontaminate
from mediamart.llm.common import mixed
from mediamart.llm.decontaminate import tokens

QUESTION = (
    "A train leaves the old station with Alice and 12 crates of apples. After 30 km the driver Bob unloads "
    "half of the 12 crates and asks how many are left for the market."
)
SWAPPED = QUESTION.replace("Alice", "Carla").replace("12", "48").replace("30 km", "95 miles").replace("Bob", "Dave")
MIXED = SWAPPED.replace("48 crates and", "47 crates and")
FILL = "some plain words of no meaning at all that go on and on until the end of it "


@pytest.fixture(scope="module")
def items(spark):
    rows = [
        (1, QUESTION),
        (1, QUESTION),
        (2, "which of these small words is last"),
        (3, "too short"),
        (4, None),
        (5, ""),
        (None, "an item that has no identifier but enough words to be found anyway"),
    ]
    return spark.createDataFrame(rows, "item_id long, text string")


def test_passages(documents, items):
    rows = [
        (1, FILL + QUESTION + " " + FILL),
        (2, FILL + SWAPPED),
        (3, FILL + MIXED),
        (4, FILL * 30),
        (5, None),
        (6, ""),
        (7, "x. " + QUESTION.upper() + " y"),
        (8, "\n".join(QUESTION.replace(",", "").split())),
        (9, FILL + "which of these small words is last, " + FILL),
        (10, " ".join(QUESTION.split()[:20])),
        (11, " ".join(QUESTION.split()[:9])),
        (12, FILL + "an item that has no identifier but enough words to be found anyway"),
        (None, QUESTION),
        (13, (FILL + QUESTION) * 40),
        (13, (FILL + QUESTION) * 40),
        (14, "too short"),
    ]
    got = {(r.doc_id, r.item_id): r for r in decontaminate.leaks(documents(rows), items).collect()}
    assert set(got) == {(1, 1), (2, 1), (7, 1), (8, 1), (9, 2), (10, 1), (12, None), (None, 1), (13, 1)}
    assert got[1, 1].exact and got[1, 1].matched == got[1, 1].item_windows
    assert not got[2, 1].exact and got[2, 1].matched == got[2, 1].item_windows
    # document 3: slots that do not map one to one count for nothing


def test_slots_must_agree(documents, spark):
    item = "there are 3 boys and then 5 girls in line so 3 of them go"
    items = spark.createDataFrame([(1, item)], "item_id long, text string")
    rows = [(1, item.replace("3", "7").replace("5", "9")), (2, "there are 1 boys and then 2 girls in line so 4 of them go")]
    got = {r.doc_id: r.exact for r in decontaminate.leaks(documents(rows), items).collect()}
    assert got == {1: False}


def leaked(documents, spark, pairs):
    """Which of the (item, document) pairs are found, each with a number of its own."""
    items = spark.createDataFrame([(k, i) for k, (i, _) in enumerate(pairs)], "item_id long, text string")
    rows = [(k, d) for k, (_, d) in enumerate(pairs)]
    return {r.doc_id: r.exact for r in decontaminate.leaks(documents(rows), items).collect() if r.doc_id == r.item_id}


SWAPS = [
    (
        "Tom has 3 apples. Anna has 5 pears. Bob has 7 plums. How many fruits do they have together?",
        "Ella has 4 apples. Jack has 9 pears. Nina has 8 plums. How many fruits do they have together?",
    ),
    ("a rope of 5kg hangs on a wall 30km from here on the 3rd of may", "a rope of 8kg hangs on a wall 45km from here on the 9th of may"),
    ("there were five cats and nine dogs on the farm near a lake", "there were seven cats and two dogs on the farm near a lake"),
    ("there were five cats and nine dogs near a river with one boat", "there were 7 cats and 2 dogs near a river with 3 boat"),
]


def test_names_at_starts_glued_units_and_number_words(documents, spark):
    assert leaked(documents, spark, SWAPS) == {k: False for k in range(len(SWAPS))}


def test_values_that_became_equal(documents, spark):
    item = "there are 3 boys and then 5 girls in line when 2 dogs and 4 cats walk by the gate"
    named = "so Tom gave the old red ball to Anna who then ran with it along the wall of the long garden near the house of Bob"
    pairs = [
        (item, item.replace("3", "6").replace("5", "8").replace("2", "6").replace("4", "9")),
        (named, named.replace("Tom", "Carl").replace("Anna", "Carl").replace("Bob", "Dora")),
        (named, named.replace("Tom", "Carl").replace("Anna", "Ella").replace("Bob", "Dora")),
        ("when Tom saw the cat of Anna it ran", "when Carl saw the cat of Carl it ran"),
    ]
    got = leaked(documents, spark, pairs)
    # of the names of the second only Bob has a partner of its own; windows without names are as written
    assert set(got) == {0, 1, 2} and not got[0] and not got[2]


def test_glued_words_are_two_tokens():
    _, kind, found, real = tokens("weighs (5kg), 30km/h a 5-year-old 3rd mp3")
    assert [(found[r], k) for r, k in zip(real, kind)] == [
        ("weighs", 0), ("(5", 1), ("kg),", 3), ("30", 1), ("km/h", 0), ("a", 0), ("5", 1), ("-year-old", 0), ("3rd", 1), ("mp3", 0),
    ]


def test_tokens():
    _, kind, found, real = tokens("Then Bob ran 5 km. Two Dogs, 7 WORDS\nNew line 3.5% -- of it")
    assert [(found[r], k) for r, k in zip(real, kind)] == [
        ("Then", 0), ("Bob", 2), ("ran", 0), ("5", 1), ("km.", 3), ("Two", 0), ("Dogs,", 2), ("7", 1),
        ("WORDS", 0), ("New", 0), ("line", 0), ("3.5%", 1), ("of", 0), ("it", 0),
    ]


def test_empty_tables(documents, items):
    assert decontaminate.leaks(documents([]), items).count() == 0
    assert decontaminate.leaks(documents([(1, QUESTION)]), items.limit(0)).count() == 0


def test_long_words_take_linear_time():
    start = time.perf_counter()
    value, *_ = tokens("a" + "-" * 1_000_000 + "b " + "-" * 1_000_000 + "c" + "_" * 1_000_000)
    assert len(value) == 2 and time.perf_counter() - start < 2


@pytest.mark.parametrize("width", range(4, 9))
def test_rolled_hash_is_the_polynomial(width):
    values = [random.Random(width).getrandbits(64) for _ in range(30)]
    got = decontaminate._rolled(np.array(values, np.uint64), width, 7)
    want = []
    for k in range(len(values) - width + 1):
        h = 7
        for v in values[k : k + width]:
            h = (h * 0x9E3779B97F4A7C15 + v) & ((1 << 64) - 1)
        want.append(h)
    assert got.tolist() == mixed(np.array(want, np.uint64)).tolist()


def test_texts_together_are_as_texts_alone():
    texts = [QUESTION, "", "5", "km of it. Then Bob", "\n", SWAPPED + " 12kg", "x"]
    value, kind, second, of, found, real = decontaminate.both(texts)
    together = [(o, v, k, s, found[r]) for o, v, k, s, r in zip(of, value, kind, second, real)]
    alone = []
    for n, text in enumerate(texts):
        v, k, s, _, f, r = decontaminate.both([text])
        alone += [(n, a, b, c, f[d]) for a, b, c, d in zip(v, k, s, r)]
    assert together == alone
    for width in (4, 8):
        got = sorted((of[a], h) for _, at, hashes in decontaminate.windows(value, kind, second, of, width) for a, h in zip(at, hashes))
        want = []
        for n, text in enumerate(texts):
            v, k, s, o, _, _ = decontaminate.both([text])
            want += [(n, h) for _, at, hashes in decontaminate.windows(v, k, s, o, width) for h in hashes]
        assert got == sorted(want)
    assert [len(t) for _, t in decontaminate.pieces(["x" * 700_000] * 3 + ["y"])] == [2, 2]


def test_plain_passages_by_brute_force(documents, spark, words):
    """All windows of all items against all documents, over texts without slots."""
    items = [" ".join(words(n, n)) for n in (5, 8, 9, 20, 60)]
    docs = [" ".join(words(80, 100 + k)) for k in range(12)]
    for k in range(12):  # a run of an item inside
        item = items[k % 5].split()
        take = item[k % 3 : k % 3 + 4 + 3 * k]
        docs[k] = docs[k][:200] + " " + " ".join(take) + " " + docs[k][200:]
    want = {}
    for i, item in enumerate(items):
        item = item.split()
        width = min(8, len(item))
        runs = [tuple(item[a : a + width]) for a in range(len(item) - width + 1)]
        for d, doc in enumerate(docs):
            doc = doc.split()
            there = {tuple(doc[a : a + width]) for a in range(len(doc) - width + 1)}
            n = sum(run in there for run in runs)
            if n and n >= min(13, math.ceil(len(runs) * 0.3)):
                want[d, i] = n
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    got = {(r.doc_id, r.item_id): r.matched for r in decontaminate.leaks(documents(list(enumerate(docs))), bench).collect()}
    assert got == want and want
