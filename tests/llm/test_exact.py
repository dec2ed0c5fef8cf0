import hashlib
from collections import defaultdict

import pytest

from mediamart.llm import exact
from mediamart.llm.common import drop_rows, keep_rows, row_key, slots_for

LONG = "x" * 300_000
ROWS = [
    (1, "a"), (2, "a"), (3, "b"), (4, None), (5, ""), (6, " a"), (None, "a"), (None, "only"), (7, "A"),
    (8, "same prefix " + "p" * 300 + "1"), (9, "same prefix " + "p" * 300 + "2"), (10, "same prefix " + "p" * 300 + "1"),
    (11, LONG), (12, LONG), (13, LONG[:-1] + "y"), (14, "é"), (15, "é"), (16, "twice"), (16, "twice"),
]


def expected(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[t or ""].append(i)
    out = []
    for text, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        out += [(i, keep, len(ids), hashlib.sha256(text.encode()).hexdigest()) for i in ids]
    return sorted(out, key=str)


@pytest.mark.parametrize("slots", [1 << 23, 32_768])
def test_groups(documents, slots):
    got = exact.assign(documents(ROWS), slots=slots, hash_all=True).collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.sha256) for r in got), key=str) == expected(ROWS)
    # one row of each group stays, and it is the one with the largest id
    kept = [r for r in got if r.kept]
    assert len(kept) == len({t or "" for _, t in ROWS})
    assert all(r.doc_id == r.keep_id for r in kept)


def test_settled_texts_are_not_hashed(documents):
    got = {r.doc_id: r.sha256 for r in exact.assign(documents([(1, "one"), (2, "three"), (3, "three")])).collect()}
    assert got[1] is None and got[2] == got[3] is not None


def test_empty(documents):
    assert exact.assign(documents([])).count() == 0


@pytest.mark.parametrize("slots", [None, 32_768])
def test_rows_kept(documents, slots):
    docs = documents(ROWS)
    out = exact.deduplicated(docs, slots=slots)
    assert out.columns == docs.columns and out.dtypes == docs.dtypes
    want = {(r[1], r[3]) for r in expected(ROWS)}
    digest = lambda t: hashlib.sha256((t or "").encode()).hexdigest()
    got = [(r.doc_id, digest(r.text)) for r in out.collect()]
    assert len(got) == len(want) and set(got) == want


def test_only_shared_texts_are_hashed_and_shuffled(documents):
    """Above the rows that pass there is neither a whole-text hash nor an exchange."""
    plan = exact.deduplicated(documents(ROWS))._jdf.queryExecution().optimizedPlan()
    assert plan.nodeName() == "Union"
    passed, picked = plan.children().apply(0).toString(), plan.children().apply(1).toString()
    assert "sha2(" not in passed and "Aggregate" not in passed.split("Join")[0]
    assert picked.index("sha2(") < picked.index("Filter")  # hashed after the filter by the bitmap


def test_most_rows_equal(documents):
    rows = [(k, "hot") for k in range(400)] + [(k, f"cold {k}") for k in range(400, 500)]
    got = [(r.doc_id, r.text) for r in exact.deduplicated(documents(rows)).collect()]
    assert sorted(got) == sorted([(399, "hot"), *rows[400:]])


def test_decided_rows(documents):
    rows = [(1, "a"), (1, "a"), (2, "b"), (3, None), (3, ""), (None, "c"), (None, "c"), (4, "d"), (5, "e")]
    docs = documents(rows)
    keyed = docs.select("doc_id", row_key().alias("row_key"))
    decided = keyed.selectExpr("row_key", "coalesce(doc_id NOT IN (2, 5), TRUE) AS kept")
    out = keep_rows(docs, decided)
    assert out.columns == docs.columns and out.dtypes == docs.dtypes
    left = sorted(((r.doc_id, r.text or "") for r in out.collect()), key=str)
    assert left == sorted([(1, "a"), (3, ""), (None, "c"), (4, "d")], key=str)  # rows that repeat stay once
    out = drop_rows(docs, keyed.filter("doc_id IN (2, 5)"))
    assert out.columns == docs.columns
    left = sorted(((r.doc_id, r.text or "") for r in out.collect()), key=str)
    assert left == sorted([(i, t or "") for i, t in rows if i not in (2, 5)], key=str)
    for no_keys in (keep_rows(docs, decided.filter("FALSE")), drop_rows(docs, keyed.filter("FALSE"))):
        assert no_keys.count() == len(rows)
    assert keep_rows(documents([]), decided).count() == drop_rows(documents([]), keyed).count() == 0


def test_bitmap_is_bounded():
    assert slots_for(0) == slots_for(1000) == 1 << 20
    assert 16 * 10**6 <= slots_for(10**6) <= 32 * 10**6
    assert slots_for(10**12) == 1 << 30
