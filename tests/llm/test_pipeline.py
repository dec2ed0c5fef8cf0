import duckdb
import pytest

import corpus_pipeline
from mediamart.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


def test_every_operator_has_one_query():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_sql_agrees(spark, name):
    for table in ("documents", "pages", "embeddings"):
        duckdb.sql(f"CREATE OR REPLACE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    want = duckdb.sql(ORACLES[name])
    columns = sorted(want.columns)
    got = QUERIES[name](spark, SF)
    assert sorted(got.columns) == columns
    as_text = lambda rows: sorted([str(v) for v in r] for r in rows)
    assert as_text(got.select(*columns).collect()) == as_text(want.select(*columns).fetchall())


def test_stages(spark, documents, words):
    texts = {k: " ".join(words(80, k)) for k in range(30)}
    rows = list(texts.items()) + [(50, texts[3]), (51, texts[4] + " more"), (51, texts[4] + " more"), (52, None), (53, "")]
    docs = documents(rows)
    benchmark = spark.read.parquet(f"{SF}/benchmark.parquet")
    leak = (60, texts[5][:100] + " " + benchmark.first().text + " " + texts[6][:100])
    docs = documents([*rows, leak])
    left = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns and dict(out.dtypes) == dict(docs.dtypes)
        docs = spark.createDataFrame(out.collect(), docs.schema)
        left.append((name, sorted(r.doc_id for r in docs.collect())))
    clean = set(texts)
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "toxicity", "exact dedup", "n-gram Jaccard join", "benchmark decontamination", "packing",
    ]
    assert left[0][1] == sorted([*texts, 50, 51, 51, 52, 53, 60])
    assert left[1][1] == sorted([*(clean - {3}), 50, 51, 53, 60])
    assert left[2][1] == sorted([*(clean - {3, 4}), 50, 51, 53, 60])
    assert left[3][1] == sorted([*(clean - {3, 4}), 50, 51, 53])
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert {r.doc_id for r in packed.collect()} == set(left[3][1])


def test_whole_run(spark):
    assert corpus_pipeline.run(spark, SF).count() > 0
