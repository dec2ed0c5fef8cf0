import json

import pytest
from pyspark.sql import functions as F

from mediamart.operators import enrich, text
from tests.rows import tuples


@pytest.mark.parametrize(
    "answer, body",
    [
        ('Sure:\n```json\n{"a": 1}\n```\nDone.', '{"a": 1}'),
        ("```\n x \n```", "x"),
        ("``` a ```json b ``` c", "b"),
        ("```json only", "only"),
        ("\n\t plain \n", "plain"),
        ("a```b", "b"),
        ("", ""),
    ],
)
def test_strip_fences(spark, answer, body):
    df = spark.createDataFrame([(answer,)], "a string")
    assert df.select(text.strip_fences(F.col("a"))).first()[0] == body == enrich.answer_text(answer)


def test_split_valid_json(spark):
    df = spark.createDataFrame([(1, '{"a":1}'), (2, "{broken"), (3, None), (4, "[1,2]")], "id int, a string")
    valid, retry = text.split_valid_json(df, "a")
    assert tuples(valid, "id") == [(1,), (4,)]
    assert tuples(retry, "id", "reason") == [(2, "not valid JSON"), (3, "no answer")]


def test_prompts(spark):
    transcript = json.dumps({"0": {"text": "hi", "start": 0, "end": 1}})
    chapters = json.dumps({"chapters": [{"id": 0, "end_id": 4, "theme": "t", "summary": "s"}]})
    df = spark.createDataFrame([(transcript, chapters)], "t string, c string")
    row = df.select(
        text.summary_prompt(F.col("t"), "S:").alias("s"),
        text.classifier_prompt(F.col("c"), "C:").alias("c"),
        text.classifier_prompt(F.lit("{}"), "C:").alias("empty"),
        text.retry_prompt(F.lit("P."), F.lit("E"), F.lit("bad")).alias("r"),
    ).first()
    assert json.loads(row.s[2:]) == {"0": {"text": "hi"}}
    assert json.loads(row.c[2:]) == {"chapters": [{"id": 0, "theme": "t", "summary": "s"}]}
    assert json.loads(row.empty[2:]) == {"chapters": []}
    assert row.r.startswith("P.") and "bad" in row.r and "E" in row.r


def test_segments_to_map(spark):
    df = spark.createDataFrame([([("a", 0.125, 2.675), ("b", 3.0, 4.0)],)], "s array<struct<text: string, start: double, end: double>>")
    got = json.loads(text.segments_to_map(df, "s").first().transcribe_json)
    assert got == {"0": {"text": "a", "start": 0.12, "end": 2.67}, "1": {"text": "b", "start": 3.0, "end": 4.0}}


def test_chapter_ends_follow_list_order(spark):
    transcript = json.dumps({str(i): {"text": "x", "start": 0, "end": 1} for i in (0, 2, 11)})
    rows = [
        ("sorted", json.dumps({"chapters": [{"id": 0}, {"id": "4"}, {"id": 9}]}), transcript),
        ("mixed", json.dumps({"chapters": [{"id": 9}, {"id": 0}]}), transcript),
        ("silent", json.dumps({"chapters": [{"id": 0}]}), "{}"),
        ("none", None, transcript),
    ]
    df = spark.createDataFrame(rows, "video_id string, llm_chapter_json string, transcribe_json string")
    got = {
        r.video_id: r.llm_chapter_json and [(c["id"], c["end_id"]) for c in json.loads(r.llm_chapter_json)["chapters"]]
        for r in text.backfill_chapter_ends(df).collect()
    }
    assert got == {"sorted": [(0, 3), (4, 8), (9, 11)], "mixed": [(9, -1), (0, 11)], "silent": [(0, 0)], "none": None}


def make_fn():
    def fn(prompt):
        if prompt.startswith("gone"):
            raise enrich.Unavailable()
        if prompt.startswith("crash"):
            raise ValueError("boom")
        if prompt.startswith("slow"):
            raise enrich.Transient()
        if prompt.startswith("twice") and prompt == "twice":
            return "{oops"
        return '```json\n{"ok": true}\n```' if not prompt.startswith("never") else "no"

    return fn


def test_enrich(spark):
    rows = [(p, p) for p in ("good", "twice", "never", "gone", "slow")]
    df = spark.createDataFrame(rows, "id string, prompt string")
    results = enrich.enrich(df, make_fn, "id", "prompt")
    assert tuples(results) == [
        ("gone", None, 1, "Unavailable"),
        ("good", '{"ok": true}', 1, None),
        ("never", None, 2, "NoValidAnswer"),
        ("slow", None, 2, "NoValidAnswer"),
        ("twice", '{"ok": true}', 2, None),
    ]
    usable, skipped = enrich.split_errors(results)
    assert (usable.count(), skipped.count()) == (2, 3)


def test_other_errors_fail_the_query(spark):
    df = spark.createDataFrame([("crash", "crash")], "id string, prompt string")
    with pytest.raises(Exception, match="boom"):
        enrich.enrich(df, make_fn, "id", "prompt").collect()
