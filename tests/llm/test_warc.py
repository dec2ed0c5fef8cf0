import random

import pytest
from pyspark.sql import functions as F

from mediamart.llm import warc

KINDS = "record_id long, url string, time long, kind string, headers map<string,string>, payload_digest string"


@pytest.mark.parametrize(
    ("url", "key"),
    [
        ("http://WWW.Example.com:80/a/?utm_source=x&b=2&a=1#top", "example.com/a?a=1&b=2"),
        ("https://example.com", "example.com"),
        ("example.com/?ref=x", "example.com"),
        (" https://www2.example.com/A.html ", "example.com/A.html"),
        ("", ""),
        (None, None),
    ],
)
def test_canonical(spark, url, key):
    assert spark.createDataFrame([(url,)], "url string").select(warc.canonical(F.col("url"))).first()[0] == key


def brute(rows):
    out = {}
    for i, url, time, kind, headers, digest in rows:
        if kind == "response":
            continue
        old = [r for r in rows if r[3] == "response" and r[1] == url and url is not None and None not in (r[2], time) and (r[2], r[0]) < (time, i)]
        last = max(old, key=lambda r: (r[2], r[0]), default=None)
        tag = lambda h: (h or {}).get("ETag", "").removeprefix("W/")
        out[i] = (last[0] if last else None, "missing" if not last else "resolved" if tag(headers) == tag(last[4]) else "changed")
    return out


@pytest.mark.parametrize("window", [1, 7, 10_000])
def test_against_brute_force(spark, window):
    rng = random.Random(window)
    rows = []
    for k in range(400):
        url = "hot.org/x" if rng.random() < 0.4 else f"h{rng.randint(0, 20)}.org/"
        url = None if rng.random() < 0.02 else url.rstrip("/")
        time = None if rng.random() < 0.02 else rng.randint(0, 120)
        tag = {"ETag": f'"{rng.randint(0, 1)}"'}
        rows.append((k, url, time, "response" if rng.random() < 0.4 else "revisit", tag, f"d{k}" if rng.random() < 2 else None))
    df = spark.createDataFrame(rows, KINDS).repartition(4)
    got = {r.record_id: (r.response_id, r.outcome) for r in warc.resolve(df, window).collect()}
    assert got == brute(rows)


def test_validators_and_headers(spark):
    old = {"ETag": '"a"', "Content-Type": "text/html", "Content-Length": "9", "X-Other": "1", "Cache-Control": "no-cache"}
    rows = [
        (1, "http://a.org/", 1, "response", old, "d1"),
        (2, "https://a.org", 2, "revisit", {"etag": 'W/"a"', "content-length": "0", "cache-control": "max-age=5", "x-other": "2"}, None),
        (3, "a.org", 3, "revisit", {"etag": '"b"'}, "d1"),
        (4, "a.org", 4, "revisit", None, "d1"),
        (5, "a.org", 5, "revisit", None, "d2"),
        (6, "a.org", 1, "revisit", None, None),
        (0, "a.org", 1, "revisit", None, None),
        (7, "b.org", 1, "response", {"Last-Modified": "x"}, "d7"),
        (8, "b.org", 2, "revisit", {"Last-Modified": "x"}, "other"),
        (9, "b.org", 3, "revisit", {"Last-Modified": "y"}, "d7"),
        (9, "b.org", 3, "revisit", {"Last-Modified": "y"}, "d7"),
        (10, None, 1, "revisit", None, None),
    ]
    found = warc.resolve(spark.createDataFrame(rows, KINDS))
    got = [(r.record_id, r.outcome) for r in found.orderBy("record_id").collect()]
    assert got == [
        (0, "missing"), (2, "resolved"), (3, "changed"), (4, "resolved"), (5, "changed"), (6, "resolved"), (8, "resolved"),
        (9, "changed"), (9, "changed"), (10, "missing"),
    ]
    two = found.filter("record_id = 2").first()
    assert two.headers == {"etag": 'W/"a"', "content-type": "text/html", "content-length": "9", "x-other": "1", "cache-control": "max-age=5"}
    assert two.payload_digest == "d1"
    payloads = spark.createDataFrame([(1, "page"), (7, "other")], "record_id long, payload string")
    assert {r.record_id: r.payload for r in warc.restored(found, payloads).collect()} == {2: "page", 4: "page", 6: "page", 8: "other"}


def test_empty(spark):
    assert warc.resolve(spark.createDataFrame([], KINDS)).count() == 0
