import json
import random

import pytest
from pyspark.sql import functions as F

from mediamart.operators import detections
from tests.rows import tuples


def by_hand(points, max_gap=0.2, min_duration=0.4, min_avg=0.3):
    """Plain replica: sort, cut where the step is too long, keep, number, round."""
    points = sorted(points)
    runs, last = [], None
    for t, c in points:
        if last is None or t - last > max_gap:
            runs.append([])
        runs[-1].append((t, c))
        last = t
    events = []
    for run in runs:
        start, end = run[0][0], run[-1][0]
        total = sum(round(c * 100) for _, c in run) / 100
        mean, peak = total / len(run), max(c for _, c in run)
        if end - start >= min_duration and mean >= min_avg:
            events.append(
                (len(events) + 1, round(start, 2), round(end, 2), round(end - start, 2), len(run), round(mean, 2), round(peak, 2))
            )
    return events


def random_videos(seed):
    rng = random.Random(seed)
    videos = {"one": [(0.5, 0.9)], "gap": [(0.5, 0.9), (0.6, 0.9), (0.7, 0.9), (0.8, 0.9), (1.0, 0.8), (1.4, 0.9)]}
    for v in range(4):
        steps = sorted(rng.sample(range(2000), 600))
        videos[f"v{v}"] = [(s / 20, rng.randrange(20, 101) / 100) for s in steps]
    # one video holds most of all points
    videos["hot"] = [(s / 20, rng.randrange(20, 101) / 100) for s in sorted(rng.sample(range(60000), 30000))]
    return videos


@pytest.mark.parametrize("bucket_seconds", [0.5, 3.0, 600.0, 1e6])
def test_clusters_do_not_depend_on_buckets(spark, bucket_seconds):
    videos = random_videos(7)
    points = spark.createDataFrame(
        [(v, t, c) for v, pts in videos.items() for t, c in pts], "video_id string, t double, confidence double"
    ).repartition(8)
    events = detections.cluster_points(points, bucket_seconds=bucket_seconds)
    got = {}
    for r in events.select("video_id", *detections.EVENT_COLUMNS).collect():
        got.setdefault(r.video_id, []).append(tuple(r)[1:])
    want = {v: by_hand(pts) for v, pts in videos.items()}
    assert {v: sorted(e) for v, e in got.items()} == {v: e for v, e in want.items() if e}


def test_runs_across_many_buckets(spark):
    points = spark.createDataFrame([("v", i / 10, 0.5) for i in range(1000)], "video_id string, t double, confidence double")
    clusters = detections.gap_clusters(points, bucket_seconds=1.0)
    assert tuples(clusters, "start", "end", "points", "avg_confidence") == [(0.0, 99.9, 1000, 0.5)]


def test_gap_is_tested_in_doubles(spark):
    points = [("a", 0.6), ("a", 0.8), ("b", 0.5), ("b", 0.7)]
    df = spark.createDataFrame([(v, t, 0.9) for v, t in points], "video_id string, t double, confidence double")
    assert tuples(detections.gap_clusters(df).groupBy("video_id").count()) == [("a", 2), ("b", 1)]


def test_negative_and_missing_times(spark):
    points = [("v", -0.1), ("v", 0.0), ("v", 0.1), ("v", None)]
    df = spark.createDataFrame([(v, t, 0.9) for v, t in points], "video_id string, t double, confidence double")
    assert tuples(detections.gap_clusters(df, bucket_seconds=0.05), "start", "end", "points") == [(-0.1, 0.1, 3)]


def test_in_row_form_agrees(spark):
    videos = random_videos(11)
    rows = [(v, json.dumps({str(t): c for t, c in random.Random(1).sample(pts, len(pts))})) for v, pts in videos.items()]
    rows += [("none", None), ("empty", "{}")]
    raw = spark.createDataFrame(rows, "video_id string, sound_classifier_json string")
    in_row = {r.video_id: json.loads(r.laugh_events_json) for r in detections.add_events(raw).collect()}
    points = detections.explode_points(raw, "sound_classifier_json")
    exploded = detections.cluster_points(points, bucket_seconds=5.0)
    shuffled = detections.events_payload(exploded, raw.select("video_id"))
    assert {r.video_id: json.loads(r.laugh_events_json) for r in shuffled.collect()} == in_row
    assert in_row["none"] == in_row["empty"] == {"events": []}
    assert [tuple(e.values()) for e in in_row["hot"]["events"]] == by_hand(videos["hot"])


def test_select_points_last_write_wins(spark):
    rows = [
        ("v", 1.0, "laughter", 0.456, 1),
        ("v", 1.0, "laughter", 0.994, 2),
        ("v", 2.0, "laughter", 0.19, 3),
        ("v", 3.0, "music", 0.9, 4),
        ("v", 4.0, "laughter", 0.2, 5),
    ]
    df = spark.createDataFrame(rows, "video_id string, t double, label string, confidence double, seq long")
    assert tuples(detections.select_points(df), "t", "confidence") == [(1.0, 0.99), (4.0, 0.2)]


def test_explode_points_sorts_by_number(spark):
    raw = spark.createDataFrame([("v", '{"10.0":0.9,"9.5":0.1,"0.05":0.4}'), ("n", None), ("e", "{}")], "video_id string, j string")
    points = detections.sort_points(detections.explode_points(raw, "j"))
    assert [r.t for r in points.orderBy("video_id", "t").collect()] == [0.05, 9.5, 10.0]


def test_numbering_starts_after_the_filter(spark):
    points = [("v", t) for t in (0.0, 5.0, 5.1, 5.2, 5.3, 5.4, 9.0, 9.1, 9.2, 9.3, 9.4)]
    df = spark.createDataFrame([(v, t, 0.9) for v, t in points], "video_id string, t double, confidence double")
    events = detections.cluster_points(df, bucket_seconds=0.1)
    assert tuples(events, "sequence", "start_seconds") == [(1, 5.0), (2, 9.0)]
    assert events.filter(F.col("points") == 5).count() == 2
