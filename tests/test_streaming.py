import datetime as dt
import json

from pyspark.sql import functions as F

from mediamart.streaming.ingest import follow_playlists
from tests.rows import tuples


def test_follow_playlists(spark, tables, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()

    def land(name, *ids):
        entries = [{"id": i, "title": f"{name} {i}", "url": "u", "channel_id": "c", "channel": "C"} for i in ids]
        (landing / f"{name}.json").write_text(json.dumps({"id": name, "title": name, "entries": entries}) + "\n")

    def follow():
        stamp = F.lit(dt.datetime(2030, 1, 1))
        follow_playlists(tables, str(landing), stamp, str(tmp_path / "checkpoint")).awaitTermination()
        return tuples(tables.read("process_video"), "video_id", "video_title", "playlist_id")

    land("p1", "a", "b", "a", None)
    assert follow() == [("a", "p1 a", "p1"), ("b", "p1 b", "p1")]
    assert len(follow()) == 2  # nothing new has landed
    land("p2", "b", "c")
    assert follow() == [("a", "p1 a", "p1"), ("b", "p1 b", "p1"), ("c", "p2 c", "p2")]
