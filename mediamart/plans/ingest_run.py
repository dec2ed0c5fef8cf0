"""One run from playlists to built tables: new videos, what is missing of each, status, build.

Each stage asks the user's function for all videos that lack its artefact, in one job whose answers are
stored, so that no function is called twice for one need.  What has changed is written back by key
into the buckets it falls in.  Nothing changed, nothing built.
"""

from __future__ import annotations

import functools
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mediamart.functions.json import parse
from mediamart.operators.detections import add_events
from mediamart.operators.enrich import enrich, split_errors
from mediamart.operators.ingest import changed_rows, fill, flatten_playlists, new_raw_rows, set_status, stamp_changes, work_flags
from mediamart.operators.text import chapter_ends, classifier_prompt, last_segment, segments_map, summary_prompt
from mediamart.plans import build
from mediamart.schemas import RAW
from mediamart.sources.tables import Tables

KEY = ["video_id"]
SENTENCES = "sentences array<struct<text: string, start: double, end: double>>"
CHAPTERS = "chapters array<struct<id: int, theme: string, summary: string>>"

Make = Callable[[], Callable[[str], str]]


@dataclass(frozen=True)
class Functions:
    """The user's functions.  Each maker is called once per task and returns a function from a prompt to JSON.

    ``meta`` and ``points`` get the video's address and answer with the artefact itself,
    ``transcript`` gets the address and answers ``{"sentences": [{"text", "start", "end"}]}``,
    ``chapters`` and ``classes`` get a prompt made of their template and the artefact before.
    """

    meta: Make
    transcript: Make
    points: Make
    chapters: Make
    classes: Make
    chapters_template: str = "List the chapters of: "
    classes_template: str = "Classify the chapters: "


@dataclass(frozen=True)
class Outcome:
    """``changed`` rows of the raw table, the ``skipped`` items (stage, video_id, attempts, error), and all
    tables by name, or None when nothing had to be built."""

    changed: int
    skipped: DataFrame
    built: dict[str, DataFrame] | None


def add_new_videos(tables: Tables, playlists: DataFrame, now: Column) -> DataFrame:
    """The raw table with the videos that it did not know."""
    new = new_raw_rows(tables.read("process_video"), flatten_playlists(playlists), now)
    return tables.upsert("process_video", new, KEY)


def complete(tables: Tables, raw: DataFrame, functions: Functions, now: Column) -> tuple[DataFrame, DataFrame]:
    """``raw`` with everything that could be had, and the skipped items."""
    skipped = []

    def ask(rows: DataFrame, stage: str, flag: str, make: Make, prompt: Column, column: str, result: Column, force: bool = False) -> DataFrame:
        pending = work_flags(rows, F.to_date(now)).filter(flag).select("video_id", prompt.alias("prompt"))
        answers = tables.stage(f"answers_{stage}", enrich(pending, make, "video_id", "prompt"))
        good, bad = split_errors(answers)
        skipped.append(bad.select(F.lit(stage).alias("stage"), "video_id", "attempts", "error"))
        return fill(rows, good.select("video_id", result.alias(column)), "video_id", column, force)

    url, result = F.col("video_url"), F.col("result")
    rows = ask(raw, "meta", "needs_meta", functions.meta, url, "video_meta_json", result, force=True)
    sentences = parse(result, SENTENCES)["sentences"]
    rows = ask(rows, "transcript", "needs_transcript", functions.transcript, url, "transcribe_json", segments_map(sentences))
    rows = ask(rows, "points", "needs_points", functions.points, url, "sound_classifier_json", result)
    derived = add_events(rows, name="_events")
    found = F.when(F.col("sound_classifier_json").isNotNull(), F.col("_events"))
    rows = derived.withColumn("laugh_events_json", F.coalesce("laugh_events_json", found)).select(*RAW.names)
    prompt = summary_prompt(F.col("transcribe_json"), functions.chapters_template)
    # the answer lists where chapters begin; where they end follows from the transcript
    rows = ask(rows, "chapters", "needs_chapters", functions.chapters, prompt, "llm_chapter_json", result)
    listed = parse(F.col("llm_chapter_json"), CHAPTERS)["chapters"]
    ended = F.to_json(F.struct(chapter_ends(listed, last_segment(F.col("transcribe_json"))).alias("chapters")))
    before = raw.select("video_id", F.col("llm_chapter_json").isNull().alias("_new"))
    rows = (
        rows.join(before, "video_id")
        .withColumn("llm_chapter_json", F.when(F.col("_new") & F.col("llm_chapter_json").isNotNull(), ended).otherwise(F.col("llm_chapter_json")))
        .select(*RAW.names)
    )
    prompt = classifier_prompt(F.col("llm_chapter_json"), functions.classes_template)
    rows = ask(rows, "classes", "needs_classes", functions.classes, prompt, "llm_classifier_json", result)
    done = set_status(stamp_changes(raw, rows, now)).select(*RAW.names)
    return done, functools.reduce(DataFrame.unionByName, skipped)


def run(tables: Tables, playlists: DataFrame, calendar: DataFrame, functions: Functions, now: Column | None = None) -> Outcome:
    """Bring the raw table up to date and build what stands behind it, if anything has changed."""
    now = F.current_timestamp() if now is None else now
    raw = add_new_videos(tables, playlists, now)
    done, skipped = complete(tables, raw, functions, now)
    changed = tables.stage("changed_raw", changed_rows(raw, done))
    n = changed.count()
    if n:
        raw = tables.upsert("process_video", changed, KEY)
    tables.clear("changed_raw")
    if not n:
        return Outcome(0, skipped, None)
    return Outcome(n, skipped, build.build_all(tables, raw, calendar, now))
