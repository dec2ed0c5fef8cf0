"""Raw-layer bookkeeping, over all rows at once."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mediamart.functions.json import non_empty
from mediamart.operators.windows import dedupe_first
from mediamart.schemas import ARTEFACTS, META_KEYS, RAW

# Where playlists are fetched from and the suffix of stored audio.
PLAYLIST_URL = "https://www.youtube.com/playlist?list="
AUDIO_SUFFIX = ".opus"
FINISHED = "finished"


def flatten_playlists(playlists: DataFrame) -> DataFrame:
    """One row per playlist entry with the playlist's id and title; no entries, no rows.

    ``position`` is the place in the list.
    """
    return playlists.select("id", "title", F.posexplode("entries").alias("position", "entry")).select(
        F.col("entry.channel_id").alias("channel_id"),
        F.col("entry.channel").alias("channel_name"),
        F.col("id").alias("playlist_id"),
        F.col("title").alias("playlist_title"),
        F.col("entry.id").alias("video_id"),
        F.col("entry.title").alias("video_title"),
        F.col("entry.url").alias("video_url"),
        "position",
    )


def project_meta(fields: dict[str, Column]) -> Column:
    """Metadata JSON with the five declared keys, as far as they are present; a key that is present
    with null stays."""
    kept = F.struct(*[fields[key].alias(key) for key in META_KEYS if key in fields])
    return F.to_json(kept, {"ignoreNullFields": "false"})


def json_value(text: Column) -> Column:
    """One text per JSON value: sorted keys on all levels, numbers by value, types kept.  A text that is
    not JSON stands for itself."""
    return F.coalesce(F.to_json(F.try_parse_json(text)), text)


def insert_absent(
    existing: DataFrame | None, new: DataFrame, keys: list[str], order: list[str | Column]
) -> DataFrame:
    """Rows of ``new`` to append: first occurrence per key, key not NULL and not stored yet."""
    first = dedupe_first(new, keys, order)
    return first if existing is None else first.join(existing.select(*keys), keys, "left_anti")


def new_raw_rows(existing: DataFrame | None, entries: DataFrame, now: Column) -> DataFrame:
    """Playlist entries not yet in the raw table, as raw rows without artefacts."""
    absent = insert_absent(existing, entries, ["video_id"], ["playlist_id", "position"])
    return fill_created(
        absent.select(*[absent[c] if c in absent.columns else F.lit(None).alias(c) for c in RAW.names]), now
    ).select(*[F.col(f.name).cast(f.dataType) for f in RAW])


def fill_created(raw: DataFrame, now: Column) -> DataFrame:
    """Default the load timestamp."""
    return raw.withColumn("created_at", F.coalesce("created_at", now))


def playlist_ids(raw: DataFrame) -> DataFrame:
    return raw.select("playlist_id").distinct()


def playlist_urls(raw: DataFrame, prefix: str = PLAYLIST_URL) -> DataFrame:
    """Address of every known playlist; entries without a playlist have none."""
    known = playlist_ids(raw).filter("playlist_id is not null")
    return known.withColumn("url", F.concat(F.lit(prefix), "playlist_id"))


def lookup(raw: DataFrame, ids: DataFrame, key: str = "video_id") -> DataFrame:
    """Rows of the given ids.  For a single id use ``raw.filter``."""
    return raw.join(ids, key, "left_semi")


def fill(
    table: DataFrame, values: DataFrame, key: str, column: str, force: bool = False
) -> DataFrame:
    """Fill ``column`` where it is NULL from ``values(key, column)``.  With ``force`` a value
    replaces the old one, but a NULL never does.  ``key`` is unique on both sides."""
    new = values.select(key, F.col(column).alias("_new"))
    first, second = ("_new", column) if force else (column, "_new")
    return (
        table.join(new, key, "left")
        .withColumn(column, F.coalesce(first, second))
        .select(*table.columns)
    )


def update(table: DataFrame, values: DataFrame, key: str, column: str) -> DataFrame:
    """Set ``column`` for every key in ``values``, also to NULL; other rows keep theirs."""
    new = values.select(key, F.col(column).alias("_new"), F.lit(True).alias("_hit"))
    return (
        table.join(new, key, "left")
        .withColumn(column, F.when(F.col("_hit"), F.col("_new")).otherwise(F.col(column)))
        .select(*table.columns)
    )


def stamp_changes(
    old: DataFrame,
    new: DataFrame,
    now: Column,
    key: str = "video_id",
    json_column: str = "video_meta_json",
    stamp: str = "meta_updated_at",
) -> DataFrame:
    """Rows of ``new`` with the stamp set to ``now`` where the metadata differs from the stored
    one as a JSON value: key order on any level, spacing and the form of a number do not count; a
    string differs from a number, and a member that is null from one that is absent.  Rows not
    stored before are not stamped."""
    before = old.select(
        key, F.col(json_column).alias("_old"), F.col(stamp).alias("_stamp"), F.lit(True).alias("_known")
    )
    same = json_value(F.col("_old")).eqNullSafe(json_value(F.col(json_column)))
    return (
        new.join(before, key, "left")
        .withColumn(
            stamp,
            F.when(F.col("_known") & ~same, now).when(F.col("_known"), F.col("_stamp")).otherwise(F.col(stamp)),
        )
        .select(*new.columns)
    )


def work_flags(raw: DataFrame, today: Column) -> DataFrame:
    """What is still to be done for each video.

    Without an address neither metadata nor audio can be fetched.  Topics need a transcript,
    and classes need chapters; an empty object counts as absent for both.
    """
    missing = {name: F.col(name).isNull() for name in ARTEFACTS}
    has_url = F.coalesce(F.length("video_url"), F.lit(0)) > 0
    stale = (
        missing["video_meta_json"]
        | F.col("meta_updated_at").isNull()
        | (F.to_date("meta_updated_at") < today)
    )
    has_transcript = non_empty(F.col("transcribe_json"))
    return raw.select(
        "*",
        (has_url & stale).alias("needs_meta"),
        (has_url & (missing["transcribe_json"] | missing["sound_classifier_json"])).alias("needs_audio"),
        (has_url & missing["transcribe_json"]).alias("needs_transcript"),
        (has_url & missing["sound_classifier_json"]).alias("needs_points"),
        (has_url & missing["laugh_events_json"]).alias("needs_events"),
        (has_transcript & missing["llm_chapter_json"]).alias("needs_chapters"),
        (
            has_transcript & non_empty(F.col("llm_chapter_json")) & missing["llm_classifier_json"]
        ).alias("needs_classes"),
    )


def set_status(raw: DataFrame, artefacts: list[str] = ARTEFACTS) -> DataFrame:
    """'finished' once every artefact is present and not empty; else the old status."""
    complete = F.lit(True)
    for name in artefacts:
        complete = complete & non_empty(F.col(name))
    return raw.withColumn(
        "process_status", F.when(complete, F.lit(FINISHED)).otherwise(F.col("process_status"))
    )


def changed_rows(old: DataFrame, new: DataFrame, key: str = "video_id") -> DataFrame:
    """Rows of ``new`` with any JSON value or status different from the stored row, or without one.

    Counting them tells whether the tables behind need to be built at all.
    """
    watched = [json_value(F.col(c)).alias(c) for c in ARTEFACTS if c in new.columns]
    watched += [F.col("process_status")] if "process_status" in new.columns else []
    before = old.select(key, F.struct(*watched).alias("_old"))
    return (
        new.withColumn("_new", F.struct(*watched))
        .join(before, key, "left")
        .filter(~F.col("_new").eqNullSafe(F.col("_old")))
        .select(*new.columns)
    )


def audio_key(video_id: Column, prefix: str) -> Column:
    """Object name of a video's audio."""
    return F.concat_ws("/", F.lit(prefix), F.concat(video_id, F.lit(AUDIO_SUFFIX)))


def missing_objects(wanted: DataFrame, listing: DataFrame, key: str = "object_name") -> DataFrame:
    """Wanted objects that the store does not list."""
    return wanted.join(listing.select(key), key, "left_anti")
