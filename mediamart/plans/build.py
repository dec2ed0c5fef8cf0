"""Build order of all models on stored tables."""

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mediamart.operators.ingest import FINISHED
from mediamart.operators.quality import declared_checks, run_checks
from mediamart.operators.states import marks_of
from mediamart.plans import core, marts, reporting
from mediamart.plans.staging import STAGING
from mediamart.schemas import UPSERT_KEYS
from mediamart.session import stored_partitioning
from mediamart.sources import taxonomy
from mediamart.sources.tables import Tables

# fact -> the core tables whose new rows can change it
FACT_INPUTS = {
    "fact_video_chapters": ["core_chapters", "core_transcript_segments", "core_sound_features", "core_videos"],
    "fact_video_daily_snapshot": ["core_videos_meta", "core_videos"],
    "fact_video_metrics": ["core_videos", "core_videos_meta", "core_sound_features"],
}

DIMENSIONS = {
    "dim_channels": "core_channels",
    "dim_playlists": "core_playlists",
    "dim_videos": "core_videos",
    "dim_category": "core_categories",
    "dim_subcategory": "core_subcategories",
}


def side_by_side(spark: SparkSession, *jobs: Callable[[], object]) -> None:
    """Run independent jobs at the same time, so that small ones do not wait for large ones;
    the first error is raised after all have ended."""
    with ThreadPoolExecutor(len(jobs)) as pool:
        for running in [pool.submit(inheritable_thread_target(spark)(job)) for job in jobs]:
            running.result()


def build_staging(raw: DataFrame) -> dict[str, DataFrame]:
    """Staging views; nothing is computed."""
    return {name: Tables.view(name, model(raw)) for name, model in STAGING.items()}


def new_videos(tables: Tables, raw: DataFrame, name: str) -> DataFrame:
    """Raw rows of finished videos that the core table ``name`` does not hold yet.

    The missing ids are found on the id column alone and stored; a stored list has a known
    size, so Spark broadcasts it when it is small, and the wide raw rows are not shuffled.
    """
    old = tables.read(name)
    if old is None:
        return raw
    finished = raw.filter(F.col("process_status") == FINISHED).select("video_id")
    ids = tables.stage(f"unseen_{name}", core.unseen(finished, old, ["video_id"]))
    return raw.join(ids, "video_id", "left_semi")


def build_core(tables: Tables, raw: DataFrame, now: Column) -> list[str]:
    """Append the new rows to each core table; returns the names of the tables."""
    tables.replace("core_categories", taxonomy.categories(tables.spark))
    topics = tables.replace("core_subcategories", taxonomy.subcategories(tables.spark))
    new: dict[str, Callable[[DataFrame], DataFrame]] = {
        "core_videos": lambda rows: core.core_videos(rows, now),
        "core_transcript_segments": core.core_transcript_segments,
        "core_sound_features": core.core_sound_features,
        "core_chapters": lambda rows: core.core_chapters(rows, topics),
    }
    other = {
        "core_channels": lambda old: core.core_channels(raw, now, old),
        "core_playlists": lambda old: core.core_playlists(raw, now, old),
    }

    def append_snapshots() -> None:
        """Reads the marks and the batch, not the stored snapshots."""
        marks = marks_of(tables, "core_videos_meta", ["video_id"], "snapshot_date")
        tables.append("core_videos_meta", core.core_videos_meta(raw, marks=marks))
        marks_of(tables, "core_videos_meta", ["video_id"], "snapshot_date")

    side_by_side(
        tables.spark,
        *[lambda n=n, model=m: tables.append(n, model(new_videos(tables, raw, n))) for n, m in new.items()],
        *[lambda n=n, model=m: tables.append(n, model(tables.read(n))) for n, m in other.items()],
        append_snapshots,
    )
    return [*new, *other, "core_videos_meta"]


def unbuilt(tables: Tables, names: list[str]) -> dict[str, DataFrame]:
    """Core rows that no finished mart build has seen yet.

    The load numbers a finished build has read are kept in ``process_builds``; a build that
    dies half-way leaves them as they were, so the next one picks up the same rows again.
    """
    state = tables.read("process_builds")
    seen = {r.table: r.number for r in state.collect()} if state is not None else {}  # a row per core table
    return {name: tables.read_after(name, seen.get(name, 0)) for name in names}


def mark_built(tables: Tables, names: list[str]) -> None:
    rows = [(name, tables.last_number(name)) for name in names]
    tables.replace("process_built_days", tables.read("dim_date").select("date_id", "date"))
    tables.replace("process_built_topics", tables.read("core_subcategories"))
    tables.replace("process_builds", tables.spark.createDataFrame(rows, "table string, number int"))


def fact_rows(read: Callable[[str], DataFrame], fact: str, ids: DataFrame | None) -> DataFrame:
    """Rows of one fact; ``ids`` limits them to the videos it names (None for all)."""

    def of_videos(name: str) -> DataFrame:
        return read(name) if ids is None else read(name).join(ids, "video_id", "left_semi")

    if fact == "fact_video_chapters":
        return marts.fact_video_chapters(
            of_videos("core_chapters"),
            read("core_subcategories"),
            of_videos("core_transcript_segments"),
            of_videos("core_sound_features"),
            of_videos("core_videos"),
            read("dim_date"),
        )
    if fact == "fact_video_daily_snapshot":
        return marts.fact_video_daily_snapshot(
            of_videos("core_videos_meta"), of_videos("core_videos"), read("dim_date")
        )
    return marts.fact_video_metrics(
        of_videos("core_videos"),
        of_videos("core_videos_meta"),
        of_videos("core_sound_features"),
        read("dim_date"),
    )


def changed_rows(new: DataFrame, old: DataFrame) -> DataFrame:
    """Rows that only one of the two has."""
    rows = old.select(*new.columns)
    return new.exceptAll(rows).unionByName(rows.exceptAll(new))


def moved_videos(tables: Tables) -> dict[str, DataFrame]:
    """Per fact the videos whose dates or topics are not what the last finished build saw.

    The calendar and the taxonomy are compared with the ones it kept, so a build that died in
    between loses nothing.
    """
    moved: dict[str, DataFrame] = {}
    built = tables.read("process_built_days")
    if built is not None:
        days = tables.stage("moved_days", changed_rows(tables.read("dim_date").select("date_id", "date"), built))
        dates = days.select("date").distinct()
        videos, metas = tables.read("core_videos"), tables.read("core_videos_meta")
        uploaded = videos.join(dates, F.col("upload_date") == F.col("date"), "left_semi").select("video_id")
        moved["fact_video_chapters"] = moved["fact_video_metrics"] = uploaded
        seen = metas.join(dates, F.col("snapshot_date") == F.col("date"), "left_semi").select("video_id")
        moved["fact_video_daily_snapshot"] = seen
    built = tables.read("process_built_topics")
    if built is not None:
        topics = tables.stage("moved_topics", changed_rows(tables.read("core_subcategories"), built))
        chapters = tables.read("core_chapters").join(topics.select("subcategory_id").distinct(), "subcategory_id", "left_semi")
        moved["fact_video_chapters"] = moved["fact_video_chapters"].unionByName(chapters.select("video_id"))
    return moved


def build_marts(tables: Tables, added: dict[str, DataFrame], full: bool = False) -> None:
    """Upsert dimensions and facts.

    A fact row depends on the rows of its own video, the calendar and the taxonomy, so a fact
    that exists is recomputed for the videos that got new core rows and for those whose dates or
    topics have changed; their ids are stored once, so their number is known when the core tables
    are cut down to them.  ``full`` recomputes everything.
    """
    read = tables.read
    moved = {} if full else moved_videos(tables)

    def load_dimension(dim: str) -> None:
        source = DIMENSIONS[dim]
        rows = read(source) if full or source not in added or not tables.exists(dim) else added[source]
        tables.upsert(dim, marts.dimension(rows, dim), UPSERT_KEYS[dim])

    def load_fact(fact: str) -> None:
        ids = None
        if tables.exists(fact) and not full:
            touched = added[FACT_INPUTS[fact][0]].select("video_id")
            for source in FACT_INPUTS[fact][1:]:
                touched = touched.unionByName(added[source].select("video_id"))
            if fact in moved:
                touched = touched.unionByName(moved[fact])
            ids = tables.stage(f"touched_{fact}", touched.distinct())
        tables.upsert(fact, fact_rows(read, fact, ids), UPSERT_KEYS[fact])

    side_by_side(
        tables.spark,
        *[lambda d=d: load_dimension(d) for d in DIMENSIONS],
        *[lambda f=f: load_fact(f) for f in FACT_INPUTS],
    )


def clear_intermediates(tables: Tables, names: list[str]) -> None:
    """Drop what only the build itself reads."""
    lists = [*[f"unseen_{n}" for n in names], *[f"touched_{f}" for f in FACT_INPUTS]]
    for label in [*lists, "moved_days", "moved_topics"]:
        tables.clear(label)


def build_views(tables: Tables) -> dict[str, DataFrame]:
    """Dashboard views; nothing is computed.  Facts bring their month, by which Spark can leave out folders."""

    def t(name: str) -> DataFrame:
        return tables.scan(name) if name in FACT_INPUTS else tables.read(name)

    dims = [t(n) for n in ("dim_videos", "dim_channels", "dim_playlists")]
    topics = [t("dim_category"), t("dim_subcategory")]
    day = t("dim_date")
    built = {
        "chapters_metrics": reporting.chapters_metrics(t("fact_video_chapters"), *topics, day, *dims),
        "video_metrics": reporting.video_metrics(
            t("fact_video_metrics"), t("fact_video_chapters"), *topics, day, *dims
        ),
        "video_daily_snapshot": reporting.video_daily_snapshot(t("fact_video_daily_snapshot"), day, *dims),
        "dwh_statistics": reporting.dwh_statistics(
            t("dim_channels"), t("dim_playlists"), t("dim_videos"), t("fact_video_metrics")
        ),
    }
    return {name: Tables.view(name, df) for name, df in built.items()}


def build_all(
    tables: Tables, raw: DataFrame, calendar: DataFrame, now: Column | None = None, full: bool = False
) -> dict[str, DataFrame]:
    """Build everything behind ``raw`` and return all tables and views by name."""
    tables.replace("dim_date", calendar)
    staged = build_staging(raw)
    names = build_core(tables, raw, F.current_timestamp() if now is None else now)
    with stored_partitioning(tables.spark):
        build_marts(tables, unbuilt(tables, names), full)
    mark_built(tables, names)
    clear_intermediates(tables, names)
    stored = [*names, "dim_date", "core_categories", "core_subcategories", *UPSERT_KEYS]
    built = {name: tables.read(name) for name in stored}
    return {"process_video": raw, **staged, **built, **build_views(tables)}


def run(
    tables: Tables,
    raw: DataFrame,
    calendar: DataFrame,
    now: Column | None = None,
    full: bool = False,
    fail: bool = True,
) -> DataFrame:
    """Build everything and return the report of all checks.

    ``fail`` raises when a check finds failures, after everything has been built.
    """
    return run_checks(declared_checks(build_all(tables, raw, calendar, now, full)), fail)
