"""One query per operator, each over whole driver tables."""

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from driverdata import domain as D
from mediamart.functions import dates, json, numbers
from mediamart.functions.arrays import let
from mediamart.operators import detections, enrich, ingest, joins, quality, states, text, windows
from mediamart.plans import build, core, marts, reporting, staging
from mediamart.plans.ingest_run import Functions
from mediamart.plans.ingest_run import run as run_ingest
from mediamart.schemas import CONTRACTS, struct
from mediamart.session import shared_folder
from mediamart.sources import taxonomy
from mediamart.sources.calendar import calendar, calendar_between
from mediamart.sources.tables import LAYERS, Tables, check_contract, conform, union_evolving

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

EVENT_GAP = 21600.0  # six hours between two events of a user
EVENT_BUCKET = 86400.0


def query(fn: Query) -> Query:
    """Register ``fn`` under its name; decimals leave as doubles to compare across engines."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = fn(spark, sf_dir)
        decimals = [f.name for f in df.schema if isinstance(f.dataType, DecimalType)]
        return df.withColumns({c: F.col(c).cast("double") for c in decimals}) if decimals else df

    QUERIES[fn.__name__] = run
    return fn


def now() -> Column:
    return F.lit("2030-01-01 00:00:00").cast("timestamp")


def today() -> Column:
    return F.lit("2020-01-01").cast("date")


class Domain:
    """The models over the driver tables, each made on request."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self.raw = D.parsed_videos(spark, sf_dir)
        self.dim_date = D.dim_date(spark)
        self.core_categories = taxonomy.categories(spark)
        self.core_subcategories = taxonomy.subcategories(spark)

    def table(self, name: str) -> DataFrame:
        return D.table(self.spark, self.sf_dir, name)

    def staged(self, name: str) -> DataFrame:
        return staging.STAGING[name](self.raw)

    def core_videos(self) -> DataFrame:
        return core.core_videos(self.raw, now())

    def core_channels(self) -> DataFrame:
        return core.core_channels(self.raw, now())

    def core_playlists(self) -> DataFrame:
        return core.core_playlists(self.raw, now())

    def core_sound_features(self) -> DataFrame:
        return core.core_sound_features(self.raw)

    def core_transcript_segments(self) -> DataFrame:
        return core.core_transcript_segments(self.raw)

    def core_chapters(self) -> DataFrame:
        return core.core_chapters(self.raw, self.core_subcategories)

    def fact_video_chapters(self) -> DataFrame:
        return marts.fact_video_chapters(
            self.core_chapters(),
            self.core_subcategories,
            self.core_transcript_segments(),
            self.core_sound_features(),
            self.core_videos(),
            self.dim_date,
        )

    def fact_video_metrics(self) -> DataFrame:
        return marts.fact_video_metrics(
            self.core_videos(),
            core.core_videos_meta(self.raw),
            self.core_sound_features(),
            self.dim_date,
        )

    def fact_video_daily_snapshot(self) -> DataFrame:
        return marts.fact_video_daily_snapshot(
            D.snapshots(self.spark, self.sf_dir), self.core_videos(), self.dim_date
        )

    def dim(self, name: str) -> DataFrame:
        source = {
            "dim_channels": self.core_channels,
            "dim_playlists": self.core_playlists,
            "dim_videos": self.core_videos,
            "dim_category": lambda: self.core_categories,
            "dim_subcategory": lambda: self.core_subcategories,
        }[name]
        return marts.dimension(source(), name)

    def dims(self, *names: str) -> list[DataFrame]:
        return [self.dim(n) for n in names]


def digest(c: Column) -> Column:
    return F.md5(c.cast("binary"))


# --- sources, sinks, materialisation -------------------------------------------------------


@query
def s1_raw_scan(spark, sf):
    return D.raw_videos(spark, sf).select(
        "channel_id",
        "channel_name",
        "playlist_id",
        "playlist_title",
        "video_id",
        "video_title",
        "video_url",
        "video_meta_json",
        "process_status",
        F.to_date("created_at").alias("created_on"),
        F.to_date("meta_updated_at").alias("meta_updated_on"),
    )


@query
def s2_taxonomy_parts(spark, sf):
    """Constant relations joined to parts: every size stands for a subcategory."""
    parts = D.table(spark, sf, "part").groupBy((F.col("p_size") % 50 + 1).alias("subcategory_id")).count()
    labels = taxonomy.subcategories(spark).join(F.broadcast(taxonomy.categories(spark)), "category_id")
    return parts.join(F.broadcast(labels), "subcategory_id").select(
        "subcategory_id", "category_id", "main_category", "subcategory", F.col("count").alias("parts")
    )


@query
def s3_calendar(spark, sf):
    """Calendar over the range of all orders, with the orders of each day."""
    orders = D.table(spark, sf, "orders").select(F.to_date("o_orderdate").alias("date"))
    per_day = orders.groupBy("date").agg(F.count("*").alias("orders"))
    days = calendar_between(orders, "date")
    return days.join(per_day, "date", "left").withColumn("orders", F.coalesce("orders", F.lit(0)))


@query
def s5_view(spark, sf):
    Tables.view("customers_by_nation", D.table(spark, sf, "customer").groupBy("c_nationkey").count())
    nations = D.table(spark, sf, "nation")
    return (
        spark.table("customers_by_nation")
        .join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
        .select("n_name", F.col("count").alias("customers"))
    )


ROWS_PER_BUCKET = 5_000


def new_tables(spark, name: str, keyed: DataFrame | None = None) -> Tables:
    """An empty warehouse of its own, with few buckets, or as many as the rows that will be stored by
    their key need (videos in a bucket bring some fifty segments, events and chapters each)."""
    own = f"{name}_{uuid.uuid4().hex}"
    root = f"{shared_folder(spark)}/{spark.sparkContext.applicationId}/{own}"
    buckets = 8 if keyed is None else max(8, -(-keyed.count() // ROWS_PER_BUCKET))
    return Tables(spark, root, {layer: f"{layer}_{own}" for layer in LAYERS}, buckets=buckets)


_built: dict[tuple[str, str], Tables] = {}


def built(spark, sf: str) -> Tables:
    """A warehouse with all models over all documents, built once per application."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _built:
        raw = D.parsed_videos(spark, sf)
        tables = new_tables(spark, "built", raw)
        build.build_all(tables, raw, D.dim_date(spark), now())
        _built[key] = tables
    return _built[key]


def repriced(spark, sf) -> DataFrame:
    """Order rows to load: open orders at twice their price, and every order again under a
    negative key, which the table does not hold yet."""
    orders = D.table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    dearer = orders.filter("o_orderstatus = 'O'").withColumn("o_totalprice", F.col("o_totalprice") * 2)
    return dearer.unionByName(orders.withColumn("o_orderkey", -F.col("o_orderkey") - 1))


@query
def s7_upsert(spark, sf):
    """A stored table, loaded and then upserted bucket by bucket."""
    tables = new_tables(spark, "upsert")
    tables.upsert("orders", D.table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice"), ["o_orderkey"])
    return tables.upsert("orders", repriced(spark, sf), ["o_orderkey"])


@query
def s8_schema_evolution(spark, sf):
    """Updates bring a column the table lacks, and lack one that it has."""
    target = D.table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    updates = D.table(spark, sf, "lineitem").groupBy((-F.col("l_orderkey") - 1).alias("o_orderkey")).agg(
        F.max("l_linestatus").alias("o_orderstatus"), F.count("*").alias("lines")
    )
    return union_evolving(target, updates)


@query
def s9_conform(spark, sf):
    contract = struct(l_orderkey="string", l_linenumber="short", l_quantity="int", l_extendedprice="seconds")
    lines = D.table(spark, sf, "lineitem").select(*contract.names)
    rows = conform(lines, contract)
    return rows.groupBy("l_linenumber").agg(
        F.count("*").alias("lines"),
        F.sum("l_quantity").alias("quantity"),
        F.sum("l_extendedprice").alias("price"),
        F.max(F.length("l_orderkey")).alias("longest_key"),
    )


@query
def s11_incremental_switch(spark, sf):
    """First run takes all customers' nations, the second only those not stored yet."""
    suppliers = D.table(spark, sf, "supplier").select(F.col("s_nationkey").alias("nation")).distinct()
    customers = D.table(spark, sf, "customer").select(F.col("c_nationkey").alias("nation"))

    def load(existing: DataFrame | None) -> DataFrame:
        return ingest.insert_absent(existing, customers, ["nation"], ["nation"])

    first = load(None).withColumn("run", F.lit("first"))
    return first.unionByName(load(suppliers).withColumn("run", F.lit("second")))


@query
def s11_incremental_build(spark, sf):
    """All models on stored tables in two runs, first the labelled videos and then all of them;
    the chapters fact holds the same rows as after a single run."""
    raw, days = D.parsed_videos(spark, sf), D.dim_date(spark)
    tables = new_tables(spark, "build", raw)
    labelled = D.table(spark, sf, "labels").select(F.col("doc_id").cast("string").alias("video_id"))
    build.build_all(tables, raw.join(labelled, "video_id", "left_semi"), days, now())
    build.build_all(tables, raw, days, now())
    return tables.read("fact_video_chapters")


@query
def s11_calendar_extended(spark, sf):
    """All models with a calendar of three years, then with one of ten and the same raw rows: the rows of
    all three facts, counted by fact and day."""
    raw, days = D.parsed_videos(spark, sf), D.dim_date(spark)
    tables = new_tables(spark, "calendar", raw)
    build.build_all(tables, raw, days.filter("year < 2018"), now())
    build.build_all(tables, raw, days, now())
    facts = [tables.read(f).select(F.lit(f).alias("fact"), "date_id", "video_id") for f in build.FACT_INPUTS]
    rows = facts[0].unionByName(facts[1]).unionByName(facts[2])
    return rows.groupBy("fact", "date_id").agg(F.count("*").alias("n"), F.max("video_id").alias("last_video"))


@query
def s9_rejected_batch(spark, sf):
    """Suppliers as channels in two batches.  The second one comes with two names for each channel first and
    is refused; then it comes right.  What is stored has each channel once."""
    tables = new_tables(spark, "rejected")
    channels = D.table(spark, sf, "supplier").select(
        F.col("s_suppkey").cast("string").alias("channel_id"), F.col("s_name").alias("channel_name"), now().alias("created_at")
    )
    second = F.col("channel_id").cast("int") % 2 == 0
    tables.append("core_channels", channels.filter(~second))
    good = channels.filter(second)
    refused = 0
    try:
        tables.append("core_channels", good.unionByName(good.withColumn("channel_name", F.concat("channel_name", F.lit("!")))))
    except ValueError:
        refused = 1
    stored = tables.read("core_channels").count()
    tables.append("core_channels", good)
    return tables.read("core_channels").select(
        "channel_id", "channel_name", F.lit(refused).alias("refused"), F.lit(stored).cast("long").alias("stored_before")
    )


@query
def s12_artefact_json(spark, sf):
    """Struct and map artefacts serialised to JSON text."""
    orders = D.table(spark, sf, "orders")
    return orders.select(
        "o_orderkey",
        F.to_json(
            F.struct(
                F.col("o_custkey").alias("customer"),
                F.col("o_orderpriority").alias("priority"),
                F.when(F.col("o_orderstatus") == "O", F.col("o_totalprice")).alias("open_price"),
            )
        ).alias("artefact"),
    )


# --- raw-layer bookkeeping -----------------------------------------------------------------


def playlists(spark, sf) -> DataFrame:
    """Every document as a playlist whose entries are its segments; one-segment documents have
    no entry list."""
    listed = F.transform(
        let(F.split("text", " "), D.sentences),
        lambda s, i: F.struct(
            F.concat_ws("-", F.col("doc_id").cast("string"), i.cast("string")).alias("id"),
            s["text"].alias("title"),
            F.concat(F.lit("https://media.example/"), i.cast("string")).alias("url"),
            F.col("source").alias("channel_id"),
            F.upper("source").alias("channel"),
        ),
    )
    return D.words(spark, sf).select(
        F.col("doc_id").cast("string").alias("id"),
        F.concat(F.lit("List "), F.col("doc_id").cast("string")).alias("title"),
        F.when(F.size("words") > 10, listed).alias("entries"),
    )


@query
def r1_flatten_playlists(spark, sf):
    return ingest.flatten_playlists(playlists(spark, sf))


@query
def r2_project_meta(spark, sf):
    """Two of five keys may be absent."""
    o = D.table(spark, sf, "orders")
    fields = {
        "duration": F.col("o_orderkey") % 3000 + 600,
        "view_count": F.floor("o_totalprice"),
        "like_count": F.when(F.col("o_orderstatus") != "P", F.col("o_custkey")),
        "upload_date": F.date_format("o_orderdate", "yyyyMMdd"),
        "fps": F.lit(25),
    }
    return o.select("o_orderkey", ingest.project_meta(fields).alias("video_meta_json"))


@query
def r3_dedupe_first(spark, sf):
    lines = D.table(spark, sf, "lineitem")
    return windows.dedupe_first(
        lines, ["l_orderkey", "l_linenumber"], sorted(set(lines.columns) - {"l_orderkey", "l_linenumber"})
    )


@query
def r4_insert_absent(spark, sf):
    """Orders named by line items that are not among the finished orders."""
    stored = D.table(spark, sf, "orders").filter("o_orderstatus = 'F'").select(
        F.col("o_orderkey").alias("l_orderkey")
    )
    lines = D.table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey")
    return ingest.insert_absent(stored, lines, ["l_orderkey"], ["l_partkey", "l_suppkey"])


@query
def r5_playlist_ids(spark, sf):
    return ingest.playlist_ids(D.table(spark, sf, "documents").withColumnRenamed("lang", "playlist_id"))


@query
def r6_lookup(spark, sf):
    ids = D.table(spark, sf, "events").select(F.col("user_id").alias("o_orderkey"))
    return ingest.lookup(D.table(spark, sf, "orders"), ids, "o_orderkey").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice"
    )


def line_priority(spark, sf) -> DataFrame:
    """New priority per order, NULL where all its lines are still open."""
    lines = D.table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey"))
    return lines.agg(F.max(F.when(F.col("l_linestatus") != "O", F.col("l_returnflag"))).alias("o_orderpriority"))


@query
def r7_update_column(spark, sf):
    orders = D.table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    return ingest.update(orders, line_priority(spark, sf), "o_orderkey", "o_orderpriority")


@query
def r8_change_stamp(spark, sf):
    """Every stored row comes again with its keys in another order; open orders also changed,
    and partial ones are not stored yet.  Half of the orders hold values that are written in another way, or
    look alike and differ."""
    o = D.table(spark, sf, "orders")
    day = F.date_format("o_orderdate", "yyyyMMdd")
    views = F.floor("o_totalprice")
    case = F.col("o_orderkey") % 8
    special = [  # (stored, new): only the first and the last differ as values
        ('{"duration":"5"}', '{"duration":5}'),
        ('{"duration":5}', '{"duration":5.0}'),
        ('{"x":{"a":1,"b":[2]}}', '{"x": {"b":[2.00], "a":1}}'),
        ('{"duration":null}', '{}'),
    ]

    def either(side: int, plain: Column) -> Column:
        out = plain
        for k, pair in enumerate(special):
            out = F.when(case == k, F.lit(pair[side])).otherwise(out)
        return out

    old = o.filter("o_orderstatus <> 'P'").select(
        F.col("o_orderkey").cast("string").alias("video_id"),
        either(0, F.to_json(F.struct(views.alias("view_count"), day.alias("upload_date")))).alias("video_meta_json"),
        F.col("o_orderdate").cast("date").cast("timestamp").alias("meta_updated_at"),
    )
    seen = F.when(F.col("o_orderstatus") == "O", views + 1).otherwise(views)
    new = o.select(
        F.col("o_orderkey").cast("string").alias("video_id"),
        either(1, F.to_json(F.struct(day.alias("upload_date"), seen.alias("view_count")))).alias("video_meta_json"),
        F.lit(None).cast("timestamp").alias("meta_updated_at"),
    )
    stamped = ingest.stamp_changes(old, new, now())
    return stamped.select("video_id", F.to_date("meta_updated_at").alias("stamped_on"))


@query
def r9_default_created(spark, sf):
    o = D.table(spark, sf, "orders")
    dated = o.withColumn(
        "created_at", F.when(F.col("o_orderstatus") == "F", F.col("o_orderdate").cast("date").cast("timestamp"))
    )
    return ingest.fill_created(dated, now()).select("o_orderkey", F.to_date("created_at").alias("created_on"))


def partly_known(spark, sf) -> DataFrame:
    return D.table(spark, sf, "orders").select(
        "o_orderkey", F.when(F.col("o_orderstatus") == "F", F.col("o_orderpriority")).alias("o_orderpriority")
    )


@query
def r10_fill_missing(spark, sf):
    return ingest.fill(partly_known(spark, sf), line_priority(spark, sf), "o_orderkey", "o_orderpriority")


@query
def r10_fill_forced(spark, sf):
    return ingest.fill(
        partly_known(spark, sf), line_priority(spark, sf), "o_orderkey", "o_orderpriority", force=True
    )


def half_done(spark, sf) -> DataFrame:
    """Raw rows in all stages: some artefacts are missing, some are empty objects."""
    raw = D.raw_videos(spark, sf)
    n = F.col("video_id").cast("long")

    def lacking(c: str, absent: Column, empty: Column) -> Column:
        return F.when(absent, F.lit(None)).when(empty, F.lit("{}")).otherwise(F.col(c)).alias(c)

    changed = {
        "transcribe_json": lacking("transcribe_json", n % 7 == 1, n % 7 == 2),
        "llm_chapter_json": lacking("llm_chapter_json", n % 5 == 1, n % 5 == 2),
        "llm_classifier_json": lacking("llm_classifier_json", n % 3 == 1, F.lit(False)),
        "sound_classifier_json": lacking("sound_classifier_json", n % 11 == 1, n % 11 == 2),
        "laugh_events_json": lacking("laugh_events_json", n % 13 == 1, F.lit(False)),
        "video_url": F.when(n % 17 != 0, F.col("video_url")).alias("video_url"),
        "process_status": F.lit("new").alias("process_status"),
    }
    return raw.select(*[changed.get(c, F.col(c)) for c in raw.columns])


@query
def r11_work_flags(spark, sf):
    flagged = ingest.work_flags(half_done(spark, sf), today())
    return flagged.select("video_id", *[c for c in flagged.columns if c.startswith("needs_")])


@query
def r14_status(spark, sf):
    return ingest.set_status(half_done(spark, sf)).select("video_id", "process_status")


@query
def r15_changed_rows(spark, sf):
    """Only the status can differ; the number of changed rows decides about the next build."""
    before = half_done(spark, sf)
    after = ingest.set_status(before)
    return ingest.changed_rows(before, after).agg(F.count("*").alias("changed"))


def make_answer(kind: str):
    """Maker of a deterministic stand-in for an outside service; a video is known by the end of its
    address, one in thirteen cannot be had, and one in five has no points."""

    def make():
        def answer(prompt: str) -> str:
            if kind == "chapters":
                return '```json\n{"chapters":[{"id":0,"theme":"All","summary":"of it"},{"id":1,"theme":"End","summary":"too"}]}\n```'
            if kind == "classes":
                return '{"classifications":[{"id":0,"main_category":"x","subcategory":"Parenting","reason":"r"}]}'
            n = int(prompt.rsplit("/", 1)[1])
            if n % 13 == 0:
                raise enrich.Unavailable()
            if kind == "meta":
                return f'{{"duration":{n % 50 + 60},"like_count":1,"view_count":{n},"comment_count":0,"upload_date":"20200105"}}'
            if kind == "transcript":
                return '{"sentences":[{"text":"one","start":0.0,"end":5.0},{"text":"two","start":5.0,"end":9.0}]}'
            if n % 5 == 0:
                return "{}"
            return "{" + ",".join(f'"{t / 10}":0.9' for t in range(10, 30)) + "}"

        return answer

    return make


@query
def ingest_run(spark, sf):
    """From playlists to built tables, twice: each document is a playlist of one video.  The second run finds
    nothing changed and builds nothing."""
    tables = new_tables(spark, "ingest")
    doc = F.col("doc_id").cast("string")
    entry = F.struct(
        doc.alias("id"), doc.alias("title"), F.concat(F.lit("https://media.example/"), doc).alias("url"),
        F.col("source").alias("channel_id"), F.upper("source").alias("channel"),
    )
    lists = D.table(spark, sf, "documents").select(F.col("lang").alias("id"), F.upper("lang").alias("title"), F.array(entry).alias("entries"))
    functions = Functions(*[make_answer(k) for k in ("meta", "transcript", "points", "chapters", "classes")])
    days = D.dim_date(spark)
    first = run_ingest(tables, lists, days, functions, now())
    missed = first.skipped.groupBy("video_id").agg(F.count("*").alias("skipped"))
    second = run_ingest(tables, lists, days, functions, now())
    metrics = tables.read("fact_video_metrics").select("video_id", "view_count", "laughter_percent")
    return (
        tables.read("process_video")
        .select("video_id", "process_status", F.col("llm_chapter_json").isNotNull().alias("chapters"))
        .join(metrics, "video_id", "left")
        .join(missed, "video_id", "left")
        .withColumns({"first": F.lit(first.changed), "second": F.lit(second.changed), "built_again": F.lit(second.built is not None)})
    )


@query
def r16_playlist_urls(spark, sf):
    known = D.table(spark, sf, "documents").withColumn(
        "playlist_id", F.when(F.col("source") != "src3", F.concat_ws("-", "source", "lang"))
    )
    return ingest.playlist_urls(known)


@query
def r17_audio_keys(spark, sf):
    docs = D.table(spark, sf, "documents")
    return docs.select("doc_id", ingest.audio_key(F.col("doc_id").cast("string"), "data/audio").alias("object_name"))


@query
def r18_missing_objects(spark, sf):
    key = ingest.audio_key(F.col("doc_id").cast("string"), "data/audio").alias("object_name")
    wanted = D.table(spark, sf, "documents").select("doc_id", key)
    return ingest.missing_objects(wanted, D.table(spark, sf, "labels").select(key))


def make_stub():
    """A deterministic stand-in for a model: some items cannot be had, some answers are only
    JSON when asked a second time."""

    def answer(prompt: str) -> str:
        asked = prompt.split(text.RETRY_ERROR)[0]
        if len(asked) % 7 == 0:
            raise enrich.Unavailable()
        if len(asked) % 11 == 0 and len(asked) % 5:  # gone when it is asked again
            if prompt == asked:
                return "one moment"
            raise enrich.Unavailable()
        if len(asked) % 5 == 0:
            return "no JSON"
        if len(asked) % 3 == 0 and prompt == asked:
            return "{broken"
        return '```json\n{"n": ' + str(len(asked)) + "}\n```"

    return answer


@query
def r20_enrich(spark, sf):
    talk = D.table(spark, sf, "conversations").select(
        F.concat_ws("-", F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("key"),
        F.col("text").alias("prompt"),
    )
    return enrich.enrich(talk, make_stub, "key", "prompt")


@query
def r20_enrich_stored(spark, sf):
    """The same in stored rounds, two runs; the first may make as many calls as there are turns, so some wait."""
    tables = new_tables(spark, "answers")
    talk = D.table(spark, sf, "conversations").select(
        F.concat_ws("-", F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("key"),
        F.col("text").alias("prompt"),
    )
    n = talk.count()
    first = enrich.enrich_stored(tables, "talk", talk, make_stub, "key", "prompt", budget=n, round_calls=max(1, n // 3))
    asked = first.agg(F.sum("attempts")).first()[0]
    found = enrich.enrich_stored(tables, "talk", talk, make_stub, "key", "prompt")
    return found.withColumns({"within_budget": F.lit(asked <= n), "some_waited": F.lit(asked > 0)})


def make_splitter():
    """A stand-in for a transcriber: the sentences of a text with their place; every ninth length cannot be had."""

    def sentences(prompt: str | None) -> list[dict]:
        if prompt is None:
            return []
        if len(prompt) % 9 == 0:
            raise enrich.Unavailable()
        return [{"place": i, "text": part} for i, part in enumerate(prompt.split(". "))]

    return sentences


@query
def x1_rows_of_a_function(spark, sf):
    """A function that returns many rows per row, as a lateral join."""
    talk = D.table(spark, sf, "conversations").select(
        F.concat_ws("-", F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("key"), "text"
    )
    return enrich.explode_with(talk.withColumnRenamed("text", "prompt"), make_splitter, "key", "prompt", "place int, text string")


@query
def r19_skipped_items(spark, sf):
    results = r20_enrich(spark, sf)
    _, skipped = enrich.split_errors(results)
    return skipped.groupBy("error").agg(F.count("*").alias("items"))


# --- text artefacts ------------------------------------------------------------------------


@query
def t1_segment_map(spark, sf):
    """Sentence lists to index-keyed JSON; times are word counts over seven, so they need the
    rounding."""
    timed = F.transform(
        let(F.split("text", " "), D.sentences),
        lambda s: F.struct(
            s["text"].alias("text"), (s["start"] / 7.0).alias("start"), (s["end"] / 7.0).alias("end")
        ),
    )
    rows = text.segments_to_map(D.words(spark, sf).withColumn("sentences", timed), "sentences")
    entries = F.explode(F.from_json("transcribe_json", "map<string, struct<text: string, start: double, end: double>>"))
    return rows.select("doc_id", entries.alias("segment", "value")).select(
        "doc_id", "segment", digest(F.col("value.text")).alias("text_md5"), "value.start", "value.end"
    )


def fenced(spark, sf) -> DataFrame:
    """Conversation texts as answers: tagged fence, plain fence with a tail, open fence, none."""
    turn = F.col("turn") % 4
    body = F.col("text")
    wrapped = (
        F.when(turn == 0, F.concat(F.lit("Sure:\n```json\n"), body, F.lit("\n```\nDone.")))
        .when(turn == 1, F.concat(F.lit("```\n "), body, F.lit(" ```tail")))
        .when(turn == 2, F.concat(F.lit("``` x ```json"), body))
        .otherwise(F.concat(F.lit(" \n"), body, F.lit("\t ")))
    )
    return D.table(spark, sf, "conversations").select("conv_id", "turn", wrapped.alias("answer"))


@query
def t2_strip_fences(spark, sf):
    return fenced(spark, sf).select("conv_id", "turn", text.strip_fences(F.col("answer")).alias("body"))


def answers(spark, sf) -> DataFrame:
    """Event properties as answers; some lost their end, some are missing, and some have text, a second
    object, a bare word or the wrong quotes."""
    kind, props, n = F.col("event_type"), F.col("props"), F.col("event_id") % 10
    cut = props.substr(F.lit(1), F.length("props") - 1)
    broken = (
        F.when(n == 1, F.concat(props, F.lit(" and so on")))
        .when(n == 2, F.concat(props, props))
        .when(n == 3, F.lit('{"k":NaN}'))
        .when(n == 4, F.lit("{'k':1}"))
        .when(n == 5, F.concat(props, F.lit(',"b":{"c":1}')))
        .otherwise(props)
    )
    return D.table(spark, sf, "events").select(
        "event_id", F.when(kind == "error", cut).when(kind != "signup", broken).alias("answer")
    )


@query
def t3_split_valid_json(spark, sf):
    valid, retry = text.split_valid_json(answers(spark, sf), "answer")
    return valid.withColumn("reason", F.lit("valid")).unionByName(retry)


@query
def t4_summary_prompt(spark, sf):
    prompt = text.summary_prompt(F.col("transcribe_json"), "Find the topics:\n")
    return D.raw_videos(spark, sf).select("video_id", digest(prompt).alias("prompt_md5"))


@query
def t5_classifier_prompt(spark, sf):
    prompt = text.classifier_prompt(F.col("llm_chapter_json"), "Classify:\n")
    return D.raw_videos(spark, sf).select("video_id", digest(prompt).alias("prompt_md5"))


@query
def t6_retry_prompt(spark, sf):
    talk = D.table(spark, sf, "conversations")
    prompt = text.retry_prompt(F.lit("Ask. "), F.col("role"), F.col("text"))
    return talk.select("conv_id", "turn", prompt.alias("prompt"))


@query
def t7_chapter_ends(spark, sf):
    """Answers without ends get them from the list order and the transcript."""
    answered = D.unprocessed(spark, sf).withColumn(
        "llm_chapter_json", F.to_json(F.struct(F.col("chapter_list").alias("chapters")))
    )
    ended = text.backfill_chapter_ends(answered)
    items = F.posexplode(json.parse(F.col("llm_chapter_json"), "chapters array<struct<id: int, end_id: int>>")["chapters"])
    return ended.select("video_id", items.alias("place", "c")).select("video_id", "place", "c.id", "c.end_id")


@query
def t8_nested_labels(spark, sf):
    parts = D.table(spark, sf, "part").withColumn("place", F.col("p_type"))
    return taxonomy.nested_labels(parts, "p_brand", "place", "p_type", "types")


# --- detector points to events -------------------------------------------------------------


def laughs(spark, sf) -> DataFrame:
    """Selected points of all events of one type per user."""
    return detections.select_points(
        D.detector_points(spark, sf), label="click", min_confidence=0.02, keys=["user_id"]
    )


def event_points(spark, sf) -> DataFrame:
    """All events as points, confidence in hundredths."""
    return D.detector_points(spark, sf).withColumn("confidence", numbers.round_hundredths(F.col("confidence")))


def word_events(spark, sf, named: bool = False) -> DataFrame:
    """Events of all raw rows; ``named``: of those with an id."""
    rows = D.raw_videos(spark, sf)
    points = detections.explode_points(rows.filter("video_id IS NOT NULL") if named else rows, "sound_classifier_json")
    return detections.cluster_points(points)


@query
def a1_select_points(spark, sf):
    return laughs(spark, sf)


@query
def a2_explode_points(spark, sf):
    points = detections.explode_points(D.raw_videos(spark, sf), "sound_classifier_json")
    return detections.sort_points(points)


@query
def a3_gap_clusters(spark, sf):
    """Clusters with their unrounded aggregates (the mean to ten places)."""
    clusters = detections.gap_clusters(
        event_points(spark, sf), ["user_id"], max_gap=EVENT_GAP, bucket_seconds=EVENT_BUCKET
    )
    return clusters.withColumn("avg_confidence", F.round("avg_confidence", 10))


@query
def a5_kept_events(spark, sf):
    clusters = detections.gap_clusters(
        event_points(spark, sf), ["user_id"], max_gap=EVENT_GAP, bucket_seconds=EVENT_BUCKET
    )
    kept = detections.keep_events(clusters, min_duration=3600.0, min_avg=0.1)
    return kept.select("user_id", "start", "end", "points")


@query
def a6_numbered_events(spark, sf):
    return detections.cluster_points(
        event_points(spark, sf),
        ["user_id"],
        max_gap=EVENT_GAP,
        min_duration=3600.0,
        min_avg=0.1,
        bucket_seconds=EVENT_BUCKET,
    )


@query
def a6_word_events(spark, sf):
    """The reference thresholds on the words of all documents."""
    return word_events(spark, sf)


@query
def a7_events_payload(spark, sf):
    ids = D.table(spark, sf, "documents").select(F.col("doc_id").cast("string").alias("video_id"))
    return detections.events_payload(word_events(spark, sf, named=True), ids)


@query
def a7_events_in_row(spark, sf):
    """The same payload made inside the raw row."""
    points = D.raw_videos(spark, sf).select("video_id", "sound_classifier_json")
    return detections.add_events(points).select("video_id", "laugh_events_json")


# --- staging -------------------------------------------------------------------------------


@query
def p1_stg_videos_base(spark, sf):
    return Domain(spark, sf).staged("stg_videos_base")


@query
def p2_stg_transcripts(spark, sf):
    return Domain(spark, sf).staged("stg_transcripts")


@query
def p3_stg_chapters(spark, sf):
    return Domain(spark, sf).staged("stg_chapters")


@query
def p4_stg_classifications(spark, sf):
    return Domain(spark, sf).staged("stg_classifications")


@query
def p5_stg_sound_features(spark, sf):
    return Domain(spark, sf).staged("stg_sound_features")


@query
def p7_valid_video(spark, sf):
    o = D.table(spark, sf, "orders").select(
        F.col("o_orderkey").cast("string").alias("video_id"),
        F.when(F.col("o_orderpriority") != "1-URGENT", F.lit("c")).alias("channel_id"),
        F.when(F.col("o_orderpriority") == "2-HIGH", "").otherwise("p").alias("playlist_id"),
        F.when(F.col("o_orderstatus") == "F", ingest.FINISHED).when(F.col("o_orderstatus") == "O", "new").alias(
            "process_status"
        ),
    )
    return o.select("video_id", staging.valid_video().alias("is_valid"))


@query
def p8_valid_segment(spark, sf):
    lines = D.table(spark, sf, "lineitem").select(
        "l_orderkey",
        F.when(F.col("l_returnflag") == "A", "")
        .when(F.col("l_returnflag") == "R", "  ")
        .alias("segment_text"),
        F.when(F.col("l_tax") > 0.01, F.col("l_quantity")).alias("end_s"),
        (F.col("l_discount") * 500).alias("start_s"),
    )
    lines = lines.withColumn("segment_text", F.coalesce("segment_text", F.col("l_orderkey").cast("string")))
    return lines.groupBy(staging.valid_segment().alias("is_valid")).agg(F.count("*").alias("segments"))


@query
def p9_valid_chapter(spark, sf):
    lines = D.table(spark, sf, "lineitem").select(
        F.when(F.col("l_returnflag") == "A", "theme").alias("chapter_theme"),
        F.when(F.col("l_linestatus") == "O", "summary").alias("chapter_summary"),
        F.col("l_partkey").alias("start_segment_id"),
        F.when(F.col("l_linenumber") > 1, F.col("l_suppkey") * 20).alias("end_segment_id"),
    )
    return lines.groupBy(staging.valid_chapter().alias("is_valid")).agg(F.count("*").alias("chapters"))


@query
def p10_valid_classification(spark, sf):
    lines = D.table(spark, sf, "lineitem").select(
        F.when(F.col("l_returnflag") == "A", "r").alias("reason"),
        F.when(F.col("l_linestatus") == "O", "s").alias("subcategory"),
        F.when(F.col("l_linenumber") == 2, "m").alias("main_category"),
    )
    return lines.groupBy(staging.valid_classification().alias("is_valid")).agg(F.count("*").alias("classes"))


@query
def p11_valid_event(spark, sf):
    lines = D.table(spark, sf, "lineitem").select(
        F.when(F.col("l_linenumber") < 6, F.col("l_quantity") - 1).alias("duration_seconds"),
        F.when(F.col("l_linenumber") < 7, F.col("l_discount") * 11).alias("avg_confidence"),
        *[F.lit(None).cast("double").alias(c) for c in ("max_confidence", "start_seconds", "end_seconds")],
        F.when(F.col("l_returnflag") == "A", 1).alias("points"),
    )
    return lines.groupBy(staging.valid_event().alias("is_valid")).agg(F.count("*").alias("events"))


# --- core ----------------------------------------------------------------------------------


def stamped(df: DataFrame) -> DataFrame:
    return df.withColumn("created_at", F.to_date("created_at"))


def earlier_load(d: Domain) -> DataFrame:
    """Videos an earlier run has stored: the labelled documents."""
    return d.table("labels").select(F.col("doc_id").cast("string").alias("video_id"))


@query
def c1_core_channels(spark, sf):
    return stamped(Domain(spark, sf).core_channels())


@query
def c1_new_channels(spark, sf):
    """Channels of documents, without those an earlier run took from labelled documents."""
    d = Domain(spark, sf)
    quality_one = d.table("labels").filter("toxic = 1").select("doc_id")
    known = d.table("documents").join(quality_one, "doc_id", "left_semi").select(F.col("source").alias("channel_id"))
    return stamped(core.core_channels(d.raw, now(), known))


@query
def c2_core_playlists(spark, sf):
    return stamped(Domain(spark, sf).core_playlists())


@query
def c3_core_videos(spark, sf):
    d = Domain(spark, sf)
    return stamped(core.core_videos(d.raw, now(), earlier_load(d)))


@query
def c4_core_videos_meta(spark, sf):
    """Snapshots behind a high-water mark: labelled documents have a stored snapshot, before or
    after the new one."""
    d = Domain(spark, sf)
    stored = d.table("labels").select(
        F.col("doc_id").cast("string").alias("video_id"),
        F.date_add(D.upload_day(), F.when(F.col("quality") == 1, 7).otherwise(6)).alias("snapshot_date"),
    )
    return core.core_videos_meta(d.raw, stored)


@query
def c4_marks(spark, sf):
    """Snapshots in three loads behind stored marks: until the 12th, until the 20th with the first batch again, and
    all of them; what is stored with the number of its load, and the mark of its video."""
    tables = new_tables(spark, "marks")
    rows = tables.stage("snapshots", D.snapshots(spark, sf))
    keys, order, name = ["video_id"], "snapshot_date", "core_videos_meta"
    for day in (12, 20, 20, 31):
        marks = states.marks_of(tables, name, keys, order)
        batch = states.above_marks(rows.filter(F.dayofmonth(order) <= day), marks, keys, order)
        tables.append(name, batch)
    marks = states.marks_of(tables, name, keys, order)
    return tables.scan(name).join(marks.select("video_id", "newest"), "video_id").withColumnRenamed("_load", "load")


@query
def c5_core_transcript_segments(spark, sf):
    d = Domain(spark, sf)
    return core.core_transcript_segments(d.raw, earlier_load(d))


@query
def c6_core_sound_features(spark, sf):
    d = Domain(spark, sf)
    return core.core_sound_features(d.raw, earlier_load(d))


@query
def c7_core_chapters(spark, sf):
    return Domain(spark, sf).core_chapters()


@query
def c7_new_chapters(spark, sf):
    d = Domain(spark, sf)
    return core.core_chapters(d.raw, d.core_subcategories, earlier_load(d))


@query
def c8_chapters_per_category(spark, sf):
    """``core_categories`` and ``core_subcategories`` joined to the chapters that use them."""
    d = Domain(spark, sf)
    used = d.core_chapters().groupBy("subcategory_id").agg(F.count("*").alias("n"))
    labels = d.core_subcategories.join(F.broadcast(d.core_categories), "category_id")
    return (
        labels.join(used, "subcategory_id", "left")
        .groupBy("category_id", "main_category")
        .agg(F.count("*").alias("subcategories"), F.coalesce(F.sum("n"), F.lit(0)).alias("chapters"))
    )


# --- marts and reporting -------------------------------------------------------------------


@query
def m1_dim_channels(spark, sf):
    return Domain(spark, sf).dim("dim_channels")


@query
def m2_dim_playlists(spark, sf):
    return Domain(spark, sf).dim("dim_playlists")


@query
def m3_dim_videos(spark, sf):
    return Domain(spark, sf).dim("dim_videos")


@query
def m4_topic_dims(spark, sf):
    """``dim_category`` and ``dim_subcategory`` with the parts of each topic."""
    d = Domain(spark, sf)
    parts = d.table("part").groupBy((F.col("p_size") % 50 + 1).alias("subcategory_id")).count()
    return (
        parts.join(F.broadcast(d.core_subcategories), "subcategory_id")
        .drop("subcategory")
        .join(F.broadcast(d.dim("dim_subcategory")), "subcategory_id")
        .join(F.broadcast(d.dim("dim_category")), "category_id")
        .groupBy("main_category", "subcategory")
        .agg(F.sum("count").alias("parts"))
    )


@query
def m6_fact_video_chapters(spark, sf):
    return Domain(spark, sf).fact_video_chapters()


@query
def m7_fact_video_daily_snapshot(spark, sf):
    return Domain(spark, sf).fact_video_daily_snapshot()


@query
def m8_fact_video_metrics(spark, sf):
    return Domain(spark, sf).fact_video_metrics()


@query
def v1_chapters_metrics(spark, sf):
    d = Domain(spark, sf)
    return reporting.chapters_metrics(
        d.fact_video_chapters(),
        *d.dims("dim_category", "dim_subcategory"),
        d.dim_date,
        *d.dims("dim_videos", "dim_channels", "dim_playlists"),
    )


@query
def v2_video_metrics(spark, sf):
    d = Domain(spark, sf)
    return reporting.video_metrics(
        d.fact_video_metrics(),
        d.fact_video_chapters(),
        *d.dims("dim_category", "dim_subcategory"),
        d.dim_date,
        *d.dims("dim_videos", "dim_channels", "dim_playlists"),
    )


@query
def v3_video_daily_snapshot(spark, sf):
    d = Domain(spark, sf)
    return reporting.video_daily_snapshot(
        d.fact_video_daily_snapshot(), d.dim_date, *d.dims("dim_videos", "dim_channels", "dim_playlists")
    )


@query
def v4_dwh_statistics(spark, sf):
    d = Domain(spark, sf)
    return reporting.dwh_statistics(
        *d.dims("dim_channels", "dim_playlists", "dim_videos"), d.fact_video_metrics()
    )


@query
def v1_chapters_of_a_quarter(spark, sf):
    """The dashboard's chapters of one quarter, from stored facts: only the months of the quarter are opened."""
    tables = built(spark, sf)
    t = tables.read
    view = reporting.chapters_metrics(
        tables.scan("fact_video_chapters"), t("dim_category"), t("dim_subcategory"), t("dim_date"),
        t("dim_videos"), t("dim_channels"), t("dim_playlists"),
    )
    return view.filter("year = 2015 and quarter = 2")


@query
def m8_metrics_of_buckets(spark, sf):
    """Chapters per video beside its metrics, both facts as they were built from the bucketed core tables."""
    tables = built(spark, sf)
    chapters = tables.read("fact_video_chapters").groupBy("video_id").agg(
        F.count("*").alias("chapters"), F.max("laughter_percent").cast("double").alias("most_laughter")
    )
    metrics = tables.read("fact_video_metrics").select("video_id", "date_id", "view_count", F.col("laughter_percent").cast("double").alias("laughter_percent"))
    return metrics.join(chapters, "video_id")


@query
def v4_totals_of_states(spark, sf):
    """Totals from states per bucket: orders are loaded, a second load adds orders, a correction halves some prices; after
    each only the states of the touched buckets are computed."""
    tables = new_tables(spark, "totals")
    measures = {"n": "count(o_orderkey)", "cents": "sum(cast(round(o_totalprice * 100) as bigint))"}
    orders = D.table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    known = F.col("o_orderkey") % 3 == 0
    loads = [orders.filter(~known), orders.filter(known), orders.filter("o_orderkey % 50 = 7").withColumn("o_totalprice", F.floor("o_totalprice").cast("double"))]
    for rows in loads:
        tables.upsert("orders", rows, ["o_orderkey"])
        states.refresh_totals(tables, "orders", measures, tables.touched["orders"])
    return states.totals(tables, "orders", list(measures))


# --- joins, aggregation, windows -----------------------------------------------------------


@query
def j1_inner_join(spark, sf):
    o, c = D.table(spark, sf, "orders"), D.table(spark, sf, "customer")
    return o.join(c, o.o_custkey == c.c_custkey).select("o_orderkey", "c_name", "c_mktsegment")


@query
def j2_composite_join(spark, sf):
    """Line items that share order and number with a line of another supplier, per pair key."""
    lines = D.table(spark, sf, "lineitem")
    per_key = lines.groupBy("l_orderkey", "l_linenumber").agg(F.count("*").alias("copies"))
    return lines.join(per_key, ["l_orderkey", "l_linenumber"]).groupBy("copies").agg(
        F.count("*").alias("lines"), F.sum(F.col("l_quantity").cast("long")).alias("quantity")
    )


@query
def j3_bound_lookup(spark, sf):
    """Price of each supplier's first part and size of its last one: two roles of one lookup
    table."""
    spans = D.table(spark, sf, "lineitem").groupBy("l_suppkey").agg(
        F.min("l_partkey").alias("first_part"), F.max("l_partkey").alias("last_part")
    )
    parts = D.table(spark, sf, "part")
    return joins.bound_lookup(
        spans, parts, [], "first_part", "last_part", "p_partkey", "p_retailprice", "p_size"
    )


def days_of_errors(spark, sf) -> DataFrame:
    """For every error event the hour from it on, as a range."""
    points = D.detector_points(spark, sf)
    return points.filter("label = 'error'").select(
        "user_id", F.col("t").alias("from_t"), (F.col("t") + 3600.0).alias("to_t"), F.col("seq").alias("error_id")
    )


@query
def j4_points_in_ranges(spark, sf):
    """Events of the same user within the hour from an error on; the error itself is on the
    lower end of its range."""
    points = D.detector_points(spark, sf).select("user_id", "t", "seq", "label")
    others = points.filter("label <> 'error'").drop("label")
    return joins.points_in_ranges(
        days_of_errors(spark, sf), others, ["user_id"], "t", "from_t", "to_t", width=7200.0
    ).select("user_id", "error_id", "seq")


@query
def j4_sum_in_ranges(spark, sf):
    points = D.detector_points(spark, sf).select("user_id", "t", "seq")
    return joins.sum_in_ranges(
        days_of_errors(spark, sf), points, ["user_id"], "t", "from_t", "to_t", F.sum("seq"), "total", width=7200.0
    ).select("error_id", "total")


@query
def j5_anti_join(spark, sf):
    """Customers without an urgent open order."""
    c = D.table(spark, sf, "customer")
    o = D.table(spark, sf, "orders").filter("o_orderstatus = 'O' and o_orderpriority = '1-URGENT'")
    return c.join(o, c.c_custkey == o.o_custkey, "left_anti").select("c_custkey", "c_name")


@query
def j6_newer_than_stored(spark, sf):
    """Snapshots later than every error day of the same user."""
    errors = D.table(spark, sf, "events").filter("event_type = 'error' and value > 60")
    stored = errors.select(F.col("user_id").cast("string").alias("video_id"), F.to_date("ts").alias("snapshot_date"))
    return joins.newer_rows(D.snapshots(spark, sf), stored, ["video_id"], "snapshot_date")


@query
def j8_star_join(spark, sf):
    o, c = D.table(spark, sf, "orders"), D.table(spark, sf, "customer")
    n, r = D.table(spark, sf, "nation"), D.table(spark, sf, "region")
    return (
        o.join(c, o.o_custkey == c.c_custkey)
        .join(n, c.c_nationkey == n.n_nationkey)
        .join(r, n.n_regionkey == r.r_regionkey)
        .groupBy("r_name", "n_name", "o_orderstatus")
        .agg(F.count("*").alias("orders"), F.sum(numbers.exact_decimal(F.col("o_totalprice"))).alias("revenue"))
        .withColumn("revenue", F.col("revenue").cast("decimal(18,2)"))
    )


@query
def j10_date_key_join(spark, sf):
    """Events and orders by day of a calendar that holds them all."""
    days = calendar(spark, "1992-01-01", "2024-12-31").select("date_id", "date", "is_weekend")
    lines = D.table(spark, sf, "events").select(F.to_date("ts").alias("date"), "user_id")
    orders = D.table(spark, sf, "orders").select(F.to_date("o_orderdate").alias("date"), F.col("o_custkey").alias("user_id"))
    both = lines.unionByName(orders)
    return both.join(days, "date").groupBy("date_id", "is_weekend").agg(
        F.count("*").alias("n"), F.max("user_id").alias("highest")
    )


@query
def g2_laughter_seconds(spark, sf):
    return marts.laughter_seconds(Domain(spark, sf).core_sound_features())


@query
def g3_null_sums(spark, sf):
    """A group of NULLs stays NULL; integer sums widen."""
    lines = D.table(spark, sf, "lineitem")
    return lines.groupBy("l_returnflag", "l_linenumber").agg(
        F.sum(F.when(F.col("l_returnflag") != "N", F.col("l_linenumber"))).alias("total"),
        F.sum(numbers.exact_decimal(F.col("l_extendedprice"))).cast("decimal(18,2)").alias("price"),
    )


@query
def g5_totals(spark, sf):
    lines = D.table(spark, sf, "lineitem")
    return lines.agg(
        F.count("l_orderkey").alias("lines"), F.expr("sum(cast(l_quantity as bigint)) div 3600").alias("hours")
    )


@query
def g6_distinct(spark, sf):
    return D.table(spark, sf, "lineitem").select("l_returnflag", "l_linestatus", "l_linenumber").distinct()


@query
def w1_deltas(spark, sf):
    return windows.deltas(
        D.snapshots(spark, sf),
        ["video_id"],
        "snapshot_date",
        {"view_count": "views", "like_count": "likes", "comment_count": "comments"},
    )


@query
def w1_late_snapshots(spark, sf):
    """Two days of snapshots come late: the deltas of all other days are stored, and those of the late rows and of
    the rows behind them are patched."""
    tables = new_tables(spark, "late")
    columns = {"view_count": "views", "like_count": "likes", "comment_count": "comments"}
    everything = tables.stage("snapshots", D.snapshots(spark, sf))
    is_late = F.dayofmonth("snapshot_date").isin(9, 10)
    early, late = everything.filter(~is_late), everything.filter(is_late)
    key = ["video_id", "snapshot_date"]
    tables.upsert("deltas", windows.deltas(early, ["video_id"], "snapshot_date", columns), key)
    return tables.upsert("deltas", windows.patched_deltas(early, late, ["video_id"], "snapshot_date", columns), key)


@query
def w2_latest(spark, sf):
    return windows.latest(D.snapshots(spark, sf), ["video_id"], "snapshot_date")


@query
def w2_latest_null_first(spark, sf):
    """A snapshot without a date counts as the latest."""
    undated = D.snapshots(spark, sf).withColumn(
        "snapshot_date", F.when(F.col("view_count") != 1, F.col("snapshot_date"))
    )
    first = undated.groupBy("video_id", "snapshot_date").agg(F.max("like_count").alias("like_count"))
    return windows.latest(first, ["video_id"], "snapshot_date")


@query
def w4_number_rows_null(spark, sf):
    """As ``w4_number_rows``; some users and some times are not known."""
    points = D.detector_points(spark, sf).select(
        F.when(F.col("user_id") % 7 > 0, F.col("user_id")).alias("user_id"),
        F.when(F.col("seq") % 500 > 0, F.col("t")).alias("t"),
        "seq",
    )
    numbered = windows.number_rows(points, ["user_id"], "t", F.floor(F.col("t") / EVENT_BUCKET))
    # rows without a time are interchangeable
    return numbered.select("user_id", "t", F.when(F.col("t").isNotNull(), F.col("seq")).alias("seq"), "sequence")


@query
def w4_number_rows(spark, sf):
    """Events of each user numbered in time order, one day per bucket."""
    points = D.detector_points(spark, sf).select("user_id", "t", "seq")
    return windows.number_rows(points, ["user_id"], "t", F.floor(F.col("t") / EVENT_BUCKET))


@query
def o1_sorted_chapters(spark, sf):
    return Domain(spark, sf).fact_video_chapters().orderBy("video_id", "start_s")


@query
def u1_labelled_totals(spark, sf):
    """UNION DISTINCT of labelled aggregates; two of them are the same row."""
    o = D.table(spark, sf, "orders")
    c = D.table(spark, sf, "customer")
    rows = [
        o.agg(F.count("o_orderkey").alias("total")).withColumn("label", F.lit("orders")),
        o.agg(F.count("*").alias("total")).withColumn("label", F.lit("orders")),
        c.agg(F.count("c_custkey").alias("total")).withColumn("label", F.lit("customers")),
    ]
    return rows[0].unionByName(rows[1]).unionByName(rows[2]).distinct()


# --- scalar functions ----------------------------------------------------------------------


@query
def f1_text_functions(spark, sf):
    """trim, coalesce, CASE, null tests and IS DISTINCT FROM."""
    c = D.table(spark, sf, "customer")
    nation = F.when(F.col("c_nationkey") > 4, F.col("c_nationkey"))
    return c.select(
        "c_custkey",
        F.trim(F.concat(F.lit("  "), "c_name", F.lit("\t "))).alias("name"),
        F.coalesce(nation.cast("double"), F.col("c_acctbal")).alias("value"),
        F.when(nation.isNull(), "none").when(nation < 10, "low").otherwise("high").alias("kind"),
        nation.isNotNull().alias("known"),
        (~nation.eqNullSafe(F.col("c_nationkey"))).alias("differs"),
    )


@query
def f6_json_members(spark, sf):
    events = D.table(spark, sf, "events")
    parsed = json.parse(F.col("props"), "k string, missing string")
    return events.select(
        "event_id", json.number(parsed["k"], "int").alias("k"), parsed["missing"].alias("missing")
    )


@query
def f10_casts(spark, sf):
    orders = D.table(spark, sf, "orders")
    compact = F.date_format("o_orderdate", "yyyyMMdd")
    iso = F.date_format("o_orderdate", "yyyy-MM-dd")
    return orders.select(
        "o_orderkey",
        json.number(F.col("o_custkey").cast("string"), "int").alias("customer"),
        json.number(F.col("o_totalprice").cast("string"), "double").alias("price"),
        json.compact_date(F.when(F.col("o_orderstatus") == "F", compact).otherwise(iso)).alias("day"),
    )


@query
def f13_round_half_even(spark, sf):
    lines = D.table(spark, sf, "lineitem")
    value = F.col("l_extendedprice") / 8.0
    return lines.groupBy("l_returnflag", "l_linenumber", numbers.round_half_even(value).alias("rounded")).agg(
        F.count("*").alias("lines")
    )


@query
def f14_round_half_up(spark, sf):
    lines = D.table(spark, sf, "lineitem")
    value = F.col("l_extendedprice") / F.col("l_quantity") / 3.0
    return lines.groupBy(
        "l_returnflag",
        numbers.round_half_up(value, 1).alias("tenths"),
        numbers.round_half_up(value / 10.0, 2).alias("hundredths"),
    ).agg(F.count("*").alias("lines"))


@query
def f15_percent(spark, sf):
    orders = D.table(spark, sf, "orders")
    lines = D.table(spark, sf, "lineitem").groupBy("l_orderkey").agg(
        F.sum(numbers.exact_decimal(F.col("l_extendedprice"))).alias("part")
    )
    return orders.join(lines, orders.o_orderkey == lines.l_orderkey).select(
        "o_orderkey", numbers.percent(F.col("part"), F.col("o_totalprice")).alias("share")
    )


@query
def f16_clock(spark, sf):
    orders = D.table(spark, sf, "orders")
    seconds = F.when(F.col("o_orderstatus") != "P", F.floor("o_totalprice").cast("int"))
    return orders.select("o_orderkey", dates.clock(seconds).alias("duration_hms"))


@query
def f25_non_empty_json(spark, sf):
    kind = F.col("event_type")
    value = (
        F.when(kind == "click", F.lit("{}"))
        .when(kind == "error", F.lit('{"events":[]}'))
        .when(kind == "view", F.lit("[1]"))
        .when(kind == "signup", F.lit(None))
        .otherwise(F.col("props"))
    )
    return D.table(spark, sf, "events").select("event_id", json.non_empty(value).alias("filled"))


@query
def f26_round_hundredths(spark, sf):
    lines = D.table(spark, sf, "lineitem")
    return lines.groupBy(numbers.round_hundredths(F.col("l_extendedprice") / 7000.0).alias("rounded")).agg(
        F.count("*").alias("lines")
    )


# --- data quality --------------------------------------------------------------------------


@query
def q1_not_null(spark, sf):
    orders = D.table(spark, sf, "orders").withColumn(
        "checked", F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus"))
    )
    return quality.not_null(orders, ["checked", "o_orderkey"], "orders")


@query
def q2_unique(spark, sf):
    return quality.unique(D.table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"], "lineitem")


@query
def q3_equal_rowcount(spark, sf):
    d = Domain(spark, sf)
    return quality.equal_rowcount(d.core_chapters(), d.staged("stg_chapters"), "core_chapters", "stg_chapters")


@query
def q4_primary_key(spark, sf):
    lines = D.table(spark, sf, "lineitem").withColumn(
        "number", F.when(F.col("l_linenumber") != 7, F.col("l_linenumber"))
    )
    return quality.primary_key(lines, ["l_orderkey", "number"], "lineitem")


@query
def q4_stored_keys(spark, sf):
    """Orders in two loads, then a batch of line numbers as keys of which some are stored: it is refused, and its
    rows with stored keys are the result."""
    tables = new_tables(spark, "keys")
    keys = ["o_orderkey"]
    orders = D.table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    guard = states.KeyGuard(tables, "orders", keys)
    for part in (0, 1):
        guard.append(orders.filter(F.col("o_orderkey") % 2 == part))
    key = F.when(F.col("l_linenumber") == 7, F.col("l_orderkey")).otherwise(-F.col("l_orderkey") - F.col("l_linenumber"))
    batch = D.table(spark, sf, "lineitem").select(key.alias("o_orderkey"), F.col("l_linestatus").alias("o_orderstatus"), "l_partkey")
    refused = 0
    try:
        guard.append(batch)
    except ValueError:
        refused = 1
    stored = tables.read("orders").count()
    return guard.repeats(batch).withColumns({"refused": F.lit(refused), "stored": F.lit(stored).cast("long")})


@query
def q5_foreign_key(spark, sf):
    finished = D.table(spark, sf, "orders").filter("o_orderstatus = 'F'")
    return quality.foreign_key(
        D.table(spark, sf, "lineitem"), ["l_orderkey"], finished, ["o_orderkey"], "lineitem", "orders"
    )


@query
def q6_composite_foreign_key(spark, sf):
    lines = D.table(spark, sf, "lineitem")
    returned = lines.filter("l_returnflag = 'R'").select("l_orderkey", "l_suppkey")
    return quality.foreign_key(
        lines, ["l_orderkey", "l_suppkey"], returned, ["l_orderkey", "l_suppkey"], "lineitem", "returned"
    )


@query
def q7_contract(spark, sf):
    """Differences of the stored shape from the declared one, with the rows behind it."""
    videos = Domain(spark, sf).staged("stg_videos_base")
    found = check_contract(videos, CONTRACTS["core_videos"])
    return videos.agg(F.count("*").alias("rows")).withColumn("differences", F.lit(len(found)))


@query
def q8_report(spark, sf):
    """All declared checks of the core tables in one report."""
    d = Domain(spark, sf)
    built = {
        "core_channels": d.core_channels(),
        "core_videos": d.core_videos(),
        "core_transcript_segments": d.core_transcript_segments(),
        "core_chapters": d.core_chapters(),
        "stg_chapters": d.staged("stg_chapters"),
    }
    return quality.run_checks(quality.declared_checks(built), fail=False)
