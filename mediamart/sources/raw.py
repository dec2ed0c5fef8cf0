"""Reading the raw table."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mediamart.schemas import ARTEFACTS, PLAYLISTS, RAW, RAW_PARSED


def read_raw(spark: SparkSession, path: str, parsed: bool = False) -> DataFrame:
    """Raw table ``process_video`` from Parquet, with the declared schema; ``parsed``: with VARIANT artefacts."""
    return spark.read.schema(RAW_PARSED if parsed else RAW).parquet(path)


def parse_artefacts(raw: DataFrame) -> DataFrame:
    """The raw rows with their JSON text as VARIANT, to be stored so; every model reads it from there.

    Malformed text is an error, and of a repeated key the last one counts (``mediamart.session``).
    """
    return raw.withColumns({name: F.parse_json(name) for name in ARTEFACTS}).select(*RAW.names)


def id_slices(bounds: list[str]) -> list[str]:
    """Conditions in plain SQL that split the ids at ``bounds``; each row fulfils exactly one, one without an id the first."""
    text = ["'" + b.replace("'", "''") + "'" for b in sorted(set(bounds))]
    if not text:
        return ["1 = 1"]
    inner = [f"video_id >= {a} AND video_id < {b}" for a, b in zip(text, text[1:])]
    return [f"video_id IS NULL OR video_id < {text[0]}", *inner, f"video_id >= {text[-1]}"]


def read_raw_jdbc(spark: SparkSession, url: str, table: str, bounds: list[str], **options: str) -> DataFrame:
    """Raw table from a relational database, one parallel read per slice of ids.

    ``bounds``: ids at which to cut, for instance every hundred-thousandth one.  The conditions use
    comparisons only, so any database can evaluate them, and by its index on the id.
    """
    slices = id_slices(bounds)
    return spark.read.jdbc(url, table, predicates=slices, properties=options).select(*RAW.names)


def read_playlists(spark: SparkSession, path: str) -> DataFrame:
    """Playlist extracts (JSON lines), with the declared schema."""
    return spark.read.schema(PLAYLISTS).json(path)
