"""Transcript and topic artefacts.  All of them work inside one row: no shuffle."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mediamart.functions.arrays import let
from mediamart.functions.json import entries, parse
from mediamart.functions.numbers import round_half_even
from mediamart.schemas import CHAPTER_FIELDS, SEGMENT_FIELDS

# The fence marks that models put around JSON, and the wording of a retry.
FENCE = "```"
RETRY_ERROR = "Your previous response had a JSON formatting error: "
RETRY_ANSWER = ".\n Here is the invalid response you provided:\n\n "
RETRY_REQUEST = " \n\n Please correct the JSON and provide the full, valid JSON object."

EDGE_SPACE = r"(?U)^\s+|\s+$"
# What lies between the first json-tagged fence (else the first plain one) and the next fence; the
# same pattern for Spark and for a worker.
FENCED = r"(?s)^(?:.*?```json|(?!.*```json).*?```)(.*?)(?:```|(?!.))"


def segments_map(sentences: Column) -> Column:
    """``array<struct<text, start, end>>`` to JSON keyed by index, times to two places."""
    entries = F.transform(
        sentences,
        lambda s, i: F.struct(
            i.cast("string").alias("key"),
            F.struct(
                s["text"].alias("text"),
                round_half_even(s["start"]).alias("start"),
                round_half_even(s["end"]).alias("end"),
            ).alias("value"),
        ),
    )
    return F.to_json(F.map_from_entries(entries))


def segments_to_map(df: DataFrame, sentences: str, name: str = "transcribe_json") -> DataFrame:
    return df.withColumn(name, segments_map(F.col(sentences)))


def strip_fences(text: Column) -> Column:
    """The text between the first json-tagged fence (else the first plain one) and the next
    fence, without white space around it; the whole text when there is no fence."""

    body = F.when(F.contains(text, F.lit(FENCE)), F.regexp_extract(text, FENCED, 1)).otherwise(text)
    return F.regexp_replace(body, EDGE_SPACE, "")


def is_json(text: Column) -> Column:
    """True for one JSON value and nothing else, false for anything else and for NULL.

    The parser stops after the first value, so the text is parsed a second time as a member of an
    object whose last key must then still be there.
    """
    wrapped = F.concat(F.lit('{"a":'), text, F.lit(',"b":0}'))
    whole = F.json_object_keys(wrapped).eqNullSafe(F.array(F.lit("a"), F.lit("b")))
    return F.try_parse_json(text).isNotNull() & F.try_parse_json(wrapped).isNotNull() & whole


def split_valid_json(df: DataFrame, column: str) -> tuple[DataFrame, DataFrame]:
    """Rows whose text is JSON, and the others with the reason, to be asked again."""
    valid = df.filter(is_json(F.col(column)))
    retry = df.filter(~is_json(F.col(column))).withColumn(
        "reason", F.when(F.col(column).isNull(), "no answer").otherwise("not valid JSON")
    )
    return valid, retry


def summary_prompt(transcript: Column, template: str) -> Column:
    """Template plus the segments with their text only."""
    texts = F.transform(
        entries(transcript, f"struct<{SEGMENT_FIELDS}>"),
        lambda s: F.struct(s["key"], F.struct(s["value"]["text"].alias("text"))),
    )
    return F.concat(F.lit(template), F.to_json(F.map_from_entries(texts)))


def classifier_prompt(chapters: Column, template: str) -> Column:
    """Template plus the chapters without their ends; a missing list counts as empty."""
    listed = parse(chapters, f"chapters array<struct<{CHAPTER_FIELDS}>>")["chapters"]
    trimmed = F.transform(
        F.coalesce(listed, F.from_json(F.lit("[]"), f"array<struct<{CHAPTER_FIELDS}>>")),
        lambda c: F.struct(
            c["id"].cast("int").alias("id"), c["theme"].alias("theme"), c["summary"].alias("summary")
        ),
    )
    return F.concat(F.lit(template), F.to_json(F.struct(trimmed.alias("chapters"))))


def retry_prompt(prompt: Column, error: Column, text: Column) -> Column:
    """The original prompt with the error and the answer that caused it."""
    return F.concat(prompt, F.lit(RETRY_ERROR), error, F.lit(RETRY_ANSWER), text, F.lit(RETRY_REQUEST))


def last_segment(transcript: Column) -> Column:
    """Highest segment index of a transcript artefact, 0 when it has none."""
    keys = F.transform(F.json_object_keys(transcript), lambda k: k.cast("int"))
    return F.coalesce(F.array_max(keys), F.lit(0))


def chapter_ends(chapters: Column, last: Column) -> Column:
    """Give every chapter the segment before its successor in list order as its end, and the
    last chapter the segment ``last``.  ``chapters`` is an array of structs with ``id``."""

    def ended(both: Column) -> Column:
        listed = both["listed"]
        return F.transform(
            listed,
            lambda c, i: F.struct(
                c["id"].alias("id"),
                F.coalesce(F.get(listed, i + 1)["id"] - 1, both["last"]).alias("end_id"),
                c["theme"].alias("theme"),
                c["summary"].alias("summary"),
            ),
        )

    return let(F.struct(chapters.alias("listed"), last.alias("last")), ended)


def backfill_chapter_ends(
    df: DataFrame,
    chapters: str = "llm_chapter_json",
    transcript: str = "transcribe_json",
) -> DataFrame:
    """Add ``end_id`` to the chapters artefact, from the transcript artefact of the same row."""
    listed = parse(F.col(chapters), f"chapters array<struct<{CHAPTER_FIELDS}>>")["chapters"]
    typed = F.transform(
        listed,
        lambda c: F.struct(
            c["id"].cast("int").alias("id"), c["theme"].alias("theme"), c["summary"].alias("summary")
        ),
    )
    ended = let(chapter_ends(typed, last_segment(F.col(transcript))), lambda e: F.when(
        e.isNotNull(), F.to_json(F.struct(e.alias("chapters")))
    ))
    return df.withColumn(chapters, F.coalesce(ended, F.col(chapters)))
