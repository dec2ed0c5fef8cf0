"""JSON helpers.  Leaf fields are declared STRING and cast afterwards, because quoted
numbers ("5") and bare ones (5) are both legal in the artefacts.

``parse``, ``entries`` and ``records`` read JSON text; the ``_of`` forms of them read a column of a table,
which may be text or VARIANT, that is text parsed once when it was stored."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import VariantType

STRICT = {"mode": "FAILFAST"}


def non_empty(c: Column) -> Column:
    """True for a JSON object with at least one member; NULL and ``{}`` are empty."""
    return F.coalesce(F.size(F.json_object_keys(c)), F.lit(0)) > 0


def parse(c: Column, schema: str) -> Column:
    """Parse JSON strictly: malformed text fails the query instead of turning into NULLs."""
    return F.from_json(c, schema, STRICT)


def entries(c: Column, value: str) -> Column:
    """The members of a JSON object as ``array<struct<key, value>>``, ``value`` being the type
    of the values.  Of a repeated key the last member counts under the session settings of
    ``mediamart.session``; under Spark's default a repeated key is an error."""
    return F.map_entries(F.map_from_entries(F.map_entries(parse(c, f"map<string, {value}>"))))


def records(c: Column, member: str, fields: str) -> Column:
    """The array of records under ``member``; anything but an array there is an error."""
    return parse(c, f"{member} array<struct<{fields}>>")[member]


# Measures of the artefacts; of a VARIANT they are read as numbers, without their text in between.  Integers stay text, so that
# 5.0 is no integer in either form.
MEASURES = ("start", "end", "start_seconds", "end_seconds", "duration_seconds", "avg_confidence", "max_confidence")


def _typed(fields: str) -> str:
    """``fields`` with the measures as DOUBLE."""
    named = [f.split(":") if ":" in f else f.split() for f in fields.split(",")]
    return ", ".join(f"{n.strip()}: {'double' if n.strip() in MEASURES else kind.strip()}" for n, kind in named)


def is_variant(df: DataFrame, column: str) -> bool:
    return isinstance(df.schema[column].dataType, VariantType)


def parse_of(df: DataFrame, column: str, fields: str) -> Column:
    """An object as ``struct<fields>``."""
    if is_variant(df, column):
        return F.variant_get(df[column], "$", f"struct<{_typed(fields)}>")
    return parse(df[column], fields)


def entries_of(df: DataFrame, column: str, fields: str) -> Column:
    """The members of an object as ``array<struct<key, value>>``, each value a record."""
    if is_variant(df, column):
        return F.map_entries(F.variant_get(df[column], "$", f"map<string, struct<{_typed(fields)}>>"))
    return entries(df[column], f"struct<{fields}>")


def records_of(df: DataFrame, column: str, member: str, fields: str) -> Column:
    """The array of records under ``member``; anything but an array there is an error."""
    if is_variant(df, column):
        return F.variant_get(df[column], f"$.{member}", f"array<struct<{_typed(fields)}>>")
    return records(df[column], member, fields)


def number(c: Column, kind: str) -> Column:
    """Text to ``kind`` (int or double); bad text is an error under ANSI mode."""
    return c.cast(kind)


def compact_date(c: Column) -> Column:
    """``YYYYMMDD`` or ISO text to DATE."""
    return F.when(c.rlike(r"^\d{8}$"), F.to_date(c, "yyyyMMdd")).otherwise(c.cast("date"))
