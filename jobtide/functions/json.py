"""JSON text helpers. Elements stay JSON text until parsed one by one, so one bad element loses only itself."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def list_of(text: Column, kind: str, field: str | None = None) -> Column:
    """A JSON array, or an object's list field, read as the given array type; NULL when it is no such list."""
    return F.from_json(text, kind) if field is None else F.from_json(text, f"`{field}` {kind}")[field]


def document(payload: Column) -> Column:
    """JSON text as a variant, NULL where it is no JSON. One that is too large for a variant raises."""
    # The parse stands here once: repeated in a condition, it would be done twice.
    lost = is_object(payload) | F.json_array_length(payload).isNotNull()
    return F.coalesce(F.try_parse_json(payload), F.when(lost, F.raise_error(F.lit("a payload is too large for a variant")).cast("variant")))


def document_of(df: DataFrame) -> Column:
    """The stored document of a raw row; a frame without any is parsed."""
    return F.col("document") if "document" in df.columns else document(F.col("payload"))


def is_object(text: Column) -> Column:
    return F.json_object_keys(text).isNotNull()


def is_json(text: Column) -> Column:
    return is_object(text) | F.json_array_length(text).isNotNull() | F.try_parse_json(text).isNotNull()
