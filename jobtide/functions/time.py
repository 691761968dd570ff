"""Timestamps: everything is UTC."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from jobtide.fixed import CSV_TIMESTAMP_FORMAT


def convert(text: Column, to: str, lenient: bool = False) -> Column:
    """Cast that raises on bad input, or yields NULL when lenient."""
    return text.try_cast(to) if lenient else text.cast(to)


def utc_from_naive(text: Column, lenient: bool = False) -> Column:
    """Zone-less timestamp text read as UTC; an offset in the text is ignored."""
    naive = convert(text, "timestamp_ntz", lenient)
    return F.convert_timezone(F.lit("UTC"), F.current_timezone(), naive).cast("timestamp")


def week_start(ts: Column) -> Column:
    """Monday of the week."""
    return F.date_trunc("week", ts).cast("date")


def csv_timestamp(ts: Column) -> Column:
    return F.date_format(ts, CSV_TIMESTAMP_FORMAT)
