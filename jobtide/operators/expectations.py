"""Declarative column checks, evaluated in one aggregation per table."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Expectation:
    """A named check on one or two columns; ``unexpected`` marks the rows that break it."""

    kind: str
    columns: tuple[str, ...]
    unexpected: Column | None = None

    @property
    def column(self) -> str:
        return "/".join(self.columns)

    @property
    def is_unique(self) -> bool:
        return self.unexpected is None


def not_null(column: str) -> Expectation:
    return Expectation("expect_column_values_to_not_be_null", (column,), F.col(column).isNull())


def unique(column: str) -> Expectation:
    """Every row holding a repeated value is unexpected; NULLs are not values."""
    return Expectation("expect_column_values_to_be_unique", (column,))


def in_set(column: str, values: Sequence[str]) -> Expectation:
    return Expectation("expect_column_values_to_be_in_set", (column,), ~F.col(column).isin(list(values)))


def _bound(value: object) -> Column:
    if isinstance(value, dt.datetime) and value.tzinfo is not None:
        # Epoch microseconds: the literal must not depend on the zone of the driver.
        micros = (value - dt.datetime(1970, 1, 1, tzinfo=dt.UTC)) // dt.timedelta(microseconds=1)
        return F.timestamp_micros(F.lit(micros))
    return F.lit(value)


def between(column: str, low: object = None, high: object = None) -> Expectation:
    """Within the given bounds, both inclusive and either optional; NULL passes."""
    outside = []
    if low is not None:
        outside.append(F.col(column) < _bound(low))
    if high is not None:
        outside.append(F.col(column) > _bound(high))
    if not outside:
        raise ValueError("between needs at least one bound")
    return Expectation(
        "expect_column_values_to_be_between", (column,), reduce(lambda a, b: a | b, outside)
    )


def pair_equal(left: str, right: str) -> Expectation:
    """Equal values; two NULLs are equal, one NULL is not."""
    return Expectation(
        "expect_column_pair_values_to_be_equal",
        (left, right),
        ~F.col(left).eqNullSafe(F.col(right)),
    )


def not_below(upper: str, lower: str) -> Expectation:
    """Upper bound at least the lower one; rows with a missing bound pass."""
    return Expectation(
        "expect_column_pair_values_a_to_be_greater_than_b",
        (upper, lower),
        F.col(upper) < F.col(lower),
    )


RESULT = (
    "struct<seq: int, expectation: string, column_name: string, "
    "unexpected_count: bigint, error: string>"
)


def _result(seq: int, expectation: Expectation, count: Column, error: str | None = None) -> Column:
    return F.struct(
        F.lit(seq).alias("seq"),
        F.lit(expectation.kind).alias("expectation"),
        F.lit(expectation.column).alias("column_name"),
        count.cast("bigint").alias("unexpected_count"),
        F.lit(error).cast("string").alias("error"),
    )


def _repeated() -> Column:
    repeated = F.col("_key").isNotNull() & (F.col("_rows") > 1)
    return F.coalesce(F.sum(F.when(repeated, F.col("_rows"))), F.lit(0))


def evaluate(df: DataFrame, suite: Sequence[Expectation]) -> DataFrame:
    """One row per expectation: its place in the suite, unexpected row count, or why it could not run.

    The table is read once. With a uniqueness check the other counts are taken per key on the way;
    each further uniqueness check reads its own column again.
    """
    missing = [[c for c in e.columns if c not in df.columns] for e in suite]
    by_row = [(i, e) for i, e in enumerate(suite) if not missing[i] and not e.is_unique]
    uniques = [(i, e) for i, e in enumerate(suite) if not missing[i] and e.is_unique]

    counts = [F.count_if(e.unexpected).alias(f"_c{i}") for i, e in by_row]
    results = [_result(i, e, F.coalesce(F.sum(f"_c{i}"), F.lit(0))) for i, e in by_row]
    if uniques:
        first, expectation = uniques[0]
        key = F.col(expectation.columns[0]).alias("_key")
        folded = df.groupBy(key).agg(F.count("*").alias("_rows"), *counts)
        results.append(_result(first, expectation, _repeated()))
    else:
        folded = df.agg(F.count("*").alias("_rows"), *counts)
    for i, e in enumerate(suite):
        if missing[i]:
            results.append(_result(i, e, F.lit(None), f"column not found: {', '.join(missing[i])}"))
    rows = folded.agg(F.array(*results).cast(f"array<{RESULT}>").alias("_r"))
    frames = [rows.select(F.explode("_r").alias("_r")).select("_r.*")]
    for i, e in uniques[1:]:
        repeats = df.groupBy(F.col(e.columns[0]).alias("_key")).agg(F.count("*").alias("_rows"))
        frames.append(repeats.agg(_result(i, e, _repeated()).alias("_r")).select("_r.*"))
    return reduce(DataFrame.unionByName, frames)
