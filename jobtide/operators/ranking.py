"""Optional filters and top-k."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def keep_in(df: DataFrame, column: str, values: Sequence[str] | None) -> DataFrame:
    """Rows whose column is in the list; None keeps all rows, an empty list none."""
    return df if values is None else df.where(F.col(column).isin(list(values)))


def drop_in(df: DataFrame, column: str, values: Sequence[str] | DataFrame | None) -> DataFrame:
    """Rows whose column is not in the list or one-column frame; a NULL column stays."""
    if values is None:
        return df
    if isinstance(values, DataFrame):
        return df.join(values.toDF(column).distinct(), column, "left_anti")
    return df.where(~F.coalesce(F.col(column).isin(list(values)), F.lit(False)))


def top_k(df: DataFrame, measure: str, tie_break: str, k: int) -> DataFrame:
    """The k largest, ties by name."""
    return df.orderBy(F.col(measure).desc(), F.col(tie_break)).limit(k)


def known(value: str, allowed: Sequence[str], what: str) -> str:
    if value not in allowed:
        raise ValueError(f"unknown {what} {value!r}; expected one of {tuple(allowed)}")
    return value


def lookup(value: Column, table: dict[str, str]) -> Column:
    """Label of a value; NULL for values without one."""
    pairs = [F.lit(part) for pair in table.items() for part in pair]
    return F.try_element_at(F.create_map(*pairs), value)
