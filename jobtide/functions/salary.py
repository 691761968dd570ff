"""Salary labels and amounts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from jobtide import fixed
from jobtide.schemas import AMOUNT

# Midpoint of two AMOUNTs: one more digit on both sides of the point keeps it exact.
MIDPOINT = "decimal(20,5)"


def any_bound(low: Column, high: Column) -> Column:
    return low.isNotNull() | high.isNotNull()


def text_label(text: Column) -> Column:
    return F.when(text.isNotNull(), fixed.TEXT_ONLY).otherwise(fixed.MISSING)


def usd_label(low: Column, high: Column) -> Column:
    return F.when(any_bound(low, high), fixed.STRUCTURED_USD).otherwise(fixed.MISSING)


def converted_label(low: Column, high: Column, currency: Column, rate: Column) -> Column:
    return (
        F.when(~any_bound(low, high) | rate.isNull(), fixed.MISSING)
        .when(currency == "USD", fixed.STRUCTURED_USD)
        .otherwise(fixed.STRUCTURED_CONVERTED)
    )


def whole_dollars(amount: Column, rate: Column) -> Column:
    """Converted amount rounded to whole dollars, halves away from zero."""
    return F.round(amount * rate).cast(AMOUNT)


def midpoint(low: Column, high: Column) -> Column:
    """Middle of the range, or whichever bound exists."""
    return F.coalesce(((low + high) / 2).cast(MIDPOINT), low.cast(MIDPOINT), high.cast(MIDPOINT))
