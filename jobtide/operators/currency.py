"""Amounts in one currency."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobtide.functions.salary import any_bound, converted_label, whole_dollars
from jobtide.operators.joins import dimension


def convert_bounds(df: DataFrame, rates: DataFrame, country: str, low: str, high: str) -> DataFrame:
    """Add currency, USD bounds and confidence label of a salary range given in local currency.

    Countries without a rate keep their row, with NULL amounts.
    """
    rate = dimension(rates, "country_code").select(
        F.col("country_code").alias("_country"),
        F.col("currency_code").alias("_currency"),
        F.col("usd_rate").alias("_rate"),
    )
    bounds = F.col(low), F.col(high)
    return (
        df.join(rate, F.col(country) == F.col("_country"), "left")
        .withColumn("salary_currency", F.when(any_bound(*bounds), F.col("_currency")))
        .withColumn("salary_min_usd", whole_dollars(bounds[0], F.col("_rate")))
        .withColumn("salary_max_usd", whole_dollars(bounds[1], F.col("_rate")))
        .withColumn("salary_source", converted_label(*bounds, F.col("_currency"), F.col("_rate")))
        .drop("_country", "_currency", "_rate")
    )
