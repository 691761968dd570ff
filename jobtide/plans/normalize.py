"""One table of postings across sources, salaries in USD."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobtide.functions.salary import any_bound, text_label, usd_label
from jobtide.operators.currency import convert_bounds
from jobtide.schemas import AMOUNT

COLUMNS = (
    "job_key",
    "job_id",
    "source",
    "title",
    "company",
    "category",
    "tags",
    "location",
    "salary_min",
    "salary_max",
    "salary_currency",
    "salary_min_usd",
    "salary_max_usd",
    "salary_text",
    "salary_source",
    "salary_is_predicted",
    "published_at",
    "url",
    "ingested_at",
)
BOUNDS = ("salary_min", "salary_max")


def text_salaries(jobs: DataFrame) -> DataFrame:
    """Postings with free-text salaries only."""
    return jobs.withColumns(
        {
            "salary_currency": F.lit(None).cast("string"),
            "salary_min_usd": F.lit(None).cast(AMOUNT),
            "salary_max_usd": F.lit(None).cast(AMOUNT),
            "salary_source": text_label(F.col("salary_text")),
        }
    )


def usd_salaries(jobs: DataFrame) -> DataFrame:
    """Postings with bounds already in USD."""
    low, high = map(F.col, BOUNDS)
    return jobs.withColumns(
        {
            "salary_currency": F.when(any_bound(low, high), "USD"),
            "salary_min_usd": low,
            "salary_max_usd": high,
            "salary_source": usd_label(low, high),
        }
    )


def local_salaries(jobs: DataFrame, rates: DataFrame) -> DataFrame:
    """Postings with bounds in the currency of the country searched."""
    return convert_bounds(jobs, rates, "search_country", *BOUNDS)


def normalize(remotive: DataFrame, remoteok: DataFrame, adzuna: DataFrame, rates: DataFrame) -> DataFrame:
    """The union of the sources, keyed by source and posting."""
    not_predicted = F.lit(None).cast("boolean")
    parts = [
        text_salaries(remotive).withColumn("salary_is_predicted", not_predicted),
        usd_salaries(remoteok).withColumn("salary_is_predicted", not_predicted),
        local_salaries(adzuna, rates),
    ]
    keyed = [
        part.withColumn("job_key", F.concat("source", F.lit(":"), "job_id")).select(*COLUMNS) for part in parts
    ]
    return reduce(DataFrame.unionByName, keyed)
