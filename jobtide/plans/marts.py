"""The four marts, built from the unified postings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobtide import fixed
from jobtide.functions.salary import midpoint
from jobtide.operators.grains import Grain, approx_grain_stats, multi_grain_stats, weekly_counts
from jobtide.operators.labels import company_rollup, explode_labels

SALARY_GRAINS = (
    Grain("source", ("source",)),
    Grain("source_salary_source", ("source", "salary_source")),
    Grain("source_category", ("source", "category"), required=("category",)),
)


def mart_skills(jobs: DataFrame, rows_unique: bool = True) -> DataFrame:
    """One row per posting, skill and kind of skill.

    The unified postings hold one row per (source, job_id), so nothing needs a shuffle; pass
    ``rows_unique=False`` for frames without that key.
    """
    rows = explode_labels(
        jobs,
        ["job_key", "source", "published_at"],
        F.col("tags"),
        F.col("category"),
        rows_unique=rows_unique,
    )
    return rows.select("job_key", "source", "skill", "skill_type", "published_at")


def mart_salary_ranges(jobs: DataFrame, exact_median: bool = True) -> DataFrame:
    """USD salary statistics per source, per source and confidence, per source and category."""
    stats = multi_grain_stats if exact_median else approx_grain_stats
    low, high = F.col("salary_min_usd"), F.col("salary_max_usd")
    salaried = jobs.where(F.col("salary_source").isin(fixed.STRUCTURED_USD, fixed.STRUCTURED_CONVERTED))
    return stats(salaried, SALARY_GRAINS, midpoint(low, high), low, high).select(
        "grouping_level",
        "source",
        "salary_source",
        "category",
        F.col("row_count").alias("job_count"),
        F.col("avg_value").alias("avg_salary_usd"),
        F.col("median_value").alias("median_salary_usd"),
        F.col("min_low").alias("min_salary_usd"),
        F.col("max_high").alias("max_salary_usd"),
    )


def mart_companies(jobs: DataFrame) -> DataFrame:
    """Postings per company across sources."""
    return company_rollup(jobs, F.col("company"), "source", "published_at")


def mart_jobs_over_time(jobs: DataFrame, skills: DataFrame) -> DataFrame:
    """Postings per week and source, and per week, source and skill; a posting counts once per skill row."""
    by_source = weekly_counts(jobs, "published_at", "source").withColumns(
        {"grouping_level": F.lit("source"), "skill": F.lit(None).cast("string")}
    )
    by_skill = weekly_counts(skills, "published_at", "source", "skill").withColumn(
        "grouping_level", F.lit("source_skill")
    )
    return by_source.unionByName(by_skill).select(
        "grouping_level", "week_start", "source", "skill", "job_count"
    )
