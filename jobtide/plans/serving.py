"""Queries over the marts; only the rows shown leave the cluster."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobtide import fixed
from jobtide.operators.labels import sorted_values
from jobtide.operators.ranking import drop_in, keep_in, known, lookup, top_k


def source_options(skills: DataFrame) -> DataFrame:
    """Sources present, sorted."""
    return sorted_values(skills, "source")


def top_skills(
    skills: DataFrame,
    *,
    sources: Sequence[str] | None = None,
    skill_types: Sequence[str] | None = None,
    limit: int = 15,
) -> DataFrame:
    """Most requested skills; a posting naming a skill as tag and as category counts once."""
    rows = keep_in(keep_in(skills, "source", sources), "skill_type", skill_types)
    counted = (
        rows.where(F.col("skill").isNotNull())
        .groupBy("skill")
        .agg(F.count_distinct("job_key").alias("job_count"))
    )
    return top_k(counted, "job_count", "skill", limit)


def salary_breakdown(
    salary_ranges: DataFrame, grouping_level: str, *, sources: Sequence[str] | None = None
) -> DataFrame:
    """Rows of one level with display labels, highest average first. Averages are never averaged again."""
    known(grouping_level, fixed.SALARY_LEVELS, "grouping_level")
    rows = keep_in(salary_ranges.where(F.col("grouping_level") == grouping_level), "source", sources)
    confidence = F.lit(fixed.MIXED_CONFIDENCE_LABEL)
    if grouping_level == "source_salary_source":
        confidence = lookup(F.col("salary_source"), fixed.CONFIDENCE_LABELS)
    second = {"source_salary_source": confidence, "source_category": F.col("category")}.get(grouping_level)
    label = F.col("source") if second is None else F.concat("source", F.lit(" · "), second)
    return rows.withColumns({"group_label": label, "confidence_label": confidence}).orderBy(
        F.col("avg_salary_usd").desc_nulls_last(), "group_label"
    )


def top_companies(companies: DataFrame, *, limit: int = 15) -> DataFrame:
    """Companies with the most postings; rows span all sources, so there is no source filter."""
    return top_k(companies, "job_count", "company_key", limit)


def jobs_over_time_series(
    jobs_over_time: DataFrame,
    grouping_level: str = "source",
    *,
    sources: Sequence[str] | None = None,
    skills: Sequence[str] | None = None,
) -> DataFrame:
    """Weekly counts per source, or per skill summed over the selected sources."""
    known(grouping_level, fixed.TIME_LEVELS, "grouping_level")
    rows = keep_in(jobs_over_time.where(F.col("grouping_level") == grouping_level), "source", sources)
    series = "source"
    if grouping_level == "source_skill":
        rows, series = keep_in(rows, "skill", skills), "skill"
    return (
        rows.where(F.col(series).isNotNull() & F.col("week_start").isNotNull())
        .groupBy("week_start", F.col(series).alias("series"))
        .agg(F.sum("job_count").alias("job_count"))
        .orderBy("week_start", "series")
    )


def category_only_skills(skills: DataFrame) -> DataFrame:
    """Labels used as a category but never as a tag: a set difference taken in one pass."""
    kind = F.col("skill_type")
    uses = skills.where(F.col("skill").isNotNull()).groupBy("skill")
    counted = uses.agg(F.count_if(kind == "category").alias("_in"), F.count_if(kind == "tag").alias("_out"))
    return counted.where("_in > 0 and _out = 0").select("skill")


def top_time_skills(
    jobs_over_time: DataFrame, *, limit: int = 8, exclude: Sequence[str] | DataFrame | None = None
) -> DataFrame:
    """Skills with the highest total weekly counts, without the excluded ones."""
    rows = jobs_over_time.where((F.col("grouping_level") == "source_skill") & F.col("skill").isNotNull())
    totals = rows.groupBy("skill").agg(F.sum("job_count").alias("job_count"))
    return top_k(drop_in(totals, "skill", exclude), "job_count", "skill", limit)


def headline_totals(skills: DataFrame, companies: DataFrame, jobs_over_time: DataFrame) -> DataFrame:
    """Postings tracked, companies, distinct skills and weeks covered, in one row."""
    weekly = jobs_over_time.where(F.col("grouping_level") == "source")
    parts = [
        weekly.agg(
            F.coalesce(F.sum("job_count"), F.lit(0)).alias("postings"),
            F.count_distinct("week_start").alias("weeks"),
        ),
        companies.agg(F.count("*").alias("companies")),
        skills.agg(F.count_distinct("skill").alias("skills")),
    ]
    # Each part is one row with its own columns: stacked, then folded into one.
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return stacked.agg(*[F.max(c).alias(c) for c in ("postings", "companies", "skills", "weeks")])
