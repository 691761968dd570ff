"""Serving queries over the marts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bindings import model
from bindings.model import plain
from bindings.registry import query
from bindings.sql import text, using
from jobtide import fixed
from jobtide.plans import serving
from jobtide.sources.marts import csv_rows

RANKED = "SELECT skill, count(DISTINCT job_key) AS job_count FROM skills {where} GROUP BY skill ORDER BY job_count DESC, skill LIMIT {k}"


@query("source_options", using("skills", select="SELECT DISTINCT source FROM skills"))
def source_options(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.source_options(model.skills(spark, sf_dir))


@query("top_skills", using("skills", select=RANKED.format(where="", k=15)))
def top_skills(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.top_skills(model.skills(spark, sf_dir))


@query(
    "top_skills_filtered",
    using("skills", select=RANKED.format(where="WHERE source IN ('remotive', 'remoteok') AND skill_type IN ('tag')", k=5)),
)
def top_skills_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.top_skills(
        model.skills(spark, sf_dir), sources=["remotive", "remoteok"], skill_types=["tag"], limit=5
    )


def _breakdown(level: str, label: str, confidence: str) -> str:
    return using(
        "salary_ranges",
        select=f"""SELECT *, {label} AS group_label, {confidence} AS confidence_label
            FROM salary_ranges WHERE grouping_level = '{level}'""",
    )


MIXED = f"'{fixed.MIXED_CONFIDENCE_LABEL}'"
CONFIDENCE = "CASE salary_source " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in fixed.CONFIDENCE_LABELS.items()) + " END"


@query("salary_breakdown_source", _breakdown("source", "source", MIXED))
def salary_breakdown_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(serving.salary_breakdown(model.salary_ranges(spark, sf_dir), "source"))


@query(
    "salary_breakdown",
    _breakdown("source_salary_source", f"source || ' · ' || {CONFIDENCE}", CONFIDENCE),
)
def salary_breakdown_confidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(serving.salary_breakdown(model.salary_ranges(spark, sf_dir), "source_salary_source"))


@query("salary_breakdown_category", _breakdown("source_category", "source || ' · ' || category", MIXED))
def salary_breakdown_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(serving.salary_breakdown(model.salary_ranges(spark, sf_dir), "source_category"))


@query(
    "top_companies",
    using(
        "companies",
        select=f"""SELECT company_key, company, job_count, source_count, sources,
            {text("first_published_at")} AS first_published_at, {text("last_published_at")} AS last_published_at
            FROM companies ORDER BY job_count DESC, company_key LIMIT 15""",
    ),
)
def top_companies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(serving.top_companies(model.companies(spark, sf_dir)))


@query(
    "jobs_over_time_by_source",
    using(
        "jobs_over_time",
        select="""SELECT week_start, source AS series, sum(job_count)::BIGINT AS job_count FROM jobs_over_time
            WHERE grouping_level = 'source' GROUP BY ALL""",
    ),
)
def jobs_over_time_by_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.jobs_over_time_series(model.jobs_over_time(spark, sf_dir))


@query(
    "jobs_over_time_series",
    using(
        "jobs_over_time",
        select="""SELECT week_start, skill AS series, sum(job_count)::BIGINT AS job_count FROM jobs_over_time
            WHERE grouping_level = 'source_skill' AND source IN ('remotive', 'remoteok') GROUP BY ALL""",
    ),
)
def jobs_over_time_by_skill(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.jobs_over_time_series(
        model.jobs_over_time(spark, sf_dir), "source_skill", sources=["remotive", "remoteok"]
    )


CATEGORY_ONLY = """SELECT DISTINCT skill FROM skills WHERE skill_type = 'category'
    AND skill NOT IN (SELECT skill FROM skills WHERE skill_type = 'tag')"""


@query("category_only_skills", using("skills", select=CATEGORY_ONLY))
def category_only_skills(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.category_only_skills(model.skills(spark, sf_dir))


@query(
    "top_time_skills",
    using(
        "jobs_over_time",
        select=f"""SELECT skill, sum(job_count)::BIGINT AS job_count FROM jobs_over_time
            WHERE grouping_level = 'source_skill' AND skill NOT IN ({CATEGORY_ONLY})
            GROUP BY skill ORDER BY job_count DESC, skill LIMIT 8""",
    ),
)
def top_time_skills(spark: SparkSession, sf_dir: str) -> DataFrame:
    board_labels = serving.category_only_skills(model.skills(spark, sf_dir))
    return serving.top_time_skills(model.jobs_over_time(spark, sf_dir), exclude=board_labels)


@query(
    "kpi_tiles",
    using(
        "jobs_over_time",
        select="""SELECT
            (SELECT sum(job_count)::BIGINT FROM jobs_over_time WHERE grouping_level = 'source') AS postings,
            (SELECT count(*) FROM companies) AS companies,
            (SELECT count(DISTINCT skill) FROM skills) AS skills,
            (SELECT count(DISTINCT week_start) FROM jobs_over_time WHERE grouping_level = 'source') AS weeks""",
    ),
)
def headline_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.headline_totals(
        model.skills(spark, sf_dir), model.companies(spark, sf_dir), model.jobs_over_time(spark, sf_dir)
    )


@query(
    "mart_csv_rows",
    using(
        "companies",
        select="""SELECT company_key, company, job_count, source_count, sources,
            strftime(first_published_at, '%Y-%m-%dT%H:%M:%S+00:00') AS first_published_at,
            strftime(last_published_at, '%Y-%m-%dT%H:%M:%S+00:00') AS last_published_at FROM companies""",
    ),
)
def mart_csv_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return csv_rows("mart_companies", model.companies(spark, sf_dir))


@query(
    "salaried_share",
    using(
        "jobs",
        select="SELECT source, salary_source, count(*) AS job_count FROM jobs GROUP BY source, salary_source",
    ),
)
def salaried_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    jobs = model.jobs_table(spark, sf_dir)
    return jobs.groupBy("source", "salary_source").agg(F.count("*").alias("job_count"))
