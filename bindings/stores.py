"""Marts written and read back, builds by selection, and the gate's report, on the driver's tables."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bindings import landing, model
from bindings.quality import MARTS, NOW, RAW_AND_STAGING, SHORT, tables
from bindings.registry import query
from bindings.sql import text, using
from jobtide.plans import suites
from jobtide.plans.build import Build, land
from jobtide.schemas import MART_TABLES
from jobtide.sources import marts as M
from jobtide.sources.workdir import shared_folder

BINDERS = {
    "mart_skills": model.skills,
    "mart_salary_ranges": model.salary_ranges,
    "mart_companies": model.companies,
    "mart_jobs_over_time": model.jobs_over_time,
}


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def keyed(marts: M.Marts) -> DataFrame:
    """Every row of the four marts as its name, its key and its count."""
    parts = {
        "mart_skills": (marts.skills, ["job_key", "skill_type", "skill"], F.lit(1)),
        "mart_salary_ranges": (marts.salary_ranges, ["grouping_level", "source", "salary_source", "category"], F.col("job_count")),
        "mart_companies": (marts.companies, ["company_key", "company", "sources"], F.col("job_count")),
        "mart_jobs_over_time": (marts.jobs_over_time, ["grouping_level", "week_start", "source", "skill"], F.col("job_count")),
    }
    return reduce(
        DataFrame.unionByName,
        [
            df.select(F.lit(name).alias("mart"), F.concat_ws("|", *[F.col(k).cast("string") for k in keys]).alias("row_key"), count.cast("long").alias("n"))
            for name, (df, keys, count) in parts.items()
        ],
    )


def keyed_sql(store: str) -> str:
    return f"""
        SELECT '{store}' AS store, 'mart_skills' AS mart, concat_ws('|', job_key, skill_type, skill) AS row_key, 1::BIGINT AS n FROM skills
        UNION ALL SELECT '{store}', 'mart_salary_ranges', concat_ws('|', grouping_level, source, salary_source, category), job_count FROM salary_ranges
        UNION ALL SELECT '{store}', 'mart_companies', concat_ws('|', company_key, company, sources), job_count FROM companies
        UNION ALL SELECT '{store}', 'mart_jobs_over_time', concat_ws('|', grouping_level, week_start, source, skill), job_count FROM jobs_over_time"""


STORES = ("catalog", "csv", "folder")


@query("mart_stores", using("jobs_over_time", select=" UNION ALL ".join(keyed_sql(store) for store in STORES)))
def mart_stores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All marts written to a catalog schema, as sorted CSV and as Parquet, and read back from each."""
    folder, schema = new_folder(spark, "marts"), f"bound_{uuid.uuid4().hex}"
    for name, build in BINDERS.items():
        df = M.write_mart(name, build(spark, sf_dir), folder=f"{folder}/parquet")
        M.write_mart(name, df, schema=schema)
        M.write_csv(name, df, f"{folder}/csv")
    read = {
        "catalog": M.load(spark, schema),
        "csv": M.read_csv(spark, f"{folder}/csv"),
        "folder": M.load(spark, f"{folder}/parquet", loader=M.read_folder),
    }
    return reduce(DataFrame.unionByName, [keyed(marts).withColumn("store", F.lit(store)) for store, marts in read.items()])


@query(
    "mart_fallback",
    using("companies", select="SELECT company_key, job_count, 1 AS is_demo, 'could not read the marts (AnalysisException)' AS reason FROM companies"),
)
def mart_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A schema that is not there: the labelled fallback, made of the driver's marts."""
    frames = {name: build(spark, sf_dir) for name, build in BINDERS.items()}
    marts = M.load(spark, f"absent_{uuid.uuid4().hex}", sample=lambda spark: M.bundle(frames, is_demo=True))
    return marts.companies.select(
        "company_key", "job_count", F.lit(int(marts.is_demo)).alias("is_demo"), F.lit(marts.demo_reason).alias("reason")
    )


def landed_build(spark: SparkSession, sf_dir: str) -> Build:
    work = new_folder(spark, "build")
    land(model.responses_table(spark, sf_dir), f"{work}/raw", work=work, feeds=landing.BOUND_FEEDS)
    return Build(spark, f"{work}/raw", f"{work}/marts", work=work)


@query(
    "build_selection",
    using(
        "companies",
        select=f"""SELECT 'mart_companies' AS model, company_key AS row_key, job_count AS n, {text("last_published_at")} AS at FROM companies
            UNION ALL SELECT 'stg_remoteok_jobs', job_id, 1, {text("published_at")} FROM stg_remoteok""",
    ),
)
def build_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One staging view and one mart, selected by name, built twice from landed responses."""
    build = landed_build(spark, sf_dir)
    for _ in range(2):
        built = build.run(["stg_remoteok_jobs", "mart_companies"])
    assert built == ["stg_remoteok_jobs", "mart_companies"]
    companies = build.table("mart_companies").select("company_key", "job_count", "last_published_at")
    staged = spark.table("stg_remoteok_jobs").select("job_id", F.lit(1).cast("long"), "published_at")
    both = companies.withColumn("model", F.lit(built[1])).union(staged.withColumn("model", F.lit(built[0])))
    return model.plain(both.toDF("row_key", "n", "at", "model"))


@query(
    "build_incremental",
    using(
        "companies",
        select=f"""SELECT 'mart_companies' AS model, company_key AS row_key, job_count AS n, {text("last_published_at")} AS at FROM companies
            UNION ALL SELECT 'stg_adzuna_jobs', job_id, raw_id // 1000, {text("published_at")} FROM stg_adzuna""",
    ),
)
def build_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landings and builds in turn: stored staging is merged, and what did not change is left alone."""
    landed, work = model.responses_table(spark, sf_dir), new_folder(spark, "build")
    build = Build(spark, f"{work}/raw", f"{work}/marts", work=work)
    for rows in (landed.where("cast(run_id as long) % 2 = 1"), landed, landed):
        land(rows, f"{work}/raw", work=work, feeds=landing.BOUND_FEEDS)
        build.run(["stg_adzuna_jobs", "mart_companies"])
    assert build.written == []  # nothing was new in the last turn
    companies = build.table("mart_companies").select("company_key", "job_count", "last_published_at")
    runs = build.table("raw").where("source = 'adzuna'").select("raw_id", F.col("run_id").cast("long").alias("run"))
    staged = build.table("stg_adzuna_jobs").join(runs, "raw_id").select("job_id", "run", "published_at")
    both = companies.withColumn("model", F.lit("mart_companies")).union(staged.withColumn("model", F.lit("stg_adzuna_jobs")))
    return model.plain(both.toDF("row_key", "n", "at", "model"))


def _statuses(checks: str) -> str:
    return f"""
        SELECT check_name, CASE WHEN count(*) FILTER (unexpected_count > 0) = 0 THEN 'passed' ELSE 'failed' END AS status,
            count(*) FILTER (unexpected_count = 0) AS held, count(*) AS total FROM ({checks}) GROUP BY check_name"""


@query("dq_gate", using("jobs_over_time", select=_statuses(f"{SHORT} ({RAW_AND_STAGING}) UNION ALL {SHORT} ({MARTS})")))
def dq_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How each check of the daily gate went; a few rows, one per check."""
    done = suites.run_checks(tables(spark, sf_dir), NOW)
    rows = [(r.check, r.status, r.passed_expectations, r.total_expectations) for r in done]
    return spark.createDataFrame(rows, "check_name string, status string, held long, total long")


assert set(BINDERS) == set(MART_TABLES)
