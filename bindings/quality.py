"""Quality checks, on the model layers and on the driver's tables, with fixed bounds instead of the clock."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bindings import model
from bindings.landing import table
from bindings.registry import query
from bindings.sql import using
from jobtide.operators.expectations import (
    between,
    evaluate,
    in_set,
    not_below,
    not_null,
    pair_equal,
    unique,
)
from jobtide.operators.grains import grain_mismatches
from jobtide.operators.joins import orphans
from jobtide.plans import suites
from jobtide.sources.raw import with_counts
from jobtide.sources.seeds import read_rates

# The last hour checks count as past: later runs of the landing table lie in its future.
NOW = dt.datetime(2025, 1, 1, 4, 0, tzinfo=dt.UTC)
KINDS = {
    "not_null": "expect_column_values_to_not_be_null",
    "unique": "expect_column_values_to_be_unique",
    "in_set": "expect_column_values_to_be_in_set",
    "between": "expect_column_values_to_be_between",
    "equal": "expect_column_pair_values_to_be_equal",
    "not_below": "expect_column_pair_values_a_to_be_greater_than_b",
}


def expected(source: str, *checks: tuple[str, str, str], check_name: str | None = None) -> str:
    """SQL listing (kind, columns, counted condition) checks of one table as result rows."""
    named = f"'{check_name}' AS check_name, " if check_name else ""
    return " UNION ALL ".join(
        f"""SELECT {named}{seq} AS seq, '{KINDS[kind]}' AS expectation, '{columns}' AS column_name,
            {"(" + counted[1:] + ")" if counted.startswith("=") else f"count(*) FILTER (WHERE {counted})"}::BIGINT AS unexpected_count
            FROM {source if not counted.startswith("=") else "(SELECT 1)"}"""
        for seq, (kind, columns, counted) in enumerate(checks)
    )


def repeated(source: str, key: str) -> str:
    """Rows holding a repeated value."""
    return f"=SELECT coalesce(sum(n), 0) FROM (SELECT count(*) AS n FROM {source} WHERE {key} IS NOT NULL GROUP BY {key}) WHERE n > 1"


def shown(results: DataFrame) -> DataFrame:
    return results.drop("error")


# On the driver's tables ------------------------------------------------------------------------


@query(
    "dq_not_null",
    expected(
        "(SELECT CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderpriority END AS priority, o_custkey FROM orders)",
        ("not_null", "priority", "priority IS NULL"),
        ("not_null", "o_custkey", "o_custkey IS NULL"),
    ),
)
def dq_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(
        F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority")).alias("priority"), "o_custkey"
    )
    return shown(evaluate(orders, [not_null("priority"), not_null("o_custkey")]))


@query(
    "dq_unique",
    expected(
        "orders",
        ("unique", "o_custkey", repeated("orders", "o_custkey")),
        ("unique", "o_orderkey", repeated("orders", "o_orderkey")),
        ("unique", "o_orderdate", repeated("orders", "o_orderdate")),
    ),
)
def dq_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = [unique("o_custkey"), unique("o_orderkey"), unique("o_orderdate")]
    return shown(evaluate(table(spark, sf_dir, "orders"), keys))


@query(
    "dq_accepted_values",
    expected(
        "orders",
        ("in_set", "o_orderstatus", "o_orderstatus NOT IN ('F', 'O')"),
        ("in_set", "o_orderpriority", "o_orderpriority NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM')"),
    ),
)
def dq_accepted_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    checks = [in_set("o_orderstatus", ["F", "O"]), in_set("o_orderpriority", ["1-URGENT", "2-HIGH", "3-MEDIUM"])]
    return shown(evaluate(table(spark, sf_dir, "orders"), checks))


@query(
    "dq_min_le_max",
    expected(
        "lineitem",
        ("not_below", "l_tax/l_discount", "l_tax < l_discount"),
        ("not_below", "l_extendedprice/l_quantity", "l_extendedprice < l_quantity"),
    ),
)
def dq_min_le_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    checks = [not_below("l_tax", "l_discount"), not_below("l_extendedprice", "l_quantity")]
    return shown(evaluate(table(spark, sf_dir, "lineitem"), checks))


@query(
    "dq_between",
    expected(
        "events",
        ("between", "value", "value < 1 OR value > 50"),
        ("between", "ts", "ts > TIMESTAMP '2024-01-15 12:00:00'"),
        ("between", "user_id", "user_id < 3"),
    ),
)
def dq_between(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    noon = dt.datetime(2024, 1, 15, 12, tzinfo=dt.UTC)
    checks = [between("value", 1, 50), between("ts", high=noon), between("user_id", low=3)]
    return shown(evaluate(events, checks))


PAIRS = """(SELECT CASE WHEN o_orderstatus <> 'F' THEN o_orderstatus END AS a,
    CASE WHEN o_orderpriority <> '1-URGENT' THEN 'O' END AS b FROM orders)"""


@query("dq_pair_equal", expected(PAIRS, ("equal", "a/b", "a IS DISTINCT FROM b")))
def dq_pair_equal(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(
        F.when(F.col("o_orderstatus") != "F", F.col("o_orderstatus")).alias("a"),
        F.when(F.col("o_orderpriority") != "1-URGENT", "O").alias("b"),
    )
    return shown(evaluate(orders, [pair_equal("a", "b")]))


@query(
    "dq_relationships",
    """SELECT l_orderkey AS orphan_key, count(*) AS child_rows FROM lineitem
       WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P') GROUP BY l_orderkey""",
)
def dq_relationships(spark: SparkSession, sf_dir: str) -> DataFrame:
    open_orders = table(spark, sf_dir, "orders").where(F.col("o_orderstatus") != "P")
    return orphans(table(spark, sf_dir, "lineitem"), "l_orderkey", open_orders, "o_orderkey")


@query(
    "dq_reconcile_orders",
    """WITH billed AS (SELECT o_custkey, count(*) AS coarse_count FROM orders GROUP BY o_custkey),
            shipped AS (SELECT o_custkey, count(*) AS fine_count FROM orders WHERE o_orderstatus <> 'P' GROUP BY o_custkey)
       SELECT coalesce(b.o_custkey, s.o_custkey) AS o_custkey, coarse_count, fine_count
       FROM billed b FULL JOIN shipped s ON b.o_custkey = s.o_custkey WHERE coarse_count IS DISTINCT FROM fine_count""",
)
def dq_reconcile_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").withColumn("n", F.lit(1))
    return grain_mismatches(orders, orders.where(F.col("o_orderstatus") != "P"), ["o_custkey"], "n", "n")


# On the model layers ---------------------------------------------------------------------------


def tables(spark: SparkSession, sf_dir: str):
    def by_name(name: str) -> DataFrame:
        if name.startswith("stg_"):
            return model.staged_table(spark, sf_dir, name.split("_")[1])
        named = {
            "raw": model.raw_table,
            "int_jobs_normalized": model.jobs_table,
            "mart_skills": model.skills,
            "mart_salary_ranges": model.salary_ranges,
            "mart_companies": model.companies,
            "mart_jobs_over_time": model.jobs_over_time,
        }
        return read_rates(spark) if name == "exchange_rates" else named[name](spark, sf_dir)

    return by_name


def _raw(source: str, first: str) -> str:
    runs = f"(SELECT TIMESTAMP '2025-01-01 00:00:00' + to_hours(run::INTEGER) AS ingested_at, count(*) AS n FROM {first} GROUP BY run)"
    return expected(
        runs,
        ("not_null", "payload", "n IS NULL"),
        ("not_null", "ingested_at", "ingested_at IS NULL"),
        ("between", "ingested_at", "ingested_at < TIMESTAMP '2025-01-01' OR ingested_at > TIMESTAMP '2025-01-01 04:05:00'"),
        ("not_null", "job_count_declared", "n IS NULL"),
        ("not_null", "job_count_actual", "n IS NULL"),
        ("equal", "job_count_declared/job_count_actual", "n IS NULL"),
        check_name=f"raw_{source}_jobs",
    )


def _staging(source: str) -> str:
    name = f"stg_{source}"
    return expected(
        name,
        ("not_null", "job_id", "job_id IS NULL"),
        ("unique", "job_id", repeated(name, "job_id")),
        ("not_null", "title", "title IS NULL"),
        ("between", "published_at", "published_at < TIMESTAMP '2015-01-01' OR published_at > TIMESTAMP '2025-01-02 04:00:00'"),
        check_name=f"{name}_jobs",
    )


RAW_AND_STAGING = " UNION ALL ".join(
    [_raw("remotive", "c_first"), _raw("remoteok", "t_first"), _raw("adzuna", "p_first")]
    + [_staging(source) for source in ("remotive", "remoteok", "adzuna")]
)
MARTS = " UNION ALL ".join(
    [
        expected(
            "salary_ranges",
            ("not_null", "grouping_level", "grouping_level IS NULL"),
            ("in_set", "grouping_level", "grouping_level NOT IN ('source', 'source_salary_source', 'source_category')"),
            ("not_null", "job_count", "job_count IS NULL"),
            ("between", "job_count", "job_count < 1"),
            ("not_below", "max_salary_usd/min_salary_usd", "max_salary_usd < min_salary_usd"),
            check_name="mart_salary_ranges",
        ),
        expected(
            "companies",
            ("not_null", "company_key", "company_key IS NULL"),
            ("unique", "company_key", repeated("companies", "company_key")),
            ("not_null", "job_count", "job_count IS NULL"),
            ("between", "job_count", "job_count < 1"),
            check_name="mart_companies",
        ),
        expected(
            "jobs_over_time",
            ("not_null", "grouping_level", "grouping_level IS NULL"),
            ("in_set", "grouping_level", "grouping_level NOT IN ('source', 'source_skill')"),
            ("not_null", "week_start", "week_start IS NULL"),
            ("not_null", "job_count", "job_count IS NULL"),
            ("between", "job_count", "job_count < 1"),
            check_name="mart_jobs_over_time",
        ),
    ]
)
SHORT = "SELECT check_name, seq, expectation, column_name, unexpected_count FROM"


def _report(spark: SparkSession, sf_dir: str, checks) -> DataFrame:
    return shown(suites.results(tables(spark, sf_dir), NOW, checks))


@query("dq_report", using("stg_adzuna", select=f"{SHORT} ({RAW_AND_STAGING})"))
def dq_report_raw_staging(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _report(spark, sf_dir, [c for c in suites.CHECKS if c.layer != "marts"])


@query("dq_report_marts", using("jobs_over_time", select=f"{SHORT} ({MARTS})"))
def dq_report_marts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _report(spark, sf_dir, [c for c in suites.CHECKS if c.layer == "marts"])


def _declared_staging(source: str) -> str:
    name = f"stg_{source}"
    return expected(
        name,
        ("not_null", "job_id", "job_id IS NULL"),
        ("unique", "job_id", repeated(name, "job_id")),
        ("not_null", "source", "source IS NULL"),
        ("not_null", "title", "title IS NULL"),
        check_name=f"{name}_jobs",
    )


MODELS = " UNION ALL ".join(
    [_declared_staging(source) for source in ("remotive", "remoteok", "adzuna")]
    + [
        expected(
            "jobs",
            ("not_null", "job_key", "job_key IS NULL"),
            ("unique", "job_key", repeated("jobs", "job_key")),
            ("not_null", "job_id", "job_id IS NULL"),
            ("not_null", "source", "source IS NULL"),
            ("in_set", "source", "source NOT IN ('remotive', 'remoteok', 'adzuna')"),
            ("not_null", "title", "title IS NULL"),
            ("not_below", "salary_max/salary_min", "salary_max < salary_min"),
            ("not_below", "salary_max_usd/salary_min_usd", "salary_max_usd < salary_min_usd"),
            ("not_null", "salary_source", "salary_source IS NULL"),
            (
                "in_set",
                "salary_source",
                "salary_source NOT IN ('structured_usd', 'structured_converted', 'text_only', 'missing')",
            ),
            check_name="int_jobs_normalized",
        ),
        expected(
            "skills",
            ("not_null", "job_key", "job_key IS NULL"),
            ("not_null", "source", "source IS NULL"),
            ("not_null", "skill", "skill IS NULL"),
            ("not_null", "skill_type", "skill_type IS NULL"),
            ("in_set", "skill_type", "skill_type NOT IN ('tag', 'category')"),
            check_name="mart_skills",
        ),
        expected(
            "salary_ranges",
            ("not_null", "grouping_level", "grouping_level IS NULL"),
            ("in_set", "grouping_level", "grouping_level NOT IN ('source', 'source_salary_source', 'source_category')"),
            ("not_null", "source", "source IS NULL"),
            ("not_null", "job_count", "job_count IS NULL"),
            ("not_below", "max_salary_usd/min_salary_usd", "max_salary_usd < min_salary_usd"),
            check_name="mart_salary_ranges",
        ),
        expected(
            "companies",
            ("not_null", "company_key", "company_key IS NULL"),
            ("unique", "company_key", repeated("companies", "company_key")),
            ("not_null", "company", "company IS NULL"),
            ("not_null", "job_count", "job_count IS NULL"),
            check_name="mart_companies",
        ),
        expected(
            "jobs_over_time",
            ("not_null", "grouping_level", "grouping_level IS NULL"),
            ("in_set", "grouping_level", "grouping_level NOT IN ('source', 'source_skill')"),
            ("not_null", "week_start", "week_start IS NULL"),
            ("not_null", "source", "source IS NULL"),
            ("not_null", "job_count", "job_count IS NULL"),
            check_name="mart_jobs_over_time",
        ),
    ]
)


SEEDS = expected(
    "(SELECT *, DATE '2026-07-15' AS captured_at FROM rates)",
    ("not_null", "country_code", "country_code IS NULL"),
    ("unique", "country_code", repeated("rates", "country_code")),
    ("not_null", "currency_code", "currency_code IS NULL"),
    ("not_null", "usd_rate", "usd_rate IS NULL"),
    ("not_null", "captured_at", "captured_at IS NULL"),
    check_name="exchange_rates",
)


@query("dq_report_models", using("jobs_over_time", select=f"{SHORT} ({SEEDS} UNION ALL {MODELS})"))
def dq_report_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _report(spark, sf_dir, suites.MODEL_CHECKS)


@query(
    "dq_skill_postings",
    using(
        "skills",
        select="""SELECT job_key AS orphan_key, count(*) AS child_rows FROM skills
            WHERE job_key NOT IN (SELECT job_key FROM jobs WHERE salary_source <> 'missing') GROUP BY job_key""",
    ),
)
def dq_skill_postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    salaried = model.jobs_table(spark, sf_dir).where(F.col("salary_source") != "missing")
    return suites.skill_orphans(model.skills(spark, sf_dir), salaried)


@query(
    "dq_reconcile",
    using(
        "jobs_over_time",
        select="""
        SELECT coalesce(c.week_start, f.week_start) AS week_start, coalesce(c.source, f.source) AS source, coarse_count, fine_count
        FROM (SELECT week_start, source, sum(job_count)::BIGINT AS coarse_count FROM jobs_over_time
                WHERE grouping_level = 'source' GROUP BY ALL) c
            FULL JOIN (SELECT week_start, source, sum(job_count)::BIGINT AS fine_count FROM jobs_over_time
                WHERE grouping_level = 'source_skill' GROUP BY ALL) f ON c.week_start = f.week_start AND c.source = f.source
        WHERE coarse_count IS DISTINCT FROM fine_count""",
    ),
)
def dq_reconcile_weeks(spark: SparkSession, sf_dir: str) -> DataFrame:
    weekly = model.jobs_over_time(spark, sf_dir)
    level = F.col("grouping_level")
    return grain_mismatches(
        weekly.where(level == "source"),
        weekly.where(level == "source_skill"),
        ["week_start", "source"],
        "job_count",
        "job_count",
    )


COUNTS = " UNION ALL ".join(
    f"""SELECT '{source}' AS source, count(*) AS payloads, sum(n)::BIGINT AS postings, 0::BIGINT AS mismatched
        FROM (SELECT run, count(*) AS n FROM {first} GROUP BY run)"""
    for source, first in (("remotive", "c_first"), ("remoteok", "t_first"), ("adzuna", "p_first"))
)


@query("raw_count_mismatches", using("p_first", select=COUNTS))
def raw_count_mismatches(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = with_counts(model.raw_table(spark, sf_dir))
    declared, actual = F.col("job_count_declared"), F.col("job_count_actual")
    return counted.groupBy("source").agg(
        F.count("*").alias("payloads"),
        F.sum(actual).alias("postings"),
        F.count_if(~declared.eqNullSafe(actual)).alias("mismatched"),
    )
