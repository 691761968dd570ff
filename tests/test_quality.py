"""Healthy rows pass their suite; each corruption fails exactly the check meant for it."""

from __future__ import annotations

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from jobtide.fixed import SOURCES
from jobtide.operators.expectations import between, evaluate, in_set, not_null, pair_equal, unique
from jobtide.operators.grains import grain_mismatches
from jobtide.operators.joins import orphans
from jobtide.plans import suites
from jobtide.schemas import MART_TYPES, RAW
from jobtide.sources.raw import with_counts

NOW = dt.datetime(2026, 7, 20, 12, tzinfo=dt.UTC)
FROM_KIND = "expect_column_"


def failed(df, suite) -> set[tuple[str, str]]:
    rows = evaluate(df, suite).collect()
    assert len(rows) == len(suite)
    return {
        (r["expectation"].removeprefix(FROM_KIND), r["column_name"]) for r in rows if r["error"] or r["unexpected_count"]
    }


def cells(*rows, **changes):
    """Rows as dicts, the first one changed."""
    first, *rest = rows
    return [{**first, **changes}, *rest]


@pytest.fixture()
def frame(spark):
    def build(rows, types):
        schema = ", ".join(f"{name} {kind if isinstance(kind, str) else kind.simpleString()}" for name, kind in types.items())
        return spark.createDataFrame([tuple(row.get(name) for name in types) for row in rows], schema)

    return build


def payload(n, **changes):
    return {"job-count": n, "jobs": [{"id": i} for i in range(n)], **changes}


RAW_ROWS = (
    {"raw_id": 1, "ingested_at": NOW - dt.timedelta(days=2), "payload": payload(2), "source": "remotive"},
    {"raw_id": 2, "ingested_at": NOW - dt.timedelta(days=1), "payload": payload(0), "source": "remotive"},
)


@pytest.mark.parametrize(
    ("change", "check"),
    [
        ({}, set()),
        ({"payload": None}, {("values_to_not_be_null", c) for c in ("payload", "job_count_declared", "job_count_actual")}),
        ({"payload": payload(2, **{"job-count": 99})}, {("pair_values_to_be_equal", "job_count_declared/job_count_actual")}),
        (
            {"payload": payload(2, jobs={"no": "list"})},
            {("values_to_not_be_null", "job_count_actual"), ("pair_values_to_be_equal", "job_count_declared/job_count_actual")},
        ),
        ({"ingested_at": NOW + dt.timedelta(hours=2)}, {("values_to_be_between", "ingested_at")}),
        ({"ingested_at": NOW + dt.timedelta(minutes=4)}, set()),
        ({"ingested_at": dt.datetime(2024, 12, 31, tzinfo=dt.UTC)}, {("values_to_be_between", "ingested_at")}),
        ({"ingested_at": None}, {("values_to_not_be_null", "ingested_at")}),
    ],
)
def test_raw_jobs(frame, change, check):
    rows = [
        {**r, "payload": r["payload"] if r["payload"] is None else json.dumps(r["payload"])}
        for r in cells(*RAW_ROWS, **change)
    ]
    assert failed(with_counts(frame(rows, {f.name: f.dataType for f in RAW if f.name != "document"})), suites.raw_jobs(NOW)) == check


STAGING_TYPES = {"job_id": "string", "title": "string", "published_at": "timestamp"}
STAGING_ROWS = (
    {"job_id": "1", "title": "a", "published_at": NOW},
    {"job_id": "2", "title": "b", "published_at": None},
    {"job_id": "3", "title": "c", "published_at": NOW + dt.timedelta(hours=23)},
)


@pytest.mark.parametrize(
    ("change", "check"),
    [
        ({}, set()),
        ({"job_id": "2"}, {("values_to_be_unique", "job_id")}),
        ({"job_id": None}, {("values_to_not_be_null", "job_id")}),
        ({"title": None}, {("values_to_not_be_null", "title")}),
        ({"published_at": dt.datetime(1999, 12, 31, tzinfo=dt.UTC)}, {("values_to_be_between", "published_at")}),
        ({"published_at": NOW + dt.timedelta(days=30)}, {("values_to_be_between", "published_at")}),
    ],
)
def test_staging_jobs(frame, change, check):
    assert failed(frame(cells(*STAGING_ROWS, **change), STAGING_TYPES), suites.staging_jobs(NOW)) == check


SALARY_ROWS = (
    {"grouping_level": "source", "source": "remoteok", "job_count": 4, "min_salary_usd": 10, "max_salary_usd": 20},
    {"grouping_level": "source_category", "source": "adzuna", "job_count": 1, "min_salary_usd": None, "max_salary_usd": 9},
)


@pytest.mark.parametrize(
    ("change", "check"),
    [
        ({}, set()),
        ({"grouping_level": "country"}, {("values_to_be_in_set", "grouping_level")}),
        ({"grouping_level": None}, {("values_to_not_be_null", "grouping_level")}),
        ({"job_count": 0}, {("values_to_be_between", "job_count")}),
        ({"job_count": None}, {("values_to_not_be_null", "job_count")}),
        ({"min_salary_usd": 21}, {("pair_values_a_to_be_greater_than_b", "max_salary_usd/min_salary_usd")}),
        ({"min_salary_usd": 20}, set()),
    ],
)
def test_mart_salary_ranges(frame, change, check):
    types = {**MART_TYPES["mart_salary_ranges"], "min_salary_usd": "bigint", "max_salary_usd": "bigint"}
    assert failed(frame(cells(*SALARY_ROWS, **change), types), suites.mart_salary_ranges(NOW)) == check


@pytest.mark.parametrize(
    ("change", "check"),
    [
        ({}, set()),
        ({"company_key": "b"}, {("values_to_be_unique", "company_key")}),
        ({"company_key": None}, {("values_to_not_be_null", "company_key")}),
        ({"job_count": 0}, {("values_to_be_between", "job_count")}),
    ],
)
def test_mart_companies(frame, change, check):
    rows = cells({"company_key": "a", "job_count": 2}, {"company_key": "b", "job_count": 1}, **change)
    assert failed(frame(rows, MART_TYPES["mart_companies"]), suites.mart_companies(NOW)) == check


@pytest.mark.parametrize(
    ("change", "check"),
    [
        ({}, set()),
        ({"grouping_level": "daily"}, {("values_to_be_in_set", "grouping_level")}),
        ({"week_start": None}, {("values_to_not_be_null", "week_start")}),
        ({"job_count": -1}, {("values_to_be_between", "job_count")}),
    ],
)
def test_mart_jobs_over_time(frame, change, check):
    week = dt.date(2026, 7, 6)
    rows = cells(
        {"grouping_level": "source", "week_start": week, "job_count": 2},
        {"grouping_level": "source_skill", "week_start": week, "skill": "sql", "job_count": 1},
        **change,
    )
    assert failed(frame(rows, MART_TYPES["mart_jobs_over_time"]), suites.mart_jobs_over_time(NOW)) == check


def test_counts_and_several_uniques_in_one_evaluation(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "b"), (3, "b"), (None, None), (None, "z")], "k int, v string")
    suite = [unique("k"), not_null("k"), unique("v"), in_set("v", ["b"]), between("k", 2), pair_equal("k", "k")]
    rows = evaluate(df, suite).orderBy("seq").collect()
    assert [r["unexpected_count"] for r in rows] == [2, 2, 3, 2, 2, 0]


def test_missing_columns_fail_and_the_rest_is_checked(spark):
    rows = evaluate(spark.range(3), [not_null("nope"), not_null("id"), unique("gone")]).orderBy("seq").collect()
    assert [r["error"] for r in rows] == ["column not found: nope", None, "column not found: gone"]
    assert rows[1]["unexpected_count"] == 0


def test_empty_tables_pass(spark):
    df = spark.createDataFrame([], "company_key string, job_count long")
    assert failed(df, suites.mart_companies(NOW)) == set()


def test_registry():
    names = [check.name for check in suites.CHECKS]
    assert names == [f"raw_{s}_jobs" for s in SOURCES] + [f"stg_{s}_jobs" for s in SOURCES] + [
        "mart_salary_ranges",
        "mart_companies",
        "mart_jobs_over_time",
    ]
    assert [len(c.suite(NOW)) for c in suites.CHECKS] == [6, 6, 6, 4, 4, 4, 5, 4, 5]
    with pytest.raises(ValueError):
        suites.Check("none", "marts", suites.mart_companies)
    with pytest.raises(ValueError):
        suites.Check("both", "marts", suites.mart_companies, table="t", derived=lambda tables: tables("t"))


def test_checks_run_independently_and_the_report_lists_them(spark, frame):
    good = frame([{"company_key": "a", "job_count": 1}], MART_TYPES["mart_companies"])
    bad = good.select("company_key", F.lit(0).alias("job_count"))

    def tables(name):
        if name == "good":
            return good
        if name == "bad":
            return bad
        return spark.table(name)

    checks = [suites.Check(name, "marts", suites.mart_companies, table=name) for name in ("good", "no_such_table", "bad")]
    results = suites.run_checks(tables, NOW, checks)
    assert [r.status for r in results] == ["passed", "error", "failed"]
    report = suites.format_report(results)
    lines = [line.split() for line in report.splitlines()]
    assert lines[1][:5] == ["good", "mart_companies", "passed", "4", "4"]
    assert lines[2][:5] == ["no_such_table", "mart_companies", "error", "0", "0"] and len(lines[2]) > 5
    assert lines[3][:5] == ["bad", "mart_companies", "failed", "3", "4"]
    assert lines[3][5:] == "expect_column_values_to_be_between on job_count: 1 unexpected value(s)".split()
    assert report.endswith("passed=1, failed=1, error=1")
    with pytest.raises(suites.QualityError, match="2 of 3"):
        suites.gate(results)
    suites.gate(results[:1])


def test_declared_checks(spark):
    from jobtide.plans.normalize import COLUMNS
    from jobtide.sources.seeds import read_rates

    declared = {check.name: check.suite(NOW) for check in suites.MODEL_CHECKS}
    kinds = [e.kind for suite in declared.values() for e in suite]
    tally = {kind: kinds.count(kind) for kind in kinds}
    assert list(tally.values()) == [32, 6, 5, 3] and len(kinds) == 46
    assert {c for e in declared["int_jobs_normalized"] for c in e.columns} <= set(COLUMNS)
    for name, types in MART_TYPES.items():
        assert {c for e in declared[name] for c in e.columns} <= set(types)
    assert failed(read_rates(spark), declared["exchange_rates"]) == set()


def test_model_checks_include_the_relationship(spark):
    frames = {
        "mart_skills": spark.createDataFrame([("a", "s", "sql", "tag"), ("lost", "s", "go", "tag")], "job_key string, source string, skill string, skill_type string"),
        "int_jobs_normalized": spark.createDataFrame([("a",)], "job_key string"),
    }
    checks = [check for check in suites.MODEL_CHECKS if check.name == "mart_skills"]
    results = suites.run_model_checks(frames.__getitem__, checks)
    assert [r.status for r in results] == ["passed", "failed"]
    assert results[1].failures == ["relationships on job_key: 1 unexpected value(s)"]
    frames["int_jobs_normalized"] = spark.createDataFrame([("a",), ("lost",)], "job_key string")
    assert suites.run_model_checks(frames.__getitem__, checks)[1].status == "passed"
    del frames["int_jobs_normalized"]
    assert suites.run_model_checks(frames.__getitem__, checks)[1].status == "error"


def test_orphans_ignore_null_keys(spark):
    child = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "k string")
    parent = spark.createDataFrame([("b",), (None,)], "p string")
    assert [tuple(r) for r in orphans(child, "k", parent, "p").collect()] == [("a", 2)]


def test_grain_mismatches_see_missing_groups(spark):
    coarse = spark.createDataFrame([("a", 3), ("b", 1)], "s string, n long")
    fine = spark.createDataFrame([("a", 1), ("a", 2), ("c", 1)], "s string, n long")
    rows = grain_mismatches(coarse, fine, ["s"], "n", "n").collect()
    assert sorted(tuple(r) for r in rows) == sorted([("b", 1, None), ("c", None, 1)], key=str)
