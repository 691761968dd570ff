"""Staging, unified postings, marts and operators on hand-made rows."""

from __future__ import annotations

import datetime as dt
import json
import random
import statistics
from decimal import Decimal

import pytest
from conftest import category_job, paged_job, response, tag_job
from pyspark.sql import functions as F

from jobtide import fixed
from jobtide.operators.dedup import first_seen, latest_by_key
from jobtide.operators.grains import Grain, approx_grain_stats, fine_bucket, multi_grain_stats, spread_counts, value_bucket
from jobtide.operators.joins import dimension
from jobtide.operators.labels import explode_labels
from jobtide.plans.build import MODELS, Build, full_run, land
from jobtide.plans.marts import mart_companies, mart_jobs_over_time, mart_salary_ranges, mart_skills
from jobtide.plans.normalize import normalize
from jobtide.plans.staging import StoredStaging, staging
from jobtide.sources import versions
from jobtide.sources.marts import write_mart
from jobtide.sources.raw import read_raw, with_counts
from jobtide.sources.seeds import read_rates

DAY = dt.datetime(2026, 7, 1, 6, tzinfo=dt.UTC)


@pytest.fixture()
def raw(spark):
    def build(source, *payloads, start=1):
        rows = []
        for i, payload in enumerate(payloads):
            text = payload if isinstance(payload, str) or payload is None else json.dumps(payload)
            rows.append((start + i, DAY + dt.timedelta(days=i), str(start + i), 0, text, source))
        return spark.createDataFrame(rows, "raw_id long, ingested_at timestamp, run_id string, chunk int, payload string, source string")

    return build


def jobs(*rows, **more):
    return {"job-count": len(rows), "jobs": list(rows), **more}


def by_id(df):
    return {row["job_id"]: row for row in df.collect()}


def test_staging_keeps_the_newest_version(raw):
    rows = by_id(staging(raw("remotive", jobs(category_job(1, title="old"), category_job(2)), jobs(category_job(1, title="new"))), "remotive"))
    assert rows["1"]["title"] == "new" and rows["1"]["raw_id"] == 2
    assert rows["2"]["raw_id"] == 1


def stored_parts(spark, path):
    return sorted((p.bucket, p.level) for p in versions.current(spark, path).parts)


def test_stored_staging_equals_staging_everything(spark, raw, tmp_path, monkeypatch):
    monkeypatch.setattr("jobtide.plans.staging.MERGED", 3)
    goes = [
        [jobs(*[category_job(n, title=f"first {n}") for n in range(200)]), jobs(category_job(3))],
        [jobs(category_job(1, title="new"), category_job(None)), {"jobs": []}],
        [jobs(category_job(1, title="newer"), category_job(4))],
        [jobs(category_job(1, title="newest"))],
        [{"jobs": []}],
    ]
    frame, path, upto = raw("remotive", *[p for go in goes for p in go]), str(tmp_path / "stg"), 0
    for number, go in enumerate(goes):
        upto += len(go)
        landed = frame.where(F.col("raw_id") <= upto)
        stored = StoredStaging(landed, path, "remotive")
        before = versions.current(spark, path)
        version = stored.refresh(f"after {number}")
        got, whole = stored.rows(version), staging(landed, "remotive")
        assert got.columns == whole.columns and got.exceptAll(whole).isEmpty() and whole.exceptAll(got).isEmpty()
        if before:
            kept, touched = set(before.parts) & set(version.parts), {p.bucket for p in set(version.parts) - set(before.parts)}
            assert len(touched) <= 2 and {p.bucket for p in set(before.parts) - kept} <= touched
        assert stored.refresh(f"after {number}") == version
    levels = {level for _, level in stored_parts(spark, path)}
    assert levels == {0, 1} and len(stored_parts(spark, path)) < 40
    folders = {f.name for f in (tmp_path / "stg").iterdir()}
    assert {p.folder for v in versions.versions(spark, path) for p in v.parts} == folders


def test_stored_staging_of_nothing(spark, raw, tmp_path):
    stored = StoredStaging(raw("remotive", {"jobs": []}), str(tmp_path / "stg"), "remotive")
    assert stored.rows(stored.refresh("none")).count() == 0


def test_newest_ties_go_to_the_higher_raw_id_then_the_later_place(spark, raw):
    same = raw("remotive", jobs(category_job(1, title="a")), jobs(category_job(1, title="b"), category_job("1", title="c")))
    rows = by_id(staging(same.withColumn("ingested_at", F.lit(DAY)), "remotive"))
    assert rows["1"]["title"] == "c"


def test_remotive_fields(raw):
    rows = by_id(staging(raw("remotive", jobs(category_job(1), category_job(2, salary="$90k", publication_date=None))), "remotive"))
    assert rows["1"]["salary_text"] is None and rows["2"]["salary_text"] == "$90k"
    assert rows["1"]["salary_min"] is None
    assert rows["1"]["published_at"] == dt.datetime(2026, 6, 30, 8)
    assert rows["2"]["published_at"] is None
    assert rows["1"]["tags"] == ["python"]


def test_remoteok_zero_is_missing_and_offsets_count(raw):
    rows = by_id(staging(raw("remoteok", jobs(tag_job("1", salary_min="0", location="Oslo"))), "remoteok"))
    assert rows["1"]["salary_min"] is None and rows["1"]["salary_max"] == Decimal("120000")
    assert rows["1"]["published_at"] == dt.datetime(2026, 7, 1, 1, 30)
    assert rows["1"]["location"] == "Oslo" and rows["1"]["category"] is None


def test_adzuna_fields(raw):
    payload = jobs(paged_job(1), paged_job(2, salary_is_predicted=True, company=None), paged_job(3, salary_is_predicted=None), country="gb")
    rows = by_id(staging(raw("adzuna", payload), "adzuna"))
    assert rows["1"]["company"] == "Birch" and rows["1"]["category"] == "IT Jobs" and rows["1"]["location"] == "Leeds"
    assert rows["1"]["salary_max"] == Decimal("60000.5") and rows["1"]["search_country"] == "gb"
    assert [rows[i]["salary_is_predicted"] for i in "123"] == [True, True, None]
    assert rows["2"]["company"] is None


def test_one_bad_posting_does_not_lose_the_payload(raw):
    payload = jobs(category_job(1), category_job(2, tags={"no": "list"}), category_job(3))
    rows = by_id(staging(raw("remotive", payload), "remotive"))
    assert set(rows) == {"1", "2", "3"} and rows["2"]["tags"] is None


def test_payloads_without_a_job_list_give_no_rows(raw):
    assert staging(raw("remotive", {"jobs": {"a": 1}}, {"other": 1}, None, "not json"), "remotive").count() == 0


def test_bad_amounts_raise_unless_lenient(raw):
    frame = raw("remoteok", jobs(tag_job("1", salary_min="lots")))
    assert staging(frame, "remoteok", lenient=True).first()["salary_min"] is None
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        staging(frame, "remoteok").collect()


def test_raw_counts(raw):
    frame = with_counts(raw("remotive", {"job-count": 0, "jobs": []}, {"jobs": "[1, 2]"}, None, {"job-count": 3, "jobs": [1]}))
    rows = [(r["job_count_declared"], r["job_count_actual"]) for r in frame.orderBy("raw_id").collect()]
    assert rows == [(0, 0), (None, None), (None, None), (3, 1)]


@pytest.fixture()
def unified(spark, raw):
    remotive = staging(raw("remotive", jobs(category_job(1, tags=["Python", " python", "SQL", "", None]), category_job(2, salary="$90k", category="Python", company_name=" ACME "))), "remotive")
    remoteok = staging(raw("remoteok", jobs(tag_job("1"), tag_job("2", salary_min="0", salary_max="0", company="  "))), "remoteok")
    adzuna = staging(
        raw(
            "adzuna",
            jobs(paged_job(1), paged_job(2, salary_min=None), country="gb"),
            jobs(paged_job(3), country="us"),
            jobs(paged_job(4), country="xx"),
            jobs(paged_job(5, salary_min=None, salary_max=None), country="gb"),
        ),
        "adzuna",
    )
    return normalize(remotive, remoteok, adzuna, read_rates(spark))


def test_normalized_salaries(unified):
    rows = {r["job_key"]: r for r in unified.collect()}
    assert len(rows) == 9
    label = {key: row["salary_source"] for key, row in rows.items()}
    assert label["remotive:1"] == "missing" and label["remotive:2"] == "text_only"
    assert label["remoteok:1"] == "structured_usd" and label["remoteok:2"] == "missing"
    assert label["adzuna:1"] == "structured_converted" and label["adzuna:3"] == "structured_usd"
    assert label["adzuna:4"] == "missing" and label["adzuna:5"] == "missing"
    assert rows["adzuna:1"]["salary_min_usd"] == Decimal("54000")
    assert rows["adzuna:1"]["salary_max_usd"] == Decimal("81001")  # 60000.5 * 1.35 = 81000.675
    assert rows["adzuna:1"]["salary_currency"] == "GBP" and rows["adzuna:5"]["salary_currency"] is None
    assert rows["adzuna:4"]["salary_min"] == 40000 and rows["adzuna:4"]["salary_min_usd"] is None
    assert rows["remoteok:1"]["salary_currency"] == "USD"


def test_skills_are_normalised_and_distinct_per_posting(unified):
    rows = sorted((r["job_key"], r["skill"], r["skill_type"]) for r in mart_skills(unified).where("source = 'remotive'").collect())
    assert rows == [
        ("remotive:1", "data and analytics", "category"),
        ("remotive:1", "python", "tag"),
        ("remotive:1", "sql", "tag"),
        ("remotive:2", "python", "category"),
        ("remotive:2", "python", "tag"),
    ]
    both = mart_skills(unified).exceptAll(mart_skills(unified, rows_unique=False))
    assert both.count() == 0


def test_salary_ranges(unified):
    rows = {(r["grouping_level"], r["source"], r["salary_source"], r["category"]): r for r in mart_salary_ranges(unified).collect()}
    whole = rows["source", "adzuna", None, None]
    # Middles: (54000 + 81001) / 2 = 67500.5, 81001 alone, (40000 + 60000.5) / 2 rounded bounds = 50000.5.
    assert whole["job_count"] == 3
    assert whole["median_salary_usd"] == 67501
    assert whole["min_salary_usd"] == 40000 and whole["max_salary_usd"] == 81001
    split = [r["job_count"] for key, r in rows.items() if key[:2] == ("source_salary_source", "adzuna")]
    assert sum(split) == whole["job_count"]
    assert ("source_category", "adzuna", None, "IT Jobs") in rows
    assert not any(key[0] == "source_category" and key[1] == "remoteok" for key in rows)


def test_companies(unified):
    rows = {r["company_key"]: r for r in mart_companies(unified).collect()}
    assert set(rows) == {"acme", "birch"}
    acme = rows["acme"]
    assert (acme["company"], acme["job_count"], acme["source_count"], acme["sources"]) == ("Acme", 3, 2, "remoteok, remotive")
    assert acme["first_published_at"] == dt.datetime(2026, 6, 30, 8)


def test_jobs_over_time_counts_skill_rows(unified):
    rows = mart_jobs_over_time(unified, mart_skills(unified)).collect()
    weekly = {(r["grouping_level"], r["source"], r["skill"]): r for r in rows}
    assert weekly["source", "remotive", None]["job_count"] == 2
    # remotive:2 names python as tag and as category, so it counts twice here.
    assert weekly["source_skill", "remotive", "python"]["job_count"] == 3
    assert weekly["source", "remotive", None]["week_start"] == dt.date(2026, 6, 29)


# Operators -------------------------------------------------------------------------------------


def test_latest_by_key_null_keys_are_one_key(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), ("a", None), ("a", 5)], "k string, t int")
    assert sorted((str(r["k"]), str(r["t"])) for r in latest_by_key(df, ["k"], ["t"]).collect()) == [("None", "2"), ("a", "None")]


def test_first_seen_spreads_missing_keys(spark):
    df = spark.range(1000).select(F.lit("run").alias("run"), F.col("id").alias("at"), F.when(F.col("id") % 10 == 0, "hot").alias("k"))
    kept = first_seen(df, ["run"], F.col("k"), ["at"])
    assert kept.count() == 901
    assert kept.where("k = 'hot'").first()["at"] == 0
    assert kept.columns == df.columns


def exact(values):
    return round(Decimal(str(statistics.median(values))), 6)


@pytest.mark.parametrize("seed", range(3))
def test_median_is_exact_with_one_hot_group(spark, seed):
    rng = random.Random(seed)
    rows = [("hot", rng.choice(["x", "y", None]), Decimal(rng.randrange(-10**6, 10**9)) / 100) for _ in range(4000)]
    rows += [("hot", "x", Decimal("17.25"))] * 3000
    rows += [(f"g{i % 300}", "z", Decimal(rng.randrange(0, 10**5)) / 10) for i in range(2000)]
    rows += [("empty", "x", None), ("half", "x", None), ("half", "x", Decimal(2))]
    df = spark.createDataFrame(rows, "g string, h string, v decimal(18,4)").repartition(8)
    grains = (Grain("g", ("g",)), Grain("gh", ("g", "h"), required=("h",)))
    v = F.col("v")
    got = {(r["level"], r["g"], r["h"]): r for r in multi_grain_stats(df, grains, v, v, v, level="level", scale=6).collect()}
    want: dict = {}
    for g, h, value in rows:
        want.setdefault(("g", g, None), []).append(value)
        if h is not None:
            want.setdefault(("gh", g, h), []).append(value)
    assert set(got) == set(want)
    for key, values in want.items():
        numbers = [x for x in values if x is not None]
        row = got[key]
        assert row["row_count"] == len(values)
        if not numbers:
            assert row["median_value"] is None and row["avg_value"] is None and row["min_low"] is None
            continue
        assert row["median_value"] == exact(numbers)
        assert abs(row["avg_value"] - sum(numbers) / len(numbers)) < Decimal("0.000001")
        assert (row["min_low"], row["max_high"]) == (min(numbers), max(numbers))


def test_values_close_together_are_spread(spark):
    """All distinct values within 0.02 %, of either sign, and one far away: many tasks share them, and the median is exact."""
    df = spark.range(0, 60_000, 1, 8).selectExpr("if(id % 2 = 0, 'up', 'down') as g", "cast(1000 + id / 1000000 as decimal(18,6)) * if(id % 2 = 0, 1, -1) v")
    df = df.unionByName(spark.sql("select 'up' g, cast(1 as decimal(18,6)) * 1 v"))
    grains, v = (Grain("g", ("g",)),), F.col("v")
    got = {r["g"]: r["median_value"] for r in multi_grain_stats(df, grains, v, v, v, scale=6).collect()}
    numbers = sorted(r["v"] for r in df.where("g = 'up'").collect()), sorted(r["v"] for r in df.where("g = 'down'").collect())
    assert got == {g: round(Decimal(statistics.median(x)), 6) for g, x in zip(("up", "down"), numbers)}
    spread = spread_counts(df, grains, v, v, v)[0]
    sizes = [r["count"] for r in spread.groupBy(F.pmod(F.hash("_g", "_b", "_c"), F.lit(8))).count().collect()]
    assert len(sizes) == 8 and max(sizes) < 2 * sum(sizes) / len(sizes)
    assert spread.groupBy("_g", "_b", "_c").count().agg(F.max("count")).first()[0] == 1


def test_both_digits_keep_order(spark):
    rng = random.Random(4)
    values = [0.0, 5e-324, 1e-300, 0.1, 1.0, 1.0000000001, 99.99, 1e5, 1e5 + 1e-7, 1e12, 1e308, *(rng.uniform(-1, 1) * 10 ** rng.randint(-20, 20) for _ in range(3000))]
    values = sorted({x * sign for x in values for sign in (1, -1)})
    rows = spark.createDataFrame([(v,) for v in values], "v double").withColumn("b", value_bucket(F.col("v")))
    digits = [(r["b"], r["c"]) for r in sorted(rows.withColumn("c", fine_bucket(F.col("v"), F.col("b"))).collect(), key=lambda r: r["v"])]
    assert digits == sorted(digits) and len(set(digits)) > 0.99 * len(values)


def test_median_reads_its_input_once(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(1000).selectExpr("id % 7 as g", "cast(id as decimal(18,4)) v").write.parquet(path)
    v = F.col("v")
    df = multi_grain_stats(spark.read.parquet(path), (Grain("g", ("g",)),), v, v, v)
    df.collect()
    final = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert final.count("FileScan") == 1
    assert "ReusedExchange" in final


def test_value_buckets_keep_order(spark):
    values = [-1e9, -250.5, -1.0, -0.25, 0.0, 0.1, 1.0, 99.99, 100.0, 1e5, 1e5 + 1, 1e12]
    rows = spark.createDataFrame([(v,) for v in values], "v double").select("v", value_bucket(F.col("v")).alias("b")).collect()
    buckets = [r["b"] for r in sorted(rows, key=lambda r: r["v"])]
    assert buckets == sorted(buckets)


def test_approximate_median_is_close(spark):
    df = spark.range(10001).selectExpr("'a' g", "cast(id as decimal(18,4)) v")
    v = F.col("v")
    row = approx_grain_stats(df, (Grain("g", ("g",)),), v, v, v).first()
    assert abs(row["median_value"] - 5000) <= 2 and row["row_count"] == 10001


@pytest.mark.parametrize("rows", [[("gb", 1), ("gb", 2)], [("gb", 1), (None, 2)]])
def test_dimension_must_be_unique_and_not_null(spark, rows):
    rates = spark.createDataFrame(rows, "country_code string, r int")
    with pytest.raises(Exception, match="must be unique"):
        dimension(rates, "country_code").collect()


def test_a_value_shared_by_many_keys_and_missing_values_stay_even(spark):
    df = spark.range(0, 40_000, 1, 8).selectExpr("id % 20000 as fine", "cast(if(id % 2 = 0, 5, null) as decimal(18,4)) v")
    grains = (Grain("all", ()), Grain("fine", ("fine",)))
    v = F.col("v")
    result = multi_grain_stats(df, grains, v, v, v)
    assert result.where("grouping_level = 'all'").first()[2:4] == (40_000, Decimal(5))
    spread = spread_counts(df, grains, v, v, v)[0]
    assert spread.where("_g._level = 0").count() == 2
    sizes = [r["count"] for r in spread.groupBy(F.pmod(F.hash("_g", "_b"), F.lit(8))).count().collect()]
    assert len(sizes) == 8 and max(sizes) < 2 * sum(sizes) / len(sizes)


def test_explode_labels_of_repeated_rows(spark):
    df = spark.createDataFrame([("a", ["X", "x "], "C"), ("a", ["y"], None), ("a", None, "c")], "k string, t array<string>, c string")
    rows = explode_labels(df, ["k"], F.col("t"), F.col("c")).collect()
    assert sorted(tuple(r) for r in rows) == [("a", "c", "category"), ("a", "x", "tag"), ("a", "y", "tag")]


# Build -----------------------------------------------------------------------------------------


def test_full_run_and_selection(spark, three_sources, tmp_path):
    raw_path, marts = str(tmp_path / "raw"), str(tmp_path / "marts")
    now = dt.datetime(2026, 7, 8, 6, tzinfo=dt.UTC)
    runs = full_run(three_sources, raw_path, marts, now=now, work=str(tmp_path / "work"))
    assert {r["source"]: r["job_count"] for r in runs.collect()} == {"remotive": 2, "remoteok": 2, "adzuna": 2}
    build = Build(spark, raw_path, marts)
    assert build.marts().companies.count() == 3
    assert all(r.status == "passed" for r in build.check(now))
    assert build.run(["marts"]) == ["mart_skills", "mart_salary_ranges", "mart_companies", "mart_jobs_over_time"]
    assert build.run(["staging", "mart_companies"])[-1] == "mart_companies"
    assert spark.table("stg_remotive_jobs").count() == 2
    with pytest.raises(ValueError, match="nosuch"):
        build.run(["nosuch"])


def test_a_second_run_refreshes_stored_staging(spark, three_sources, tmp_path):
    raw_path, marts = str(tmp_path / "raw"), str(tmp_path / "marts")
    day = dt.datetime(2026, 7, 8, tzinfo=dt.UTC)
    full_run(three_sources, raw_path, marts, now=day)
    again = three_sources.withColumns({"run_id": F.lit("2"), "fetched_at": F.col("fetched_at") + F.expr("interval 1 hour")})
    full_run(three_sources.unionByName(again), raw_path, marts, now=day + dt.timedelta(days=1))
    build = Build(spark, raw_path, marts)
    assert build.table("int_jobs_normalized").count() == 6
    assert build.table("raw").count() == 6
    staged = build.table("stg_remotive_jobs")
    whole = staging(build.table("raw"), "remotive")
    assert staged.columns == whole.columns
    assert staged.exceptAll(whole).count() == whole.exceptAll(staged).count() == 0
    assert {level for _, level in stored_parts(spark, f"{marts}/staging/stg_remotive_jobs")} == {0}


def test_only_what_changed_is_built_again(spark, three_sources, responses, tmp_path):
    raw_path, marts = str(tmp_path / "raw"), str(tmp_path / "marts")
    land(three_sources, raw_path)
    build = Build(spark, raw_path, marts)
    build.run()
    assert build.written == list(MODELS["marts"])
    files = {f: f.stat().st_mtime_ns for f in (tmp_path / "marts").rglob("*")}
    for again in (build, Build(spark, raw_path, marts)):
        assert len(again.run()) == 8 and again.written == []
    assert {f: f.stat().st_mtime_ns for f in (tmp_path / "marts").rglob("*")} == files
    assert build.run(["mart_skills"], full_refresh=True) == build.written == ["mart_skills"]

    staged = {s: versions.current(spark, f"{marts}/staging/stg_{s}_jobs").version for s in fixed.SOURCES}
    rates = build.table("exchange_rates").withColumn("usd_rate", (F.col("usd_rate") * 2).cast("decimal(18,6)"))
    dearer = Build(spark, raw_path, marts, rates=rates)
    dearer.run()
    assert dearer.written == list(MODELS["marts"])
    assert {s: versions.current(spark, f"{marts}/staging/stg_{s}_jobs").version for s in fixed.SOURCES} == staged

    land(responses(response("remoteok", "2", "dev", 0, [tag_job("77")])), raw_path)
    dearer.run(["marts"])
    after = {s: versions.current(spark, f"{marts}/staging/stg_{s}_jobs").version for s in fixed.SOURCES}
    assert after == {**staged, "remoteok": staged["remoteok"] + 1}
    assert dearer.marts().skills.where("job_key = 'remoteok:77'").count() > 0


@pytest.mark.parametrize("lost", ["write", "publish"])
def test_a_broken_write_leaves_the_old_mart(spark, three_sources, tmp_path, monkeypatch, lost):
    raw_path, marts = str(tmp_path / "raw"), str(tmp_path / "marts")
    land(three_sources, raw_path)
    build = Build(spark, raw_path, marts)
    build.run()
    before = sorted(map(tuple, build.marts().companies.collect()))
    half = build.marts().companies.withColumn("job_count", F.raise_error(F.lit("lost")).cast("long"))
    with monkeypatch.context() as patched:
        if lost == "publish":
            patched.setattr(versions, "publish", lambda *_, **__: (_ for _ in ()).throw(KeyboardInterrupt))
            half = build.marts().companies.limit(1)
        with pytest.raises((Exception, KeyboardInterrupt)):
            write_mart("mart_companies", half, folder=marts)
    assert sorted(map(tuple, build.marts().companies.collect())) == before
    build.run(["mart_companies"], full_refresh=True)
    assert sorted(map(tuple, build.marts().companies.collect())) == before
    assert len(list((tmp_path / "marts" / "mart_companies").iterdir())) == 2


@pytest.mark.parametrize("source", fixed.SOURCES)
def test_a_payload_is_parsed_in_one_node(raw, source):
    plan = staging(raw(source, jobs()), source)._jdf.queryExecution().executedPlan().toString()
    assert sum("parseJson(payload" in line for line in plan.splitlines()) == 1 and "from_json" not in plan


def test_landed_payloads_are_not_parsed_again(spark, three_sources, tmp_path):
    land(three_sources, str(tmp_path / "raw"))
    raw = read_raw(spark, str(tmp_path / "raw"))
    assert raw.where("document is null").isEmpty()
    for source in fixed.SOURCES:
        plan = staging(raw, source)._jdf.queryExecution().executedPlan().toString()
        assert "from_json" not in plan and "parseJson" not in plan and "payload" not in plan.split("ReadSchema")[1]
        assert staging(raw, source).exceptAll(staging(raw.drop("document"), source)).isEmpty()


def test_odd_postings_keep_their_payload(raw):
    text = '{"job-count":4,"jobs":[{"id":1,"title":"a","title":"b","tags":["x",3,null]},5,null,{"id":"2","title":{"z":1,"a":[2]},"tags":"no"}]}'
    rows = staging(raw("remotive", text), "remotive").collect()
    got = {r["job_id"]: (r["title"], r["tags"]) for r in rows}
    assert got == {None: (None, None), "1": ("b", ["x", "3", None]), "2": ('{"a":[2],"z":1}', None)}


def test_fixed_labels_cover_both_structured_kinds():
    assert set(fixed.CONFIDENCE_LABELS) == {fixed.STRUCTURED_USD, fixed.STRUCTURED_CONVERTED}
