"""The driver's tables as landed responses: written source by source, in row groups bounded by bytes."""

from __future__ import annotations

import datetime as dt
import json
import random

import pyarrow.parquet as pq
from pyspark.sql import functions as F

import __spark_entry__ as entry
from bindings.landing import BUILDERS
from jobtide.schemas import RAW
from jobtide.sources.raw import Landing, append_payloads, as_raw, read_raw, with_counts
from jobtide.sources.workdir import written

NOW = dt.datetime(2026, 7, 1)


def row_groups(folder):
    return [pq.ParquetFile(f).metadata.num_row_groups for f in folder.rglob("*.parquet")]


def wide_rows(spark, rows=400):
    """Texts of 60 KB that do not compress well, in one partition."""
    noise = random.Random(1)
    return spark.createDataFrame([(n, "%060000x" % noise.getrandbits(8 * 30_000)) for n in range(rows)], "n long, text string").coalesce(1)


def test_a_reader_never_has_to_hold_a_whole_file_of_wide_rows(spark, tmp_path):
    stored = written(wide_rows(spark), "wide", work=str(tmp_path))
    assert stored.agg(F.sum(F.length("text"))).first()[0] == 400 * 60_000
    assert min(row_groups(tmp_path)) > 1


def test_payloads_are_stored_in_bounded_row_groups(spark, tmp_path):
    noise = wide_rows(spark).select(F.lit("remotive").alias("source"), F.to_json(F.struct("text")).alias("payload"))
    append_payloads(noise, str(tmp_path / "raw"), NOW)
    assert min(row_groups(tmp_path / "raw")) > 1


def test_pages_and_row_groups_of_wide_rows_stay_small(spark, tmp_path):
    noise = random.Random(1)
    rows = [(n, "%01200000x" % noise.getrandbits(8 * 600_000)) for n in range(60)]
    written(spark.createDataFrame(rows, "n long, text string").coalesce(1), "wide", work=str(tmp_path))
    files = [pq.ParquetFile(f).metadata for f in tmp_path.rglob("*.parquet")]
    sizes = [m.row_group(i).total_byte_size for m in files for i in range(m.num_row_groups)]
    assert sum(sizes) > 60 * 1_200_000 and max(sizes) < 16 << 20


def test_documents_are_stored_whole(spark, tmp_path):
    payloads = spark.createDataFrame([("remotive", '{"jobs":[{"id":%d,"title":"a"}]}' % n) for n in range(50)], "source string, payload string")
    append_payloads(payloads, str(tmp_path / "raw"), NOW)
    (file,) = list((tmp_path / "raw").rglob("*.parquet"))[:1]
    columns = pq.ParquetFile(file).metadata.schema
    paths = {columns.column(i).path for i in range(len(columns))}
    assert {"document.value", "document.metadata"} <= paths and not any("typed_value" in p for p in paths)
    assert sorted(r["job_count_actual"] for r in with_counts(read_raw(spark, str(tmp_path / "raw"))).collect()) == [1] * 50


def test_payloads_by_source_are_found_as_those_sorted_by_it(spark, tmp_path):
    rows = spark.createDataFrame([("remotive", '{"jobs":[]}'), ("adzuna", '{"jobs":[1]}')], "source string, payload string")
    landing = Landing.begin(spark, str(tmp_path / "raw"))
    parts = {s: as_raw(rows.where(F.col("source") == s), landing.base, NOW) for s in ("remotive", "remoteok", "adzuna")}
    landing.commit(landing.write(parts, RAW))
    assert sorted((r["source"], r["payload"]) for r in read_raw(spark, landing.path).collect()) == [
        ("adzuna", '{"jobs":[1]}'),
        ("remotive", '{"jobs":[]}'),
    ]


def test_a_query_of_one_source_makes_that_source_alone(spark, tmp_path):
    at = dt.datetime(2025, 1, 1)
    kinds = ["click", "view", "click"]
    events = [(n, at, n % 2, kind, 1.5, '{"k": 7}') for n, kind in enumerate(kinds)]
    spark.createDataFrame(events, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string").write.parquet(
        str(tmp_path / "events.parquet")
    )
    for name, ids in {"resp_filter_tag": ["0-7", "0-7", "1-7"], "resp_dedup_first": ["0-7", "1-7"]}.items():
        assert sorted(r["id"] for r in entry.queries()[name](spark, str(tmp_path)).collect()) == ids
    staged = entry.queries()["stg_remoteok_jobs"](spark, str(tmp_path)).collect()
    assert sorted((r["job_id"], r["title"]) for r in staged) == [("0-7", "click"), ("1-7", "view")]


def test_postings_of_two_requests_are_gathered_once(spark, tmp_path):
    at = dt.datetime(2025, 1, 1)
    kinds = ["view", "click", None, "click"]
    events = [(n % 3, at, n, kind, 1.5, '{"k": 7}') for n, kind in enumerate(kinds)]
    spark.createDataFrame(events, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string").write.parquet(
        str(tmp_path / "events.parquet")
    )
    made = BUILDERS["remoteok"](spark, str(tmp_path))
    ids = {r["request_ordinal"]: [j["id"] for j in json.loads(r["body"])[1:]] for r in made.collect()}
    assert ids == {4: ["0-7", "3-7", "1-7"], 3: ["0-7"], 0: ["3-7", "1-7"], None: ["2-7", "2-7"]}
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Generate") < plan.index("Exchange")  # the explode comes after the shuffle
