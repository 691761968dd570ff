"""Explicit schemas of every table the engine reads or writes."""

from __future__ import annotations

from pyspark.sql import types as T

AMOUNT = T.DecimalType(18, 4)
RATE = T.DecimalType(18, 6)

# One row per API call. (source, run_id, request_ordinal) is the key; ordinals count up from 0 within a run.
RESPONSES = T.StructType(
    [
        T.StructField("source", T.StringType()),
        T.StructField("run_id", T.StringType()),
        T.StructField("request_key", T.StringType()),
        T.StructField("request_ordinal", T.IntegerType()),
        T.StructField("url", T.StringType()),
        T.StructField("http_status", T.IntegerType()),
        T.StructField("error", T.StringType()),
        T.StructField("body", T.StringType()),
        T.StructField("country", T.StringType()),
        T.StructField("fetched_at", T.TimestampType()),
    ]
)

# (source, run_id, chunk) is the key of a landed payload; raw ids grow with the run and the chunk.
RAW = T.StructType(
    [
        T.StructField("raw_id", T.LongType()),
        T.StructField("ingested_at", T.TimestampType()),
        T.StructField("run_id", T.StringType()),
        T.StructField("chunk", T.IntegerType()),
        T.StructField("payload", T.StringType()),
        T.StructField("document", T.VariantType()),
        T.StructField("job_count", T.LongType()),
        T.StructField("source", T.StringType()),
    ]
)

# One row for each landing, written last: only the payloads and runs of committed landings are there for readers.
COMMITS = T.StructType(
    [
        T.StructField("landing", T.StringType()),
        T.StructField("committed_at", T.TimestampType()),
        T.StructField("last_raw_id", T.LongType()),
        T.StructField("runs", T.LongType()),
        T.StructField("payloads", T.LongType()),
        T.StructField("sources", T.ArrayType(T.StringType())),
    ]
)

# Every failed request of a run in which none went well, in order of chunk and ordinal.
FAILURES = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("chunk", T.IntegerType()),
        T.StructField("request_ordinal", T.IntegerType()),
        T.StructField("request_key", T.StringType()),
        T.StructField("message", T.StringType()),
        T.StructField("source", T.StringType()),
    ]
)

# How every run landed so far went, failed ones included.
RUNS = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("n_requests", T.LongType()),
        T.StructField("n_ok", T.LongType()),
        T.StructField("error", T.StringType()),
        T.StructField("ingested_at", T.TimestampType()),
        T.StructField("payloads", T.LongType()),
        T.StructField("job_count", T.LongType()),
        T.StructField("source", T.StringType()),
    ]
)

RATES = T.StructType(
    [
        T.StructField("country_code", T.StringType()),
        T.StructField("currency_code", T.StringType()),
        T.StructField("usd_rate", RATE),
        T.StructField("captured_at", T.DateType()),
    ]
)

MART_TYPES = {
    "mart_skills": {
        "job_key": T.StringType(),
        "source": T.StringType(),
        "skill": T.StringType(),
        "skill_type": T.StringType(),
        "published_at": T.TimestampType(),
    },
    "mart_salary_ranges": {
        "grouping_level": T.StringType(),
        "source": T.StringType(),
        "salary_source": T.StringType(),
        "category": T.StringType(),
        "job_count": T.LongType(),
        "avg_salary_usd": AMOUNT,
        "median_salary_usd": AMOUNT,
        "min_salary_usd": AMOUNT,
        "max_salary_usd": AMOUNT,
    },
    "mart_companies": {
        "company_key": T.StringType(),
        "company": T.StringType(),
        "job_count": T.LongType(),
        "source_count": T.LongType(),
        "sources": T.StringType(),
        "first_published_at": T.TimestampType(),
        "last_published_at": T.TimestampType(),
    },
    "mart_jobs_over_time": {
        "grouping_level": T.StringType(),
        "week_start": T.DateType(),
        "source": T.StringType(),
        "skill": T.StringType(),
        "job_count": T.LongType(),
    },
}
MART_TABLES = tuple(MART_TYPES)
