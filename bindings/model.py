"""Model layers: responses to payloads, staging, unified postings and marts."""

from __future__ import annotations

import uuid
from functools import cache, reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bindings import landing
from bindings.registry import query
from bindings.sql import CATEGORY_KEYS, TAG_LIST, text, using
from jobtide.plans import build, marts, normalize, responses, staging
from jobtide.schemas import RESPONSES
from jobtide.sources.raw import read_raw, read_runs, with_counts
from jobtide.sources.seeds import read_rates
from jobtide.sources.workdir import shared_folder, written


def plain(df: DataFrame) -> DataFrame:
    """Columns as types every engine prints alike: text timestamps, double amounts, joined tags."""

    def column(field: T.StructField) -> Column:
        value = F.col(field.name)
        if isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
            value = F.date_format(value, "yyyy-MM-dd HH:mm:ss")
        elif isinstance(field.dataType, T.DecimalType):
            value = value.cast("double")
        elif isinstance(field.dataType, T.ArrayType):
            value = F.array_join(value, "/")
        elif isinstance(field.dataType, T.BooleanType):
            value = value.cast("int")
        return value.alias(field.name)

    return df.select([column(field) for field in df.schema])


# Responses and payloads are landed once, and a build stores the unified postings, as four marts read
# them. The queries below start from those tables, written once per session and folder. Those before the
# unified postings are written source by source: a query about one source makes that one alone, and no
# wide row is sorted for the sake of its folder.


def of_source(rows: DataFrame, name: str, source: str) -> DataFrame:
    """Rows of one source, stored; a filter on another source does not even open them."""
    stored = written(rows.drop("source"), f"{name}-{source}")
    return stored.select([F.lit(source).alias(c) if c == "source" else F.col(c) for c in rows.columns])


@cache
def responses_of(spark: SparkSession, sf_dir: str, source: str) -> DataFrame:
    return of_source(landing.BUILDERS[source](spark, sf_dir), "responses", source)


def responses_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reduce(DataFrame.unionByName, [responses_of(spark, sf_dir, source) for source in landing.BUILDERS])


@cache
def classified_of(spark: SparkSession, sf_dir: str, source: str) -> DataFrame:
    """The responses classified, as a landing stores them: their bodies are parsed once for all that follows."""
    return written(responses.classify(responses_of(spark, sf_dir, source), landing.BOUND_FEEDS[source]), f"classified-{source}")


@cache
def raw_of(spark: SparkSession, sf_dir: str, source: str) -> DataFrame:
    return of_source(landing.raw(classified_of(spark, sf_dir, source), landing.BOUND_FEEDS[source]), "raw", source)


def raw_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reduce(DataFrame.unionByName, [raw_of(spark, sf_dir, source) for source in landing.BUILDERS])


@cache
def jobs_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return written(jobs(spark, sf_dir), "jobs")


def stage(spark: SparkSession, sf_dir: str, source: str) -> DataFrame:
    return staging.staging(raw_of(spark, sf_dir, source), source)


@cache
def staged_table(spark: SparkSession, sf_dir: str, source: str) -> DataFrame:
    """Staging as a build stores it: checks and the unified postings read this."""
    return written(stage(spark, sf_dir, source), f"stg-{source}")


def jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    staged = [staged_table(spark, sf_dir, source) for source in landing.BUILDERS]
    return normalize.normalize(*staged, read_rates(spark))


def skills(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.mart_skills(jobs_table(spark, sf_dir))


def salary_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    whole = {c: F.col(c).cast("long") for c in ("avg_salary_usd", "median_salary_usd")}
    return marts.mart_salary_ranges(jobs_table(spark, sf_dir)).withColumns(whole)


def companies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.mart_companies(jobs_table(spark, sf_dir))


def jobs_over_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    unified = jobs_table(spark, sf_dir)
    return marts.mart_jobs_over_time(unified, marts.mart_skills(unified))


# Responses to payloads -----------------------------------------------------------------------


@query(
    "resp_classify",
    """SELECT event_id::VARCHAR AS request_key, (event_type = 'click')::INTEGER AS ok, CASE WHEN event_type = 'click' THEN 1 END AS n_elements,
        CASE event_type WHEN 'error' THEN 'Timeout after 30.0s while calling https://jobs.example/' || user_id
            WHEN 'signup' THEN 'Remotive API returned HTTP 503 for https://jobs.example/' || user_id
            WHEN 'view' THEN 'Remotive API returned a non-JSON response from https://jobs.example/' || user_id
            WHEN 'purchase' THEN 'Unexpected shape in Remotive response: expected an object with a ''jobs'' list' END AS message
       FROM events""",
)
def resp_classify(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event as a response of its own: a type per way to fail, one that works."""
    kind = F.col("event_type")
    landed = landing.table(spark, sf_dir, "events").select(
        F.lit("remotive").alias("source"),
        F.col("user_id").cast("string").alias("run_id"),
        F.col("event_id").cast("string").alias("request_key"),
        F.lit(0).alias("request_ordinal"),
        F.concat(F.lit("https://jobs.example/"), "user_id").alias("url"),
        F.when(kind == "signup", 503).when(kind != "error", 200).alias("http_status"),
        F.when(kind == "error", "timeout").alias("error"),
        F.when(kind == "view", F.concat(F.lit("oops "), "props"))
        .when(kind == "purchase", F.col("props"))
        .otherwise(F.concat(F.lit('{"jobs":['), "props", F.lit("]}")))
        .alias("body"),
        F.lit(None).cast("string").alias("country"),
        F.col("ts").cast("timestamp").alias("fetched_at"),
    )
    rows = responses.outcomes(landed, landing.BOUND_FEEDS["remotive"])
    return plain(rows.select("request_key", "ok", "message", "n_elements"))


ALL_OUTCOMES = f"""
    SELECT 'adzuna' AS source, run::VARCHAR AS run_id, (page + 1)::VARCHAR AS request_key, page::INTEGER AS request_ordinal, ok::INTEGER AS ok,
        CASE WHEN NOT ok THEN 'Adzuna API returned HTTP 500 for https://adzuna.example/' || page END AS message,
        CASE WHEN ok THEN n::INTEGER END AS n_elements FROM p_pages
    UNION ALL
    SELECT 'remotive', run::VARCHAR, {CATEGORY_KEYS}[place + 1], place::INTEGER, 1, NULL, n::INTEGER FROM c_asked
    UNION ALL
    SELECT 'remoteok', run::VARCHAR, {TAG_LIST}[place + 1], place::INTEGER, 1, NULL, (n + 1)::INTEGER FROM t_asked"""


def of_all_sources(rows_of) -> DataFrame:
    """One frame of the rows a function gives for each source."""
    frames = [rows_of(feed).withColumn("source", F.lit(name)) for name, feed in landing.BOUND_FEEDS.items()]
    return reduce(DataFrame.unionByName, frames)


@query("resp_outcomes", using("p_runs", select=ALL_OUTCOMES))
def response_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    landed = responses_table(spark, sf_dir)
    columns = ["source", "run_id", "request_key", "request_ordinal", "ok", "message", "n_elements"]
    return plain(of_all_sources(lambda feed: responses.outcomes(landed, feed)).select(columns))


@query(
    "resp_filter_category",
    using(
        "c_feed",
        select="""SELECT run::VARCHAR AS run_id, place::INTEGER AS request_ordinal, o_custkey AS id,
            'https://jobs.example/c/' || o_orderkey AS url FROM c_feed""",
    ),
)
def response_filter_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = responses.postings(responses_of(spark, sf_dir, "remotive"), landing.BOUND_FEEDS["remotive"])
    parsed = kept.withColumn("_j", F.from_json("job", "id long, url string"))
    return parsed.select("run_id", "request_ordinal", "_j.id", "_j.url")


@query(
    "resp_filter_tag",
    using(
        "t_feed",
        select="""SELECT run::VARCHAR AS run_id, place::INTEGER AS request_ordinal, user_id || '-' || k AS id,
            'https://jobs.example/t/' || event_id AS url FROM t_feed WHERE k > 0""",
    ),
)
def response_filter_tag(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = responses.postings(responses_of(spark, sf_dir, "remoteok"), landing.BOUND_FEEDS["remoteok"])
    parsed = kept.withColumn("_j", F.from_json("job", "id string, url string"))
    return parsed.select("run_id", "request_ordinal", "_j.id", "_j.url")


@query(
    "resp_dedup_first",
    using(
        "t_first",
        select="""SELECT run::VARCHAR AS run_id, place::INTEGER AS request_ordinal, user_id || '-' || k AS id,
            'https://jobs.example/t/' || event_id AS url FROM t_first""",
    ),
)
def response_first_seen(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = responses.postings(responses_of(spark, sf_dir, "remoteok"), landing.BOUND_FEEDS["remoteok"])
    first = responses.distinct_postings(kept).withColumn("_j", F.from_json("job", "id string, url string"))
    return first.select("run_id", "request_ordinal", "_j.id", "_j.url")


@query(
    "resp_short_page",
    using(
        "p_used",
        select="""SELECT f.run::VARCHAR AS run_id, f.page::INTEGER AS request_ordinal, p_name || '|' || p_brand AS id,
            'https://jobs.example/p/' || p_partkey AS url
            FROM p_feed f JOIN p_used u ON f.run = u.run AND f.page = u.page WHERE u.ok""",
    ),
)
def response_short_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    landed = classified_of(spark, sf_dir, "adzuna")
    runs = responses.run_outcomes(responses.outcomes(landed, landing.PAGED), landing.PAGED)
    used = responses.used_only(responses.postings(landed, landing.PAGED), runs)
    parsed = used.withColumn("_j", F.from_json("job", "id string, redirect_url string"))
    return parsed.select("run_id", "request_ordinal", "_j.id", F.col("_j.redirect_url").alias("url"))


@query(
    "payload_build",
    using(
        "p_first",
        select=f"""
        SELECT 'adzuna' AS source, u.run::VARCHAR AS run_id, max(coalesce(j.n, 0))::BIGINT AS job_count,
            string_agg(CASE WHEN u.ok THEN (u.page + 1)::VARCHAR END, '/' ORDER BY u.page) AS fetched,
            coalesce(string_agg(CASE WHEN NOT u.ok THEN (u.page + 1)::VARCHAR || '=Adzuna API returned HTTP 500 for https://adzuna.example/' || u.page END,
                '/' ORDER BY u.page), '') AS failed
        FROM p_used u LEFT JOIN (SELECT run, count(*) AS n FROM p_first GROUP BY run) j ON u.run = j.run GROUP BY u.run
        UNION ALL
        SELECT 'remotive', run::VARCHAR, (SELECT count(*) FROM c_first f WHERE f.run = a.run),
            string_agg({CATEGORY_KEYS}[place + 1], '/' ORDER BY place), '' FROM c_asked a GROUP BY run
        UNION ALL
        SELECT 'remoteok', run::VARCHAR, (SELECT count(*) FROM t_first f WHERE f.run = a.run),
            string_agg({TAG_LIST}[place + 1], '/' ORDER BY place), '' FROM t_asked a GROUP BY run""",
    ),
)
def payload_accounting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return accounts(of_all_sources(lambda feed: responses.payloads(classified_of(spark, sf_dir, feed.source), feed))).drop("chunk")


def accounts(packed: DataFrame) -> DataFrame:
    """What payloads say of their requests: those fetched, and those failed with their messages."""
    kinds = [feed.requests for feed in landing.BOUND_FEEDS.values()]
    schema = ", ".join(f"`fetched-{k}` array<string>, `failed-{k}` map<string, string>" for k in kinds)
    read = packed.withColumn("_p", F.from_json("payload", schema))
    failed = F.transform(
        F.sort_array(F.map_entries(F.coalesce(*[F.col(f"_p.failed-{k}") for k in kinds]))),
        lambda e: F.concat(e["key"], F.lit("="), e["value"]),
    )
    return read.select(
        "source",
        "run_id",
        "chunk",
        "job_count",
        F.array_join(F.coalesce(*[F.col(f"_p.fetched-{k}") for k in kinds]), "/").alias("fetched"),
        F.array_join(failed, "/").alias("failed"),
    )


@query(
    "run_summary",
    using(
        "p_runs",
        select="""
        SELECT 'adzuna' AS source, run::VARCHAR AS run_id, CASE WHEN n_ok > 0 THEN 'succeeded' ELSE 'failed' END AS status,
            n_requests, n_ok, CASE WHEN n_ok = 0 THEN 'All pages failed during the Adzuna extraction: ' ||
                (SELECT string_agg('page ' || (page + 1) || ': Adzuna API returned HTTP 500 for https://adzuna.example/' || page,
                    '; ' ORDER BY page) FROM p_pages g WHERE g.run = r.run) END AS error
        FROM p_runs r
        UNION ALL
        SELECT 'remotive', run::VARCHAR, 'succeeded', count(*), count(*), NULL FROM c_asked GROUP BY run
        UNION ALL
        SELECT 'remoteok', run::VARCHAR, 'succeeded', count(*), count(*), NULL FROM t_asked GROUP BY run""",
    ),
)
def run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = {name: responses.outcomes(classified_of(spark, sf_dir, name), feed) for name, feed in landing.BOUND_FEEDS.items()}
    return responses.run_summary(responses_table(spark, sf_dir), requests_of=stored, feeds=landing.BOUND_FEEDS)


# Events as requests of long runs, keys repeated, most of them failing: a run per user, a request per event.
LONG_RUNS = """
    SELECT user_id AS run, event_type AS key, row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS place,
        event_type = 'click' AND event_id % 4 = 0 AS ok, 'Remotive API returned HTTP ' || (500 + event_id % 3) || ' for https://jobs.example/' || event_id AS message
    FROM events"""


def long_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    place = F.row_number().over(Window.partitionBy("user_id").orderBy("event_id")) - 1
    ok = (F.col("event_type") == "click") & (F.col("event_id") % 4 == 0)
    columns = {
        "source": F.lit("remotive"),
        "run_id": F.col("user_id").cast("string"),
        "request_key": F.col("event_type"),
        "request_ordinal": place,
        "url": F.concat(F.lit("https://jobs.example/"), "event_id"),
        "http_status": F.when(ok, 200).otherwise((F.col("event_id") % 3 + 500).cast("int")),
        "error": F.lit(None),
        "body": F.lit('{"jobs":[]}'),
        "country": F.lit(None),
        "fetched_at": F.col("ts"),
    }
    events = landing.table(spark, sf_dir, "events")
    return events.select([columns[f.name].cast(f.dataType).alias(f.name) for f in RESPONSES])


@query(
    "run_summary_long",
    f"""WITH r AS ({LONG_RUNS})
        SELECT 'remotive' AS source, run::VARCHAR AS run_id, CASE WHEN bool_or(ok) THEN 'succeeded' ELSE 'failed' END AS status,
            count(*) AS n_requests, count(*) FILTER (ok) AS n_ok, CASE WHEN NOT bool_or(ok) THEN
                'All categories failed during the Remotive extraction: ' || string_agg(key || ': ' || message, '; ' ORDER BY place) END AS error
        FROM r GROUP BY run""",
)
def run_summary_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    return responses.run_summary(long_runs(spark, sf_dir), ["remotive"])


@query(
    "payload_accounts_long",
    f"""WITH r AS ({LONG_RUNS}),
        good AS (SELECT *, bool_or(ok) OVER (PARTITION BY run) AS any_ok, place // 16 AS chunk FROM r),
        last AS (SELECT * FROM good WHERE NOT ok QUALIFY row_number() OVER (PARTITION BY run, chunk, key ORDER BY place DESC) = 1),
        bad AS (SELECT run, chunk, string_agg(key || '=' || message, '/' ORDER BY key) AS failed FROM last GROUP BY run, chunk)
        SELECT 'remotive' AS source, g.run::VARCHAR AS run_id, g.chunk::INTEGER AS chunk, 0::BIGINT AS job_count,
            coalesce(string_agg(key, '/' ORDER BY place) FILTER (ok), '') AS fetched, coalesce(any_value(failed), '') AS failed
        FROM good g LEFT JOIN bad b ON g.run = b.run AND g.chunk = b.chunk WHERE any_ok GROUP BY g.run, g.chunk""",
)
def payload_accounts_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    return accounts(responses.payloads(long_runs(spark, sf_dir), landing.BOUND_FEEDS["remotive"]))


# The landing path ------------------------------------------------------------------------------

LANDED = " UNION ALL ".join(
    f"SELECT job_id, source, title, company, url, {text('ingested_at')} AS ingested_at FROM {name}"
    for name in ("stg_remotive", "stg_remoteok", "stg_adzuna")
)


def land_all(spark: SparkSession, *goes: DataFrame) -> DataFrame:
    """The newest postings after landing some responses after others into a new table."""
    work = f"{shared_folder(spark)}/land-{uuid.uuid4().hex}"
    for landed in goes:
        build.land(landed, f"{work}/raw", work=work, feeds=landing.BOUND_FEEDS)
    staged = [staging.staging(read_raw(spark, f"{work}/raw", source), source) for source in landing.BUILDERS]
    columns = ["job_id", "source", "title", "company", "url", "ingested_at"]
    return plain(reduce(DataFrame.unionByName, [stage.select(columns) for stage in staged]))


@query("land_latest", using("stg_adzuna", select=LANDED))
def land_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All runs landed in one call."""
    return land_all(spark, responses_table(spark, sf_dir))


@query("land_twice", using("stg_adzuna", select=LANDED))
def land_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs with odd numbers first, then the whole folder: the others are older and newer than those there."""
    landed = responses_table(spark, sf_dir)
    return land_all(spark, landed.where("cast(run_id as long) % 2 = 1"), landed)


LANDED_COUNTS = " UNION ALL ".join(
    f"""SELECT '{source}' AS source, run::VARCHAR AS run_id, count(*) AS job_count_declared, count(*) AS job_count_actual,
        count(*) AS job_count_logged, 'succeeded' AS status FROM {first} GROUP BY run"""
    for source, first in (("remotive", "c_first"), ("remoteok", "t_first"), ("adzuna", "p_first"))
)


@query(
    "land_recovered",
    using(
        "p_first",
        select=f"""{LANDED_COUNTS}
        UNION ALL SELECT 'adzuna', run::VARCHAR, NULL, NULL, 0, 'failed' FROM p_runs WHERE n_ok = 0""",
    ),
)
def land_recovered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What every run landed, after a landing that broke off before its commit and two that did not."""
    landed = responses_table(spark, sf_dir)
    work = f"{shared_folder(spark)}/land-{uuid.uuid4().hex}"
    path, options = f"{work}/raw", {"work": work, "feeds": landing.BOUND_FEEDS}
    build.land(landed.where("cast(run_id as long) % 2 = 1"), path, **options)
    build.stage_landing(landed, path, **options)  # and the driver is lost
    build.land(landed, path, **options)
    sums = [F.sum(f"job_count_{c}").alias(f"job_count_{c}") for c in ("declared", "actual")]
    counted = with_counts(read_raw(spark, path)).groupBy("source", "run_id").agg(*sums)
    runs = read_runs(spark, path).select("source", "run_id", F.col("job_count").alias("job_count_logged"), "status")
    return runs.join(counted, ["source", "run_id"], "left")


# Raw and staging -------------------------------------------------------------------------------

RAW_COUNTS = " UNION ALL ".join(
    f"""SELECT run * 1000 AS raw_id, {text("TIMESTAMP '2025-01-01 00:00:00' + to_hours(run::INTEGER)")} AS ingested_at,
        '{source}' AS source, count(*)::INTEGER AS job_count_declared, count(*)::INTEGER AS job_count_actual
        FROM {first} GROUP BY run"""
    for source, first in (("remotive", "c_first"), ("remoteok", "t_first"), ("adzuna", "p_first"))
)


@query("raw_counts", using("p_first", select=RAW_COUNTS))
def raw_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(with_counts(raw_table(spark, sf_dir)).drop("payload", "document"))


EXPLODED = " UNION ALL ".join(
    f"SELECT run * 1000 AS raw_id, '{source}' AS source, count(*) AS jobs FROM {first} GROUP BY run"
    for source, first in (("remotive", "c_first"), ("remoteok", "t_first"), ("adzuna", "p_first"))
)


@query("json_explode", using("p_first", select=EXPLODED))
def json_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    exploded = staging.explode_jobs(raw_table(spark, sf_dir))
    return exploded.groupBy("raw_id", "source").agg(F.count("job").alias("jobs"))


STAGED = f"""job_id, source, title, company, category, array_to_string(tags, '/') AS tags, location,
    salary_min::DOUBLE AS salary_min, salary_max::DOUBLE AS salary_max, salary_text,
    {text("published_at")} AS published_at, url, {text("ingested_at")} AS ingested_at, raw_id"""


PARSED = " UNION ALL ".join(f"SELECT {STAGED} FROM {name}" for name in ("c_parsed", "t_parsed", "p_parsed"))


@query("stg_parse", using("p_parsed", select=PARSED))
def parse_all_jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    dropped = ["position", "salary_is_predicted", "search_country"]
    parsed = [staging.parse_jobs(raw_of(spark, sf_dir, source), source).drop(*dropped) for source in landing.BUILDERS]
    return plain(reduce(DataFrame.unionByName, parsed))


@query("stg_remotive_jobs", using("stg_remotive", select=f"SELECT {STAGED} FROM stg_remotive"))
def stg_remotive_jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(stage(spark, sf_dir, "remotive"))


@query("stg_remoteok_jobs", using("stg_remoteok", select=f"SELECT {STAGED} FROM stg_remoteok"))
def stg_remoteok_jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(stage(spark, sf_dir, "remoteok"))


@query(
    "stg_adzuna_jobs",
    using(
        "stg_adzuna",
        select=f"SELECT {STAGED}, salary_is_predicted::INTEGER AS salary_is_predicted, search_country FROM stg_adzuna",
    ),
)
def stg_adzuna_jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(stage(spark, sf_dir, "adzuna"))


# Unified postings and marts --------------------------------------------------------------------


@query(
    "int_jobs_normalized",
    using(
        "jobs",
        select=f"""
        SELECT job_key, job_id, source, title, company, category, array_to_string(tags, '/') AS tags, location,
            salary_min::DOUBLE AS salary_min, salary_max::DOUBLE AS salary_max, salary_currency,
            salary_min_usd::DOUBLE AS salary_min_usd, salary_max_usd::DOUBLE AS salary_max_usd, salary_text,
            salary_source, salary_is_predicted::INTEGER AS salary_is_predicted, {text("published_at")} AS published_at, url,
            {text("ingested_at")} AS ingested_at FROM jobs""",
    ),
)
def int_jobs_normalized(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(jobs(spark, sf_dir))


@query(
    "mart_skills",
    using(
        "skills",
        select=f"SELECT job_key, source, skill, skill_type, {text('published_at')} AS published_at FROM skills",
    ),
)
def mart_skills(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(skills(spark, sf_dir))


@query("mart_salary_ranges", using("salary_ranges", select="SELECT * FROM salary_ranges"))
def mart_salary_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(salary_ranges(spark, sf_dir))


@query(
    "mart_companies",
    using(
        "companies",
        select=f"""SELECT company_key, company, job_count, source_count, sources,
            {text("first_published_at")} AS first_published_at, {text("last_published_at")} AS last_published_at FROM companies""",
    ),
)
def mart_companies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(companies(spark, sf_dir))


@query("mart_jobs_over_time", using("jobs_over_time", select="SELECT * FROM jobs_over_time"))
def mart_jobs_over_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jobs_over_time(spark, sf_dir)
