"""Landed API responses to payloads: validate, filter, deduplicate and pack.

A run is landed in chunks of :data:`RESPONSES_PER_CHUNK` responses, each a payload of its own with the
run's id and its number, so that no row grows with the run and a run can be put together again.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobtide import fixed
from jobtide.functions.json import is_json, list_of
from jobtide.functions.text import same_text
from jobtide.operators.dedup import first_seen
from jobtide.operators.ranking import lookup

RESPONSES_PER_CHUNK = 16
# Keys within one source; each function below handles one source, so the source itself is no key.
RUN = ("run_id",)
CHUNK = (*RUN, "chunk")


@dataclass(frozen=True)
class Feed:
    """How one source answers: where its list is, what a request is called, which postings to keep."""

    source: str
    label: str
    shape: str
    requests: str
    list_name: str | None = None
    categories: Mapping[str, str] | None = None
    by_tag: bool = False
    per_page: int | None = None

    @property
    def noun(self) -> str:
        """One request of an error listing."""
        return "page " if self.per_page else ""


FEEDS = {
    "remotive": Feed(
        "remotive",
        "Remotive",
        "an object with a 'jobs' list",
        "categories",
        list_name="jobs",
        categories=fixed.CATEGORY_NAMES,
    ),
    "remoteok": Feed("remoteok", "RemoteOK", "an array of objects", "tags", by_tag=True),
    "adzuna": Feed(
        "adzuna",
        "Adzuna",
        "an object with a 'results' list",
        "pages",
        list_name="results",
        per_page=fixed.RESULTS_PER_PAGE,
    ),
}


def _fields(feed: Feed) -> str:
    """What is read of each element, as variants: any value parses, so only a non-object is NULL."""
    names = ["id", *(["category"] if feed.categories else []), *(["tags"] if feed.by_tag else [])]
    return "array<struct<" + ", ".join(f"{name}: variant" for name in names) + ">>"


def classify(responses: DataFrame, feed: Feed) -> DataFrame:
    """How each response went and, in ``kept``, its postings that belong to the request made.

    The body is parsed as a whole, once for the text of its elements and once for their fields; a parse
    per element costs several times as much. Written out, the rows serve all that follows. A frame
    classified before is returned as it is.
    """
    if "kept" in responses.columns:
        return responses

    def listed(kind: str) -> Column:
        return list_of(F.col("body"), kind, feed.list_name)

    objects = F.col("elements").isNotNull() & F.forall("fields", lambda e: e.isNotNull())
    success = F.col("http_status").between(200, 299)
    message = (
        F.when(
            F.col("error") == "timeout",
            F.format_string(fixed.TIMEOUT_MESSAGE, F.lit(str(fixed.TIMEOUT_SECONDS)), "url"),
        )
        .when(F.col("error").isNotNull(), F.format_string(fixed.TRANSPORT_MESSAGE, "url", "error"))
        .when(
            ~F.coalesce(success, F.lit(False)),
            F.format_string(fixed.STATUS_MESSAGE, F.lit(feed.label), F.col("http_status").cast("string"), "url"),
        )
        .when(objects, None)
        .when(
            F.coalesce(is_json(F.col("body")), F.lit(False)),
            F.format_string(fixed.SHAPE_MESSAGE, F.lit(feed.label), F.lit(feed.shape)),
        )
        .otherwise(F.format_string(fixed.NOT_JSON_MESSAGE, F.lit(feed.label), "url"))
    )
    elements = F.arrays_zip(F.col("elements").alias("job"), F.col("fields").alias("f"))
    asked = F.filter(elements, lambda element: _asked_for(element["f"], feed))
    kept = F.transform(asked, lambda e: F.struct(e["job"].alias("job"), _posting_key(e["f"]["id"]).alias("posting_key")))
    parsed = responses.where(F.col("source") == feed.source).withColumns(
        {"elements": listed("array<string>"), "fields": listed(_fields(feed))}
    )
    return parsed.withColumn("message", message).select(
        *RUN,
        F.expr(f"cast(request_ordinal div {RESPONSES_PER_CHUNK} as int)").alias("chunk"),
        "request_key",
        "request_ordinal",
        "country",
        "fetched_at",
        F.col("message").isNull().alias("ok"),
        "message",
        F.when(F.col("message").isNull(), F.size("elements")).alias("n_elements"),
        F.when(F.col("message").isNull(), kept).alias("kept"),
    )


def _posting_key(posting_id: Column) -> Column:
    """What tells postings apart: a number and a text of the same digits are different ids."""
    is_text = F.schema_of_variant(posting_id) == "STRING"
    key = F.struct(posting_id.cast("string").alias("text"), is_text.alias("is_text"))
    return F.when(F.is_variant_null(posting_id) | posting_id.isNull(), None).otherwise(key)


def outcomes(responses: DataFrame, feed: Feed) -> DataFrame:
    """One row per request: how it went and how many elements it returned."""
    return classify(responses, feed).drop("kept")


def run_outcomes(requests: DataFrame, feed: Feed) -> DataFrame:
    """One row per run: requests that went well, and the first short page, after which none is used."""
    short = F.col("ok") & (F.col("n_elements") < (feed.per_page or 0))
    return requests.groupBy(*RUN).agg(
        F.count_if("ok").alias("n_ok"),
        F.min(F.when(short, F.col("request_ordinal"))).alias("stop"),
        F.min("chunk").alias("_first"),
        F.max("chunk").alias("_last"),
    )


def postings(responses: DataFrame, feed: Feed) -> DataFrame:
    """The postings of every successful response, in order, that belong to the request made.

    They are filtered before the explode, and the explode is an outer one: either kind of filter after
    it would be pushed below the parse and repeat it.
    """
    exploded = classify(responses, feed).select(
        *CHUNK, "request_key", "request_ordinal", F.posexplode_outer("kept").alias("position", "_e")
    )
    return exploded.where(F.col("position").isNotNull()).select(
        *CHUNK, "request_key", "request_ordinal", "position", "_e.job", "_e.posting_key"
    )


def _asked_for(fields: Column, feed: Feed) -> Column:
    """Whether an element is a posting and the one its request asked for."""
    keep = F.lit(True)
    if feed.list_name is None:
        # Elements without an id are notices, not postings; one holding null is a posting.
        keep = keep & fields["id"].isNotNull()
    if feed.categories is not None:
        wanted = lookup(F.col("request_key"), dict(feed.categories))
        keep = keep & same_text(fields["category"].cast("string"), wanted)
    if feed.by_tag:
        tags = F.try_variant_get(fields["tags"], "$", "array<string>")
        keep = keep & F.exists(tags, lambda tag: same_text(tag, F.col("request_key")))
    return keep


def distinct_postings(jobs: DataFrame) -> DataFrame:
    """The first posting of each id in a run; those without an id are all kept."""
    return first_seen(jobs, RUN, F.col("posting_key"), ["request_ordinal", "position"])


def used_only(rows: DataFrame, runs: DataFrame) -> DataFrame:
    """Requests or postings up to and including the first short page of their run.

    Runs without any good request have none. Joining per chunk spreads a large run over tasks.
    """
    per_chunk = runs.select(*RUN, "n_ok", "stop", F.explode(F.sequence("_first", "_last")).alias("chunk"))
    used = "n_ok > 0 and (stop is null or request_ordinal <= stop)"
    return rows.join(per_chunk, list(CHUNK)).where(used).drop("n_ok", "stop")


def payload_text(jobs: Column, account: Column) -> Column:
    """Payload of a list of JSON postings and a JSON object of further fields.

    Postings are JSON text already and go in as they are; a missing list is an empty one.
    """
    return F.concat(
        F.lit('{"job-count":'),
        F.coalesce(F.size(jobs), F.lit(0)).cast("string"),
        F.lit(',"jobs":['),
        F.coalesce(F.array_join(jobs, ","), F.lit("")),
        F.lit("],"),
        F.substring(account, 2, 2**31 - 1),
    )


def pack_jobs(jobs: DataFrame) -> DataFrame:
    """The postings of each chunk, in order. A chunk is bounded by the size of its responses."""
    listed = F.sort_array(F.collect_list(F.struct("request_ordinal", "position", "job")))
    return jobs.groupBy(*CHUNK).agg(F.transform(listed, lambda row: row["job"]).alias("jobs"))


def run_times(requests: DataFrame) -> DataFrame:
    """When each run was fetched: the time of its last response."""
    return requests.groupBy(*RUN).agg(F.max("fetched_at").alias("ingested_at"))


def payloads(responses: DataFrame, feed: Feed) -> DataFrame:
    """The payloads of every run of a source in which some request went well.

    A key that failed more than once keeps its last message.
    """
    classified = classify(responses, feed)
    requests = outcomes(classified, feed)
    runs = run_outcomes(requests, feed)
    jobs = distinct_postings(postings(classified, feed))
    packed = pack_jobs(used_only(jobs, runs) if feed.per_page else jobs)
    used = used_only(requests, runs)
    number = F.col("request_key").cast("int") if feed.per_page else F.col("request_key")
    request = F.struct("request_ordinal", number.alias("key"), "request_key", "ok", "message")
    accounts = used.groupBy(*CHUNK).agg(
        F.sort_array(F.collect_list(request)).alias("requests"), F.max("country").alias("country")
    )
    accounts = accounts.join(run_times(requests), list(RUN)).withColumn("bad", F.filter("requests", lambda r: ~r["ok"]))
    fetched = F.transform(F.filter("requests", lambda r: r["ok"]), lambda r: r["key"])
    last = F.filter(
        "bad", lambda r: ~F.exists("bad", lambda o: (o["request_key"] == r["request_key"]) & (o["request_ordinal"] > r["request_ordinal"]))
    )
    failed = F.transform(last, lambda r: F.struct(r["request_key"], r["message"]))
    account = F.to_json(
        F.struct(
            *(["country"] if feed.per_page else []),
            fetched.alias(f"fetched-{feed.requests}"),
            F.map_from_entries(failed).alias(f"failed-{feed.requests}"),
        )
    )
    return accounts.join(packed, list(CHUNK), "left").select(
        F.lit(feed.source).alias("source"),
        *CHUNK,
        "ingested_at",
        F.coalesce(F.size("jobs"), F.lit(0)).cast("long").alias("job_count"),
        payload_text(F.col("jobs"), account).alias("payload"),
    )


def chunk_places(requests: DataFrame, feed: Feed) -> DataFrame:
    """Numbers of the chunks with a payload that grow with the run's time, the run and the chunk.

    Only these small rows are sorted; gaps stay between the partitions of the sort.
    """
    used = used_only(requests, run_outcomes(requests, feed)).select(*CHUNK).distinct()
    order = ["ingested_at", *CHUNK]
    ranged = used.join(run_times(requests), list(RUN)).repartitionByRange(*order).sortWithinPartitions(*order)
    return ranged.select(*CHUNK, F.monotonically_increasing_id().alias("place"))


def all_payloads(responses: DataFrame, sources: Sequence[str] = fixed.SOURCES) -> DataFrame:
    """Payloads of the chosen sources."""
    return reduce(DataFrame.unionByName, [payloads(responses, FEEDS[name]) for name in known_sources(sources)])


def known_sources(sources: Sequence[str]) -> list[str]:
    unknown = [name for name in sources if name not in FEEDS]
    if unknown:
        raise ValueError(f"Unknown source(s) {unknown}; expected a subset of {list(FEEDS)}")
    return list(sources)


def run_counts(requests: DataFrame, feed: Feed) -> DataFrame:
    """One row per run: whether any request went well, and the request counts."""
    counted = requests.groupBy(*RUN).agg(F.count("*").alias("n_requests"), F.count_if("ok").alias("n_ok"))
    status = F.when(F.col("n_ok") > 0, "succeeded").otherwise("failed")
    return counted.select(F.lit(feed.source).alias("source"), *RUN, status.alias("status"), "n_requests", "n_ok")


def failures(requests: DataFrame, counts: DataFrame, feed: Feed) -> DataFrame:
    """Every request of the runs in which none went well, as a row of its own."""
    failed = counts.where(F.col("n_ok") == 0).select(*RUN)
    rows = requests.join(failed, list(RUN), "left_semi")
    return rows.select(F.lit(feed.source).alias("source"), *CHUNK, "request_ordinal", "request_key", "message")


def error_texts(failed: DataFrame, feed: Feed) -> DataFrame:
    """The failures of each run joined to one text, in order, chunk by chunk."""
    listed = F.sort_array(
        F.collect_list(F.struct("request_ordinal", F.concat(F.lit(feed.noun), "request_key", F.lit(": "), "message").alias("text")))
    )
    chunks = failed.groupBy(*CHUNK).agg(F.array_join(F.transform(listed, lambda r: r["text"]), "; ").alias("text"))
    parts = F.sort_array(F.collect_list(F.struct("chunk", "text")))
    text = F.array_join(F.transform(parts, lambda r: r["text"]), "; ")
    return chunks.groupBy(*RUN).agg(F.format_string(fixed.ALL_REQUESTS_FAILED, F.lit(feed.requests), F.lit(feed.label), text).alias("error"))


def run_summary(
    responses: DataFrame,
    sources: Sequence[str] = fixed.SOURCES,
    requests_of: Mapping[str, DataFrame] | None = None,
    feeds: Mapping[str, Feed] = FEEDS,
) -> DataFrame:
    """One row per run with its counts; that of a failed run carries its error, which lists every request.

    Nothing is gathered of runs in which some request went well, however many failed. ``requests_of``
    takes stored outcomes by source.
    """
    frames = []
    for name in known_sources(sources):
        feed = feeds[name]
        requests = (requests_of or {}).get(name)
        if requests is None:
            requests = outcomes(responses, feed)
        counts = run_counts(requests, feed)
        frames.append(counts.join(error_texts(failures(requests, counts, feed), feed), list(RUN), "left"))
    columns = ["source", *RUN, "status", "n_requests", "n_ok", "error"]
    return reduce(DataFrame.unionByName, [frame.select(columns) for frame in frames])
