"""The driver's tables as landed API responses, so that every layer runs on their rows.

Orders answer as the feed with categories, events as the feed with tags, parts as the paged feed.
Bodies hold a bounded block of keys each; all rows are used.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from jobtide import fixed
from jobtide.functions.json import document
from jobtide.plans.responses import FEEDS, Feed, payloads
from jobtide.schemas import RESPONSES

ORDERS_PER_RUN = 1000
EVENTS_PER_RUN = 1000
PARTS_PER_RUN = 200
PAGE_SPAN = 50
SHORT_PAGE = 20

PRIORITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")
EVENT_TYPES = ("click", "error", "purchase", "signup", "view")
COUNTRIES = ("at", "au", "be", "br", "ca", "ch", "de", "es", "fr", "gb", "in", "it", "mx", "nl", "nz", "pl", "sg", "us", "za", "xx")

# The paged feed of the driver's parts: pages span 50 keys, and fewer than 20 results end a run.
PAGED: Feed = replace(FEEDS["adzuna"], per_page=SHORT_PAGE)
BOUND_FEEDS = {"remotive": FEEDS["remotive"], "remoteok": FEEDS["remoteok"], "adzuna": PAGED}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _array(values) -> Column:
    return F.array(*[F.lit(v) for v in values])


def _place(value: str, values) -> Column:
    return (F.array_position(_array(values), F.col(value)) - 1).cast("int")


def _money(value: Column) -> Column:
    return value.cast("decimal(18,4)")


def _bodies(rows: DataFrame, *by: str, order: str, job: Callable[[Column], Column]) -> DataFrame:
    # Postings and their JSON are made after the shuffle: only the columns they are made of travel, and the
    # work is spread over tasks whatever the file layout.
    plain = F.struct(*[c for c in rows.columns if c not in (*by, "size_ok")])
    gathered = rows.groupBy(*by).agg(F.collect_list(plain).alias("rows"), F.max("size_ok").alias("size_ok"))
    listed = F.sort_array(F.transform("rows", lambda r: F.struct(r[order].alias("at"), job(r).alias("job"))))
    return gathered.select(*by, F.array_join(F.transform(listed, lambda r: F.to_json(r["job"])), ",").alias("list"), "size_ok")


def _shared_bodies(rows: DataFrame, order: str, job: Callable[[Column], Column]) -> DataFrame:
    """Bodies of runs whose requests return the rows of their own place and of the next: a row stands in two of them.

    A run is gathered once and its postings are made once, for both. Rows without a place answer the request without a
    number, twice.
    """

    def asked(place: Column) -> list[Column]:
        return [place, F.pmod(place + 4, F.lit(5))]

    plain = F.struct(*[c for c in rows.columns if c != "run_id"])
    gathered = rows.groupBy("run_id").agg(F.collect_list(plain).alias("rows"))
    listed = F.sort_array(F.transform("rows", lambda r: F.struct(r[order].alias("at"), job(r).alias("job"), r["place"].alias("place"))))
    made = gathered.select(
        "run_id",
        F.array_distinct(F.flatten(F.transform("rows", lambda r: F.array(*asked(r["place"]))))).alias("requests"),
        F.transform(listed, lambda r: F.struct(r["place"], F.to_json(r["job"]).alias("text"))).alias("made"),
    )
    bodies = made.select("run_id", F.explode("requests").alias("request_ordinal"), "made")
    ordinal = F.col("request_ordinal")
    own = F.filter("made", lambda r: asked(r["place"])[0].eqNullSafe(ordinal) | asked(r["place"])[1].eqNullSafe(ordinal))
    texts = F.transform(own, lambda r: r["text"])
    twice = F.flatten(F.transform(own, lambda r: F.array(r["text"], r["text"])))
    return bodies.select("run_id", "request_ordinal", F.array_join(F.when(ordinal.isNull(), twice).otherwise(texts), ",").alias("list"))


def category_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run per 1000 order keys, a request per priority; each body also holds the next priority's orders."""
    slugs, names = list(fixed.CATEGORY_NAMES)[:5], list(fixed.CATEGORY_NAMES.values())[:5]
    rows = table(spark, sf_dir, "orders").select(
        *["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"],
        F.expr(f"o_orderkey div {ORDERS_PER_RUN}").alias("run_id"),
        _place("o_orderpriority", PRIORITIES).alias("place"),
    )

    def job(r: Column) -> Column:
        name = F.element_at(_array(names), r["place"] + 1)
        buyer = F.call_function("div", r["o_custkey"], F.lit(10))
        return F.struct(
            r["o_custkey"].alias("id"),
            F.concat(F.lit("Order "), r["o_orderkey"]).alias("title"),
            F.when(r["o_orderstatus"] == "F", F.concat(F.lit("BUYER "), buyer))
            .otherwise(F.concat(F.lit("  Buyer "), buyer, F.lit(" ")))
            .alias("company_name"),
            F.when(r["o_orderstatus"] == "F", F.upper(name)).otherwise(name).alias("category"),
            F.array(
                r["o_orderpriority"],
                F.concat(F.lit(" "), F.lower(r["o_orderpriority"])),
                r["o_orderstatus"],
                F.lit(" "),
            ).alias("tags"),
            r["o_orderstatus"].alias("candidate_required_location"),
            F.when(r["o_orderstatus"] == "P", "").otherwise(F.concat(F.lit("$"), _money(r["o_totalprice"]))).alias("salary"),
            F.date_format(r["o_orderdate"], "yyyy-MM-dd'T'HH:mm:ss").alias("publication_date"),
            F.concat(F.lit("https://jobs.example/c/"), r["o_orderkey"]).alias("url"),
        )

    bodies = _shared_bodies(rows, order="o_orderkey", job=job)
    return _responses(
        bodies,
        "remotive",
        F.element_at(_array(slugs), F.col("request_ordinal") + 1),
        F.concat(F.lit('{"job-count":0,"jobs":['), "list", F.lit("]}")),
    )


def tag_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run per 1000 event ids, a request per event type; each body also holds the next type's events."""
    tags = fixed.REQUEST_TAGS[:5]
    rows = table(spark, sf_dir, "events").select(
        *["event_id", "ts", "user_id", "event_type", "value"],
        F.expr(f"event_id div {EVENTS_PER_RUN}").alias("run_id"),
        _place("event_type", EVENT_TYPES).alias("place"),
        F.from_json("props", "k int")["k"].alias("k"),
    )

    def job(r: Column) -> Column:
        salary = (_money(r["value"]) * 1000).cast("long")
        return F.struct(
            F.concat(r["user_id"], F.lit("-"), r["k"]).alias("id"),
            r["event_type"].alias("position"),
            F.concat(F.when(r["k"] < 50, "Buyer ").otherwise("Team "), F.call_function("div", r["user_id"], F.lit(10))).alias("company"),
            F.when(
                r["k"] > 0,
                F.array(
                    F.upper(F.element_at(_array(tags), r["place"] + 1)),
                    F.concat(F.lit("k"), F.call_function("div", r["k"], F.lit(10))),
                    F.lit(" Remote"),
                ),
            ).alias("tags"),
            F.when(r["event_type"] == "error", "").otherwise(r["event_type"]).alias("location"),
            F.when(r["event_type"].isin("view", "signup"), "0").otherwise(salary.cast("string")).alias("salary_min"),
            F.when(r["event_type"] == "signup", "0").otherwise((salary + r["k"] * 100).cast("string")).alias("salary_max"),
            F.date_format(r["ts"], "yyyy-MM-dd'T'HH:mm:ss'+00:00'").alias("date"),
            F.concat(F.lit("https://jobs.example/t/"), r["event_id"]).alias("url"),
        )

    bodies = _shared_bodies(rows, order="event_id", job=job)
    return _responses(
        bodies,
        "remoteok",
        F.element_at(_array(tags), F.col("request_ordinal") + 1),
        F.concat(F.lit('[{"last_updated":1,"legal":"notice"},'), "list", F.lit("]")),
    )


def paged_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run per 200 part keys, paged by key and size; a page without small parts failed."""
    rows = table(spark, sf_dir, "part").select(
        *["p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"],
        F.expr(f"p_partkey div {PARTS_PER_RUN}").alias("run_id"),
        F.expr(f"cast((p_partkey % {PARTS_PER_RUN} + p_size) div {PAGE_SPAN} as int)").alias("request_ordinal"),
        (F.col("p_size") <= 2).alias("size_ok"),
    )

    def job(r: Column) -> Column:
        size, price = r["p_size"], _money(r["p_retailprice"])
        return F.struct(
            F.concat(r["p_name"], F.lit("|"), r["p_brand"]).alias("id"),
            r["p_name"].alias("title"),
            F.struct(F.concat(F.lit("Buyer "), size).alias("display_name")).alias("company"),
            F.struct(F.concat(r["p_type"], F.lit(" Jobs")).alias("label")).alias("category"),
            F.struct(r["p_brand"].alias("display_name")).alias("location"),
            F.when(size > 10, price * 40).alias("salary_min"),
            F.when(size > 5, price * 50).alias("salary_max"),
            F.when(size > 25, "1").otherwise("0").alias("salary_is_predicted"),
            F.concat(F.date_format(F.date_add(F.lit("2024-01-01").cast("date"), size), "yyyy-MM-dd"), F.lit("T08:30:00Z")).alias("created"),
            F.concat(F.lit("https://jobs.example/p/"), r["p_partkey"]).alias("redirect_url"),
        )

    bodies = _bodies(rows, "run_id", "request_ordinal", order="p_partkey", job=job)
    country = F.element_at(_array(COUNTRIES), F.pmod("run_id", F.lit(len(COUNTRIES))).cast("int") + 1)
    return _responses(
        bodies,
        "adzuna",
        (F.col("request_ordinal") + 1).cast("string"),
        F.concat(F.lit('{"count":0,"results":['), "list", F.lit("]}")),
        status=F.when(F.col("size_ok"), 200).otherwise(500),
        country=country,
    )


def _responses(bodies, source, key, body, status=None, country=None) -> DataFrame:
    columns = {
        "source": F.lit(source),
        "run_id": F.col("run_id").cast("string"),
        "request_key": key,
        "request_ordinal": F.col("request_ordinal"),
        "url": F.concat(F.lit(f"https://{source}.example/"), F.col("request_ordinal")),
        "http_status": F.lit(200) if status is None else status,
        "error": F.lit(None),
        "body": body,
        "country": F.lit(None) if country is None else country,
        "fetched_at": F.timestamp_seconds(F.lit(1735689600) + F.col("run_id").cast("long") * 3600),
    }
    return bodies.select([columns[f.name].cast(f.dataType).alias(f.name) for f in RESPONSES])


BUILDERS = {"remotive": category_responses, "remoteok": tag_responses, "adzuna": paged_responses}


def raw(responses: DataFrame, feed: Feed) -> DataFrame:
    """The landing table of one source: a run is fetched an hour after the one before."""
    run = F.col("run_id").cast("long")
    return payloads(responses, feed).select(
        (run * 1000 + F.col("chunk")).alias("raw_id"),
        "ingested_at",
        "source",
        "payload",
        document(F.col("payload")).alias("document"),
    )
