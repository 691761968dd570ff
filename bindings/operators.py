"""The operators on the driver's tables directly, under their own column names."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bindings.landing import table
from bindings.model import plain
from bindings.registry import query
from bindings.sql import CTES, text
from jobtide.functions import salary, time
from jobtide.functions.text import flag, fold, null_if, same_text
from jobtide.operators.currency import convert_bounds
from jobtide.operators.dedup import first_seen, latest_by_key
from jobtide.operators.grains import Grain, multi_grain_stats, weekly_counts
from jobtide.operators.labels import company_rollup, explode_labels, only_in, sorted_values
from jobtide.operators.ranking import drop_in, keep_in, lookup, top_k
from jobtide.plans.responses import pack_jobs, payload_text
from jobtide.plans.staging import explode_jobs
from jobtide.sources.marts import coerce
from jobtide.sources.raw import append_payloads, read_raw
from jobtide.sources.seeds import read_rates
from jobtide.sources.workdir import shared_folder


@query(
    "raw_scan",
    """SELECT 'remotive' AS source, props AS payload, count(*) AS n, 1 AS ids_unique FROM events
       WHERE event_type IN ('click', 'error') GROUP BY props""",
)
def raw_append_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events appended as payloads in two goes, then one source read back."""
    path = f"{shared_folder(spark)}/raw-{uuid.uuid4().hex}"
    events = table(spark, sf_dir, "events")
    kind = F.col("event_type")
    source = F.when(kind.isin("click", "error"), "remotive").when(kind == "view", "remoteok").otherwise("adzuna")
    rows = events.select(source.alias("source"), F.col("props").alias("payload"), "event_type")
    append_payloads(rows.where(kind != "error"), path)
    append_payloads(rows.where(kind == "error"), path)
    raw = read_raw(spark, path, "remotive")
    ids_unique = F.count_distinct("raw_id") == F.count("raw_id")
    return raw.groupBy("source", "payload").agg(
        F.count("*").alias("n"), ids_unique.cast("int").alias("ids_unique")
    )


@query(
    "coerce_types",
    """SELECT c_custkey::VARCHAR AS company_key, c_name AS company, c_nationkey::BIGINT AS job_count, c_custkey AS source_count,
        c_mktsegment AS sources, '2024-05-06 07:08:09' AS first_published_at, NULL::VARCHAR AS last_published_at FROM customer""",
)
def coerce_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("company_key"),
        F.col("c_name").alias("company"),
        F.col("c_nationkey").cast("string").alias("job_count"),
        F.col("c_custkey").cast("string").alias("source_count"),
        F.col("c_mktsegment").alias("sources"),
        F.lit("2024-05-06T09:08:09+02:00").alias("first_published_at"),
        F.lit(None).cast("string").alias("last_published_at"),
    )
    return plain(coerce("mart_companies", texts))


def _folded(text: str) -> str:
    return f"replace(replace(replace(replace(lower(replace({text}, 'İ', 'i̇')), 'ß', 'ss'), 'ς', 'σ'), 'ﬁ', 'fi'), 'ŉ', 'ʼn')"


FOLDED = ("STRASSE", "Straße", "ΟΔΟΣ", "οδος", "İstanbul", "i̇STANBUL", "ﬁrst", "FIRST", "ŉ", "İ")


@query(
    "fold_match",
    f"""WITH w AS (SELECT c_custkey AS k, c_mktsegment || ' ' || {list(FOLDED)}[c_custkey % {len(FOLDED)} + 1] AS mine,
            lower(c_mktsegment) || ' ' || {list(FOLDED)}[c_nationkey % {len(FOLDED)} + 1] AS other FROM customer)
        SELECT k, {_folded("mine")} AS folded, ({_folded("mine")} = {_folded("other")})::INTEGER AS same FROM w""",
)
def fold_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts whose case folding is not their lower case."""
    words = F.array(*[F.lit(word) for word in FOLDED])

    def one(number: str) -> Column:
        return F.concat(F.lit(" "), F.element_at(words, (F.col(number) % len(FOLDED) + 1).cast("int")))

    mine, other = F.concat("c_mktsegment", one("c_custkey")), F.concat(F.lower("c_mktsegment"), one("c_nationkey"))
    rows = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"), mine.alias("mine"), other.alias("other"))
    return rows.select("k", fold(F.col("mine")).alias("folded"), same_text(F.col("mine"), F.col("other")).cast("int").alias("same"))


@query(
    "stg_latest",
    """SELECT user_id, event_id, event_type, value FROM events
       QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""",
)
def latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    newest = latest_by_key(table(spark, sf_dir, "events"), ["user_id"], ["ts", "event_id"])
    return newest.select("user_id", "event_id", "event_type", "value")


@query(
    "first_seen",
    """SELECT event_type, event_id, user_id FROM events
       QUALIFY user_id < 10 OR row_number() OVER (PARTITION BY event_type, CASE WHEN user_id >= 10 THEN user_id END ORDER BY ts, event_id) = 1""",
)
def first_seen_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first event of each type and user; low user ids stand for a missing id and are all kept."""
    user = F.when(F.col("user_id") >= 10, F.col("user_id"))
    rows = first_seen(table(spark, sf_dir, "events"), ["event_type"], user, ["ts", "event_id"])
    return rows.select("event_type", "event_id", "user_id")


@query(
    "fx_normalize",
    f"""WITH rates AS ({CTES["rates"]}), bounds AS (
        SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'gb' WHEN 'O' THEN 'us' ELSE 'xx' END AS country,
            CASE WHEN o_orderpriority <> '5-LOW' THEN o_totalprice::DECIMAL(18,4) END AS lo,
            CASE WHEN o_orderpriority NOT IN ('5-LOW', '2-HIGH') THEN (o_totalprice::DECIMAL(18,4) * 2)::DECIMAL(18,4) END AS hi FROM orders)
       SELECT o_orderkey, CASE WHEN lo IS NOT NULL OR hi IS NOT NULL THEN currency_code END AS salary_currency,
           round(lo * usd_rate)::DOUBLE AS salary_min_usd, round(hi * usd_rate)::DOUBLE AS salary_max_usd,
           CASE WHEN lo IS NULL AND hi IS NULL OR usd_rate IS NULL THEN 'missing' WHEN currency_code = 'USD' THEN 'structured_usd'
               ELSE 'structured_converted' END AS salary_source
       FROM bounds LEFT JOIN rates ON country = country_code""",
)
def fx_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    price, status, priority = F.col("o_totalprice").cast("decimal(18,4)"), F.col("o_orderstatus"), F.col("o_orderpriority")
    bounds = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.when(status == "F", "gb").when(status == "O", "us").otherwise("xx").alias("country"),
        F.when(priority != "5-LOW", price).alias("lo"),
        F.when(~priority.isin("5-LOW", "2-HIGH"), (price * 2).cast("decimal(18,4)")).alias("hi"),
    )
    return plain(convert_bounds(bounds, read_rates(spark), "country", "lo", "hi").drop("country", "lo", "hi"))


@query(
    "salary_source_label",
    """WITH s AS (SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderpriority END AS t,
            CASE WHEN o_orderstatus = 'F' THEN o_totalprice::DECIMAL(18,4) END AS lo,
            CASE WHEN o_orderpriority = '1-URGENT' THEN o_totalprice::DECIMAL(18,4) END AS hi FROM orders)
       SELECT o_orderkey, CASE WHEN t IS NOT NULL THEN 'text_only' ELSE 'missing' END AS text_label,
           CASE WHEN lo IS NOT NULL OR hi IS NOT NULL THEN 'structured_usd' ELSE 'missing' END AS usd_label,
           CASE WHEN lo IS NOT NULL AND hi IS NOT NULL THEN (lo + hi) / 2 ELSE coalesce(lo, hi) END::DOUBLE AS mid,
           CASE WHEN t = '1-URGENT' THEN 1 WHEN t IS NOT NULL THEN 0 END AS urgent FROM s""",
)
def salary_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    price = F.col("o_totalprice").cast("decimal(18,4)")
    rows = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.when(status != "P", priority).alias("t"),
        F.when(status == "F", price).alias("lo"),
        F.when(priority == "1-URGENT", price).alias("hi"),
    )
    lo, hi = F.col("lo"), F.col("hi")
    return plain(
        rows.select(
            "o_orderkey",
            salary.text_label(F.col("t")).alias("text_label"),
            salary.usd_label(lo, hi).alias("usd_label"),
            salary.midpoint(lo, hi).alias("mid"),
            flag(F.when(F.col("t") == "1-URGENT", "1").when(F.col("t").isNotNull(), "0")).alias("urgent"),
        )
    )


GRAINED = """SELECT '{label}' AS level, {keys}, count(*) AS row_count, round(sum(v)::DOUBLE / count(v), 6) AS avg_value,
    round(quantile_cont(v::DOUBLE, 0.5), 6) AS median_value, min({low})::DOUBLE AS min_low, max({high})::DOUBLE AS max_high
    FROM r {where} GROUP BY {by}"""


@query(
    "multi_grain_orders",
    "WITH r AS (SELECT *, o_totalprice::DECIMAL(18,4) AS v FROM orders) "
    + " UNION ALL ".join(
        GRAINED.format(label=label, keys=keys, low="v", high="v", where=where, by=by)
        for label, keys, where, by in (
            ("status", "o_orderstatus, NULL::VARCHAR AS o_orderpriority, NULL::BIGINT AS o_custkey", "", "o_orderstatus"),
            ("status_priority", "o_orderstatus, o_orderpriority, NULL::BIGINT AS o_custkey", "", "o_orderstatus, o_orderpriority"),
            ("customer", "NULL::VARCHAR AS o_orderstatus, NULL::VARCHAR AS o_orderpriority, o_custkey", "", "o_custkey"),
        )
    ),
)
def multi_grain_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    grains = (
        Grain("status", ("o_orderstatus",)),
        Grain("status_priority", ("o_orderstatus", "o_orderpriority")),
        Grain("customer", ("o_custkey",)),
    )
    price = F.col("o_totalprice").cast("decimal(18,4)")
    return plain(
        multi_grain_stats(table(spark, sf_dir, "orders"), grains, price, price, price, level="level", scale=6)
    )


@query(
    "multi_grain_lineitem",
    "WITH r AS (SELECT *, CASE WHEN l_linestatus = 'F' THEN l_returnflag END AS flag, l_extendedprice::DECIMAL(18,4) AS v FROM lineitem) "
    + " UNION ALL ".join(
        GRAINED.format(label=label, keys=keys, low="l_quantity", high="l_quantity", where=where, by=by)
        for label, keys, where, by in (
            ("status", "l_linestatus, NULL::VARCHAR AS flag", "", "l_linestatus"),
            ("flag", "l_linestatus, flag", "WHERE flag IS NOT NULL", "l_linestatus, flag"),
        )
    ),
)
def multi_grain_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").withColumn(
        "flag", F.when(F.col("l_linestatus") == "F", F.col("l_returnflag"))
    )
    grains = (Grain("status", ("l_linestatus",)), Grain("flag", ("l_linestatus", "flag"), required=("flag",)))
    value, quantity = F.col("l_extendedprice").cast("decimal(18,4)"), F.col("l_quantity")
    return plain(multi_grain_stats(rows, grains, value, quantity, quantity, level="level", scale=6))


@query(
    "week_bucket",
    """SELECT date_trunc('week', ts)::DATE AS week_start, event_type, count(*) AS n FROM events GROUP BY ALL""",
)
def week_bucket(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    return weekly_counts(events, "ts", "event_type", count="n")


@query(
    "explode_labels",
    """SELECT DISTINCT * FROM (
        SELECT p_brand, lower(trim(unnest(string_split(p_name, ' ')))) AS skill, 'tag' AS skill_type FROM part
        UNION ALL SELECT p_brand, lower(trim(p_type)), 'category' FROM part) WHERE skill <> ''""",
)
def label_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return explode_labels(table(spark, sf_dir, "part"), ["p_brand"], F.split("p_name", " "), F.col("p_type"))


@query(
    "company_rollup",
    f"""SELECT lower(trim(company)) AS company_key, max(trim(company)) AS company, count(*) AS job_count,
        count(DISTINCT p_brand) AS source_count, string_agg(DISTINCT p_brand, ', ' ORDER BY p_brand) AS sources,
        {text("min(seen)")} AS first_published_at, {text("max(seen)")} AS last_published_at
        FROM (SELECT *, CASE WHEN p_size > 25 THEN upper(p_name) || '  ' WHEN p_size < 3 THEN ' ' ELSE p_name END AS company,
            TIMESTAMP '2024-01-01' + to_days(p_size) AS seen FROM part)
        WHERE trim(company) <> '' GROUP BY lower(trim(company))""",
)
def rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = F.col("p_size")
    parts = table(spark, sf_dir, "part").withColumns(
        {
            "company": F.when(size > 25, F.concat(F.upper("p_name"), F.lit("  ")))
            .when(size < 3, " ")
            .otherwise(F.col("p_name")),
            "seen": F.date_add(F.lit("2024-01-01").cast("date"), size).cast("timestamp"),
        }
    )
    return plain(company_rollup(parts, F.col("company"), "p_brand", "seen"))


@query(
    "label_sets",
    """SELECT DISTINCT l_orderkey FROM lineitem
       WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'P')""",
)
def label_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    pending = table(spark, sf_dir, "orders").where(F.col("o_orderstatus") == "P")
    pending = pending.select(F.col("o_orderkey").alias("l_orderkey"))
    return sorted_values(only_in(table(spark, sf_dir, "lineitem"), pending, "l_orderkey"), "l_orderkey")


@query(
    "list_filters",
    """SELECT o_orderstatus, o_orderpriority,
        CASE o_orderpriority WHEN '1-URGENT' THEN 'now' WHEN '3-MEDIUM' THEN 'soon' END AS label, count(*) AS n FROM orders
        WHERE o_orderstatus IN ('F', 'P') AND o_orderpriority NOT IN ('2-HIGH', '5-LOW') GROUP BY ALL""",
)
def list_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = keep_in(table(spark, sf_dir, "orders"), "o_orderstatus", ["F", "P"])
    rows = drop_in(keep_in(rows, "o_custkey", None), "o_orderpriority", ["2-HIGH", "5-LOW"])
    label = lookup(F.col("o_orderpriority"), {"1-URGENT": "now", "3-MEDIUM": "soon"})
    return rows.groupBy("o_orderstatus", "o_orderpriority", label.alias("label")).agg(F.count("*").alias("n"))


@query(
    "top_customers",
    """SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey ORDER BY n DESC, o_custkey LIMIT 20""",
)
def top_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.count("*").alias("n"))
    return top_k(counted, "n", "o_custkey", 20)


@query(
    "scalar_functions",
    f"""SELECT event_id, {text("ts")} AS naive_utc, (props->>'k') AS k_text,
        CASE WHEN event_type = 'view' THEN NULL ELSE event_type END AS not_view,
        CASE WHEN lower(event_type) = 'click' THEN 1 ELSE 0 END AS is_click,
        strftime(ts, '%Y-%m-%dT%H:%M:%S+00:00') AS csv_ts,
        round(value::DECIMAL(18,4) * 1.35)::DOUBLE AS rounded FROM events""",
)
def scalar_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    naive = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    rows = table(spark, sf_dir, "events").withColumn("at", time.utc_from_naive(naive))
    return rows.select(
        "event_id",
        F.date_format("at", "yyyy-MM-dd HH:mm:ss").alias("naive_utc"),
        F.from_json("props", "k string")["k"].alias("k_text"),
        null_if(F.col("event_type"), "view").alias("not_view"),
        same_text(F.upper("event_type"), F.lit("Click")).cast("int").alias("is_click"),
        time.csv_timestamp(F.col("at")).alias("csv_ts"),
        salary.whole_dollars(F.col("value").cast("decimal(18,4)"), F.lit("1.35").cast("decimal(18,6)"))
        .cast("double")
        .alias("rounded"),
    )


@query(
    "document_payloads",
    """SELECT source, lang, count(*) AS postings, sum(length(text))::BIGINT AS characters, count(DISTINCT text) AS texts
       FROM documents GROUP BY source, lang""",
)
def document_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole texts packed into payloads of up to 64 documents and parsed back out of them."""
    job = F.to_json(F.struct(F.col("doc_id").alias("id"), F.col("text").alias("title"), "source", "lang"))
    docs = table(spark, sf_dir, "documents").select(
        F.lit("remotive").alias("run_id"),
        F.expr("doc_id div 64").alias("chunk"),
        F.lit(0).alias("request_ordinal"),
        F.col("doc_id").alias("position"),
        job.alias("job"),
    )
    raw = pack_jobs(docs).select(
        F.col("chunk").alias("raw_id"),
        F.lit(None).cast("timestamp").alias("ingested_at"),
        F.col("run_id").alias("source"),
        payload_text(F.col("jobs"), F.lit('{"fetched-categories":[]}')).alias("payload"),
    )
    parsed = explode_jobs(raw).select(F.try_variant_get("job", "$", "struct<title: string, source: string, lang: string>").alias("j"))
    return parsed.groupBy("j.source", "j.lang").agg(
        F.count("*").alias("postings"),
        F.sum(F.length("j.title")).alias("characters"),
        F.count_distinct("j.title").alias("texts"),
    )
