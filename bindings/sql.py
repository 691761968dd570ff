"""SQL twins of the model layers, straight from the driver's tables.

Each constant is a list of common table expressions; a query names the last one it needs and gets
all before it.
"""

from __future__ import annotations

from bindings.landing import (
    COUNTRIES,
    EVENT_TYPES,
    EVENTS_PER_RUN,
    ORDERS_PER_RUN,
    PAGE_SPAN,
    PARTS_PER_RUN,
    PRIORITIES,
    SHORT_PAGE,
)
from jobtide import fixed
from jobtide.sources.seeds import RATES_CSV


def text(ts: str) -> str:
    return f"strftime({ts}, '%Y-%m-%d %H:%M:%S')"


def _list(values) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


def _rates() -> str:
    lines = [line for line in RATES_CSV.read_text().splitlines() if not line.startswith("#")][1:]
    rows = [line.split(",") for line in lines]
    return ", ".join(f"('{c}', '{cur}', {rate}::DECIMAL(18,6))" for c, cur, rate, _ in rows)


INGESTED = "(TIMESTAMP '2025-01-01 00:00:00' + to_hours(run::INTEGER))"
CATEGORY_LIST = _list(list(fixed.CATEGORY_NAMES.values())[:5])
CATEGORY_KEYS = _list(list(fixed.CATEGORY_NAMES)[:5])
TAG_LIST = _list(fixed.REQUEST_TAGS[:5])

CTES = {
    # The feed with categories: a posting survives in the response asked for its own category.
    "c_feed": f"""
        SELECT *, o_orderkey // {ORDERS_PER_RUN} AS run,
            list_position({_list(PRIORITIES)}, o_orderpriority) - 1 AS place FROM orders""",
    # A response holds the rows of its own place and of the next one.
    "c_asked": """
        SELECT run, place, count(*) AS n FROM (
            SELECT run, place FROM c_feed UNION ALL SELECT run, (place + 4) % 5 FROM c_feed) GROUP BY run, place""",
    "c_first": """
        SELECT * FROM c_feed
        QUALIFY row_number() OVER (PARTITION BY run, o_custkey ORDER BY place, o_orderkey) = 1""",
    "c_parsed": f"""
        SELECT o_custkey::VARCHAR AS job_id, 'remotive' AS source, 'Order ' || o_orderkey AS title,
            CASE WHEN o_orderstatus = 'F' THEN 'BUYER ' || (o_custkey // 10)
                ELSE '  Buyer ' || (o_custkey // 10) || ' ' END AS company,
            CASE WHEN o_orderstatus = 'F' THEN upper({CATEGORY_LIST}[place + 1])
                ELSE {CATEGORY_LIST}[place + 1] END AS category,
            [o_orderpriority, ' ' || lower(o_orderpriority), o_orderstatus, ' '] AS tags,
            o_orderstatus AS location, NULL::DECIMAL(18,4) AS salary_min, NULL::DECIMAL(18,4) AS salary_max,
            CASE WHEN o_orderstatus = 'P' THEN NULL ELSE '$' || o_totalprice::DECIMAL(18,4) END AS salary_text,
            o_orderdate AS published_at, 'https://jobs.example/c/' || o_orderkey AS url,
            {INGESTED} AS ingested_at, run * 1000 AS raw_id FROM c_first""",
    "stg_remotive": """
        SELECT * FROM c_parsed QUALIFY row_number() OVER (PARTITION BY job_id ORDER BY ingested_at DESC) = 1""",
    # The feed with tags: a posting whose tags are no list is dropped.
    "t_feed": f"""
        SELECT *, event_id // {EVENTS_PER_RUN} AS run, (props->>'k')::INTEGER AS k,
            list_position({_list(EVENT_TYPES)}, event_type) - 1 AS place,
            (value::DECIMAL(18,4) * 1000)::BIGINT AS amount FROM events""",
    "t_asked": """
        SELECT run, place, count(*) AS n FROM (
            SELECT run, place FROM t_feed UNION ALL SELECT run, (place + 4) % 5 FROM t_feed) GROUP BY run, place""",
    "t_first": """
        SELECT * FROM t_feed WHERE k > 0
        QUALIFY row_number() OVER (PARTITION BY run, user_id, k ORDER BY place, event_id) = 1""",
    "t_parsed": f"""
        SELECT user_id || '-' || k AS job_id, 'remoteok' AS source, event_type AS title,
            CASE WHEN k < 50 THEN 'Buyer ' ELSE 'Team ' END || (user_id // 10) AS company,
            NULL::VARCHAR AS category,
            [upper({TAG_LIST}[place + 1]), 'k' || (k // 10), ' Remote'] AS tags,
            CASE WHEN event_type = 'error' THEN NULL ELSE event_type END AS location,
            CASE WHEN event_type IN ('view', 'signup') OR amount = 0 THEN NULL ELSE amount END::DECIMAL(18,4) AS salary_min,
            CASE WHEN event_type = 'signup' OR amount + k * 100 = 0 THEN NULL ELSE amount + k * 100 END::DECIMAL(18,4) AS salary_max,
            NULL::VARCHAR AS salary_text, date_trunc('second', ts) AS published_at,
            'https://jobs.example/t/' || event_id AS url, {INGESTED} AS ingested_at, run * 1000 AS raw_id
        FROM t_first""",
    "stg_remoteok": """
        SELECT * FROM t_parsed QUALIFY row_number() OVER (PARTITION BY job_id ORDER BY ingested_at DESC) = 1""",
    # The paged feed: failed pages give nothing, pages after the first short one are not used.
    "p_feed": f"""
        SELECT *, p_partkey // {PARTS_PER_RUN} AS run, (p_partkey % {PARTS_PER_RUN} + p_size) // {PAGE_SPAN} AS page
        FROM part""",
    "p_pages": "SELECT run, page, count(*) AS n, min(p_size) <= 2 AS ok FROM p_feed GROUP BY run, page",
    "p_runs": f"""
        SELECT run, count(*) FILTER (WHERE ok) AS n_ok, min(page) FILTER (WHERE ok AND n < {SHORT_PAGE}) AS stop,
            count(*) AS n_requests FROM p_pages GROUP BY run""",
    "p_used": """
        SELECT g.run, g.page, g.n, g.ok FROM p_pages g JOIN p_runs r ON g.run = r.run
        WHERE r.n_ok > 0 AND (r.stop IS NULL OR g.page <= r.stop)""",
    "p_first": """
        SELECT f.* FROM p_feed f JOIN p_used u ON f.run = u.run AND f.page = u.page WHERE u.ok
        QUALIFY row_number() OVER (PARTITION BY f.run, p_name, p_brand ORDER BY f.page, p_partkey) = 1""",
    "p_parsed": f"""
        SELECT p_name || '|' || p_brand AS job_id, 'adzuna' AS source, p_name AS title, 'Buyer ' || p_size AS company,
            p_type || ' Jobs' AS category, NULL::VARCHAR[] AS tags, p_brand AS location,
            CASE WHEN p_size > 10 THEN (p_retailprice::DECIMAL(18,4) * 40)::DECIMAL(18,4) END AS salary_min,
            CASE WHEN p_size > 5 THEN (p_retailprice::DECIMAL(18,4) * 50)::DECIMAL(18,4) END AS salary_max,
            NULL::VARCHAR AS salary_text, p_size > 25 AS salary_is_predicted,
            TIMESTAMP '2024-01-01 08:30:00' + to_days(p_size) AS published_at,
            'https://jobs.example/p/' || p_partkey AS url,
            {_list(COUNTRIES)}[run % {len(COUNTRIES)} + 1] AS search_country,
            {INGESTED} AS ingested_at, run * 1000 AS raw_id FROM p_first""",
    "stg_adzuna": """
        SELECT * FROM p_parsed QUALIFY row_number() OVER (PARTITION BY job_id ORDER BY ingested_at DESC) = 1""",
    "rates": f"SELECT * FROM (VALUES {_rates()}) AS v(country_code, currency_code, usd_rate)",
    "unioned": """
        SELECT job_id, source, title, company, category, tags, location, salary_min, salary_max,
            NULL::VARCHAR AS salary_currency, NULL::DECIMAL(18,4) AS salary_min_usd, NULL::DECIMAL(18,4) AS salary_max_usd,
            salary_text, CASE WHEN salary_text IS NOT NULL THEN 'text_only' ELSE 'missing' END AS salary_source,
            NULL::BOOLEAN AS salary_is_predicted, published_at, url, ingested_at FROM stg_remotive
        UNION ALL
        SELECT job_id, source, title, company, category, tags, location, salary_min, salary_max,
            CASE WHEN salary_min IS NOT NULL OR salary_max IS NOT NULL THEN 'USD' END, salary_min, salary_max, salary_text,
            CASE WHEN salary_min IS NOT NULL OR salary_max IS NOT NULL THEN 'structured_usd' ELSE 'missing' END,
            NULL, published_at, url, ingested_at FROM stg_remoteok
        UNION ALL
        SELECT job_id, source, title, company, category, tags, location, salary_min, salary_max,
            CASE WHEN salary_min IS NOT NULL OR salary_max IS NOT NULL THEN currency_code END,
            round(salary_min * usd_rate)::DECIMAL(18,4), round(salary_max * usd_rate)::DECIMAL(18,4), salary_text,
            CASE WHEN salary_min IS NULL AND salary_max IS NULL THEN 'missing' WHEN usd_rate IS NULL THEN 'missing'
                WHEN currency_code = 'USD' THEN 'structured_usd' ELSE 'structured_converted' END,
            salary_is_predicted, published_at, url, ingested_at
        FROM stg_adzuna LEFT JOIN rates ON search_country = country_code""",
    "jobs": "SELECT source || ':' || job_id AS job_key, * FROM unioned",
    "skills": """
        SELECT DISTINCT * FROM (
            SELECT job_key, source, lower(trim(unnest(tags))) AS skill, 'tag' AS skill_type, published_at FROM jobs
            UNION ALL
            SELECT job_key, source, lower(trim(category)), 'category', published_at FROM jobs)
        WHERE skill <> ''""",
    "salaried": """
        SELECT *, CASE WHEN salary_min_usd IS NOT NULL AND salary_max_usd IS NOT NULL
                THEN ((salary_min_usd + salary_max_usd)::DECIMAL(20,5) * 0.5)::DECIMAL(20,5)
                ELSE coalesce(salary_min_usd, salary_max_usd)::DECIMAL(20,5) END AS mid
        FROM jobs WHERE salary_source IN ('structured_usd', 'structured_converted')""",
    "salary_ranges": " UNION ALL ".join(
        f"""
        SELECT '{level}' AS grouping_level, source, {keys}, count(*) AS job_count,
            round(sum(mid)::DOUBLE / count(mid))::BIGINT AS avg_salary_usd,
            round(quantile_cont(mid::DOUBLE, 0.5))::BIGINT AS median_salary_usd,
            min(salary_min_usd)::DOUBLE AS min_salary_usd, max(salary_max_usd)::DOUBLE AS max_salary_usd
        FROM salaried {where} GROUP BY {by}"""
        for level, keys, where, by in (
            ("source", "NULL::VARCHAR AS salary_source, NULL::VARCHAR AS category", "", "source"),
            ("source_salary_source", "salary_source, NULL::VARCHAR AS category", "", "source, salary_source"),
            (
                "source_category",
                "NULL::VARCHAR AS salary_source, category",
                "WHERE category IS NOT NULL",
                "source, category",
            ),
        )
    ),
    "companies": """
        SELECT lower(trim(company)) AS company_key, max(trim(company)) AS company, count(*) AS job_count,
            count(DISTINCT source) AS source_count, string_agg(DISTINCT source, ', ' ORDER BY source) AS sources,
            min(published_at) AS first_published_at, max(published_at) AS last_published_at
        FROM jobs WHERE company IS NOT NULL AND trim(company) <> '' GROUP BY lower(trim(company))""",
    "jobs_over_time": """
        SELECT 'source' AS grouping_level, date_trunc('week', published_at)::DATE AS week_start, source,
            NULL::VARCHAR AS skill, count(*) AS job_count
        FROM jobs WHERE published_at IS NOT NULL GROUP BY ALL
        UNION ALL
        SELECT 'source_skill', date_trunc('week', published_at)::DATE, source, skill, count(*)
        FROM skills WHERE published_at IS NOT NULL GROUP BY ALL""",
}


def using(*names: str, select: str) -> str:
    """A statement over the named expressions and everything listed before the last of them."""
    order = list(CTES)
    upto = order[: max(order.index(name) for name in names) + 1]
    return "WITH " + ",\n".join(f"{name} AS ({CTES[name]})" for name in upto) + f"\n{select}"
