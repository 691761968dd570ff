"""The operators bound to the driver's tables, each with its SQL twin where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from jobtide.llm import alignment, chunk_bpe, huffman, line_dedup, mixing, near_dup, ngram_join, onebit, phrases, quality, warc, wrappers
from jobtide.llm.token_count import token_counts
from jobtide.session import pin

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[name] = lambda spark, sf_dir: function(pin(spark), sf_dir)
        if sql is not None:
            SQL[name] = sql
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query(
    "op1_line_dedup",
    """
    WITH l AS (
        SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
            unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS place
        FROM documents),
    k AS (
        SELECT *, trim(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS key
        FROM l),
    c AS (
        SELECT key, max(doc_id) AS keeper FROM k WHERE length(key) >= 40
        GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
    d AS (SELECT k.*, coalesce(doc_id <> keeper, false) AS dropped FROM k LEFT JOIN c USING (key))
    SELECT doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
        sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT dropped), '')) AS kept_sha256
    FROM d GROUP BY doc_id
    """,
)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.dedup_lines(docs).select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


@query("op2_token_count")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query("op3_source_mix")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents").select("doc_id", "source"))


@query("op4_token_files")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return huffman.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), end_id=2)


@query(
    "op5_near_duplicates",
    """
    WITH RECURSIVE w AS (
        SELECT doc_id, list_filter(regexp_split_to_array(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w
        FROM documents),
    s AS (
        SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
            ELSE list_transform(range(len(w) - 2), lambda i: w[i + 1] || ' ' || w[i + 2] || ' ' || w[i + 3]) END) AS g
        FROM w WHERE len(w) > 0),
    n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
    p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
    l AS (SELECT x, y FROM p JOIN n a ON x = a.doc_id JOIN n b ON y = b.doc_id WHERE 100 * c >= 85 * (a.n + b.n - c)),
    e AS (SELECT x AS u, y AS v FROM l UNION ALL SELECT y, x FROM l),
    r AS (SELECT doc_id AS node, doc_id AS root FROM documents UNION SELECT e.v, r.root FROM r JOIN e ON r.node = e.u),
    c AS (SELECT node AS doc_id, min(root) AS component_id FROM r GROUP BY node)
    SELECT d.doc_id, coalesce(n, 0) AS n_shingles, component_id, d.doc_id = component_id AS kept
    FROM documents d JOIN c USING (doc_id) LEFT JOIN n USING (doc_id)
    """,
)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(table(spark, sf_dir, "documents"), words=3, percent=85)


@query(
    "op6_warc",
    # Base32 of the digest: every five hexadecimal digits are four letters.
    """
    WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS sha FROM pages),
    g AS (SELECT sha, max(page_id) AS last FROM p GROUP BY sha)
    SELECT page_id, strlen(html)::BIGINT AS payload_bytes,
        list_aggregate(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
            ((('0x' || substr(sha, (i // 4) * 5 + 1, 5))::BIGINT >> (15 - 5 * (i % 4))::INT) & 31)::INT + 1, 1)),
            'string_agg', '') AS payload_digest,
        CASE WHEN page_id IS NOT DISTINCT FROM last OR last IS NULL THEN 'response' ELSE 'revisit' END AS record_type,
        CASE WHEN page_id IS DISTINCT FROM last THEN last END AS refers_to
    FROM p JOIN g USING (sha)
    """,
)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


@query("op7_chunk_bpe")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    encoded = chunk_bpe.encode(table(spark, sf_dir, "documents"), tokenizer, decoded=True)
    return encoded.select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"),
        "chunks_seen",
        "chunks_encoded",
    )


@query("op8_main_text")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wrappers.main_text(table(spark, sf_dir, "pages"))


@query("op9_quality")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality.judge(docs, table(spark, sf_dir, "labels"), keep_text=False)


@query(
    "op10_one_bit",
    """
    WITH v AS (
        SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
        WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
            AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
    p AS (
        SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e) AS score
        FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e) WHERE q.vec_id % 20 = 0),
    r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM p)
    SELECT query_id, rank::INT AS rank, vec_id, score FROM r WHERE rank <= 20
    """,
)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    indexed = onebit.index(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
    return onebit.search(indexed, indexed.where("vec_id % 20 = 0"))


@query("op11_alignment")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = [public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model")]
    return alignment.align(table(spark, sf_dir, "documents"), *paths)


@query(
    "op12_phrases",
    """
    WITH t AS (
        SELECT row_number() OVER () AS id, coalesce(lang, 'und') AS lang,
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
    p AS (SELECT lang, unnest(regexp_split_to_array(text, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM t),
    w AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\\x20\\x09]+'), lambda x: x <> '') AS w FROM p),
    g AS (
        SELECT lang, k, unnest(list_transform(range(len(w) - k + 1), lambda i: array_to_string(w[i + 1 : i + k], ' '))) AS phrase
        FROM w, (SELECT unnest([1, 2, 3, 4]) AS k) WHERE len(w) >= k),
    f AS (SELECT lang, k, phrase, count(*) AS f FROM g GROUP BY ALL),
    n AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang),
    often AS (SELECT *, string_split(phrase, ' ') AS w FROM f WHERE f >= 30),
    cuts AS (SELECT lang, k, phrase, f, w, unnest(range(1, k)) AS cut FROM often WHERE k > 1),
    scores AS (
        SELECT c.lang, c.k, c.phrase, c.f, c.w, cut, l.f AS l, r.f AS r, (2000000::HUGEINT * c.f) // (l.f + r.f) AS score
        FROM cuts c JOIN often l ON l.lang = c.lang AND l.phrase = array_to_string(c.w[1:cut], ' ')
        JOIN often r ON r.lang = c.lang AND r.phrase = array_to_string(c.w[cut + 1:], ' ')),
    c AS (SELECT * FROM scores QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
    subs AS (
        SELECT lang, f, unnest(flatten(list_transform(range(2, k), lambda s: list_transform(range(1, k - s + 2), lambda i: array_to_string(w[i : i + s - 1], ' '))))) AS phrase
        FROM c WHERE k > 2),
    around AS (SELECT lang, phrase, max(f) AS most FROM subs GROUP BY ALL),
    ranked AS (
        SELECT c.*, row_number() OVER (PARTITION BY lang ORDER BY score DESC, f DESC, encode(phrase)) AS rank
        FROM c LEFT JOIN around USING (lang, phrase) WHERE most IS NULL OR 100::HUGEINT * most < 80::HUGEINT * f)
    SELECT lang, rank, phrase, f AS a, l, r, n, score::BIGINT AS score FROM ranked JOIN n USING (lang) WHERE rank <= 2000
    """,
)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


@query(
    "op13_ngram_join",
    """
    WITH RECURSIVE w AS (
        SELECT doc_id, list_filter(regexp_split_to_array(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w
        FROM documents),
    s AS (
        SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
            ELSE list_transform(range(len(w) - 3), lambda i: w[i + 1] || ' ' || w[i + 2] || ' ' || w[i + 3] || ' ' || w[i + 4]) END) AS g
        FROM w WHERE len(w) > 0),
    n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
    p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
    l AS (SELECT x, y FROM p JOIN n a ON x = a.doc_id JOIN n b ON y = b.doc_id WHERE 100 * c >= 85 * (a.n + b.n - c)),
    e AS (SELECT x AS u, y AS v FROM l UNION ALL SELECT y, x FROM l),
    r AS (SELECT doc_id AS node, doc_id AS root FROM documents UNION SELECT e.v, r.root FROM r JOIN e ON r.node = e.u),
    c AS (SELECT node AS doc_id, min(root) AS component_id FROM r GROUP BY node)
    SELECT d.doc_id, coalesce(n, 0) AS n_shingles, component_id
    FROM documents d JOIN c USING (doc_id) LEFT JOIN n USING (doc_id)
    """,
)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.jaccard_join(table(spark, sf_dir, "documents"), words=4, percent=85)


@query("pipeline", corpus_pipeline.ORACLE_SQL)
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)
