"""From raw documents to token ids: quality, lines, near duplicates, mixture, encoding.

Each stage takes ``(spark, docs, sf_dir)`` and works on all that the one before it kept. ``run`` writes
every stage's rows to the shared folder and reads them back, so that a lost executor costs one stage at
most. Extra columns pass through all stages but the last.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobtide.llm import chunk_bpe, line_dedup, mixing, near_dup, quality
from jobtide.llm.common import new_path
from jobtide.session import pin

#: No SQL expresses hashed language models, probabilistic banding or a token vocabulary.
ORACLE_SQL = None


def whole(docs: DataFrame, *columns: str) -> DataFrame:
    """The columns an operator reads, and the whole row beside them, safe from columns that it adds."""
    return docs.select("doc_id", *columns, F.struct("*").alias("document"))


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the n-gram ratio keep. Null and empty texts go."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    judged = quality.judge(whole(docs, "text"), labels, keep_text=False)  # the text is stored once, in the document
    return judged.where("kept").select("document.*")


def without_common_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The same documents without lines that many share; ``n_chars``, if there, follows the text."""
    kept = line_dedup.dedup_lines(docs).select(*docs.columns)
    if "n_chars" in docs.columns:
        kept = kept.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return kept


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: five-word runs, similarity of at least 0.8."""
    found = near_dup.near_duplicates(docs, words=5, percent=80)
    return docs.join(found.where("not kept").select("doc_id").distinct(), "doc_id", "left_anti").select(*docs.columns)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents in the order of the mixture: from file to file, and in each from row to row."""
    return mixing.in_order(mixing.mix(whole(docs, "source"))).select("document.*")


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of each document and its place in the mixture: ``part`` (file) and ``row``, null if not read from files."""
    try:
        placed = docs.withColumns({"part": F.regexp_extract("_metadata.file_name", r"^part-(\d+)", 1).try_cast("int"), "row": F.col("_metadata.row_index")})
    except AnalysisException:
        placed = docs.withColumns({"part": F.lit(None).cast("int"), "row": F.lit(None).cast("long")})
    encoded = chunk_bpe.encode(placed, public_tokenizers.path("byte_bpe_50k.json"), decoded=True, carry=("source", "part", "row"))
    return encoded.select(
        "doc_id",
        "source",
        "part",
        "row",
        "n_tokens",
        "ids",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"),
    )


STAGES = [
    ("quality", good_documents),
    ("line_dedup", without_common_lines),
    ("near_dup", one_of_each),
    ("mix", mixture),
    ("encode", token_ids),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage, over the whole of ``documents``."""
    pin(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = new_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
