"""The raw landing table: one JSON payload per row, by landing and source.

A landing writes its payloads, its runs and their failures into folders named after it, and commits them by
one row, written last. Readers take the folders of committed landings only, so that a landing that broke
off half way leaves nothing to be seen, and the next one lands the same runs anew. One landing at a time.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jobtide.fixed import SOURCES
from jobtide.functions.json import document, document_of
from jobtide.schemas import COMMITS, FAILURES, RAW, RUNS
from jobtide.sources.workdir import ROW_GROUPS

LANDING = T.StructField("landing", T.StringType())


def known_source(source: str) -> str:
    if source not in SOURCES:
        raise ValueError(f"Unknown source {source!r}; expected one of {sorted(SOURCES)}")
    return source


def stored_or_none(read: Callable[[], DataFrame]) -> DataFrame | None:
    """A table that may not have been written yet."""
    try:
        return read()
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def read_commits(spark: SparkSession, path: str) -> DataFrame | None:
    """A row for each committed landing; none before the first."""
    return stored_or_none(lambda: spark.read.schema(COMMITS).parquet(f"{path}.commits"))


def last_raw_id(spark: SparkSession, path: str) -> int:
    commits = read_commits(spark, path)
    return 0 if commits is None else commits.agg(F.max("last_raw_id")).first()[0] or 0


def landings(spark: SparkSession, path: str, source: str) -> list[str]:
    """The committed landings that brought payloads of a source: what its rows follow from."""
    commits = read_commits(spark, path)
    if commits is None:
        return []
    return sorted(r["landing"] for r in commits.where(F.array_contains("sources", source)).select("landing").distinct().collect())


def _committed(spark: SparkSession, folder: str, path: str, schema: T.StructType) -> DataFrame:
    """The rows of committed landings. Their names are constants of the plan, so that other folders are not listed."""
    rows = spark.read.schema(T.StructType([*schema.fields, LANDING])).parquet(folder)
    commits = read_commits(spark, path)
    names = [] if commits is None else [r["landing"] for r in commits.select("landing").distinct().collect()]
    return rows.where(F.col("landing").isin(names)).select(schema.fieldNames())


def read_raw(spark: SparkSession, path: str, source: str | None = None) -> DataFrame:
    """The landing table, or one source of it: only those partitions are listed and read."""
    raw = _committed(spark, path, path, RAW)
    return raw if source is None else raw.where(F.col("source") == known_source(source))


def read_runs(spark: SparkSession, raw_path: str) -> DataFrame | None:
    """The log of landed runs beside a landing table; none before the first landing."""
    return stored_or_none(lambda: _committed(spark, f"{raw_path}.runs", raw_path, RUNS))


def read_failures(spark: SparkSession, raw_path: str) -> DataFrame | None:
    """The failed requests of the runs that failed; none before the first landing."""
    return stored_or_none(lambda: _committed(spark, f"{raw_path}.failures", raw_path, FAILURES))


@dataclass(frozen=True)
class Landing:
    """Rows on their way into a landing table: written to folders of their own, not seen before the commit."""

    spark: SparkSession
    path: str
    base: int
    name: str

    @classmethod
    def begin(cls, spark: SparkSession, path: str) -> Landing:
        """New ids lie above ``base``, which no committed id does."""
        return cls(spark, path, last_raw_id(spark, path), uuid.uuid4().hex)

    def write(self, rows: DataFrame | Mapping[str, DataFrame], schema: T.StructType, suffix: str = "") -> DataFrame:
        """Write rows under this landing and return them as stored.

        Rows given by their source go into its folder as they are; others are sorted first to find theirs.
        """
        path = f"{self.path}{suffix}"
        if isinstance(rows, Mapping):
            for source, of_source in rows.items():
                self._append(of_source, [f for f in schema if f.name != "source"], f"{path}/landing={self.name}/source={known_source(source)}")
        else:
            self._append(rows.withColumn("landing", F.lit(self.name)), [*schema, LANDING], path, "landing", "source")
        stored = self.spark.read.schema(T.StructType([*schema.fields, LANDING])).parquet(path)
        return stored.where(F.col("landing") == self.name).select(schema.fieldNames())

    @staticmethod
    def _append(rows: DataFrame, fields: Sequence[T.StructField], path: str, *partition_by: str) -> None:
        typed = rows.select([F.col(f.name).cast(f.dataType) for f in fields])
        typed.write.mode("append").options(**ROW_GROUPS).partitionBy(*partition_by).parquet(path)

    def commit(self, payloads: DataFrame, runs: int = 0, at: dt.datetime | None = None) -> None:
        """Make all that was written visible, by one row in one file."""
        written = payloads.agg(F.count("*").alias("n"), F.max("raw_id").alias("last"), F.collect_set("source").alias("sources")).first()
        row = (self.name, at or dt.datetime.now(dt.UTC), written["last"] or self.base, runs, written["n"], sorted(written["sources"]))
        self.spark.createDataFrame([row], COMMITS).coalesce(1).write.mode("append").parquet(f"{self.path}.commits")


def as_raw(payloads: DataFrame, base: int, ingested_at: dt.datetime | None = None) -> DataFrame:
    """(source, payload) rows as rows of the landing table.

    Rows of runs also bring ``run_id``, ``chunk``, ``job_count``, ``ingested_at`` and ``place``, which grows in the
    order of runs and chunks and becomes the id. Others are numbered as they come, with gaps.
    """
    given = set(payloads.columns)
    now = F.lit(ingested_at or dt.datetime.now(dt.UTC)).cast("timestamp")
    declared = F.try_variant_get("document", "$['job-count']", "bigint")
    columns = {
        "raw_id": F.lit(base + 1) + (F.col("place") if "place" in given else F.monotonically_increasing_id()),
        "ingested_at": F.coalesce("ingested_at", now) if "ingested_at" in given else now,
        "run_id": F.col("run_id") if "run_id" in given else F.lit(None),
        "chunk": F.col("chunk") if "chunk" in given else F.lit(None),
        "payload": F.col("payload"),
        "document": F.col("document"),
        "job_count": F.col("job_count") if "job_count" in given else declared,
        "source": F.when(F.col("source").isin(list(SOURCES)), F.col("source")).otherwise(
            F.raise_error(F.concat(F.lit("Unknown source "), F.col("source")))
        ),
    }
    parsed = payloads.withColumn("document", document(F.col("payload")))
    return parsed.select([columns[f.name].cast(f.dataType).alias(f.name) for f in RAW])


def append_payloads(payloads: DataFrame, path: str, ingested_at: dt.datetime | None = None) -> int:
    """Append payloads (see :func:`as_raw`) and return the id all new ids lie above. Ids grow from append to append."""
    landing = Landing.begin(payloads.sparkSession, path)
    landing.commit(landing.write(as_raw(payloads, landing.base, ingested_at), RAW))
    return landing.base


def insert_payload(
    spark: SparkSession,
    source: str,
    payload: Mapping[str, object] | str,
    path: str,
    ingested_at: dt.datetime | None = None,
) -> int:
    """Append one payload and return its id."""
    known_source(source)
    text = payload if isinstance(payload, str) else json.dumps(payload, ensure_ascii=False)
    row = spark.createDataFrame([(source, text)], "source string, payload string").coalesce(1)
    return append_payloads(row, path, ingested_at) + 1


def with_counts(raw: DataFrame) -> DataFrame:
    """Raw rows with the declared job count and the real one, NULL where ``jobs`` is no list."""
    counted = raw.withColumn("_d", document_of(raw))
    return counted.select(
        *raw.columns,
        F.try_variant_get("_d", "$['job-count']", "string").cast("int").alias("job_count_declared"),
        F.size(F.try_variant_get("_d", "$.jobs", "array<variant>")).alias("job_count_actual"),
    )
