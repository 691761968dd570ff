"""Mart tables: typed reads, full-refresh writes, sorted CSV, and a sample to fall back on."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, replace
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jobtide.functions.time import csv_timestamp
from jobtide.schemas import MART_TABLES, MART_TYPES
from jobtide.sources import versions

SAMPLE_DIR = Path(__file__).parent.parent / "data" / "sample_marts"
DEFAULT_SCHEMA = "analytics"

# Order of the rows in each CSV file.
CSV_ORDER = {
    "mart_skills": ("source", "job_key", "skill_type", "skill"),
    "mart_salary_ranges": ("grouping_level", "source", "salary_source", "category"),
    "mart_companies": ("-job_count", "company_key"),
    "mart_jobs_over_time": ("grouping_level", "week_start", "source", "skill"),
}


@dataclass(frozen=True)
class Marts:
    """The four marts and where they came from."""

    skills: DataFrame
    salary_ranges: DataFrame
    companies: DataFrame
    jobs_over_time: DataFrame
    is_demo: bool = False
    demo_reason: str | None = None


def known_mart(name: str) -> str:
    if name not in MART_TYPES:
        raise ValueError(f"Unknown mart {name!r}; expected one of {sorted(MART_TYPES)}")
    return name


def coerce(name: str, df: DataFrame) -> DataFrame:
    """Cast a mart's columns to their declared types; other columns stay. Missing ones raise."""
    wanted = MART_TYPES[known_mart(name)]
    missing = set(wanted) - set(df.columns)
    if missing:
        raise ValueError(f"no column {', '.join(sorted(missing))} in {name}")
    return df.select([F.col(c).cast(wanted[c]).alias(c) if c in wanted else F.col(c) for c in df.columns])


def bundle(
    frames: Mapping[str, DataFrame], *, is_demo: bool = False, demo_reason: str | None = None
) -> Marts:
    typed = {name.removeprefix("mart_"): coerce(name, frames[name]) for name in MART_TABLES}
    return Marts(**typed, is_demo=is_demo, demo_reason=demo_reason)


def read_tables(spark: SparkSession, schema: str | None = None) -> Marts:
    """The four marts of a catalog schema."""
    return bundle({name: spark.table(f"`{schema or DEFAULT_SCHEMA}`.{name}") for name in MART_TABLES})


def read_folder(spark: SparkSession, folder: str) -> Marts:
    """The four marts as last written under a folder."""
    return bundle({name: versions.read(spark, f"{folder}/{name}") for name in MART_TABLES})


def read_csv(spark: SparkSession, folder: str) -> Marts:
    """The four marts as CSV files or folders named after them."""
    frames = {
        name: spark.read.csv(f"{folder}/{name}.csv", header=True, inferSchema=False) for name in MART_TABLES
    }
    return bundle(frames, is_demo=True)


def read_sample(spark: SparkSession) -> Marts:
    """The small packaged sample, handed over by the driver."""
    frames = {}
    for name in MART_TABLES:
        header, *lines = (SAMPLE_DIR / f"{name}.csv").read_text(encoding="utf-8").splitlines()
        columns = ", ".join(f"{column} string" for column in header.split(","))
        text = spark.createDataFrame([(line,) for line in lines], "line string")
        frames[name] = text.selectExpr(f"from_csv(line, '{columns}') r").select("r.*")
    return bundle(frames, is_demo=True)


def load(
    spark: SparkSession,
    location: str | None = None,
    loader: Callable[[SparkSession, str], Marts] = read_tables,
    sample: Callable[[SparkSession], Marts] = read_sample,
) -> Marts:
    """The marts at a location, or the labelled sample when there is none or it cannot be read."""
    if not location:
        return replace(sample(spark), demo_reason="no mart location is configured")
    try:
        return loader(spark, location)
    except Exception as error:  # whatever went wrong, labelled sample data beats an error page
        return replace(sample(spark), demo_reason=f"could not read the marts ({type(error).__name__})")


def write_mart(
    name: str, df: DataFrame, *, folder: str | None = None, schema: str | None = None, fingerprint: str = ""
) -> DataFrame:
    """Replace a mart and return the stored table.

    The new rows are written beside those being served, which readers leave by one step: in a folder by the
    pointer to its version, in a catalog by the view that has the mart's name.
    """
    known_mart(name)
    if (folder is None) == (schema is None):
        raise ValueError("give exactly one of folder and schema")
    typed = coerce(name, df)
    spark = df.sparkSession
    if folder is not None:
        return versions.replace(typed, f"{folder}/{name}", fingerprint)
    spark.sql(f"create schema if not exists `{schema}`")
    stored = f"{name}__{versions.new_folder()}"
    typed.write.format("parquet").saveAsTable(f"`{schema}`.{stored}")
    before = [r["tableName"] for r in spark.sql(f"show tables in `{schema}`").collect() if r["tableName"].startswith(f"{name}__") and r["tableName"] != stored]
    served = _served(spark, schema, name)
    spark.sql(f"create or replace view `{schema}`.{name} tblproperties ('stored' = '{stored}') as select * from `{schema}`.{stored}")
    for old in before:
        if old != served:  # the version before stays for those still reading it
            spark.sql(f"drop table `{schema}`.{old}")
    return spark.table(f"`{schema}`.{name}")


def _served(spark: SparkSession, schema: str, name: str) -> str | None:
    """The table that the view of a mart shows."""
    if not spark.catalog.tableExists(f"`{schema}`.{name}"):
        return None
    return next((r["value"] for r in spark.sql(f"show tblproperties `{schema}`.{name}").collect() if r["key"] == "stored"), None)


def csv_rows(name: str, df: DataFrame, order: Sequence[str] | None = None) -> DataFrame:
    """A mart in its CSV order with timestamps as UTC text."""
    keys = [
        F.col(key[1:]).desc() if key.startswith("-") else F.col(key) for key in order or CSV_ORDER[known_mart(name)]
    ]
    typed = coerce(name, df).orderBy(*keys)
    return typed.select(
        [
            csv_timestamp(F.col(f.name)).alias(f.name) if isinstance(f.dataType, T.TimestampType) else F.col(f.name)
            for f in typed.schema
        ]
    )


def write_csv(name: str, df: DataFrame, folder: str) -> None:
    """Write a mart as sorted CSV; the part files continue each other in name order."""
    csv_rows(name, df).write.mode("overwrite").csv(f"{folder}/{name}.csv", header=True)
