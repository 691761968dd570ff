"""Spark session settings the transforms rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Week buckets and naive timestamps are read in the session zone; ANSI mode makes bad casts raise.
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    # As in JSON text columns, the last of equal keys counts; else one such posting would cost its whole payload.
    "spark.sql.variant.allowDuplicateKeys": "true",
}

# How tables are stored; no result depends on it. Shredded, a payload of a thousand postings is tens of thousands of values
# of some thirty columns, which a writer gathers by 64 MB and a reader puts together again by row groups.
STORAGE_CONF = {"spark.sql.variant.inferShreddingSchema": "false"}

CLUSTER_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def pin(spark: SparkSession) -> SparkSession:
    """Apply the settings that results depend on, and how tables are stored, to an existing session."""
    for key, value in {**REQUIRED_CONF, **STORAGE_CONF}.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def local_session(app: str, cpus: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A local session for tests and benchmarks; clusters bring their own and call :func:`pin`."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for key, value in {**CLUSTER_CONF, **REQUIRED_CONF}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return pin(spark)
