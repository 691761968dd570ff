"""Intermediate tables in a folder that all executors share."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``; a local session without one uses its warehouse."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if spark.sparkContext.master.startswith("local"):
        return spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_work"
    raise ValueError("name a work folder shared by all executors, or set spark.checkpoint.dir")


# Rows of these tables may hold a whole response or payload, and a reader takes up to 4096 rows of a row group at once:
# row groups and pages are bounded by bytes, so that what a task holds of them does not grow with the table. Their size
# is looked at after every few rows; by default a hundred rows of any size go into a page and a row group.
ROW_GROUPS = {"parquet.block.size": str(4 << 20), "parquet.block.size.row.check.min": "4", "parquet.page.size.row.check.min": "4"}


def written(df: DataFrame, name: str, *partition_by: str, work: str | None = None) -> DataFrame:
    """The frame as a Parquet table: computed once, column-pruned when read, safe from lost executors.

    Every call writes a folder of its own below ``work``, so that two builds never share one.
    """
    spark = df.sparkSession
    path = f"{work or shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.options(**ROW_GROUPS).partitionBy(*partition_by).parquet(path)
    return spark.read.schema(df.schema).parquet(path).select(df.columns)
