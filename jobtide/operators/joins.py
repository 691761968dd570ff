"""Joins against dimensions and parents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def dimension(dim: DataFrame, key: str) -> DataFrame:
    """A dimension to be looked up by key. A repeated or missing key raises when the rows are read.

    Whether the lookup is broadcast is left to Spark, which goes by bytes.
    """
    repeated = F.concat(F.lit(f"{key} must be unique and not null, but has "), F.coalesce(F.col(key).cast("string"), F.lit("NULL")))
    others = [F.first(c).alias(c) for c in dim.columns if c != key]
    once = dim.groupBy(key).agg(*others, F.count("*").alias("_n"))
    sound = F.when((F.col("_n") == 1) & F.col(key).isNotNull(), F.col(key)).otherwise(F.raise_error(repeated).cast(dim.schema[key].dataType))
    return once.select([sound.alias(c) if c == key else F.col(c) for c in dim.columns])


def orphans(child: DataFrame, key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Child keys missing from the parent, with their row count; NULL keys are not looked up.

    Both sides are reduced to one row per key first, so a hot key is one row in the join.
    """
    counted = (
        child.where(F.col(key).isNotNull())
        .groupBy(F.col(key).alias("orphan_key"))
        .agg(F.count("*").alias("child_rows"))
    )
    parents = parent.select(F.col(parent_key).alias("orphan_key")).distinct()
    return counted.join(parents, "orphan_key", "left_anti")
