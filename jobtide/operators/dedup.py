"""Keep one row per key. Both filters run before the shuffle too, so a hot key sends one row per task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_by_key(df: DataFrame, keys: Sequence[str], newest_first: Sequence[str]) -> DataFrame:
    """The newest row of each key; rows with a NULL key form one key."""
    order = [F.col(name).desc_nulls_first() for name in newest_first]
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).where("_rank = 1").drop("_rank")


def first_seen(
    df: DataFrame, scope: Sequence[str], key: Column, oldest_first: Sequence[str]
) -> DataFrame:
    """The first row of each key within a scope; every row with a NULL key is kept.

    NULL keys get a partition each: they need no comparison and may be most of the table.
    """
    df = df.withColumn("_key", key)
    alone = F.when(F.col("_key").isNull(), F.struct(*oldest_first))
    window = Window.partitionBy(*scope, "_key", alone).orderBy(*oldest_first)
    return df.withColumn("_rank", F.row_number().over(window)).where("_rank = 1").drop("_rank", "_key")
