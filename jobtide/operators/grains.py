"""Aggregates at several grains, one labelled row per group."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jobtide.functions.time import week_start


@dataclass(frozen=True)
class Grain:
    """One grouping: its label, its keys, and keys whose NULL rows take no part in it."""

    label: str
    keys: tuple[str, ...]
    required: tuple[str, ...] = ()


STEPS_PER_OCTAVE = 4096
#: Above the octaves that doubles have below 1, so that steps are positive.
OCTAVES = 1100
FINE_STEPS = 1 << 20
NO_VALUE_BUCKET = -(2**62)


def value_bucket(value: Column) -> Column:
    """The leading digit of a number's rank key: its octave and 4096th of an octave, about 0.02 % wide.

    It keeps the order and depends on the value alone, so that a group of any size splits into buckets
    without a first pass over the data.
    """
    number = value.cast("double")
    steps = F.floor((F.log2(F.abs(number)) + OCTAVES) * STEPS_PER_OCTAVE)
    return F.when(number < 0, -steps).when(number > 0, steps).when(number == 0, 0)


def fine_bucket(value: Column, bucket: Column) -> Column:
    """The next digit: the place of a number within its bucket, in 2 to the power 20 steps.

    What shares both digits differs by less than 2e-10 of itself, which leaves under a million doubles.
    """
    number = value.cast("double")
    start = F.pow(F.lit(2.0), F.abs(bucket) / STEPS_PER_OCTAVE - OCTAVES)
    width = 2.0 ** (1 / STEPS_PER_OCTAVE) - 1
    place = F.floor((F.abs(number) / start - 1) * (FINE_STEPS / width))
    inside = F.greatest(F.lit(0), F.least(F.lit(FINE_STEPS - 1), place))
    return F.when(number < 0, -inside).when(number > 0, inside).otherwise(0)


def _grouping_bits(grain: Grain, columns: Sequence[str]) -> int:
    """The grouping_id of a grain: a set bit for each column it rolls up, first column highest."""
    return sum(1 << i for i, name in enumerate(reversed(columns)) if name not in grain.keys)


def _label(grains: Sequence[Grain], keys: Sequence[str], bits: Column) -> Column:
    return reduce(
        lambda chain, grain: chain.when(bits == _grouping_bits(grain, keys), grain.label), grains, F
    )


def _takes_part(grains: Sequence[Grain], level: str) -> Column:
    excluded = [
        (F.col(level) == grain.label) & F.col(key).isNull() for grain in grains for key in grain.required
    ]
    return ~reduce(lambda a, b: a | b, excluded, F.lit(False))


def _group(grain: Grain, place: int, keys: Sequence[str], types: dict[str, T.DataType]) -> Column:
    """The group a row falls into at a grain, rolled-up keys NULL; NULL if it takes no part."""
    group = F.struct(
        F.lit(place).alias("_level"),
        *[(F.col(k) if k in grain.keys else F.lit(None).cast(types[k])).alias(k) for k in keys],
    )
    return reduce(lambda rest, key: F.when(F.col(key).isNotNull(), rest), grain.required, group)


def spread_counts(
    df: DataFrame, grains: Sequence[Grain], value: Column, low: Column, high: Column
) -> tuple[DataFrame, list[str]]:
    """Rows per group and distinct value (missing is one), spread over tasks by group and both digits of the value.

    Equal values are counted in each task and again behind a shuffle by value before they are spread, so
    that a value or a gap in ever so many rows is one row of its group. The group is a struct: it is
    never NULL, so a plain equality joins groups with NULL keys too.
    """
    keys = list(dict.fromkeys(key for grain in grains for key in grain.keys))
    plain = df.select(*keys, value.alias("_v"), low.alias("_lo"), high.alias("_hi"))
    types = {field.name: field.dataType for field in plain.schema}
    groups = F.array(*[_group(grain, i, keys, types) for i, grain in enumerate(grains)])
    counted = (
        plain.select(F.explode(groups).alias("_g"), "_v", "_lo", "_hi")
        .where("_g is not null")
        .groupBy("_g", "_v")
        .agg(F.count("*").alias("_n"), F.min("_lo").alias("_lo"), F.max("_hi").alias("_hi"))
        .withColumn("_b", F.coalesce(value_bucket(F.col("_v")), F.lit(NO_VALUE_BUCKET)))
        .withColumn("_c", F.when(F.col("_v").isNotNull(), fine_bucket(F.col("_v"), F.col("_b"))).otherwise(0).cast("int"))
    )
    return counted.repartition("_g", "_b", "_c"), keys


def multi_grain_stats(
    df: DataFrame,
    grains: Sequence[Grain],
    value: Column,
    low: Column,
    high: Column,
    *,
    level: str = "grouping_level",
    scale: int = 0,
) -> DataFrame:
    """Row count, rounded average and exact median of ``value``, lowest ``low`` and highest ``high``.

    The median is found by rank, digit by digit of an order-preserving key: counts of the first digit give
    the buckets holding the middle ranks, counts of the second the parts of these, and only the values of
    such a part are sorted. One shuffle, by group and both digits, serves the counts of the parts, the
    join and the last window, so that values close together are spread too. No group is gathered anywhere.
    """
    counted, keys = spread_counts(df, grains, value, low, high)

    valued = F.when(F.col("_v").isNotNull(), F.col("_n")).otherwise(0)
    weighted = F.when(F.col("_n") == 1, F.col("_v")).otherwise(F.col("_v") * F.col("_n"))
    extremes = [F.min("_lo").alias("_lo"), F.max("_hi").alias("_hi")]
    parts = counted.groupBy("_g", "_b", "_c").agg(F.sum("_n").alias("_n"), F.sum(valued).alias("_valued"), F.sum(weighted).alias("_sum"), *extremes)
    buckets = parts.groupBy("_g", "_b").agg(*[F.sum(c).alias(c) for c in ("_n", "_valued", "_sum")], *extremes)
    whole = Window.partitionBy("_g")
    before = Window.unboundedPreceding, -1
    ranked = buckets.select(
        "_g",
        "_b",
        "_valued",
        F.coalesce(F.sum("_valued").over(whole.orderBy("_b").rowsBetween(*before)), F.lit(0)).alias("_before"),
        F.sum("_n").over(whole).alias("_rows"),
        F.sum("_valued").over(whole).alias("_values"),
        F.sum("_sum").over(whole).alias("_total"),
        F.min("_lo").over(whole).alias("_min"),
        F.max("_hi").over(whole).alias("_max"),
    )
    lower, upper = F.expr("(_values - 1) div 2"), F.expr("_values div 2")

    def holds(rank: Column, start: Column, size: Column) -> Column:
        return (rank >= start) & (rank < start + size)

    def middle(rows: DataFrame) -> DataFrame:
        in_middle = [holds(rank, F.col("_before"), F.col("_valued")) for rank in (lower, upper)]
        return rows.where((F.col("_values") == 0) | in_middle[0] | in_middle[1]).drop("_valued")

    inner = Window.partitionBy("_g", "_b").orderBy("_c").rowsBetween(*before)
    of_parts = parts.select("_g", "_b", "_c", "_valued", F.col("_lo").alias("_part_lo"), F.col("_hi").alias("_part_hi"))
    finer = of_parts.join(middle(ranked), ["_g", "_b"])
    finer = finer.withColumn("_before", F.col("_before") + F.coalesce(F.sum("_valued").over(inner), F.lit(0)))

    inside = Window.partitionBy("_g", "_b", "_c").orderBy("_v").rowsBetween(*before)
    start = F.col("_before") + F.coalesce(F.sum("_n").over(inside), F.lit(0))
    picked = (
        counted.join(middle(finer), ["_g", "_b", "_c"])
        .withColumn("_start", start)
        .withColumn(
            "_weight",
            holds(lower, F.col("_start"), F.col("_n")).cast("int")
            + holds(upper, F.col("_start"), F.col("_n")).cast("int"),
        )
        .where("_weight > 0 or _values = 0")
    )
    # All sides of the joins carry _lo and _hi, so they read one shuffle of the counts, not three.
    return (
        picked.groupBy("_g")
        .agg(
            F.first("_rows").alias("row_count"),
            F.round(F.try_divide(F.first("_total"), F.first("_values")), scale).alias("avg_value"),
            F.round(F.sum(F.col("_v") * F.col("_weight")) / 2, scale).alias("median_value"),
            F.min(F.least("_min", "_part_lo", "_lo")).alias("min_low"),
            F.max(F.greatest("_max", "_part_hi", "_hi")).alias("max_high"),
        )
        .select(
            F.element_at(F.array(*[F.lit(grain.label) for grain in grains]), F.col("_g._level") + 1).alias(level),
            *[f"_g.{key}" for key in keys],
            "row_count",
            "avg_value",
            "median_value",
            "min_low",
            "max_high",
        )
    )


def approx_grain_stats(
    df: DataFrame,
    grains: Sequence[Grain],
    value: Column,
    low: Column,
    high: Column,
    *,
    level: str = "grouping_level",
    scale: int = 0,
    accuracy: int = 10_000,
) -> DataFrame:
    """The same columns with the median from a sketch: one pass, rank error below 1/accuracy."""
    keys = list(dict.fromkeys(key for grain in grains for key in grain.keys))
    return (
        df.select(*keys, value.alias("_v"), low.alias("_lo"), high.alias("_hi"))
        .groupingSets([list(grain.keys) for grain in grains], *keys)
        .agg(
            F.grouping_id().alias("_bits"),
            F.count("*").alias("row_count"),
            F.round(F.avg("_v"), scale).alias("avg_value"),
            F.round(F.percentile_approx("_v", 0.5, accuracy), scale).alias("median_value"),
            F.min("_lo").alias("min_low"),
            F.max("_hi").alias("max_high"),
        )
        .withColumn(level, _label(grains, keys, F.col("_bits")))
        .where(_takes_part(grains, level))
        .select(level, *keys, "row_count", "avg_value", "median_value", "min_low", "max_high")
    )


def weekly_counts(df: DataFrame, ts: str, *by: str, count: str = "job_count") -> DataFrame:
    """Rows per week and key; rows without a timestamp are left out."""
    return (
        df.where(F.col(ts).isNotNull())
        .groupBy(week_start(F.col(ts)).alias("week_start"), *by)
        .agg(F.count("*").alias(count))
    )


def grain_mismatches(
    coarse: DataFrame, fine: DataFrame, by: Sequence[str], coarse_count: str, fine_count: str
) -> DataFrame:
    """Groups whose coarse count differs from the sum of the finer rows, either side missing included."""
    left = coarse.groupBy(*by).agg(F.sum(coarse_count).alias("coarse_count"))
    right = fine.groupBy(*by).agg(F.sum(fine_count).alias("fine_count"))
    joined = left.join(right, list(by), "full")
    return joined.where(~F.col("coarse_count").eqNullSafe(F.col("fine_count")))
