"""Exploding labels, display spellings, label sets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobtide.functions.text import label_key, not_blank


def explode_labels(
    df: DataFrame,
    carry: Sequence[str],
    tags: Column,
    category: Column,
    *,
    rows_unique: bool = False,
) -> DataFrame:
    """One row per (label, kind) of each row: normalised tags plus the single category.

    Repeats within a row go before the explode. If the carried columns are unique per row that
    is the whole DISTINCT and nothing is shuffled; otherwise a DISTINCT over the rows follows.
    """

    def kinds(labels: Column, kind: str) -> Column:
        clean = F.array_distinct(F.filter(F.transform(labels, label_key), not_blank))
        return F.transform(clean, lambda label: F.struct(label.alias("skill"), F.lit(kind).alias("skill_type")))

    empty = F.array().cast("array<string>")
    found = F.concat(kinds(F.coalesce(tags, empty), "tag"), kinds(F.array(category), "category"))
    rows = df.select(*carry, F.explode(found).alias("_label")).select(
        *carry, "_label.skill", "_label.skill_type"
    )
    return rows if rows_unique else rows.distinct()


def company_rollup(
    df: DataFrame, name: Column, source: str, ts: str
) -> DataFrame:
    """One row per normalised name: counts, contributing sources, display spelling and time span.

    Spellings are counted per source first. That step has only numbers in its buffers, so it hashes,
    and it leaves a handful of rows per name for the second one however many postings a name has.
    """
    spelled = (
        df.where(not_blank(name))
        .groupBy(label_key(name).alias("company_key"), F.trim(name).alias("_spelling"), source)
        .agg(F.count("*").alias("_n"), F.min(ts).alias("_first"), F.max(ts).alias("_last"))
    )
    per_source = spelled.groupBy("company_key").agg(
        F.max("_spelling").alias("company"),
        F.sum("_n").alias("job_count"),
        F.sort_array(F.collect_set(source)).alias("_sources"),
        F.min("_first").alias("first_published_at"),
        F.max("_last").alias("last_published_at"),
    )
    return per_source.select(
        "company_key",
        "company",
        "job_count",
        F.size("_sources").cast("long").alias("source_count"),
        F.array_join("_sources", ", ").alias("sources"),
        "first_published_at",
        "last_published_at",
    )


def only_in(left: DataFrame, right: DataFrame, column: str) -> DataFrame:
    """Distinct values of the left column that never occur on the right."""
    return left.select(column).distinct().join(right.select(column).distinct(), column, "left_anti")


def sorted_values(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNotNull()).select(column).distinct().orderBy(column)
