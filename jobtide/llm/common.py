"""Helpers the operators share: stored tables, words, bounded caches."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The white space of the contracts: space, tab, line feed, vertical tab, form feed, carriage return.
BLANKS = " \t\n\x0b\x0c\r"


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share; where none is named, as in local tests, one in the warehouse."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder shared by all executors")
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_work"


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/llm-{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str, *partition_by: str) -> DataFrame:
    """The frame written once to the shared folder and read back: cuts lineage, survives lost executors."""
    path = new_path(df.sparkSession, name)
    df.write.partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path).select(df.columns)


def by_group(df: DataFrame, keys: list[str], function: Callable[[pa.Table], pa.Table], schema: str) -> DataFrame:
    """A function of all rows of each group, for groups of bounded size and any number of them.

    Tasks read their groups one after another from sorted rows, which costs less a group than a call of
    Spark's own grouped functions. Keys are whole numbers without nulls.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def done() -> Iterator[pa.RecordBatch]:
            if held:
                yield from function(pa.Table.from_batches(held)).combine_chunks().to_batches()
                held.clear()

        for batch in batches:
            if not batch.num_rows:
                continue
            columns = [batch.column(name).to_numpy(zero_copy_only=False) for name in keys]
            if held and any(held[-1].column(name)[-1].as_py() != c[0] for name, c in zip(keys, columns)):
                yield from done()
            new = np.flatnonzero(np.logical_or.reduce([c[1:] != c[:-1] for c in columns])) + 1
            for a, b in zip([0, *new.tolist()], [*new.tolist(), batch.num_rows]):
                if a:
                    yield from done()
                held.append(batch.slice(a, b - a))
        yield from done()

    return df.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, schema)


def present(text: str | Column) -> Column:
    """The text, empty where null."""
    return F.coalesce(text if isinstance(text, Column) else F.col(text), F.lit(""))


def without(text: Column, characters: str) -> Column:
    """The text without some ASCII characters: plain byte searches, no regular expression."""
    for c in characters:
        text = F.replace(text, F.lit(c), F.lit(""))
    return text


def words(text: Column) -> Column:
    """Runs of characters other than :data:`BLANKS`, in order."""
    for c in BLANKS[1:]:
        text = F.replace(text, F.lit(c), F.lit(" "))
    return F.array_remove(F.split(text, " "), "")


class Bounded(dict):
    """A memo of a function of one argument in two generations of bounded size; results never depend on it."""

    def __init__(self, function, most: int):
        super().__init__()
        self.function, self.most, self.older = function, most // 2, {}

    def __missing__(self, key):
        value = self.older.get(key)
        if value is None:
            value = self.function(key)
        if len(self) >= self.most:
            self.older = dict(self)
            self.clear()
        self[key] = value
        return value
