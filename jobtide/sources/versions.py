"""Tables that change as a whole: files of every version in folders of their own, and a pointer row written last.

A version is a list of folders, which may be shared with versions before it. Readers take the newest
pointer and the folders it names; what a write that broke off left behind is named by none. The two newest
versions stay, so that a reader that found the one before still ends.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

KEPT = 2

_PART = T.StructType(
    [
        T.StructField("folder", T.StringType()),
        T.StructField("bucket", T.IntegerType()),
        T.StructField("level", T.IntegerType()),
    ]
)
POINTER = T.StructType(
    [
        T.StructField("version", T.LongType()),
        T.StructField("written_at", T.TimestampType()),
        T.StructField("fingerprint", T.StringType()),
        T.StructField("upto", T.LongType()),
        T.StructField("parts", T.ArrayType(_PART)),
    ]
)


@dataclass(frozen=True)
class Part:
    """A folder of a version; of a bucketed table, one bucket of it and how often its rows were merged."""

    folder: str
    bucket: int | None = None
    level: int = 0


@dataclass(frozen=True)
class Version:
    version: int
    fingerprint: str
    upto: int
    parts: tuple[Part, ...]


def versions(spark: SparkSession, path: str) -> list[Version]:
    """The newest versions, newest first."""
    try:
        rows = spark.read.schema(POINTER).parquet(f"{path}.versions").orderBy(F.col("version").desc()).limit(KEPT).collect()
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return []
        raise
    return [Version(r["version"], r["fingerprint"], r["upto"], tuple(Part(*p) for p in r["parts"])) for r in rows]


def current(spark: SparkSession, path: str) -> Version | None:
    return next(iter(versions(spark, path)), None)


def new_folder() -> str:
    return uuid.uuid4().hex


def publish(spark: SparkSession, path: str, parts: Sequence[Part], fingerprint: str = "", upto: int = 0) -> Version:
    """Make a version of written folders the current one, by one row in one file; older ones are cleared."""
    last = current(spark, path)
    made = Version(last.version + 1 if last else 1, fingerprint, upto, tuple(parts))
    row = (made.version, dt.datetime.now(dt.UTC), fingerprint, upto, [(p.folder, p.bucket, p.level) for p in parts])
    spark.createDataFrame([row], POINTER).coalesce(1).write.mode("append").parquet(f"{path}.versions")
    _clear(spark, path)
    return made


def _clear(spark: SparkSession, path: str) -> None:
    """Remove folders that none of the versions kept names."""
    named = {p.folder for v in versions(spark, path) for p in v.parts}
    jvm, root = spark._jvm, spark._jvm.org.apache.hadoop.fs.Path(path)
    files = root.getFileSystem(spark._jsc.hadoopConfiguration())
    for status in files.listStatus(root):
        if status.isDirectory() and status.getPath().getName() not in named:
            files.delete(jvm.org.apache.hadoop.fs.Path(root, status.getPath().getName()), True)


def replace(df: DataFrame, path: str, fingerprint: str = "") -> DataFrame:
    """Write a frame as the next version of a table and return it as stored."""
    folder = new_folder()
    df.write.parquet(f"{path}/{folder}")
    publish(df.sparkSession, path, [Part(folder)], fingerprint)
    return df.sparkSession.read.schema(df.schema).parquet(f"{path}/{folder}")


def read(spark: SparkSession, path: str) -> DataFrame:
    """The current version of a table written by :func:`replace`."""
    version = current(spark, path)
    return spark.read.parquet(f"{path}/{version.parts[0].folder}" if version else path)


def read_buckets(spark: SparkSession, path: str, parts: Sequence[Part], schema: T.StructType) -> DataFrame:
    """The rows of some parts of a bucketed table, whose folders hold a folder for each bucket."""
    by_folder: dict[str, list[int]] = {}
    for part in parts:
        by_folder.setdefault(part.folder, []).append(part.bucket)
    frames = [
        spark.read.schema(T.StructType([*schema.fields, T.StructField("bucket", T.IntegerType())]))
        .parquet(f"{path}/{folder}")
        .where(F.col("bucket").isin(buckets))
        for folder, buckets in by_folder.items()
    ]
    if not frames:
        return spark.createDataFrame([], T.StructType([*schema.fields, T.StructField("bucket", T.IntegerType())]))
    return reduce(DataFrame.unionByName, frames)
