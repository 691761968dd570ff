"""Line deduplication by levelled sorted runs of line hashes. DataFrame expressions only.

Documents come in batches of falling id. A batch's line hashes are anti-joined with the runs so far:
a key not found there is new, and its largest document lies in this batch, so the new run notes that
document as its keeper; of a key found, only the documents are counted. Each batch adds a run of its
own, sorted by hash, and runs of a level are merged into one of the next as soon as there are enough.
"""

from __future__ import annotations

import string
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from jobtide.llm.common import BLANKS, new_path, present, stored

KEY = ["h1", "h2"]


def line_key(line: Column) -> Column:
    """The line without blanks at both ends, A-Z lower-cased and no other letter."""
    ascii_only = F.octet_length(line) == F.char_length(line)
    lowered = F.when(ascii_only, F.lower(line)).otherwise(
        F.translate(line, string.ascii_uppercase, string.ascii_lowercase)
    )
    return F.btrim(lowered, F.lit(BLANKS))


class Runs:
    """Runs of (128-bit hash, documents, keeper) in the shared folder, in levels of at most ``fanout - 1``."""

    def __init__(self, spark: SparkSession, fanout: int = 3):
        self.spark, self.fanout = spark, fanout
        self.folder = new_path(spark, "line-runs")
        self.levels: list[list[DataFrame]] = []
        self.written = 0

    def _write(self, rows: DataFrame) -> DataFrame:
        self.written += 1
        path = f"{self.folder}/{self.written}"
        rows.select(*KEY, "docs", "keeper").sortWithinPartitions(*KEY).write.parquet(path)
        return self.spark.read.schema(rows.select(*KEY, "docs", "keeper").schema).parquet(path)

    def all(self) -> list[DataFrame]:
        return [run for level in self.levels for run in level]

    def add(self, lines: DataFrame) -> None:
        """A batch of (``id``, hash) rows, all ids below those of the batches before it."""
        keys = lines.select("id", *KEY).distinct().groupBy(*KEY).agg(F.count(F.lit(1)).alias("docs"), F.max("id").alias("keeper"))
        runs = self.all()
        if runs:
            keys = stored(keys, "line-batch")
            fresh = reduce(lambda left, run: left.join(run.hint("merge"), KEY, "left_anti"), runs, keys)
            known = reduce(DataFrame.unionByName, [run.select(*KEY) for run in runs]).distinct()
            counted = keys.join(known.hint("merge"), KEY, "left_semi").withColumn("keeper", F.lit(None).cast(keys.schema["keeper"].dataType))
            keys = fresh.unionByName(counted)
        self._push(0, self._write(keys))

    def _push(self, level: int, run: DataFrame) -> None:
        if level == len(self.levels):
            self.levels.append([])
        self.levels[level].append(run)
        if len(self.levels[level]) == self.fanout:
            merged = self._write(combined(self.levels[level]))
            self.levels[level] = []
            self._push(level + 1, merged)


def combined(runs: list[DataFrame]) -> DataFrame:
    """One row per key: a key has one keeper, in the run of its first batch."""
    rows = reduce(DataFrame.unionByName, runs)
    return rows.groupBy(*KEY).agg(F.sum("docs").alias("docs"), F.max("keeper").alias("keeper"))


def dedup_lines(
    docs: DataFrame,
    min_chars: int = 40,
    min_docs: int = 5,
    batches: int = 4,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """The rows with the text's other lines, and ``n_lines`` and ``n_dropped``.

    Keys of at least ``min_chars`` code points in at least ``min_docs`` documents lose their lines
    except in the largest id. A null text is an empty one: one empty line. Null ids are one document,
    below all others. Rows with equal ids are one document; each keeps its row. A text that loses all
    lines is empty. An empty table gives none. Columns named as those added here are replaced by them.
    """
    spark = docs.sparkSession
    row = docs.drop("n_lines", "n_dropped").select(F.struct("*").alias("row"))
    text = present(F.col(f"row.`{text_column}`"))
    keyed = row.select("row", F.col(f"row.`{id_column}`").alias("id"), F.xxhash64(text).alias("text_hash"))

    line = row.select(
        F.col(f"row.`{id_column}`").alias("id"),
        F.xxhash64(text).alias("text_hash"),
        F.posexplode(F.split(text, "\n")).alias("place", "line"),
    ).withColumn("key", line_key(F.col("line")))
    hashed = line.where(F.char_length("key") >= min_chars).select(
        "id", "text_hash", "place", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2")
    )
    # Batches of about equal size by id; the cuts are one row.
    cuts = docs.agg(F.percentile_approx(id_column, [i / batches for i in range(1, batches)], 1000)).first()[0] or []
    batch = reduce(lambda n, cut: n + F.when(F.col("id") > F.lit(cut), 0).otherwise(1), cuts, F.lit(0))
    lines = stored(hashed.withColumn("batch", batch.cast("int")), "lines", "batch")

    runs = Runs(spark)
    for number in range(len(cuts) + 1):
        runs.add(lines.where(F.col("batch") == number))
    # Written out, so that both sides of the join are plain shuffles and a line in very many documents is split.
    common = stored(combined(runs.all()).where(F.col("docs") >= min_docs), "common")
    dropped = lines.join(common, KEY).where(~F.col("id").eqNullSafe(F.col("keeper")))
    per_row = dropped.groupBy("id", "text_hash").agg(F.array_sort(F.collect_set("place")).alias("drop"))
    per_row = per_row.select(F.col("id").alias("of_id"), F.col("text_hash").alias("of_text"), "drop")

    same = F.col("id").eqNullSafe(F.col("of_id")) & (F.col("text_hash") == F.col("of_text"))
    # A flag per line up to the last dropped one, in time proportional to the lines.
    flags = F.flatten(
        F.transform(
            "drop",
            lambda place, i: F.concat(
                F.array_repeat(F.lit(False), place - F.coalesce(F.get("drop", i - 1), F.lit(-1)) - 1), F.array(F.lit(True))
            ),
        )
    )
    pairs = F.arrays_zip(F.split(text, "\n").alias("line"), flags.alias("flag"))
    kept = F.transform(F.filter(pairs, lambda p: ~F.coalesce(p["flag"], F.lit(False))), lambda p: p["line"])
    dropped_lines = F.coalesce(F.size("drop"), F.lit(0))
    return keyed.join(per_row, same, "left").select(
        F.col("row").withField(f"`{text_column}`", F.when(F.col("drop").isNull(), text).otherwise(F.array_join(kept, "\n"))).alias("row"),
        F.size(F.split(text, "\n")).cast("long").alias("n_lines"),
        F.when(F.col("drop").isNull(), 0).otherwise(dropped_lines).cast("long").alias("n_dropped"),
    ).select("row.*", "n_lines", "n_dropped")
