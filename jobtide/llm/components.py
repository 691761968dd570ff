"""Connected components of a link table, grouped without gathering any group."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobtide.llm.common import stored


class Union:
    """Union-find whose roots are the smallest nodes."""

    def __init__(self):
        self.parent: dict[int, int] = {}

    def root(self, node: int) -> int:
        parent = self.parent
        while (up := parent.setdefault(node, node)) != node:
            parent[node] = node = parent.setdefault(up, up)
        return node

    def join(self, a: int, b: int) -> None:
        a, b = self.root(a), self.root(b)
        self.parent[max(a, b)] = min(a, b)


def _forest(links: DataFrame) -> DataFrame:
    """The links of each task replaced by one from every node to the root of its tree."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = Union()
        for batch in batches:
            for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                trees.join(a, b)
        pairs = [(n, r) for n in list(trees.parent) if (r := trees.root(n)) != n]
        columns = np.array(pairs, dtype=np.int64).reshape(-1, 2)
        yield pa.RecordBatch.from_arrays([pa.array(columns[:, 0]), pa.array(columns[:, 1])], ["u", "v"])

    return links.mapInArrow(run, "u long, v long")


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``component`` (its smallest node) of every node in a link of columns ``a`` and ``b``.

    Each task first unites its own links; large-star and small-star steps, which send every node to the
    smallest neighbour known, then go on until nothing changes. Each step's table is written out.
    """
    edges = stored(_forest(links.select(F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b"))).distinct(), "links")
    seen = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
        edges = stored(small.where("u <> v").distinct(), "links")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == seen:
            break
        seen = now
    roots = edges.groupBy("u").agg(F.min("v").alias("component"))
    nodes = roots.select(F.col("u").alias("node"), "component")
    return nodes.unionByName(roots.select(F.col("component").alias("node"), "component").distinct())
