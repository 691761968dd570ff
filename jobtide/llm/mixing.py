"""Mixing sources to target weights by Pfair scheduling.

Documents of a source form blocks of equally many. With ``W`` of a cycle's ``L`` slots due to a source,
its block ``j`` of the cycle may not come before ``floor(j L / W)`` and has to come before
``ceil((j + 1) L / W)``. Taking, of the blocks released, the one with the earliest deadline meets all of
them, so that after every slot each source is less than one block from its target share. Weights are
whole numbers of slots, hence the order repeats from cycle to cycle: any block's slot follows from its
number, and no task has to go through the schedule. Each document is used once. When a source runs out,
the others share its slots by their weights: the cycles after that are scheduled anew the same way.
"""

from __future__ import annotations

import heapq
from collections.abc import Mapping
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from jobtide.llm.common import stored

#: Documents of a block, and the slots of a cycle: weights are rounded to whole slots, 1 at least.
BLOCK_ROWS = 32
CYCLE = 1024
#: Documents that are numbered in one group; a source has as many groups as it needs.
GROUP_ROWS = 2048


@lru_cache(maxsize=4096)
def cycle_order(blocks: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray]:
    """Slots of one cycle, earliest deadline first: for each source after another, those of its blocks.

    The second array tells where each source's slots begin in the first.
    """
    length = sum(blocks)
    first = np.concatenate([[0], np.cumsum(blocks)]).astype(np.int64)
    slots = np.zeros(length, dtype=np.int64)
    released: list[tuple[int, int, int]] = []
    waiting = [(0, i, 0) for i, n in enumerate(blocks) if n]
    heapq.heapify(waiting)
    for t in range(length):
        while waiting and waiting[0][0] <= t:
            _, i, j = heapq.heappop(waiting)
            heapq.heappush(released, (-((j + 1) * length // -blocks[i]), i, j))
        deadline, i, j = heapq.heappop(released)
        if t >= deadline:
            raise AssertionError("a deadline was missed")
        slots[first[i] + j] = t
        if j + 1 < blocks[i]:
            heapq.heappush(waiting, ((j + 1) * length // blocks[i], i, j + 1))
    return slots, first


class Schedule:
    """Slots of blocks, from each source's number of blocks and its slots in a cycle."""

    def __init__(self, blocks: np.ndarray, weights: np.ndarray):
        self.blocks, self.weights = blocks.astype(np.int64), weights.astype(np.int64)
        self.full, self.rest = self.blocks // self.weights, self.blocks % self.weights
        # Cycles in which what sources have left changes.
        self.turns = np.unique(np.concatenate([[0], self.full, self.full + 1]))
        self.starts = np.array([np.minimum(c * self.weights, self.blocks).sum() for c in self.turns])

    def cycle(self, turn: int) -> tuple[int, ...]:
        """Blocks of each source in the cycles from this turn to the next."""
        c = self.turns[turn]
        return tuple(np.where(c < self.full, self.weights, np.where(c == self.full, self.rest, 0)).tolist())

    def place(self, source: np.ndarray, block: np.ndarray) -> pd.DataFrame:
        """Slot, release and deadline of each block."""
        cycle, j = block // self.weights[source], block % self.weights[source]
        turn = np.searchsorted(self.turns, cycle, side="right") - 1
        out = np.zeros((3, len(block)), dtype=np.int64)
        for t in np.unique(turn):
            at = np.flatnonzero(turn == t)
            here = self.cycle(int(t))
            slots, first = cycle_order(here)
            length, own = len(slots), np.array(here)[source[at]]
            start = self.starts[t] + (cycle[at] - self.turns[t]) * length
            out[0, at] = start + slots[first[source[at]] + j[at]]
            out[1, at] = start + j[at] * length // own
            out[2, at] = start - (-(j[at] + 1) * length // own)
        return pd.DataFrame({"slot": out[0], "release": out[1], "deadline": out[2]})


def cycle_weights(rows: Mapping[str | None, int], targets: Mapping[str | None, float] | None, cycle: int) -> dict[str | None, int]:
    """Slots of each source in a cycle.

    Without targets a source's share follows the square root of its documents. Sources without a target,
    or one of 0, get one slot, so that none is lost.
    """
    shares = {s: (n**0.5 if targets is None else max(0.0, float(targets.get(s, 0.0)))) for s, n in rows.items()}
    total = sum(shares.values()) or 1.0
    return {s: max(1, round(share / total * cycle)) for s, share in shares.items()}


ADDED = ("block", "place", "slot", "release", "deadline")


def mix(
    docs: DataFrame,
    targets: Mapping[str | None, float] | None = None,
    block_rows: int = BLOCK_ROWS,
    cycle: int = CYCLE,
    id_column: str = "doc_id",
    source_column: str = "source",
    group_rows: int = GROUP_ROWS,
) -> DataFrame:
    """Every row with its ``block`` (number within the source), ``slot``, ``release``, ``deadline``, ``place``.

    Sorted by slot and place the rows are the mixture. Null is a source of its own; rows with equal or
    null ids each have a place. The last block of a group may hold fewer documents. An empty table gives
    none. Columns named as those added here are replaced by them. The driver sees one row per source; a
    large source is numbered in many groups, dealt by id.
    """
    spark = docs.sparkSession
    docs = docs.drop(*ADDED).select(F.struct("*").alias("row"))
    docs = docs.select(
        "row", F.col(f"row.`{source_column}`").cast("string").alias("_source"), F.xxhash64(f"row.`{id_column}`").alias("_dealt")
    )
    counts = {r["_source"]: r["n"] for r in docs.groupBy("_source").agg(F.count(F.lit(1)).alias("n")).toLocalIterator()}
    sources = sorted(counts, key=lambda s: (s is not None, s or ""))
    weights = cycle_weights(counts, targets, max(cycle, 4 * len(sources)))
    known = spark.createDataFrame(
        [(s, i, -(-counts[s] // group_rows)) for i, s in enumerate(sources)], "of_source string, number int, groups long"
    )
    known = stored(known.coalesce(1), "sources")  # a file: small ones are broadcast for their size
    numbered = docs.join(known, F.col("_source").eqNullSafe(F.col("of_source")))
    numbered = numbered.select("row", "number", F.pmod("_dealt", "groups").alias("group"), "_dealt")

    sizes = numbered.groupBy("number", "group").agg(F.count(F.lit(1)).alias("n"))
    blocks = F.ceil(F.col("n") / block_rows)
    before = Window.partitionBy("number").orderBy("group").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        F.col("number").alias("of_number"), F.col("group").alias("of_group"), blocks.alias("blocks"),
        F.coalesce(F.sum(blocks).over(before), F.lit(0)).cast("long").alias("offset"),
    )
    offsets = stored(offsets, "source-groups")
    totals = {r["of_number"]: r["n"] for r in offsets.groupBy("of_number").agg(F.sum("blocks").alias("n")).collect()}
    schedule = Schedule(
        np.array([totals[i] for i in range(len(sources))], dtype=np.int64), np.array([weights[s] for s in sources], dtype=np.int64)
    )

    @F.pandas_udf("slot long, release long, deadline long")
    def placed(number: pd.Series, block: pd.Series) -> pd.DataFrame:
        return schedule.place(number.to_numpy(), block.to_numpy())

    rank = F.row_number().over(Window.partitionBy("number", "group").orderBy("_dealt", F.xxhash64("row"))) - 1
    ranked = numbered.select("row", "number", "group", rank.alias("rank"))
    same = (F.col("number") == F.col("of_number")) & (F.col("group") == F.col("of_group"))
    ranked = ranked.join(offsets.drop("blocks"), same).select(
        "row", "number", (F.col("offset") + F.expr(f"rank div {block_rows}")).alias("block"), (F.col("rank") % block_rows).cast("int").alias("place")
    )
    out = ranked.select("row", "block", "place", placed("number", "block").alias("at"))
    return out.select("row.*", "block", "place", "at.slot", "at.release", "at.deadline")


def in_order(mixed: DataFrame) -> DataFrame:
    """The mixture in its order, over many partitions, without the columns added."""
    return mixed.repartitionByRange("slot", "place").sortWithinPartitions("slot", "place").drop(*ADDED)
