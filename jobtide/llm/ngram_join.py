"""N-gram Jaccard join: an exact search for all texts whose word runs overlap enough, by T-occurrence.

A text of ``n`` runs shares at least ``T``, a given percentage of ``n``, with every text it is linked to.
Its runs are inverted lists to search; the ``T - 1`` that are likely the longest are set aside, and a
partner stands in at least one of the rest, the short lists. Which lists are short goes by an order
that is the same for all texts: the rarity of a run's rarest word, by counts of all words hashed to a
table of fixed size, then the run's hash. A list is never longer than that word's count, so that runs of
common passages come last, and are not merged.

Short lists are gathered by Spark. In each, the member that shares most is compared with the others; of
what then still lies apart, blocks of a list are searched in tasks (:mod:`jobtide.llm.divide_skip`): short
lists merged by a heap, long ones probed. Members that no other comes near in size leave a list, and marks, a
bit for two elements, tell of most unrelated pairs that they differ too much before sets travel. All links are decided on full sets, and only links leave the tasks.
Texts with equal sets are one class. The hashes have 64 bits a run and 128 a set.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from jobtide.llm import grams
from jobtide.llm.common import BLANKS, by_group, present, stored
from jobtide.llm.components import Union, components
from jobtide.llm.divide_skip import occurrences
from jobtide.llm.superminhash import shared

#: Members of a list that are searched with as many others in one task.
BLOCK = 256
#: Cells of the table of word counts, and how many of them travel in one row.
CELL_BITS, SLICE_BITS = 22, 16
#: Bits of the filters by which rows without a partner are left out before a shuffle.
FILTER = 1 << 23
BLANK = grams.table(BLANKS.encode())
LEVEL_SHIFT = np.uint64(56)
#: The smallest number of bits of a mark.
MARK_BITS = 128


def _texts(column: pa.Array) -> list[bytes]:
    return [t.as_buffer().to_pybytes().lower() for t in column.cast(pa.binary())]


def word_levels(docs: DataFrame) -> bytes:
    """For each cell the logarithm, in halves, of how often words of it occur in all texts: 4 MB."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros(1 << CELL_BITS, dtype=np.int64)
        for batch in batches:
            for _, data, _ in grams.buffers(_texts(batch.column(0))):
                _, _, h = grams.words(data, BLANK)
                cells, n = np.unique(h >> np.uint64(64 - CELL_BITS), return_counts=True)
                totals[cells.astype(np.int64)] += n
        cells = np.flatnonzero(totals)
        columns = [pa.array((cells >> SLICE_BITS).astype(np.int32)), pa.array((cells & (1 << SLICE_BITS) - 1).astype(np.int32)), pa.array(totals[cells])]
        yield pa.RecordBatch.from_arrays(columns, ["slice", "cell", "n"])

    def packed(table: pa.Table) -> pa.Table:
        out = np.zeros(1 << SLICE_BITS, dtype=np.uint8)
        out[table["cell"].to_numpy()] = table["level"].to_numpy()
        return pa.table({"slice": table["slice"][:1], "levels": pa.array([out.tobytes()], pa.binary())})

    counted = docs.select("text").mapInArrow(count, "slice int, cell int, n long").groupBy("slice", "cell").agg(F.sum("n").alias("n"))
    level = F.least(F.floor(2 * F.log2(F.col("n") + 1)), F.lit(127)).cast("int")
    slices = counted.select("slice", "cell", level.alias("level")).groupBy("slice").applyInArrow(packed, "slice int, levels binary")
    out = bytearray(1 << CELL_BITS)
    for row in slices.collect():  # of fixed size
        out[row["slice"] << SLICE_BITS : row["slice"] + 1 << SLICE_BITS] = row["levels"]
    return bytes(out)


def sets_of(texts: list[bytes], width: int, levels: np.ndarray | None = None) -> Iterator[tuple[np.ndarray, np.ndarray | None]]:
    """For each text its sorted distinct run hashes and, in the same order, their keys in the order of the lists."""
    for _, data, ends in grams.buffers(texts):
        starts, _, w = grams.words(data, BLANK)
        firsts = np.searchsorted(starts, np.concatenate([[0], ends]))
        level = levels[(w >> np.uint64(64 - CELL_BITS)).astype(np.int64)] if levels is not None else None
        runs, lows = np.full(len(w), width, dtype=np.uint64), level
        for i in range(width):
            runs = grams.joined(runs[: len(w) - i], w[i:])
            if level is not None:
                lows = np.minimum(lows[: len(w) - i], level[i:])
        for a, b in zip(firsts[:-1], firsts[1:]):
            if b - a >= width:
                found, low = runs[a : b - width + 1], lows[a : b - width + 1] if level is not None else None
            elif b > a:
                found = np.full(1, b - a, dtype=np.uint64)
                for i in range(a, b):
                    found = grams.joined(found, w[i : i + 1])
                low = level[a:b].min(keepdims=True) if level is not None else None
            else:
                found, low = np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.uint8)
            elements, at = np.unique(found, return_index=True)
            if level is None:
                yield elements, None
            else:
                yield elements, low[at].astype(np.uint64) << LEVEL_SHIFT | elements >> np.uint64(8)


def least_shared(n: int, percent: int) -> int:
    """Runs that a text of ``n`` shares with every text it is linked to."""
    return -(-percent * n // 100)


def short_lists(keys: np.ndarray, percent: int) -> np.ndarray:
    """The first keys in order: all but one less than the runs that must be shared."""
    wanted = len(keys) - least_shared(len(keys), percent) + 1
    return np.sort(np.partition(keys, wanted - 1)[:wanted] if wanted < len(keys) else keys)


def _key(elements: np.ndarray) -> tuple[int, int]:
    h = xxhash.xxh3_128_intdigest(elements.tobytes())
    return tuple(int(x) for x in np.array([h >> 64, h & (1 << 64) - 1], dtype=np.uint64).view(np.int64))


def mark(elements: np.ndarray) -> np.ndarray:
    """Bits that tell whether an odd number of elements falls on them, packed: a power of two of them, half the size at least.

    Marks of two sets differ in no more bits than the sets in elements, as elements of both fall on the same bits.
    """
    bits = max(MARK_BITS, 1 << (len(elements) // 2 - 1).bit_length())
    return np.packbits(np.bincount((elements & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1)


def may_link(marks: np.ndarray, sizes: np.ndarray, with_mark: np.ndarray, with_size: int, percent: int) -> np.ndarray:
    """Whether sets with marks of one length can be linked with a set. The longer marks are folded to the length of the others."""
    short = min(marks.shape[1], len(with_mark))
    folded = [np.bitwise_xor.reduce(m.reshape(len(m), m.shape[1] // short, short), axis=1) for m in (marks, with_mark[None])]
    differ = np.bitwise_count(folded[0] ^ folded[1]).sum(axis=1, dtype=np.int64)
    return (100 + percent) * differ <= (100 - percent) * (sizes + with_size)


def signed(docs: DataFrame, width: int, percent: int, levels: bytes) -> DataFrame:
    """Per row of (doc_id, text): the set's size, 128-bit hash and mark, and the keys of its short lists."""
    held = docs.sparkSession.sparkContext.broadcast(levels)  # of fixed size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.frombuffer(held.value, dtype=np.uint8)
        for batch in batches:
            sizes, hashes, marks, keys = [], [], [], []
            for elements, order in sets_of(_texts(batch.column(1)), width, table):
                sizes.append(len(elements))
                hashes.append(_key(elements))
                marks.append(mark(elements).tobytes())
                keys.append(short_lists(order, percent) if len(elements) else order)
            flat = np.concatenate(keys).view(np.int64) if keys else np.zeros(0, dtype=np.int64)
            offsets = np.concatenate([[0], np.cumsum([len(k) for k in keys])]).astype(np.int32)
            h1, h2 = (pa.array([h[i] for h in hashes], pa.int64()) for i in (0, 1))
            columns = [batch.column(0), pa.array(sizes, pa.int64()), h1, h2, pa.array(marks, pa.binary()), pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_shingles", "h1", "h2", "mark", "keys"])

    return docs.mapInArrow(run, "doc_id long, n_shingles long, h1 long, h2 long, mark binary, keys array<long>")


def filter_of(df: DataFrame, column: str) -> np.ndarray:
    """A bit for each value of a whole-number column by its low bits: of fixed size. Others may share it."""
    found = df.select(F.col(column).bitwiseAND(F.lit(FILTER - 1)).cast("int").alias("cell")).distinct().toArrow()
    bits = np.zeros(FILTER, dtype=bool)
    bits[found["cell"].to_numpy()] = True
    return np.packbits(bits)


def passing(packed: np.ndarray, values: np.ndarray) -> np.ndarray:
    at = values & (FILTER - 1)
    return packed[at >> 3] >> (7 - (at & 7)).astype(np.uint8) & 1 == 1


def full_sets(docs: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """``rep``, ``tie`` and ``elements`` (sorted 64-bit hashes) of the classes asked for, from their texts.

    Sets are made where the texts are read, of ids that pass a filter of the ids asked for.
    """
    ids = docs.sparkSession.sparkContext.broadcast(filter_of(wanted, "rep"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(pa.array(passing(ids.value, batch.column(0).to_numpy())))
            sets = [elements for elements, _ in sets_of(_texts(batch.column(1)), width)]
            keys = [_key(elements) for elements in sets]
            columns = [batch.column(0), *(pa.array([k[i] for k in keys], pa.int64()) for i in (0, 1)), pa.array([e.tobytes() for e in sets], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["rep", "h1", "h2", "elements"])

    made = docs.where("doc_id is not null").mapInArrow(run, "rep long, h1 long, h2 long, elements binary")
    found = made.join(wanted.select("rep", "tie", "h1", "h2"), ["rep", "h1", "h2"])
    return found.dropDuplicates(["rep", "h1", "h2"]).select("rep", "tie", "elements")  # as they are partitioned for the join


def entries_of(classes: DataFrame, keys: np.ndarray) -> DataFrame:
    """A row for each class and short list of it that passes a filter of the lists with several members."""
    held = classes.sparkSession.sparkContext.broadcast(keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(3)
            flat = lists.flatten().to_numpy(zero_copy_only=False)
            owner = np.repeat(np.arange(batch.num_rows), lists.value_lengths().to_numpy(zero_copy_only=False))
            some = passing(held.value, flat)
            at = pa.array(owner[some])
            yield pa.RecordBatch.from_arrays([pa.array(flat[some]), *(batch.column(i).take(at) for i in range(3))], ["key", "rep", "tie", "n"])

    return classes.select("rep", "tie", "n_shingles", "keys").mapInArrow(run, "key long, rep long, tie long, n long")


def members_of(classes: DataFrame, lists: DataFrame, percent: int) -> DataFrame:
    """The members of each list, without those of lists of up to a block that no other member comes near in size.

    Sizes of linked texts lie within ``percent`` of each other, and of all members the next smaller or larger one comes
    nearest. Most texts that share a run by chance have no link to look for. Longer lists, which are few, are left whole, so
    that Spark can split them.
    """
    short, long = (
        entries_of(classes, filter_of(of_length, "key")).join(of_length, "key").select("key", "rep", "tie", "n", "size")
        for of_length in (lists.where(F.col("size") <= BLOCK), lists.where(F.col("size") > BLOCK))
    )
    by_size = Window.partitionBy("key").orderBy("n")
    beside = short.withColumns({"smaller": F.lag("n").over(by_size), "larger": F.lead("n").over(by_size)})
    near = (100 * F.col("smaller") >= percent * F.col("n")) | (100 * F.col("n") >= percent * F.col("larger"))
    return beside.where(near).drop("smaller", "larger").unionByName(long)


def _elements(data) -> np.ndarray:
    return np.frombuffer(data.as_buffer(), dtype=np.uint64)


def _mark(data) -> np.ndarray:
    return np.frombuffer(data.as_buffer(), dtype=np.uint8)


def likely(edges: DataFrame, marks: DataFrame, percent: int) -> DataFrame:
    """The edges whose ends can be linked by their marks: full sets of the others need not travel."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_a, n_b = (batch.column(i).to_numpy() for i in (4, 6))
            pairs = enumerate(zip(batch.column(5), batch.column(7)))
            good = [bool(may_link(_mark(x)[None], n_a[i : i + 1], _mark(y), int(n_b[i]), percent)[0]) for i, (x, y) in pairs]
            yield pa.RecordBatch.from_arrays(batch.columns[:4], ["a", "a_tie", "b", "b_tie"]).filter(pa.array(good, pa.bool_()))

    for x in ("a", "b"):
        side = marks.select(F.col("rep").alias(x), F.col("tie").alias(f"{x}_tie"), F.col("n_shingles").alias(f"n_{x}"), F.col("mark").alias(f"of_{x}"))
        edges = edges.join(side, [x, f"{x}_tie"])
    row = ["a", "a_tie", "b", "b_tie"]
    return edges.select(*row, "n_a", "of_a", "n_b", "of_b").mapInArrow(run, ", ".join(f"{c} long" for c in row))


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    both = shared(a, b)
    return 100 * both >= percent * (len(a) + len(b) - both)


def verified(edges: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The edges (a, b) between classes (a, a_tie) and (b, b_tie) whose sets are linked."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = [linked(_elements(x), _elements(y), percent) for x, y in zip(batch.column(2), batch.column(3))]
            yield pa.RecordBatch.from_arrays(batch.columns[:2], ["a", "b"]).filter(pa.array(good, pa.bool_()))

    sides = [sets.select(F.col("rep").alias(x), F.col("tie").alias(f"{x}_tie"), F.col("elements").alias(f"of_{x}")) for x in ("a", "b")]
    both = edges.join(sides[0], ["a", "a_tie"]).join(sides[1], ["b", "b_tie"])
    return both.select("a", "b", "of_a", "of_b").mapInArrow(run, "a long, b long")


def _due(table: pa.Table, percent: int) -> np.ndarray:
    """Of a block of outsiders and a block of members of a list: who is in a pair that meets first in this list.

    ``earlier`` holds the lists of a member that come before this one, in an order that is the same for all.
    """
    before = [np.array(k.values) for k in table["earlier"].combine_chunks()]
    group, size, asks = table["component"].to_numpy(), table["n_shingles"].to_numpy(), table["asks"].to_numpy()
    members = np.flatnonzero(~asks)
    earlier = [before[i] for i in members]
    owner = np.repeat(members, [len(k) for k in earlier])
    flat = np.concatenate([*earlier, np.zeros(0, dtype=np.int64)])
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    due = set()
    for i in np.flatnonzero(asks).tolist():
        apart = ~asks & (group != group[i])
        apart &= 100 * np.minimum(size, size[i]) >= percent * np.maximum(size, size[i])
        for a, b in zip(np.searchsorted(flat, before[i], "left"), np.searchsorted(flat, before[i], "right")):
            apart[owner[a:b]] = False
        if apart.any():
            due.update([i, *np.flatnonzero(apart).tolist()])
    return np.array(sorted(due), dtype=np.int64)


def _near(table: pa.Table, percent: int) -> np.ndarray:
    """Of a block of outsiders and a block of members: who is in a pair of two components that can be linked by its marks."""
    group, size, asks = table["component"].to_numpy(), table["n_shingles"].to_numpy(), table["asks"].to_numpy()
    marks = [_mark(x) for x in table["mark"]]
    lengths = np.array([len(m) for m in marks], dtype=np.int64)
    of_length = {n: np.flatnonzero(~asks & (lengths == n)) for n in np.unique(lengths[~asks]).tolist()}
    stacked = {n: np.stack([marks[j] for j in at]) for n, at in of_length.items()}
    near = set()
    for i in np.flatnonzero(asks).tolist():
        for n, at in of_length.items():
            apart = (group[at] != group[i]) & (100 * np.minimum(size[at], size[i]) >= percent * np.maximum(size[at], size[i]))
            found = at[apart][may_link(stacked[n][apart], size[at][apart], marks[i], int(size[i]), percent)]
            if len(found):
                near.update([i, *found.tolist()])
    return np.array(sorted(near), dtype=np.int64)


def _search(table: pa.Table, percent: int) -> list[tuple[int, int]]:
    """Links of outsiders with members in other components, by T-occurrence."""
    reps, group, asks = table["rep"].to_pylist(), table["component"].to_pylist(), table["asks"].to_numpy()
    sets = [_elements(x) for x in table["elements"]]
    members = np.flatnonzero(~asks)
    flat = np.concatenate([*(sets[i] for i in members), np.zeros(0, dtype=np.uint64)])
    owner = np.repeat(members, [len(sets[i]) for i in members])
    order = np.lexsort((owner, flat))
    flat, owner = flat[order], owner[order].tolist()
    trees, found = Union(), []
    for q in np.flatnonzero(asks).tolist():
        n = len(sets[q])
        spans = zip(np.searchsorted(flat, sets[q], "left").tolist(), np.searchsorted(flat, sets[q], "right").tolist())
        for i, both in occurrences([owner[a:b] for a, b in spans if b > a], least_shared(n, percent)):
            apart = group[i] != group[q] and trees.root(reps[i]) != trees.root(reps[q])
            if apart and 100 * both >= percent * (n + len(sets[i]) - both):
                trees.join(reps[i], reps[q])
                found.append((reps[i], reps[q]))
    return found


def remaining(
    docs: DataFrame,
    members: DataFrame,
    centres: DataFrame,
    classes: DataFrame,
    groups: DataFrame,
    width: int,
    percent: int,
    marks: DataFrame | None = None,
) -> DataFrame:
    """Links between members of one short list, other than its centre, that are not in one component yet.

    Those outside the largest component of a list, the outsiders, are compared with all its members: blocks
    of outsiders with blocks of members, so that what travels follows the members as long as outsiders are few.
    With the marks of the classes, sets of pairs that cannot be linked stay where they are.
    """
    tried = centres.select("key", F.col("b").alias("rep"), F.col("b_tie").alias("tie"))
    others = members.join(tried, ["key", "rep", "tie"], "left_anti")
    placed = others.join(groups, others["rep"] == groups["node"], "left").select("key", "rep", "tie", "n", F.coalesce("component", "rep").alias("component"))
    shares = placed.groupBy("key", "component").agg(F.count(F.lit(1)).alias("n"))
    lists = shares.groupBy("key").agg(F.max(F.struct("n", "component")).alias("top"), F.sum("n").alias("all"))
    lists = lists.where("all > top.n").select("key", F.col("top.component").alias("largest"), "all", (F.col("all") - F.col("top.n")).alias("out"))
    blocks = [F.ceil(F.col(n) / BLOCK).cast("int").alias(name) for n, name in (("all", "blocks"), ("out", "out_blocks"))]
    held = stored(placed.join(lists.select("key", "largest", "all", *blocks), "key"), "apart")
    number = F.xxhash64("rep", "tie")
    outsiders = held.where("component <> largest").withColumns(
        {"asker": F.pmod(number, "out_blocks").cast("int"), "block": F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)), "asks": F.lit(True)}
    )
    asked = held.withColumns(
        {"block": F.pmod(number, "blocks").cast("int"), "asker": F.explode(F.sequence(F.lit(0), F.col("out_blocks") - 1)), "asks": F.lit(False)}
    )
    at, of_class = ["key", "asker", "block"], ["rep", "tie"]
    row = [*at, *of_class, "component", "asks"]
    # A pair meets in every list left that holds both; the first of them is enough to tell. Long lists come first: their
    # members stand in the most blocks, and take along the keys of the lists before.
    ordered = F.sort_array(F.collect_list(F.struct((-F.col("all")).alias("minus"), "key")))
    lists_of = held.groupBy(*of_class).agg(F.transform(ordered, lambda x: x["key"]).alias("keys"), F.first("n").alias("n_shingles"))
    described = outsiders.select(row).unionByName(asked.select(row)).join(lists_of, of_class)
    earlier = F.slice("keys", F.lit(1), F.array_position("keys", F.col("key")).cast("int") - 1).alias("earlier")

    def needed(table: pa.Table) -> pa.Table:
        return table.drop_columns(["n_shingles", "earlier"]).take(pa.array(_due(table, percent)))

    def search(table: pa.Table) -> pa.Table:
        links = np.array(_search(table, percent), dtype=np.int64).reshape(-1, 2)
        return pa.table({"a": links[:, 0], "b": links[:, 1]})

    # Sets travel only to where a pair needs them.
    schema = "key long, asker int, block int, rep long, tie long, component long, asks boolean"
    due = stored(by_group(described.select(*row, "n_shingles", earlier), at, needed, schema), "due")
    if marks is not None:

        def near(table: pa.Table) -> pa.Table:
            return table.drop_columns(["n_shingles", "mark"]).take(pa.array(_near(table, percent)))

        due = stored(by_group(due.join(marks, of_class).select(*row, "n_shingles", "mark"), at, near, schema), "near")
    sets = stored(full_sets(docs, due.select(*of_class).distinct().join(classes, of_class), width), "sets")
    return by_group(due.join(sets, of_class).select(*row, "elements"), at, search, "a long, b long")


def jaccard_join(
    docs: DataFrame, words: int = 5, percent: int = 80, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """Per row its id, ``n_shingles`` and ``component_id``, the smallest id reachable by links.

    Two texts are linked if their sets of word runs share at least ``percent`` of a hundred of their
    union. A text shorter than a run is one element; one without words (null, empty, blanks) has none and
    is linked with nothing. Rows with equal ids are one node, also if their texts differ; a row with a null
    id is not linked and has no component. An empty table gives none. Other columns are not read.
    """
    docs = docs.select(F.col(id_column).cast("long").alias("doc_id"), present(text_column).alias("text"))
    rows = stored(signed(docs, words, percent, word_levels(docs)), "short-lists")
    some = rows.where("n_shingles > 0 and doc_id is not null")
    of_id = some.groupBy("doc_id").agg(F.min(F.struct("h1", "h2")).alias("lo"), F.max(F.struct("h1", "h2")).alias("hi"))
    several = stored(of_id.where("lo <> hi").select("doc_id"), "several")  # ids of more than one set
    found = some.groupBy("h1", "h2").agg(
        F.min("doc_id").alias("rep"), F.max("n_shingles").alias("n_shingles"), F.min_by(F.struct("keys", "mark"), "doc_id").alias("of")
    ).select("h1", "h2", "rep", "n_shingles", "of.*")
    tie = F.when(F.col("doc_id").isNotNull(), F.xxhash64("h1", "h2")).otherwise(F.lit(0).cast("long"))
    classes = stored(found.join(several, F.col("rep") == F.col("doc_id"), "left").withColumn("tie", tie).drop("doc_id"), "classes")
    of_class = ["rep", "tie"]
    same = some.join(several, "doc_id").select("doc_id", "h1", "h2").join(classes.select("h1", "h2", "rep"), ["h1", "h2"])
    same = same.where("doc_id <> rep").select(F.col("doc_id").alias("a"), F.col("rep").alias("b")).distinct()

    lists = stored(classes.select(F.explode("keys").alias("key")).groupBy("key").agg(F.count(F.lit(1)).alias("size")).where("size > 1"), "lists")
    members = stored(members_of(classes, lists, percent), "members")
    known = members.groupBy(*of_class).agg(F.sum("size").alias("score"))
    best = F.max(F.struct("score", (-F.col("rep")).alias("minus"), "tie", "n")).alias("best")
    centres = members.join(known, of_class).groupBy("key").agg(best)
    centres = stored(centres.select("key", (-F.col("best.minus")).alias("b"), F.col("best.tie").alias("b_tie"), F.col("best.n").alias("b_n")), "centres")
    fits = (F.col("rep") != F.col("b")) & (100 * F.least("n", "b_n") >= percent * F.greatest("n", "b_n"))
    pairs = members.join(centres, "key").where(fits)
    edges = pairs.select(F.col("rep").alias("a"), F.col("tie").alias("a_tie"), "b", "b_tie").distinct()
    marks = classes.select(*of_class, "n_shingles", "mark")
    edges = stored(likely(edges, marks, percent), "edges")

    ends = edges.select(F.col("a").alias("rep"), F.col("a_tie").alias("tie")).union(edges.select("b", "b_tie")).distinct()
    sets = stored(full_sets(docs, ends.join(classes.drop("keys", "mark"), of_class), words), "sets")
    links = stored(verified(edges, sets, percent).unionByName(same), "verified")
    groups = components(links)
    more = stored(remaining(docs, members, centres, classes, groups, words, percent, marks), "verified")
    if not more.isEmpty():
        groups = components(links.unionByName(more))

    named = classes.join(groups, classes["rep"] == groups["node"], "left").select("h1", "h2", F.coalesce("component", "rep").alias("component"))
    left = rows.select("doc_id", "n_shingles", "h1", "h2", (F.col("n_shingles") > 0).alias("some"))
    out = left.join(named.withColumn("some", F.lit(True)), ["h1", "h2", "some"], "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return out.select(F.col("doc_id").alias(id_column), "n_shingles", component.alias("component_id"))
