"""Near-duplicate documents: SuperMinHash, banding, verification on full sets, union-find grouping.

Documents with equal shingle sets form a class, which its smallest id stands for, with a hash of the set
where that id has more than one text. Classes that share
a band's bucket are candidates. In every bucket the member that shares most buckets with others is the
centre, and the others are compared with it on their full sets: of many copies of one text that differ
among each other, the text itself is found, and no pairs of copies are needed. What then still lies
apart in a bucket is compared pair by pair inside tasks, block against block, each pair in the first
band that both share, so that a link between unlike copies is not lost. Only links leave the tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobtide.llm.common import present, stored
from jobtide.llm.components import Union, components
from jobtide.llm.superminhash import BANDS, bands, shared, shingles, signatures

#: Members of a bucket that are compared with as many others in one task.
BLOCK = 256
SHINGLES_AT_ONCE = 400_000


def _key(elements: np.ndarray) -> tuple[int, int]:
    h = xxhash.xxh3_128_intdigest(elements.tobytes())
    return tuple(int(x) for x in np.array([h >> 64, h & (1 << 64) - 1], dtype=np.uint64).view(np.int64))


def signed(docs: DataFrame, words: int) -> DataFrame:
    """Per row of (doc_id, text): the set's size and 128-bit hash, and its band hashes (none for an empty set)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held, rows, size = [], [], 0
            ids = batch.column(0)
            for i, text in enumerate(batch.column(1).cast(pa.binary())):
                held.append(shingles(text.as_buffer().to_pybytes(), words))
                rows.append(i)
                size += len(held[-1])
                if size >= SHINGLES_AT_ONCE or i + 1 == batch.num_rows:
                    yield summary(ids.take(pa.array(rows)), held)
                    held, rows, size = [], [], 0

    def summary(ids: pa.Array, sets: list[np.ndarray]) -> pa.RecordBatch:
        some = [s for s in sets if len(s)]
        hashes = bands(signatures(some)).reshape(-1) if some else np.zeros(0, dtype=np.int64)
        offsets = np.concatenate([[0], np.cumsum([BANDS * bool(len(s)) for s in sets])])
        keys = [_key(s) for s in sets]
        return pa.RecordBatch.from_arrays(
            [
                ids, pa.array([len(s) for s in sets], pa.int64()), pa.array([k[0] for k in keys], pa.int64()),
                pa.array([k[1] for k in keys], pa.int64()), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(hashes)),
            ],
            ["doc_id", "n_shingles", "h1", "h2", "bands"],
        )

    return docs.mapInArrow(run, "doc_id long, n_shingles long, h1 long, h2 long, bands array<long>")


def full_sets(docs: DataFrame, classes: DataFrame, words: int) -> DataFrame:
    """``rep``, ``tie`` and ``elements`` (sorted 64-bit hashes) of the classes asked for, from their documents' texts."""
    wanted = classes.select(F.col("rep").alias("doc_id"), "tie", "h1", "h2")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, sets = [], []
            for i, (text, h1, h2) in enumerate(zip(batch.column(1).cast(pa.binary()), batch.column(3), batch.column(4))):
                elements = shingles(text.as_buffer().to_pybytes(), words)
                if _key(elements) == (h1.as_py(), h2.as_py()):  # another row may have the same id
                    found.append(i)
                    sets.append(elements.tobytes())
            at = pa.array(found, pa.int64())
            columns = [batch.column(0).take(at), batch.column(2).take(at), pa.array(sets, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["rep", "tie", "elements"])

    texts = docs.join(wanted, "doc_id").select("doc_id", "text", "tie", "h1", "h2")
    return texts.mapInArrow(run, "rep long, tie long, elements binary").dropDuplicates(["rep", "tie"])


def _elements(data) -> np.ndarray:
    return np.frombuffer(data.as_buffer(), dtype=np.uint64)


def alike(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    both = shared(a, b)
    return 100 * both >= percent * (len(a) + len(b) - both)


def verified(edges: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The edges (a, b), between classes (a, a_tie) and (b, b_tie), whose sets are alike."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = [alike(_elements(x), _elements(y), percent) for x, y in zip(batch.column(2), batch.column(3))]
            yield pa.RecordBatch.from_arrays(batch.columns[:2], ["a", "b"]).filter(pa.array(good, pa.bool_()))

    of_a = sets.select(F.col("rep").alias("a"), F.col("tie").alias("a_tie"), F.col("elements").alias("of_a"))
    of_b = sets.select(F.col("rep").alias("b"), F.col("tie").alias("b_tie"), F.col("elements").alias("of_b"))
    return edges.join(of_a, ["a", "a_tie"]).join(of_b, ["b", "b_tie"]).select("a", "b", "of_a", "of_b").mapInArrow(run, "a long, b long")


def _pairs(table: pa.Table, percent: int) -> np.ndarray:
    """Of one block against one block of a bucket: pairs in different components that meet first in this band."""
    bucket, block = table["bucket"][0].as_py(), table["block"].to_numpy()
    hashes = np.array(table["bands"].combine_chunks().values).reshape(-1, BANDS)
    group, size = table["component"].to_numpy(), table["n_shingles"].to_numpy()
    band = int(np.flatnonzero(hashes[0] == bucket)[0])
    first, second = table["first"][0].as_py(), table["second"][0].as_py()
    left, right = np.flatnonzero(block == first), np.flatnonzero(block == second)
    met = (hashes[left][:, None, :] == hashes[right][None, :, :]).argmax(axis=2) == band
    met &= group[left][:, None] != group[right][None, :]
    a, b = size[left][:, None], size[right][None, :]
    met &= 100 * np.minimum(a, b) >= percent * np.maximum(a, b)
    if first == second:
        met &= left[:, None] < right[None, :]
    i, j = np.nonzero(met)
    return np.stack([left[i], right[j]], axis=1)


def remaining(members: DataFrame, classes: DataFrame, groups: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links between members of one bucket that are not in one component yet."""
    placed = members.join(groups, members["rep"] == groups["node"], "left").select(
        "bucket", "rep", "tie", F.coalesce("component", "rep").alias("component")
    )
    spread = placed.groupBy("bucket").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.count(F.lit(1)).alias("n"))
    spread = spread.where("lo < hi").select("bucket", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"))
    blocked = placed.join(spread, "bucket").withColumn("block", F.pmod(F.xxhash64("rep", "tie"), "blocks").cast("int"))
    blocked = blocked.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "bucket", "rep", "tie", "component", "block", F.least("block", "other").alias("first"), F.greatest("block", "other").alias("second")
    )
    key = ["bucket", "first", "second"]
    of_class = ["rep", "tie"]
    described = blocked.join(classes.select(*of_class, "n_shingles", "bands"), of_class)
    described = described.select(*key, *of_class, "block", "component", "n_shingles", "bands")

    def needed(table: pa.Table) -> pa.Table:
        return table.take(pa.array(np.unique(_pairs(table, percent))))

    def compare(table: pa.Table) -> pa.Table:
        reps, found, trees = table["rep"].to_pylist(), [], Union()
        elements = [_elements(x) for x in table["elements"]]
        for i, j in _pairs(table, percent).tolist():
            if trees.root(reps[i]) != trees.root(reps[j]) and alike(elements[i], elements[j], percent):
                trees.join(reps[i], reps[j])
                found.append((reps[i], reps[j]))
        links = np.array(found, dtype=np.int64).reshape(-1, 2)
        return pa.table({"a": links[:, 0], "b": links[:, 1]})

    # Sets travel only to where a pair needs them.
    schema = "bucket long, first int, second int, rep long, tie long, block int, component long, n_shingles long, bands array<long>"
    due = stored(described.groupBy(*key).applyInArrow(needed, schema), "due")
    return due.join(sets, of_class).groupBy(*key).applyInArrow(compare, "a long, b long")


def near_duplicates(
    docs: DataFrame, words: int = 5, percent: int = 80, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """Per row its id, ``n_shingles``, ``component_id`` (smallest id reachable by links) and ``kept``.

    Texts are linked if their sets of word runs share at least ``percent`` of a hundred of their union. A
    text shorter than a run is one element; one without words (null, empty, blanks) is linked with
    nothing and kept. Rows with equal ids are one node,
    also if their texts differ; a row with a null id cannot be linked, has no
    component and is kept. An empty table gives none. Other columns are not read.
    """
    docs = docs.select(F.col(id_column).cast("long").alias("doc_id"), present(text_column).alias("text"))
    rows = stored(signed(docs, words), "signatures")
    some = rows.where("n_shingles > 0 and doc_id is not null")
    of_id = some.groupBy("doc_id").agg(F.min(F.struct("h1", "h2")).alias("lo"), F.max(F.struct("h1", "h2")).alias("hi"))
    several = stored(of_id.where("lo <> hi").select("doc_id"), "several")  # ids of more than one set
    classes = some.groupBy("h1", "h2").agg(
        F.min("doc_id").alias("rep"), F.max("n_shingles").alias("n_shingles"), F.min_by("bands", "doc_id").alias("bands")
    )
    classes = classes.join(several, F.col("rep") == F.col("doc_id"), "left").withColumn(
        "tie", F.when(F.col("doc_id").isNotNull(), F.xxhash64("h1", "h2")).otherwise(F.lit(0).cast("long"))
    )
    classes = stored(classes.drop("doc_id"), "classes")
    of_class = ["rep", "tie"]
    same = some.join(several, "doc_id").select("doc_id", "h1", "h2").join(classes.select("h1", "h2", "rep"), ["h1", "h2"])
    same = same.where("doc_id <> rep").select(F.col("doc_id").alias("a"), F.col("rep").alias("b")).distinct()

    buckets = classes.select(*of_class, F.explode("bands").alias("bucket"))
    sizes = buckets.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    members = stored(buckets.join(sizes, "bucket").select("bucket", *of_class, "size"), "members")
    known = members.groupBy(*of_class).agg(F.sum("size").alias("score"))
    best = F.max(F.struct("score", (-F.col("rep")).alias("minus"), "tie")).alias("best")
    centres = members.join(known, of_class).groupBy("bucket").agg(best)
    centres = centres.select("bucket", (-F.col("best.minus")).alias("b"), F.col("best.tie").alias("b_tie"))
    edges = members.join(centres, "bucket").where("rep <> b").select(F.col("rep").alias("a"), F.col("tie").alias("a_tie"), "b", "b_tie").distinct()

    candidates = classes.join(known.select(*of_class), of_class, "left_semi")
    sets = stored(full_sets(docs, candidates, words), "sets")
    links = stored(verified(edges, sets, percent).unionByName(same), "verified")
    groups = components(links)
    more = stored(remaining(members, candidates, groups, sets, percent), "verified")
    if not more.isEmpty():
        groups = components(links.unionByName(more))

    named = classes.join(groups, classes["rep"] == groups["node"], "left")
    named = named.select("h1", "h2", F.coalesce("component", "rep").alias("component"))
    left = rows.select("doc_id", "n_shingles", "h1", "h2", (F.col("n_shingles") > 0).alias("some"))
    out = left.join(named.withColumn("some", F.lit(True)), ["h1", "h2", "some"], "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return out.select(
        F.col("doc_id").alias(id_column), "n_shingles", component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )
