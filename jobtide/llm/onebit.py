"""Nearest neighbours by inner product, from randomly rotated one-bit codes.

A vector is turned by random rotations, as many as give 256 signs, and kept as these signs, packed to
bits, with two numbers: the factor that makes the inner product of its signs with a turned query an
unbiased estimate of the true one, and how far that estimate may be off. In a block, the vectors of the
highest estimates are compared exactly first, which gives a score that the query's twentieth best
reaches at least; then those whose estimate plus bound reaches that score. All vectors are scanned,
block by block; blocks are dealt by id hash, so that copies of one vector do not meet in one block.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from jobtide.llm.common import stored

#: Standard errors of the estimate that the bound covers.
DEVIATIONS = 3.5
SEED = 20_240_601
BLOCK_VECTORS, LEAST_BLOCK, QUERY_BLOCK = 32_768, 1_024, 8_192
#: Signs kept of a vector, at least: the error falls with the root of their number.
SIGNS = 256
#: Estimates that are held at once.
PAIRS_AT_ONCE = 1 << 20


@lru_cache(maxsize=8)
def rotation(dim: int) -> np.ndarray:
    """Random orthogonal matrices side by side, the same wherever they are needed; lengths are kept on the whole."""
    random, times = np.random.default_rng(SEED), -(-SIGNS // dim)
    turns = []
    for _ in range(times):
        q, r = np.linalg.qr(random.standard_normal((dim, dim)))
        turns.append(q * np.sign(np.diag(r)))
    return np.hstack(turns) / math.sqrt(times)


def codes(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Packed signs, correction factor and error scale of each row; the error is that for a unit query."""
    turned = vectors @ rotation(vectors.shape[1])
    signs = turned.shape[1]
    length = np.linalg.norm(vectors, axis=1)
    along = np.abs(turned).sum(axis=1) / (length * math.sqrt(signs))  # cosine of the vector and its signs
    along = np.clip(along, 1e-12, 1.0)
    off = length * np.sqrt(1 - along**2) / along / math.sqrt(max(signs - 1, 1))
    return np.packbits(turned > 0, axis=1), length / (along * math.sqrt(signs)), off


def usable(vector: Column) -> Column:
    """Neither null nor empty nor zero, all components finite."""
    finite = F.forall(vector, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def index(vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """The stored index: a row per usable vector with its code, the two numbers and the vector itself.

    Nothing is fitted, so every row is indexed alike. Null ids take no part, as a result cannot name them.
    """
    given = vectors.select(F.col(id_column).cast("long").alias("vec_id"), F.col(vector_column).cast("array<double>").alias("vector"))
    given = given.where(usable(F.col("vector")) & F.col("vec_id").isNotNull())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, lists = batch.column(0).to_numpy(zero_copy_only=False), batch.column(1)
            dims = lists.value_lengths().to_numpy(zero_copy_only=False)
            starts, flat = lists.offsets.to_numpy()[:-1], lists.values.to_numpy(zero_copy_only=False)
            for dim in np.unique(dims):
                at = np.flatnonzero(dims == dim)
                x = flat[starts[at][:, None] + np.arange(dim)]
                packed, factor, off = codes(x)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(ids[at]), pa.array(np.full(len(at), dim, dtype=np.int32)), pa.array([p.tobytes() for p in packed], pa.binary()),
                        pa.array(factor), pa.array(off), pa.array([v.tobytes() for v in x], pa.binary()),
                    ],
                    ["vec_id", "dim", "code", "factor", "off", "vector"],
                )

    return stored(given.mapInArrow(run, "vec_id long, dim int, code binary, factor double, off double, vector binary"), "codes")


def exact(x: list[np.ndarray], y: list[np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Inner products of pairs in double precision, component after component, so that copies tie exactly."""
    total = np.zeros(len(i))
    for a, b in zip(x, y):
        total += a[i] * b[j]
    return total


def best_of(query: np.ndarray, ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Places of each query's k best: highest score, then smallest id; sorted by query."""
    order = np.lexsort((ids, -scores, query))
    of = query[order]
    rank = np.arange(len(of)) - np.searchsorted(of, of)
    return order[rank < k]


def scan(ids, packed, factor, off, vectors, query_ids, queries, k: int):
    """Each query's k best of these vectors, none of them with the query's id: query place, id, score."""
    # Powers of two take lengths near 1, so that estimates of any finite vectors fit; vectors whose lengths differ
    # by more than single precision holds are estimated in double.
    kind = np.float32 if factor.min() > 1e-30 * factor.max() else np.float64
    scale = 2.0 ** np.floor(np.log2(factor.max()))
    of_each = 2.0 ** np.floor(np.log2(np.abs(queries).max(axis=1)))
    scaled = queries / of_each[:, None]
    turned = (scaled @ rotation(vectors.shape[1])).astype(kind)
    signs = np.unpackbits(packed, axis=1, count=turned.shape[1]).astype(kind).T * 2 - 1
    signs *= (factor / scale).astype(kind)
    reach = (DEVIATIONS * np.linalg.norm(scaled, axis=1)).astype(kind)
    off = (off / scale).astype(kind)
    columns, of_query = list(np.ascontiguousarray(vectors.T)), list(np.ascontiguousarray(queries.T))
    kept = []
    for first in range(0, len(queries), max(1, PAIRS_AT_ONCE // len(ids))):
        part = slice(first, first + max(1, PAIRS_AT_ONCE // len(ids)))
        estimate = turned[part] @ signs
        estimate[ids == query_ids[part, None]] = -np.inf
        rows = np.arange(len(estimate))
        bar = np.full(len(estimate), -np.inf)
        if len(ids) > 2 * k:
            likely = np.argpartition(estimate, len(ids) - 2 * k, axis=1)[:, -2 * k :]
            scores = exact(of_query, columns, np.repeat(rows + first, 2 * k), likely.ravel()).reshape(likely.shape)
            scores[estimate[rows[:, None], likely] == -np.inf] = -np.inf
            bar = np.partition(scores, k, axis=1)[:, k]  # the k-th best of 2k
        estimate += reach[part, None] * off
        low = (bar - 1e-5 * np.abs(bar)) / of_each[part] / scale
        q, c = np.nonzero((estimate >= np.nextafter(low.astype(kind), kind(-np.inf))[:, None]) & (estimate > -np.inf))
        found = exact(of_query, columns, q + first, c)
        good = found >= bar[q]
        kept.append((q[good] + first, ids[c[good]], found[good]))
    query, of, score = (np.concatenate(z) for z in zip(*kept))
    best = best_of(query, of, score, k)
    return query[best], of[best], score[best]


def search(indexed: DataFrame, queries: DataFrame, k: int = 20) -> DataFrame:
    """The k nearest rows of every row of ``queries`` (rows of an index): ``query_id, rank, vec_id, score``.

    Vectors of another dimension and those with the query's own id are no candidates. Equal scores go by
    smaller id. With fewer candidates than k, all are returned; empty tables give no rows. Repeated ids
    are repeated rows of the result, once for each.
    """
    spark = indexed.sparkSession
    n, m = indexed.count(), queries.count()
    spread = 2 * spark.sparkContext.defaultParallelism
    blocks = max(1, math.ceil(n / BLOCK_VECTORS), min(spread, math.ceil(n / LEAST_BLOCK)))
    query_blocks = max(1, math.ceil(m / QUERY_BLOCK))

    def every(count: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(count - 1)))

    def own(count: int) -> Column:
        return F.pmod(F.xxhash64("vec_id"), F.lit(count)).cast("int")

    left = indexed.withColumn("block", own(blocks)).withColumn("query_block", every(query_blocks))
    right = queries.select("vec_id", "dim", "vector").withColumn("query_block", own(query_blocks)).withColumn("block", every(blocks))
    key = ["dim", "block", "query_block"]
    empty = pa.table({"query_id": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})

    def matrix(column: pa.ChunkedArray, kind: str) -> np.ndarray:
        data = b"".join(v.as_py() for v in column)
        return np.frombuffer(data, dtype=kind).reshape(len(column), -1)

    def run(a: pa.Table, b: pa.Table) -> pa.Table:
        if not a.num_rows or not b.num_rows:
            return empty
        query_ids = b["vec_id"].to_numpy()
        q, ids, scores = scan(
            a["vec_id"].to_numpy(), matrix(a["code"], "u1"), a["factor"].to_numpy(), a["off"].to_numpy(), matrix(a["vector"], "f8"),
            query_ids, matrix(b["vector"], "f8"), k,
        )
        return pa.table({"query_id": pa.array(query_ids[q], pa.int64()), "vec_id": pa.array(ids, pa.int64()), "score": pa.array(scores)})

    found = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(run, "query_id long, vec_id long, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
