"""Phrase collocations by dynamic itemset counting over cyclic scans of corpus shards.

The corpus is dealt into shards, which are scanned one after another, over and over. Words are counted
from the first scan on. A longer phrase becomes active after the scan that showed both of its
subphrases (all words but the last, all but the first) to reach the threshold, whichever shard comes next,
and is counted in that and the following scans until it has seen every shard once. So phrases of different
lengths are counted side by side, and a length needs no pass of its own.

The scan in which a phrase reached the threshold is kept in a table of fixed size by the phrase's hash. A
shared cell may activate a phrase early, never late; from its activation on it is counted in one full
cycle either way, so that counts are exact. A scan's rows carry the scan that activated them; they are
summed over tasks once, when that cycle is complete. Before, what a scan's tasks saw at least twice tells
which phrases have reached the threshold already. Phrases are told apart by 64-bit hashes of all words but
the last and of the last; the texts of the frequent ones follow from those of the frequent words.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from jobtide.llm import grams
from jobtide.llm.common import present, stored

#: Fixed: the characters that end a piece, all made one of them; tab is a space; A-Z lower-cased.
ENDS = b".,;:!?\n\x0b\x0c\r"
PLAIN = bytes.maketrans(bytes(range(65, 91)) + ENDS + b"\t", bytes(range(97, 123)) + b"." * len(ENDS) + b" ")
BLANK = grams.table(b" .")
#: Cells of the table of scans, a byte each, for every length; and the mark of a cell without a frequent phrase.
CELL_BITS, NEVER = 22, 255
#: Occurrences that a task gathers before it sums them up.
GATHERED = 1 << 20
ROW = "k int, began int, lang string, word string, head long, last long, n long"


def _cells(hashes: np.ndarray, cells: int) -> np.ndarray:
    return (hashes >> np.uint64(65 - cells.bit_length())).astype(np.int64)


class _Scan:
    """What one task of one scan has seen of each length since it last summed up."""

    def __init__(self, step: int, shards: int, longest: int, marks: bytes):
        self.step, self.shards, self.longest = step, shards, longest
        self.marks = np.frombuffer(marks, dtype=np.uint8).reshape(longest - 1, -1)
        self.held: dict[int, list] = {}
        self.size = 0

    def words(self, lang: str, data: bytes, starts: np.ndarray, ends: np.ndarray, w: np.ndarray) -> pa.RecordBatch:
        hashes, at, n = np.unique(w, return_index=True, return_counts=True)
        texts = [data[a:b] for a, b in zip(starts[at].tolist(), ends[at].tolist())]
        return self._rows(1, np.zeros(len(at)), np.zeros(len(at)), hashes, n, lang, texts)

    def add(self, lang: str, texts: list[bytes]) -> Iterator[pa.RecordBatch]:
        seed = np.uint64(xxhash.xxh3_64_intdigest(lang.encode()))
        for _, data, _ in grams.buffers(texts, b"."):
            starts, ends, w = grams.words(data, BLANK)
            if not len(w):
                continue
            w = grams.joined(np.full(len(w), seed), w)
            if self.step < self.shards:
                yield self.words(lang, data, starts, ends, w)
            piece = np.cumsum(np.frombuffer(data, dtype=np.uint8) == ord("."), dtype=np.int32)[starts]
            part = w
            for k in range(2, min(self.longest, len(w)) + 1):
                mark = self.marks[k - 2][_cells(part, self.marks.shape[1])]
                began = np.maximum(mark[:-1], mark[1:]).astype(np.int16) + 1
                active = (began <= self.step) & (self.step < began + self.shards) & (piece[: len(began)] == piece[k - 1 :])
                at = np.flatnonzero(active)
                self.held.setdefault(k, []).append((part[at], w[at + k - 1], began[at]))
                self.size += len(at)
                part = grams.joined(part[:-1], w[k - 1 :])
            if self.size >= GATHERED:
                yield from self.summed()

    def summed(self) -> Iterator[pa.RecordBatch]:
        for k, parts in self.held.items():
            head, last, began = (np.concatenate(columns) for columns in zip(*parts))
            _, at, n = np.unique(grams.joined(head, last), return_index=True, return_counts=True)
            yield self._rows(k, began[at], head[at], last[at], n)
        self.held, self.size = {}, 0

    @staticmethod
    def _rows(k, began, head, last, n, lang=None, words=None) -> pa.RecordBatch:
        count = len(n)
        texts = [pa.nulls(count, pa.string())] * 2 if lang is None else [pa.array([lang] * count, pa.string()), pa.array(words, pa.binary()).cast(pa.string())]
        numbers = [pa.array(np.asarray(x).astype(np.uint64).view(np.int64)) for x in (head, last, n)]
        columns = [pa.array(np.full(count, k, dtype=np.int32)), pa.array(np.asarray(began).astype(np.int32)), *texts, *numbers]
        return pa.RecordBatch.from_arrays(columns, ["k", "began", "lang", "word", "head", "last", "n"])


def _scan(docs: DataFrame, step: int, shards: int, longest: int, marks: np.ndarray) -> DataFrame:
    """Rows of one shard: words, and the phrases active in this scan, with their counts in a task."""
    held = docs.sparkSession.sparkContext.broadcast(marks.tobytes())  # of fixed size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scan = _Scan(step, shards, longest, held.value)
        for batch in batches:
            by_lang: dict[str, list[bytes]] = {}
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary())):
                by_lang.setdefault(lang, []).append(text.as_buffer().to_pybytes().translate(PLAIN))
            for lang, texts in by_lang.items():
                yield from scan.add(lang, texts)
        yield from scan.summed()

    return stored(docs.mapInArrow(run, ROW), "scan")


def hashed(rows: DataFrame) -> DataFrame:
    """The rows with ``phrase_hash``, by which longer phrases and the table of scans know the phrase."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            k, head, last = (batch.column(name).to_numpy() for name in ("k", "head", "last"))
            whole = np.where(k == 1, last.view(np.uint64), grams.joined(head.view(np.uint64), last.view(np.uint64)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(whole.view(np.int64))], [*batch.schema.names, "phrase_hash"])

    return rows.mapInArrow(run, ", ".join(f"{n} {t}" for n, t in rows.dtypes) + ", phrase_hash long")


def _mark(marks: np.ndarray, reached: DataFrame, step: int) -> None:
    """Note the scan in the cells of phrases; at most a row for each cell comes to the driver."""
    cell = F.shiftrightunsigned("phrase_hash", 65 - marks.shape[1].bit_length()).cast("int")
    found = reached.where(F.col("k") <= len(marks)).select("k", cell.alias("cell")).distinct().toArrow()
    for k, cells in zip(found["k"].chunks, found["cell"].chunks):
        at = (k.to_numpy() - 1, cells.to_numpy())
        marks[at] = np.minimum(marks[at], step)


def phrase_counts(docs: DataFrame, threshold: int, longest: int, shards: int) -> tuple[DataFrame, DataFrame]:
    """All words of (lang, text) rows, and the frequent phrases as hashes, with their counts."""
    dealt = docs.withColumn("shard", F.pmod(F.monotonically_increasing_id(), F.lit(shards)).cast("int"))
    corpus = stored(dealt, "shards", "shard")
    marks = np.full((longest - 1, 1 << CELL_BITS), NEVER, dtype=np.uint8)
    scans: list[DataFrame] = []
    frequent: list[DataFrame] = []
    words = None

    def rows(first: int, last: int) -> DataFrame:
        return reduce(DataFrame.unionByName, scans[first : last + 1])

    def latest() -> int:
        known = marks[marks != NEVER]
        return int(known.max()) if len(known) else -1

    step = 0
    while step <= shards or step <= latest() + shards:
        scans.append(_scan(corpus.where(F.col("shard") == step % shards).select("lang", "text"), step, shards, longest, marks))
        done = step - shards + 1  # phrases that became active for this scan have been counted in every shard
        if done == 0:
            summed = rows(0, step).where("k = 1").groupBy("k", "lang", "word", "head", "last").agg(F.sum("n").alias("n"))
            words = stored(summed, "words")
            _mark(marks, hashed(words.where(F.col("n") >= threshold).select("k", "head", "last")), step)
        elif done > 0:
            summed = rows(done, step).where((F.col("k") > 1) & (F.col("began") == done)).groupBy("k", "head", "last").agg(F.sum("n").alias("n"))
            frequent.append(stored(hashed(summed.where(F.col("n") >= threshold)), "frequent"))
            _mark(marks, frequent[-1], step)
        if done < step:  # others are not complete yet, but may have reached the threshold
            active = (F.col("began") > max(done, 0)) | (F.col("k") == 1) & F.lit(done < 0)
            seen = rows(max(done + 1, 0), step).where((F.col("k") < longest) & (F.col("n") > 1) & active)
            so_far = seen.groupBy("k", "head", "last").agg(F.sum("n").alias("n")).where(F.col("n") >= threshold)
            _mark(marks, hashed(so_far.select("k", "head", "last")), step)
        step += 1
    return words, reduce(DataFrame.unionByName, frequent)


def spelled(words: DataFrame, phrases: DataFrame, threshold: int, longest: int) -> DataFrame:
    """``lang``, ``k``, ``phrase`` and ``f`` of the frequent words and phrases."""
    words = words.where(F.col("n") >= threshold).select("lang", "word", F.col("last").alias("hash"), "n")
    levels = [words.select("lang", F.lit(1).alias("k"), F.col("word").alias("phrase"), F.col("n").alias("f"), "hash")]
    lasts = words.select("word", F.col("hash").alias("last"))
    for k in range(2, longest + 1):
        heads = levels[-1].select("lang", F.col("phrase").alias("start"), F.col("hash").alias("head"))
        made = phrases.where(F.col("k") == k).join(heads, "head").join(lasts, "last")
        made = made.select("lang", "k", F.concat_ws(" ", "start", "word").alias("phrase"), F.col("n").alias("f"), F.col("phrase_hash").alias("hash"))
        levels.append(stored(made, "spelled"))
    return reduce(DataFrame.unionByName, levels).drop("hash")


def _exact(number: str | Column) -> Column:
    return (F.col(number) if isinstance(number, str) else number).cast("decimal(20,0)")


def scored(phrases: DataFrame) -> DataFrame:
    """Each phrase of two words or more with the lowest score of its cuts, and the counts of the parts."""
    whole = phrases.where("k > 1").withColumn("cut", F.explode(F.expr("sequence(1, k - 1)")))
    whole = whole.withColumns(
        {"first": F.expr("substring_index(phrase, ' ', cut)"), "rest": F.expr("substring_index(phrase, ' ', cut - k)")}
    )
    for side, count in (("first", "l"), ("rest", "r")):
        whole = whole.join(phrases.select("lang", F.col("phrase").alias(side), F.col("f").alias(count)), ["lang", side])
    sums = whole.withColumn("score", F.expr("(cast(2000000 as decimal(7,0)) * cast(f as decimal(20,0))) div (cast(l as decimal(20,0)) + cast(r as decimal(20,0)))"))
    lowest = F.min(F.struct("score", "cut", "l", "r")).alias("cut")
    return sums.groupBy("lang", "k", "phrase", "f").agg(lowest).select("lang", "k", "phrase", "f", "cut.l", "cut.r", "cut.score")


def uncovered(candidates: DataFrame) -> DataFrame:
    """Candidates without a longer one around them that is found in at least 80 of 100 of their places."""
    inner = candidates.where("k > 2").select("lang", "f", "k", F.split("phrase", " ").alias("w"))
    inner = inner.withColumn("size", F.explode(F.expr("sequence(2, k - 1)"))).withColumn("at", F.explode(F.expr("sequence(1, k - size + 1)")))
    most = inner.select("lang", F.expr("array_join(slice(w, at, size), ' ')").alias("phrase"), "f").groupBy("lang", "phrase").agg(F.max("f").alias("around"))
    covered = F.coalesce(_exact("around") * 100 >= _exact("f") * 80, F.lit(False))
    return candidates.join(most, ["lang", "phrase"], "left").where(~covered).drop("around")


def collocations(
    docs: DataFrame,
    threshold: int = 30,
    longest: int = 4,
    top: int = 2000,
    shards: int = 3,
    lang_column: str = "lang",
    text_column: str = "text",
) -> DataFrame:
    """The best phrases of each language: ``lang``, ``rank``, ``phrase``, ``a``, ``l``, ``r``, ``n``, ``score``.

    Phrases of two to ``longest`` words that occur ``threshold`` times (1 or more) or more. A null language is ``und``;
    null and empty texts have no words. Repeated rows count each time. Equal scores and counts are ranked
    by the phrase's bytes. An empty table, or one without frequent phrases, gives no rows; other columns are not read.
    """
    docs = docs.select(F.coalesce(F.col(lang_column), F.lit("und")).alias("lang"), present(text_column).alias("text"))
    words, phrases = phrase_counts(docs, threshold, longest, shards)
    totals = words.groupBy("lang").agg(F.sum("n").alias("n"))
    candidates = stored(scored(spelled(words, phrases, threshold, longest)), "candidates")
    best = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("f").desc(), "phrase")
    ranked = uncovered(candidates).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", F.col("f").alias("a"), "l", "r", "n", F.col("score").cast("long").alias("score")
    )
