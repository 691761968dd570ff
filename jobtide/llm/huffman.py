"""Token ids in binary files: canonical length-limited Huffman codes from counts over the whole corpus.

One table row is a block of whole documents in ascending id order: their ids and token counts, the
packed codes, and the bit offset of every 256th token. A block is decoded by itself; all its stretches
between checkpoints are decoded side by side, one table lookup per token, so that decoding needs no
bit-by-bit loop. The code lengths, one per vocabulary id, are stored beside the blocks and suffice to
rebuild the code.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from jobtide.llm import bpe
from jobtide.llm.common import Bounded, new_path, present

MAX_BITS = 18
STEP = 256
BLOCK_TOKENS = 1 << 18


def code_lengths(counts: np.ndarray, most: int = MAX_BITS) -> np.ndarray:
    """Optimal code lengths of at most ``most`` bits (package-merge); 0 for symbols that never occur."""
    used = np.flatnonzero(counts)
    lengths = np.zeros(len(counts), dtype=np.uint8)
    if len(used) == 0:
        return lengths
    if len(used) == 1:
        lengths[used] = 1
        return lengths
    if len(used) > 1 << most:
        raise ValueError(f"{len(used)} symbols need codes of more than {most} bits")
    order = used[np.argsort(counts[used], kind="stable")]
    weight = counts[order].astype(np.int64)
    n = len(order)
    # Each level merges the coins (one per symbol) with pairs of the level below. Of a level it is enough
    # to know which places are coins: a prefix of a level always holds a prefix of the sorted coins.
    pairs, coins_at = np.zeros(0, dtype=np.int64), []
    for _ in range(most):
        both = np.concatenate([weight, pairs])
        at = np.argsort(both, kind="stable")
        coins_at.append(at < n)
        both = both[at]
        even = len(both) // 2 * 2
        pairs = both[:even:2] + both[1:even:2]
    take = 2 * n - 2
    for is_coin in reversed(coins_at):
        coins = int(np.count_nonzero(is_coin[:take]))
        lengths[order[:coins]] += 1
        take = 2 * (take - coins)
    return lengths


def canonical(lengths: np.ndarray) -> np.ndarray:
    """The codes: by length, then by symbol, counting up."""
    codes = np.zeros(len(lengths), dtype=np.uint64)
    order = np.lexsort((np.arange(len(lengths)), lengths))
    order = order[lengths[order] > 0]
    size = lengths[order].astype(np.uint64)
    step = np.uint64(1) << (np.uint64(MAX_BITS) - size)
    left_aligned = np.concatenate([np.zeros(1, np.uint64), np.cumsum(step)[:-1]]) if len(order) else step
    codes[order] = left_aligned >> (np.uint64(MAX_BITS) - size)
    return codes


def pack(ids: np.ndarray, lengths: np.ndarray, codes: np.ndarray) -> tuple[bytes, np.ndarray]:
    """The codes one after another, highest bit first, and the bit offset of every 256th id."""
    size = lengths[ids].astype(np.int64)
    ends = np.cumsum(size)
    starts = ends - size
    word, shift = starts >> 5, (64 - (starts & 31) - size).astype(np.uint64)
    value = codes[ids] << shift
    out = np.zeros((int(ends[-1]) >> 5) + 3, dtype=np.uint32)
    first = np.flatnonzero(np.diff(word, prepend=-1))  # codes are shorter than a word, so none is skipped
    high = np.bitwise_or.reduceat((value >> np.uint64(32)).astype(np.uint32), first)
    low = np.bitwise_or.reduceat(value.astype(np.uint32), first)
    at = word[first]
    out[at] |= high
    out[at + 1] |= low
    return out.astype(">u4").tobytes(), starts[::STEP]


class Table:
    """Decodes by one lookup of the next 18 bits per token."""

    def __init__(self, lengths: np.ndarray):
        order = np.lexsort((np.arange(len(lengths)), lengths))
        order = order[lengths[order] > 0]
        span = 1 << (MAX_BITS - lengths[order].astype(np.int64))
        self.symbol = np.zeros(1 << MAX_BITS, dtype=np.uint32)
        self.size = np.ones(1 << MAX_BITS, dtype=np.uint8)
        end = int(span.sum())
        self.symbol[:end] = np.repeat(order, span)
        self.size[:end] = np.repeat(lengths[order], span)

    def unpack(self, packed: bytes, checkpoints: np.ndarray, tokens: int) -> np.ndarray:
        words = np.frombuffer(packed, dtype=">u4").astype(np.uint64)
        at = checkpoints.astype(np.int64).copy()
        out = np.zeros((len(at), STEP), dtype=np.uint32)
        last = len(words) - 2
        for step in range(min(STEP, tokens)):
            word = np.minimum(at >> 5, last)  # the stretch at the end may be shorter than the others
            both = words[word] << np.uint64(32) | words[word + 1]
            peek = (both >> (64 - MAX_BITS - (at & 31)).astype(np.uint64)) & np.uint64((1 << MAX_BITS) - 1)
            out[:, step] = self.symbol[peek]
            at += self.size[peek]
        return out.reshape(-1)[:tokens]


class WordEncoder:
    """Ids of whole texts with a vocabulary that drops white space, blank by blank, memoised.

    Blanks never join with what stands beside them, so that the stretches between them are independent.
    """

    def __init__(self, path: str):
        spec = bpe.read_tokenizer(path)
        self.library = bpe.Library(path)
        self.size = self.library.tokenizer.get_vocab_size()
        self.added = [t["content"] for t in spec["added_tokens"]]
        self.words = regex.compile(WORDS)
        self.fast = _word_ends(spec) if _as_expected(spec) else None
        self.unit = Bounded(self._ids, bpe.UNITS_KEPT)

    def _ids(self, unit: str) -> bytes:
        if self.fast is None or not bpe.KNOWN.match(unit) or any(a in unit for a in self.added):
            return array("I", self.library.ids(unit)).tobytes()
        ids: list[int] = []
        for word in self.words.findall(unit.lower()):
            ids += self.fast._encode_single_piece(word.encode() + WORD_END)
        return array("I", ids).tobytes()

    def encode(self, text: str) -> bytes:
        return b"".join(map(self.unit.__getitem__, text.replace("\n", " ").split(" ")))


#: Fixed: the words of the lower-cased vocabulary, as its file has them.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: Stands for the mark of a word's end; no UTF-8 text holds this byte.
WORD_END = b"\xff"


def _as_expected(spec: dict) -> bool:
    splitter = spec["pre_tokenizer"]["pretokenizers"][0] if spec["pre_tokenizer"]["type"] == "Sequence" else {}
    return splitter.get("pattern") == {"Regex": WORDS} and spec["model"].get("end_of_word_suffix") == "</w>"


def _word_ends(spec: dict):
    """A quicker encoder of the same vocabulary: ids are merge ranks, and a word's end is merged first of all."""
    import tiktoken

    letters = {letter: byte for byte, letter in bpe.byte_letters().items()}
    vocab, ranks = spec["model"]["vocab"], {}
    for token, i in vocab.items():
        ends = token.endswith("</w>") and len(token) > 4
        ranks[bytes(letters[c] for c in (token[:-4] if ends else token)) + WORD_END * ends] = i
    made = [vocab["".join(m if isinstance(m, list) else m.split(" "))] for m in spec["model"]["merges"]]
    singles = [i for token, i in ranks.items() if len(token) == 1 or len(token) == 2 and token.endswith(WORD_END)]
    if made != sorted(made) or max(singles) > min(made):
        return None
    return tiktoken.Encoding("words", pat_str=WORDS, mergeable_ranks=ranks, special_tokens={})


def tokenize(docs: DataFrame, tokenizer: str, end_id: int, id_column: str, text_column: str) -> DataFrame:
    """``doc_id`` and ``ids``: unsigned 16-bit integers where the vocabulary allows, with the end id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = bpe.loaded(WordEncoder, tokenizer)
        end = array("I", [end_id]).tobytes()
        for batch in batches:
            ids = [np.frombuffer(encoder.encode(t.as_py()) + end, "<u4").astype("<u2").tobytes() for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.binary())], ["doc_id", "ids"])

    rows = docs.select(F.col(id_column).alias("doc_id"), present(text_column).alias("text"))
    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, ids binary")


def id_counts(tokens: DataFrame) -> DataFrame:
    """How often each id occurs: summed in each task first, so at most a row per id and task is shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << 16, dtype=np.int64)
        for batch in batches:
            data = b"".join(i.as_py() for i in batch.column(0))
            total += np.bincount(np.frombuffer(data, "<u2"), minlength=1 << 16)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(total[used], pa.int64())], ["id", "n"])

    return tokens.select("ids").mapInArrow(run, "id int, n long").groupBy("id").agg(F.sum("n").alias("n"))


BLOCK = (
    "part int, block long, doc_ids array<{kind}>, n_tokens array<long>, packed binary, checkpoints binary, tokens long"
)


def write(
    docs: DataFrame, path: str, tokenizer: str, end_id: int = 2, id_column: str = "doc_id", text_column: str = "text"
) -> None:
    """Encode every text, append the end id, and write blocks and code lengths under ``path``.

    Null and empty texts are the end id alone. Rows with equal ids stay apart, ordered by their tokens;
    null ids come first. An empty table gives an empty file set. Other columns are not read.
    Only the code lengths, one per vocabulary id, and one total per part pass the driver.
    """
    spark = docs.sparkSession
    if bpe.loaded(WordEncoder, tokenizer).size > 1 << 16:
        raise ValueError("ids of more than 16 bits are not supported")
    tokenize(docs, tokenizer, end_id, id_column, text_column).write.option("compression", "zstd").parquet(f"{path}/tokens")
    tokens = spark.read.parquet(f"{path}/tokens")
    counts = np.zeros(1 << 16, dtype=np.int64)
    for row in id_counts(tokens).toLocalIterator():  # at most one row per vocabulary id
        counts[row["id"]] = row["n"]
    lengths = code_lengths(counts)
    spark.createDataFrame([(bytearray(lengths.tobytes()),)], "lengths binary").coalesce(1).write.parquet(f"{path}/code")

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, held, size, number = canonical(lengths), [], 0, 0

        def block():
            ids = np.concatenate([x for _, x, _ in held])
            packed, checkpoints = pack(ids, lengths, codes)
            row = {
                "part": held[0][2], "block": number, "doc_ids": [d for d, _, _ in held], "n_tokens": [len(x) for _, x, _ in held],
                "packed": packed, "checkpoints": checkpoints.astype("<i8").tobytes(), "tokens": len(ids),
            }
            return pa.RecordBatch.from_pylist([row], schema=arrow)

        arrow = None
        for batch in batches:
            if arrow is None:
                kind = batch.schema.field(0).type
                arrow = pa.schema([
                    ("part", pa.int32()), ("block", pa.int64()), ("doc_ids", pa.list_(kind)), ("n_tokens", pa.list_(pa.int64())),
                    ("packed", pa.binary()), ("checkpoints", pa.binary()), ("tokens", pa.int64()),
                ])
            for doc_id, ids, part in zip(*(c.to_pylist() for c in batch.columns)):
                held.append((doc_id, np.frombuffer(ids, "<u2"), part))
                size += len(held[-1][1])
                if size >= BLOCK_TOKENS:
                    yield block()
                    held, size, number = [], 0, number + 1
        if held:
            yield block()

    parts = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    ordered = tokens.withColumn("tie", F.xxhash64("ids")).repartitionByRange(parts, "doc_id", "tie")
    ordered = ordered.sortWithinPartitions("doc_id", "tie", "ids").select("doc_id", "ids", F.spark_partition_id().alias("part"))
    kind = tokens.schema["doc_id"].dataType.simpleString()
    ordered.mapInArrow(blocks, BLOCK.format(kind=kind)).write.parquet(f"{path}/blocks")


def read(spark: SparkSession, path: str) -> DataFrame:
    """Every document of the files: ``doc_id``, ``start`` (tokens before it), ``n_tokens``, ``ids`` (unsigned 32-bit)."""
    first = spark.read.parquet(f"{path}/code").first()
    lengths = np.frombuffer(bytes(first[0]), dtype=np.uint8)
    blocks = spark.read.parquet(f"{path}/blocks")

    # One row per block, without its codes: the tokens before it, first by part and then inside the part.
    sizes = blocks.select("part", "block", "tokens")
    of_part = sizes.groupBy("part").agg(F.sum("tokens").alias("tokens"))
    before = of_part.select("part", (F.sum("tokens").over(Window.orderBy("part")) - F.col("tokens")).alias("base"))
    inside = F.sum("tokens").over(Window.partitionBy("part").orderBy("block")) - F.col("tokens")
    starts = sizes.withColumn("inside", inside).join(before, "part")
    starts = starts.select("part", "block", (F.col("base") + F.col("inside")).alias("base"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = Table(lengths)
        for batch in batches:
            for i in range(batch.num_rows):
                base, doc_ids, n_tokens, packed, checkpoints, tokens = (c[i] for c in batch.columns)
                ids = table.unpack(packed.as_py(), np.frombuffer(checkpoints.as_py(), "<i8"), tokens.as_py())
                sizes = np.array(n_tokens.as_py(), dtype=np.int64)
                ends = np.cumsum(sizes)
                data = ids.astype("<u4").tobytes()
                each = [data[4 * (e - n) : 4 * e] for e, n in zip(ends.tolist(), sizes.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [doc_ids.values, pa.array(base.as_py() + ends - sizes), pa.array(sizes), pa.array(each, pa.binary())],
                    ["doc_id", "start", "n_tokens", "ids"],
                )

    kind = blocks.schema["doc_ids"].dataType.elementType.simpleString()
    columns = ["base", "doc_ids", "n_tokens", "packed", "checkpoints", "tokens"]
    placed = blocks.join(starts, ["part", "block"]).select(columns)
    return placed.mapInArrow(run, f"doc_id {kind}, start long, n_tokens long, ids binary")


def digests(read_back: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of documents read back."""
    return read_back.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def round_trip(docs: DataFrame, tokenizer: str, end_id: int = 2) -> DataFrame:
    path = new_path(docs.sparkSession, "ids")
    write(docs, path, tokenizer, end_id)
    return digests(read(docs.sparkSession, path))
