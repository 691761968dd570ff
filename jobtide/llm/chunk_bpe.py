"""BPE encoding with content-defined chunks, and decoding.

A rolling hash over the last 32 bytes cuts texts where the content says so, hence copies and shared
passages are cut alike wherever they stand. Documents are first brought together by their smallest
chunk hash; a worker then reuses the ids of the chunks that it met last (:data:`CHUNKS_KEPT` at most) and
encodes all others anew.

A chunk encoded alone can be wrong at its ends only: up to its first unit start and from its last one
(see :mod:`jobtide.llm.bpe`). Between two chunks, the end of the one and the head of the other are
joined and encoded anew up to the next unit start, from where on the chunk's own ids are those of the
whole text. Where a chunk has no unit start, the repair goes on through the next.
"""

from __future__ import annotations

import hashlib
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jobtide.llm import bpe
from jobtide.llm.common import Bounded, present

WINDOW_DOUBLINGS = 5
#: A cut on average every 2 to this power bytes.
CUT_BITS = 8
#: Memos of a worker, which stays alive beside those of other stages.
CHUNKS_KEPT, UNITS_KEPT = 20_000, 300_000


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit mix in which every input bit moves every output bit (the finaliser of splitmix64)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


_BYTE_HASH = (mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)).astype(np.uint32)


def rolling(data: np.ndarray) -> np.ndarray:
    """At each byte a hash of it and the 31 before, by doubling the window five times."""
    h = _BYTE_HASH[data]
    for step in range(WINDOW_DOUBLINGS):
        width = 1 << step
        doubled = h.copy()
        doubled[width:] += h[:-width] << np.uint32(width)
        h = doubled
    return h


def chunks(data: bytes) -> list[bytes]:
    """The text's bytes cut after each window whose leading hash bits are 0, at character starts only."""
    if len(data) < 64:
        return [data]
    view = np.frombuffer(data, dtype=np.uint8)
    at = np.flatnonzero(rolling(view)[:-1] >> np.uint32(32 - CUT_BITS) == 0) + 1
    at = at[(view[at] & 0xC0) != 0x80].tolist()
    return [data[a:b] for a, b in zip([0, *at], [*at, len(data)])]


def byte_pairs(table: dict[int, bytes], merges: bpe.Merges):
    """A quicker encoder of the same vocabulary, where token ids follow the merge order; else none."""
    import tiktoken

    if any(a >= b for a, b in zip(merges.merged, merges.merged[1:])):
        return None
    made = {*merges.first, *merges.merged}
    known = {token: i for i, token in table.items() if i in made}
    return tiktoken.Encoding("units", pat_str=bpe.PIECES, mergeable_ranks=known, special_tokens={})


class ChunkCodec:
    """Encodes whole texts chunk by chunk, to the ids of the tokenizers library, and decodes ids."""

    def __init__(self, path: str):
        spec = bpe.read_tokenizer(path)
        self.library = bpe.Library(path)
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.split_added = re.compile("(" + "|".join(map(re.escape, self.added)) + ")") if self.added else None
        letters = {letter: byte for byte, letter in bpe.byte_letters().items()}
        table = {i: bytes(letters[c] for c in token) for token, i in spec["model"]["vocab"].items()}
        table |= {i: content.encode() for content, i in self.added.items()}
        self.table = [table.get(i, b"") for i in range(max(table) + 1)]
        self.fast = byte_pairs(table, bpe.Merges(spec)) if spec["model"]["type"] == "BPE" else None
        self.first = Bounded(self._ids, UNITS_KEPT // 10)
        self.later = Bounded(lambda unit: self._ids(" " + unit), UNITS_KEPT)
        self.chunk = Bounded(self._chunk, CHUNKS_KEPT)
        self.encoded = self.seen = 0

    def _ids(self, text: str) -> bytes:
        plain = self.fast is not None and bpe.KNOWN.match(text)
        return array("I", self.fast.encode_ordinary(text) if plain else self.library.ids(text)).tobytes()

    def _units(self, text: str) -> bytes:
        first, *rest = bpe.units(text)
        return self.first[first] + b"".join(map(self.later.__getitem__, rest))

    def _chunk(self, data: bytes) -> tuple[str, bytes, str | None]:
        """The chunk up to its first unit start, the ids up to its last, and the text from there on."""
        self.encoded += 1
        head, *rest = bpe.units(data.decode())
        if not rest:
            return head, b"", None
        return head, b"".join(map(self.later.__getitem__, rest[:-1])), " " + rest[-1]

    def _segment(self, text: str) -> bytes:
        out, pending = [], []
        for data in chunks(text.encode()):
            self.seen += 1
            head, ids, tail = self.chunk[data]
            pending.append(head)
            if tail is not None:
                out += (self._units("".join(pending)), ids)
                pending = [tail]
        out.append(self._units("".join(pending)))
        return b"".join(out)

    def encode(self, text: str) -> bytes:
        """All ids as little-endian unsigned 32-bit integers; the strings of added tokens are those tokens."""
        if not text:
            return b""
        parts = self.split_added.split(text) if self.split_added else [text]
        return b"".join(
            np.array([self.added[p]], dtype="<u4").tobytes() if i % 2 else self._segment(p)
            for i, p in enumerate(parts)
            if p
        )

    def decode(self, ids: bytes) -> str:
        return b"".join(map(self.table.__getitem__, np.frombuffer(ids, dtype="<u4").tolist())).decode("utf-8", "replace")


def _smallest(data: bytes) -> int:
    """The smallest chunk hash: equal for copies, and likely for texts that share most chunks."""
    return min(int.from_bytes(hashlib.blake2b(c, digest_size=8).digest(), "little", signed=True) for c in set(chunks(data)))


def together(docs: DataFrame, text_column: str) -> DataFrame:
    """The rows shuffled by smallest chunk hash. Partitions that grow too large, as by many copies, are split."""

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index(text_column)
            keys = [_smallest(t.as_buffer().to_pybytes()) for t in batch.column(at).cast(pa.binary())]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(keys, pa.int64())], [*batch.schema.names, "route"])

    routed = docs.mapInArrow(route, T.StructType([*docs.schema.fields, T.StructField("route", T.LongType())]))
    return routed.hint("rebalance", "route").drop("route")


def encode(
    docs: DataFrame,
    tokenizer: str,
    id_column: str = "doc_id",
    text_column: str = "text",
    decoded: bool = False,
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """Per row its id, ``ids`` (binary, little-endian unsigned 32-bit) and ``n_tokens``; on request ``decoded``.

    Columns named in ``carry`` come along; they may not be called as those above.

    ``chunks_seen`` and ``chunks_encoded`` count, at each row, the text's chunks and those encoded for
    it first in the worker. Null and empty texts have no ids. Repeated rows and null ids keep their
    rows; an empty table gives none; other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = bpe.loaded(ChunkCodec, tokenizer)
        for batch in batches:
            ids, texts, seen, fresh = [], [], [], []
            for t in batch.column(1):
                before = codec.seen, codec.encoded
                ids.append(codec.encode(t.as_py()))
                seen.append(codec.seen - before[0])
                fresh.append(codec.encoded - before[1])
                if decoded:
                    texts.append(codec.decode(ids[-1]))
            columns = [batch.column(0), pa.array(ids, pa.binary()), pa.array([len(i) // 4 for i in ids], pa.int64())]
            columns += [pa.array(seen, pa.int64()), pa.array(fresh, pa.int64())]
            names = ["id", "ids", "n_tokens", "chunks_seen", "chunks_encoded"]
            if decoded:
                columns, names = [*columns, pa.array(texts, pa.string())], [*names, "decoded"]
            yield pa.RecordBatch.from_arrays([*columns, *batch.columns[2:]], [*names, *batch.schema.names[2:]])

    rows = docs.select(F.col(id_column).alias("id"), present(text_column).alias("text"), *carry)
    made = T.StructType.fromDDL("ids binary, n_tokens long, chunks_seen long, chunks_encoded long" + ", decoded string" * decoded)
    schema = T.StructType([rows.schema["id"], *made.fields, *rows.schema.fields[2:]])
    return together(rows, "text").mapInArrow(run, schema).withColumnRenamed("id", id_column)


def decode(encoded: DataFrame, tokenizer: str, ids_column: str = "ids") -> DataFrame:
    """The rows with ``decoded``: the text of their ids, special tokens included."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = bpe.loaded(ChunkCodec, tokenizer)
        for batch in batches:
            at = batch.schema.get_field_index(ids_column)
            texts = [codec.decode(i.as_py() or b"") for i in batch.column(at)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], [*batch.schema.names, "decoded"])

    return encoded.mapInArrow(run, T.StructType([*encoded.schema.fields, T.StructField("decoded", T.StringType())]))
