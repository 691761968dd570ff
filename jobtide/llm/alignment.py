"""Cross-tokenizer alignment: groups that two tokenizers cut together, and how often their ids are linked.

Texts up to :data:`LONG` characters are aligned in one task, unit by unit: neither tokenizer joins what
stands on both sides of a space between a character that is no space and one that is no white space. Longer
ones are cut into byte ranges, spread over tasks; each gives a fragment (:mod:`jobtide.llm.fragments`), and
fragments are composed in a tree, a few neighbours in each group of each level.

How many documents hold a pair is counted without a row for each document and pair: a task gathers
documents in blocks with the distinct pairs of each, cut into parts by the pair's hash; a part of all blocks
is summed in one task, and the sums go back to the blocks. The number of parts follows the size of the
corpus. The highest count of an id is one number for each id of the vocabulary, which every task gets.
"""

from __future__ import annotations

import hashlib
import re
from array import array
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobtide.llm import bpe
from jobtide.llm.chunk_bpe import byte_pairs, mixed
from jobtide.llm.common import by_group, present, stored
from jobtide.llm.fragments import Fragment, fragment

#: Characters of a text that one task aligns as a whole; the ranges of longer texts have as many.
LONG = 1 << 15
#: Fragments composed in one step of the tree.
FAN = 8
#: Distinct (document, pair) entries of a block, and bytes of text for each part of the pairs.
BLOCK, PART_BYTES = 1 << 20, 1 << 24
UNITS_KEPT = 120_000
#: How far from the edge of a range the end of a unit is looked for, before the edge is moved.
REACH = 1024
#: Where a text can be cut for both tokenizers: their pieces hold spaces in front only.
CUT = re.compile(r"(?<=[^ ]) (?=\S)")
#: Fixed: the character that stands for a space in pieces.
SPACE = "▁"


class Aligner:
    """Aligns units; each unit lacks its leading space."""

    def __init__(self, paths: tuple[str, str]):
        import sentencepiece

        spec = bpe.read_tokenizer(paths[0])
        self.library = bpe.Library(paths[0])
        self.library.tokenizer.encode_special_tokens = True
        letters = {letter: byte for byte, letter in bpe.byte_letters().items()}
        known = {i: bytes(map(letters.__getitem__, token)) for token, i in spec["model"]["vocab"].items() if all(c in letters for c in token)}
        self.fast = byte_pairs(known, bpe.Merges(spec))
        a_bytes = [known.get(i, b"") for i in range(max(known) + 1)]
        self.pieces = sentencepiece.SentencePieceProcessor(model_file=paths[1])
        b_bytes = [
            bytes([int(piece[3:5], 16)]) if self.pieces.is_byte(i) else piece.replace(SPACE, " ").encode()
            for i, piece in enumerate(map(self.pieces.id_to_piece, range(self.pieces.get_piece_size())))
        ]
        self.bytes = a_bytes, b_bytes
        self.sizes = [len(x) for x in a_bytes], [len(x) for x in b_bytes]
        self.names = [str(i) for i in range(len(a_bytes))], [str(i) for i in range(len(b_bytes))]
        self.memo: dict[str, tuple[int, int, int, bytes, bytes] | None] = {}
        self.older = self.memo

    def tokens(self, units: list[str]) -> Iterator[tuple[list[int], list[int]] | None]:
        """Ids of both for each unit; none if either does not give the unit back."""
        a_of, b_of = (part.__getitem__ for part in self.bytes)
        for unit, b in zip(units, self.pieces.encode(units, num_threads=1)):
            text = " " + unit
            a = self.fast.encode_ordinary(text) if self.fast is not None and bpe.KNOWN.match(text) else self.library.ids(text)
            data = text.encode()
            yield (a, b) if b"".join(map(b_of, b)) == data and b"".join(map(a_of, a)) == data else None

    def ends(self, ids: list[int], side: int) -> Iterator[int]:
        return accumulate(map(self.sizes[side].__getitem__, ids))

    def _aligned(self, a: list[int], b: list[int]) -> tuple[int, int, int, bytes, bytes]:
        of_a, of_b = self.sizes
        name_a, name_b = self.names
        groups, pairs, n_groups = [], [], 0
        rest = iter(b)
        lead, left, right = 0, [], []  # how far A is ahead of B, and the tokens of the open group
        for x in a:
            left.append(x)
            lead += of_a[x]
            while lead > 0:
                y = next(rest)
                right.append(y)
                lead -= of_b[y]
            if not lead:
                groups.append(f"{name_a[left[0]] if len(left) == 1 else ','.join([name_a[i] for i in left])}|{name_b[right[0]] if len(right) == 1 else ','.join([name_b[i] for i in right])}")
                pairs += [i << 32 | j for i in left for j in right]
                n_groups += 1
                left, right = [], []
        return len(a), len(b), n_groups, ";".join(groups).encode(), array("Q", pairs).tobytes()

    def units(self, units: list[str]) -> list[tuple[int, int, int, bytes, bytes] | None]:
        """Of each unit: tokens of both, groups and their text, pairs with repeats; none if it is not given back."""
        memo, older, missing = self.memo, self.older, []
        for unit in set(units):
            if unit not in memo:
                if unit in older:
                    memo[unit] = older[unit]
                else:
                    missing.append(unit)
        for unit, found in zip(missing, self.tokens(missing) if missing else ()):
            memo[unit] = found and self._aligned(*found)
        rows = list(map(memo.__getitem__, units))
        if len(memo) > UNITS_KEPT:  # what is met again moves on; the rest goes with the generation after this
            self.memo, self.older = {}, memo
        return rows

    def text(self, text: str) -> tuple[int, int, int, bytes, np.ndarray] | None:
        """Of a whole text: the same, summed up."""
        if not text:
            return None
        units = CUT.split(f" {text}")
        units[0] = units[0][1:]
        return _joined(self.units(units))

    def range(self, text: str, skip: int, keep: int) -> tuple[Fragment, int, int] | None:
        """The fragment of a range of a text, and its tokens: those that end after ``skip`` bytes and up to ``keep``.

        Only the units that the range cuts are looked at token by token.
        """
        first, *rest = CUT.split(text)
        units, ends = [first[1:], *rest], [0]
        for unit in units:
            ends.append(ends[-1] + 1 + len(unit.encode()))
        inside = [n for n in range(len(units)) if skip <= ends[n] and ends[n + 1] <= keep]
        out, n_a, n_b = Fragment(), 0, 0
        for n in [*range(inside[0] if inside else len(units)), -1, *range(inside[-1] + 1 if inside else len(units), len(units))]:
            if n >= 0:
                part = self._part(units[n], skip - ends[n], keep - ends[n])
                if part is None:
                    return None
                n_a, n_b = n_a + part[1], n_b + part[2]
                out = out + part[0]
            elif inside:
                row = _joined(self.units([units[k] for k in inside]))
                if row is None:
                    return None
                n_a, n_b = n_a + row[0], n_b + row[1]
                pairs, counts = np.unique(row[4], return_counts=True)
                out = out + Fragment(closed=True, groups=[row[3]], n_groups=row[2], pairs=pairs, counts=counts)
        return out, n_a, n_b

    def _part(self, unit: str, skip: int, keep: int) -> tuple[Fragment, int, int] | None:
        """Of a unit, the tokens that end in a range of its bytes."""
        found = next(self.tokens([unit]))
        if found is None:
            return None
        held = []
        for side in (0, 1):
            chosen = [(i, end) for i, end in zip(found[side], self.ends(found[side], side)) if skip < end <= keep]
            held += [[i for i, _ in chosen], [end for _, end in chosen]]
        return fragment(*held), len(held[0]), len(held[2])


def _joined(rows: list[tuple[int, int, int, bytes, bytes] | None]) -> tuple[int, int, int, bytes, np.ndarray] | None:
    if None in rows:
        return None
    n_a, n_b, n_groups, groups, pairs = zip(*rows)
    return sum(n_a), sum(n_b), sum(n_groups), b";".join(groups), np.frombuffer(b"".join(pairs), dtype=np.uint64)


def ranges(text: str, size: int) -> Iterator[tuple[str, int, int]]:
    """A text (with its leading space) in ranges: for each the units it touches, and where it begins and ends in them.

    An edge in a unit that goes on for long on either side is moved to the unit's end.
    """
    edges, at = [(0, 0, 0)], size
    while at < len(text):
        before = [m.start() for m in CUT.finditer(text, max(at - REACH, 0), at + 1)]
        after = CUT.search(text, at)
        if after is None:
            break
        if before and before[-1] > edges[-1][0] and after.start() - at <= REACH:
            edges.append((at, before[-1], after.start()))
        else:
            edges.append((after.start(),) * 3)
        at = edges[-1][0] + size
    edges.append((len(text),) * 3)
    for (start, low, _), (end, _, high) in zip(edges, edges[1:]):
        skip = len(text[low:start].encode())
        yield text[low:high], skip, skip + len(text[start:end].encode())


FRAGMENT = (
    "row long, part int, doc_id long, ok boolean, closed boolean, prefix_a array<int>, prefix_b array<int>, groups binary, "
    "n_groups long, pairs binary, counts binary, suffix_a array<int>, suffix_b array<int>, n_a long, n_b long"
)
_TYPES = {"boolean": pa.bool_(), "long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "array<int>": pa.list_(pa.int32())}
_KINDS = {name: _TYPES[kind] for name, kind in (column.strip().split(" ") for column in FRAGMENT.split(","))}


def _packed(row: int, part: int, doc_id: int | None, found: Fragment | None, n_a: int, n_b: int) -> dict:
    f = found or Fragment()
    return {
        "row": row, "part": part, "doc_id": doc_id, "ok": found is not None, "closed": f.closed, "prefix_a": f.prefix[0], "prefix_b": f.prefix[1],
        "groups": b";".join(f.groups), "n_groups": f.n_groups, "pairs": f.pairs.tobytes(), "counts": f.counts.tobytes(),
        "suffix_a": f.suffix[0], "suffix_b": f.suffix[1], "n_a": n_a, "n_b": n_b,
    }


def _unpacked(r: dict) -> Fragment:
    pairs, counts = np.frombuffer(r["pairs"], dtype=np.uint64), np.frombuffer(r["counts"], dtype=np.int64)
    groups = [r["groups"]] if r["n_groups"] else []
    return Fragment((r["prefix_a"], r["prefix_b"]), r["closed"], groups, r["n_groups"], pairs, counts, (r["suffix_a"], r["suffix_b"]))


def _table(rows: list[dict]) -> pa.Table:
    return pa.Table.from_pydict({name: pa.array([r[name] for r in rows], kind) for name, kind in _KINDS.items()})


def long_fragments(docs: DataFrame, paths: tuple[str, str], size: int) -> DataFrame:
    """One composed fragment for each text of more than ``size`` characters."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc_id, text, row in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist()):
                for part, (piece, skip, keep) in enumerate(ranges(f" {text.as_py()}", size)):
                    columns = [[row], [part], [doc_id], [piece], [skip], [keep]]
                    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["row", "part", "doc_id", "piece", "skip", "keep"])

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = bpe.loaded(Aligner, paths)
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                found = aligner.range(r["piece"], r["skip"], r["keep"])
                rows.append(_packed(r["row"], r["part"], r["doc_id"], *(found or (None, 0, 0))))
            yield from _table(rows).combine_chunks().to_batches()

    def compose(table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda r: r["part"])
        total = Fragment()
        for r in rows:
            total = total + _unpacked(r)
        if not all(r["ok"] for r in rows):
            total = None
        return _table([_packed(rows[0]["row"], rows[0]["part"], rows[0]["doc_id"], total, sum(r["n_a"] for r in rows), sum(r["n_b"] for r in rows))])

    cuts = docs.where(F.char_length("text") > size).withColumn("row", F.monotonically_increasing_id())
    pieces = stored(cuts.mapInArrow(cut, "row long, part int, doc_id long, piece string, skip long, keep long"), "ranges")
    parts = stored(pieces.repartition("row", "part").mapInArrow(align, FRAGMENT), "fragments")
    left = (parts.agg(F.max("part")).first()[0] or 0) + 1
    while left > 1:
        grouped = parts.withColumn("level", F.floor(F.col("part") / FAN).cast("int"))
        composed = by_group(grouped, ["row", "level"], lambda t: compose(t.drop_columns(["level"])), FRAGMENT)
        parts = stored(composed.withColumn("part", F.floor(F.col("part") / FAN).cast("int")), "fragments")
        left = -(-left // FAN)
    return parts


BLOCKS = "block long, part int, pairs binary, docs binary, payload binary, head binary"
_ZIP = zstandard.ZstdCompressor(level=1)
_UNZIP = zstandard.ZstdDecompressor()


def _zip(numbers: np.ndarray, kind: str) -> bytes:
    return _ZIP.compress(np.ascontiguousarray(numbers, dtype=kind).view(np.uint8).reshape(-1, np.dtype(kind).itemsize).T.tobytes())


def _unzip(data: bytes, kind: str) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(_UNZIP.decompress(data), dtype=np.uint8).reshape(size, -1).T).reshape(-1).view(kind)


class _Blocks:
    """Documents gathered until their distinct pairs are many; each block is a payload and its parts of pairs."""

    def __init__(self, first: int, parts: int):
        self.block, self.parts = first, parts
        self.docs: list[tuple] = []
        self.entries = 0

    def add(self, doc_id, n_a=0, n_b=0, n_groups=0, groups=b"", pairs=None, counts=None) -> Iterator[pa.RecordBatch]:
        pairs = np.zeros(0, dtype=np.uint64) if pairs is None else pairs
        counts = np.zeros(0, dtype=np.int64) if counts is None else counts
        self.docs.append((doc_id, n_a, n_b, n_groups, int(counts.sum()), hashlib.sha256(groups).hexdigest() if n_groups else "", pairs, counts))
        self.entries += len(pairs)
        if self.entries >= BLOCK or len(self.docs) >= BLOCK // 16:
            yield from self.done()

    def done(self) -> Iterator[pa.RecordBatch]:
        if not self.docs:
            return
        *facts, pairs, counts = zip(*self.docs)
        distinct, at, held = np.unique(np.concatenate(pairs), return_inverse=True, return_counts=True)
        part = (mixed(distinct + np.uint64(1)) % np.uint64(self.parts)).astype(np.int64)
        order = np.argsort(part, kind="stable")  # by part, and in it by pair
        place = np.empty(len(order), dtype=np.int64)
        place[order] = np.arange(len(order))
        sizes = np.array([len(p) for p in pairs])
        head = pa.RecordBatch.from_arrays(
            [pa.array(facts[0], pa.int64()), *(pa.array(c, pa.int64()) for c in facts[1:5]), pa.array(facts[5], pa.string()), pa.array(sizes, pa.int64())],
            ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "size"],
        )
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, head.schema) as writer:
            writer.write_batch(head)
        packed = [_zip(place[at], "<u4"), _zip(np.concatenate(counts), "<u4"), _zip(distinct[order] >> np.uint64(32), "<u4")]
        payload = b"".join(len(p).to_bytes(4, "little") + p for p in packed)
        rows = [(self.block, -1, None, None, payload, sink.getvalue().to_pybytes())]
        distinct, held, part = distinct[order], held[order], part[order]
        starts = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]])) if len(part) else []
        for a, b in zip(starts, [*starts[1:], len(part)]):
            rows.append((self.block, int(part[a]), _zip(distinct[a:b], "<u8"), _zip(held[a:b], "<u4"), None, None))
        kinds = [pa.int64(), pa.int32(), *[pa.binary()] * 4]
        columns = [pa.array(c, k) for c, k in zip(zip(*rows), kinds)]
        yield pa.RecordBatch.from_arrays(columns, ["block", "part", "pairs", "docs", "payload", "head"])
        self.docs, self.entries, self.block = [], 0, self.block + 1


def blocks(docs: DataFrame, composed: DataFrame, paths: tuple[str, str], size: int, parts: int) -> DataFrame:
    """Blocks of all documents: short texts aligned here, long ones from their composed fragments."""

    def short(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner, made = bpe.loaded(Aligner, paths), _Blocks(TaskContext.get().partitionId() << 32, parts)
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                found = aligner.text(text.as_py())
                if found is None:
                    yield from made.add(doc_id)
                else:
                    yield from made.add(doc_id, *found[:4], *np.unique(found[4], return_counts=True))
        yield from made.done()

    def long(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = _Blocks(1 << 62 | TaskContext.get().partitionId() << 32, parts)
        for batch in batches:
            for r in batch.to_pylist():
                if not r["ok"]:
                    yield from made.add(r["doc_id"])
                    continue
                f = _unpacked(r).whole()
                yield from made.add(r["doc_id"], r["n_a"], r["n_b"], f.n_groups, b";".join(f.groups), f.pairs, f.counts)
        yield from made.done()

    few = docs.where(F.char_length("text") <= size).mapInArrow(short, BLOCKS)
    return stored(few.unionByName(composed.mapInArrow(long, BLOCKS)), "blocks")


def _sums(table: pa.Table) -> pa.Table:
    """Of one part of the pairs: for each block the corpus-wide counts of its pairs; and the highest of each id."""
    held = [_unzip(p, "<u8") for p in table["pairs"].to_pylist()]
    docs = [_unzip(d, "<u4") for d in table["docs"].to_pylist()]
    distinct, at = np.unique(np.concatenate(held), return_inverse=True)
    totals = np.bincount(at, weights=np.concatenate(docs), minlength=len(distinct)).astype(np.uint64)
    ids, first = np.unique(distinct >> np.uint64(32), return_index=True)
    highest = np.maximum.reduceat(totals, first)
    ends = np.cumsum([len(p) for p in held])
    n = len(held) + 1
    return pa.table(
        {
            "block": pa.concat_arrays([*table["block"].chunks, pa.array([None], pa.int64())]),
            "part": pa.array([table["part"][0].as_py()] * n, pa.int32()),
            "totals": pa.array([*(_zip(t, "<u8") for t in np.split(totals[at], ends[:-1])), None], pa.binary()),
            "ids": pa.array([None] * (n - 1) + [ids.astype(np.int32)], pa.list_(pa.int32())),
            "highest": pa.array([None] * (n - 1) + [highest.astype(np.int64)], pa.list_(pa.int64())),
        }
    )


RESULT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def align(
    docs: DataFrame,
    byte_tokenizer: str,
    piece_tokenizer: str,
    id_column: str = "doc_id",
    text_column: str = "text",
    size: int = LONG,
) -> DataFrame:
    """Per row its id, ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``n_best``, ``count_sum`` and ``groups_sha256``.

    The byte-level tokenizer encodes a space and the text, the piece tokenizer the text, to which it adds
    the space. A null or empty text, and one that either tokenizer does not give back byte for byte, has no
    tokens: numbers are 0 and the hash is empty. Repeated rows and ids, null ids among them, each keep a
    row and each count as a document. An empty table gives none; other columns are not read.
    """
    spark, paths = docs.sparkSession, (byte_tokenizer, piece_tokenizer)
    docs = docs.select(F.col(id_column).cast("long").alias("doc_id"), present(text_column).alias("text"))
    volume = docs.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    parts = max(1, -(-volume // PART_BYTES))
    made = blocks(docs, long_fragments(docs, paths, size), paths, size, parts)
    sums = stored(by_group(made.where("part >= 0").select("part", "block", "pairs", "docs"), ["part"], _sums, "block long, part int, totals binary, ids array<int>, highest array<long>"), "pair-sums")
    highest = sums.where("block is null").select(F.explode(F.arrays_zip("ids", "highest")).alias("x")).groupBy("x.ids").agg(F.max("x.highest").alias("n"))
    table = highest.toArrow()  # a row for each id of the vocabulary
    best = np.zeros(max(table["ids"].to_pylist(), default=0) + 1, dtype=np.uint64)
    best[table["ids"].to_numpy()] = table["n"].to_numpy()
    held = spark.sparkContext.broadcast(best)

    def result(table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda r: r["part"])
        head = pa.ipc.open_stream(rows[0]["head"]).read_all()
        data, packed = rows[0]["payload"], []
        while data:
            n = int.from_bytes(data[:4], "little")
            packed.append(data[4 : 4 + n])
            data = data[4 + n :]
        at, counts, ids = (_unzip(p, "<u4") for p in packed)
        totals = np.concatenate([*(_unzip(r["totals"], "<u8") for r in rows[1:]), np.zeros(0, dtype=np.uint64)])
        counts = counts.astype(np.int64)
        top = totals == held.value[ids]
        ends = np.concatenate([[0], np.cumsum(head["size"].to_numpy())])
        columns = []
        for of_link in (counts * top[at], counts * totals[at].astype(np.int64)):
            running = np.concatenate([[0], np.cumsum(of_link)])
            columns.append(pa.array(running[ends[1:]] - running[ends[:-1]], pa.int64()))
        out = head.drop_columns(["size"]).append_column("n_best", columns[0]).append_column("count_sum", columns[1])
        return out.select(["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"])

    nothing = F.lit(None).cast("binary")
    payloads = made.where("part < 0").select("block", "part", "payload", "head", nothing.alias("totals"))
    returned = sums.where("block is not null").select("block", "part", nothing.alias("payload"), nothing.alias("head"), "totals")
    return by_group(payloads.unionByName(returned), ["block"], result, RESULT).withColumnRenamed("doc_id", id_column)
