"""Token counts, token files and chunked BPE against the library and exact round trips."""

from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from jobtide.llm import bpe, chunk_bpe, huffman, token_count

BYTE, WORD = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
SF_DIR = "/root/testdata/sf0.001"
PARTS = [
    " ", "  ", "\n", " \n", "\t", "\x1c", "\x85", " ", " ", "'s", "'re", "'", "<|endoftext|>", "a", "The", "É", "1", "½", "՘",
    "!", "中", "́", "​", "\r\n", "😀", " x", "﻿", "İ", "Σ",
]


def odd_texts(count, length, seed):
    rng = random.Random(seed)
    return ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, length))) for _ in range(count)]


@pytest.fixture(scope="module")
def texts(spark):
    rows = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    long = "x" * 20_000 + " " + "ab" * 3000 + " word" * 40_000
    return [*(tuple(r) for r in rows), (10**9, None), (10**9 + 1, ""), (10**9 + 2, long), (7, "twice"), (7, "twice"), (None, "no id")]


@pytest.fixture(scope="module")
def docs(spark, texts):
    """With extra columns whose names the operators use themselves."""
    frame = spark.createDataFrame(texts, "doc_id long, text string")
    return frame.withColumns({"id": F.lit(1), "n_tokens": F.lit("no"), "route": F.lit("x"), "ids": F.lit(0)})


def ids_of(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids


def as_bytes(ids):
    return np.array(ids, dtype="<u4").tobytes()


def same_rows(got, want):
    assert sorted(map(repr, got)) == sorted(map(repr, want))


def test_counts(docs, texts):
    library = Tokenizer.from_file(BYTE)
    got = [tuple(r) for r in token_count.token_counts(docs, BYTE).collect()]
    counts = [(i, len((t or "").encode()), len(ids_of(library, t))) for i, t in texts]
    same_rows(got, [(i, b, n, n > 1024) for i, b, n in counts])


def test_counts_of_odd_texts():
    counter, library = bpe.Counter(BYTE), Tokenizer.from_file(BYTE)
    for text in odd_texts(4000, 20, 1):
        assert counter.count(text) == len(ids_of(library, text)), text


def test_a_small_memo_changes_nothing():
    counter, library = bpe.Counter(BYTE), Tokenizer.from_file(BYTE)
    counter.later.most = counter.piece.most = counter.first.most = 2
    text = " ".join(f"word{i % 7} {i}." for i in range(300))
    assert counter.count(text) == len(ids_of(library, text))
    assert len(counter.later) <= 2


@pytest.mark.parametrize("bits", [2, 4, 8])
def test_chunks_are_repaired(monkeypatch, bits):
    monkeypatch.setattr(chunk_bpe, "CUT_BITS", bits)
    codec, library = chunk_bpe.ChunkCodec(BYTE), Tokenizer.from_file(BYTE)
    for text in odd_texts(2000, 120, bits):
        ids = codec.encode(text)
        assert ids == as_bytes(ids_of(library, text)), text
        assert codec.decode(ids) == library.decode(ids_of(library, text), skip_special_tokens=False)


def test_shared_passages_are_encoded_once():
    codec = chunk_bpe.ChunkCodec(BYTE)
    rng = random.Random(0)
    passage = " ".join("".join(rng.choices("abcdefgh", k=6)) for _ in range(800))
    codec.encode("one start " + passage)
    seen, encoded = codec.seen, codec.encoded
    codec.encode("quite another beginning, " + passage + " and an end")
    assert codec.seen - seen > 10 and codec.encoded - encoded <= 3


def test_chunked_encoding(docs, texts):
    library = Tokenizer.from_file(BYTE)
    rows = chunk_bpe.encode(docs, BYTE, decoded=True, carry=("n_chars",) if "n_chars" in docs.columns else ()).collect()
    same_rows(
        [(r["doc_id"], r["n_tokens"], hashlib.sha256(r["ids"]).hexdigest(), r["decoded"]) for r in rows],
        [(i, len(e), hashlib.sha256(as_bytes(e)).hexdigest(), t or "") for i, t in texts for e in [ids_of(library, t)]],
    )
    again = chunk_bpe.decode(chunk_bpe.encode(docs, BYTE), BYTE).select("doc_id", "decoded").collect()
    same_rows([tuple(r) for r in again], [(i, t or "") for i, t in texts])


def test_words_of_odd_texts():
    encoder, library = huffman.WordEncoder(WORD), Tokenizer.from_file(WORD)
    assert encoder.fast is not None
    for text in [*odd_texts(4000, 30, 2), "it's <|startoftext|>x<|endoftext|>"]:
        assert encoder.encode(text) == as_bytes(ids_of(library, text)), text


def entropy_coded(counts, most):
    """Plain package-merge over lists of symbols."""
    symbols = [(c, (s,)) for s, c in enumerate(counts) if c]
    level = []
    for _ in range(most):
        merged = sorted(symbols + level, key=lambda x: x[0])
        level = [(a[0] + b[0], a[1] + b[1]) for a, b in zip(merged[::2], merged[1::2])]
    lengths = [0] * len(counts)
    for _, group in merged[: 2 * len(symbols) - 2]:
        for s in group:
            lengths[s] += 1
    return lengths


def test_code_lengths_are_optimal_and_limited():
    rng = random.Random(3)
    for size, most in ((2, 4), (5, 3), (40, 6), (40, 12), (300, 18)):
        counts = np.array([int(rng.paretovariate(0.5)) if rng.random() < 0.9 else 0 for _ in range(size)])
        counts[:2] = 5, 9
        lengths = huffman.code_lengths(counts, most)
        plain = entropy_coded(counts.tolist(), most)
        assert lengths.max() <= most and (lengths > 0).tolist() == (counts > 0).tolist()
        assert (counts * lengths).sum() == (counts * np.array(plain)).sum()
        assert sum(2.0 ** -int(n) for n in lengths if n) <= 1
    assert huffman.code_lengths(np.array([0, 7]))[1] == 1 and not huffman.code_lengths(np.zeros(4, dtype=int)).any()


@pytest.mark.parametrize("tokens", [1, 2, 255, 256, 257, 70_000])
def test_packed_blocks_come_back(tokens):
    rng = np.random.default_rng(tokens)
    ids = (rng.pareto(0.3, tokens) * 3 % 50_000).astype("<u2")
    lengths = huffman.code_lengths(np.bincount(ids, minlength=1 << 16))
    packed, checkpoints = huffman.pack(ids, lengths, huffman.canonical(lengths))
    assert (huffman.Table(lengths).unpack(packed, checkpoints, tokens) == ids).all()


def test_token_files(spark, docs, texts, tmp_path, monkeypatch):
    library = Tokenizer.from_file(WORD)
    monkeypatch.setattr(huffman, "BLOCK_TOKENS", 3000)
    path = str(tmp_path / "files")
    huffman.write(docs, path, WORD, end_id=2)
    rows = huffman.read(spark, path).orderBy("start").collect()
    want = sorted(((i, as_bytes([*ids_of(library, t), 2])) for i, t in texts), key=lambda x: (x[0] is not None, x[0] or 0))
    same_rows([(r["doc_id"], bytes(r["ids"])) for r in rows], want)
    assert [r["doc_id"] for r in rows] == [i for i, _ in want]
    start = 0
    for r in rows:
        assert (r["start"], r["n_tokens"]) == (start, len(r["ids"]) // 4)
        start += r["n_tokens"]
    digests = huffman.digests(huffman.read(spark, path)).collect()
    same_rows([tuple(r) for r in digests], [(r["doc_id"], r["start"], r["n_tokens"], zlib.crc32(bytes(r["ids"]))) for r in rows])


def test_empty_tables(spark, docs, tmp_path):
    none = docs.limit(0)
    assert token_count.token_counts(none, BYTE).count() == chunk_bpe.encode(none, BYTE).count() == 0
    assert huffman.round_trip(none, WORD).count() == 0
