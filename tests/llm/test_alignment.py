"""Alignment of two tokenizers and its fragments against a plain alignment of whole texts."""

from __future__ import annotations

import collections
import hashlib
import random

import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from jobtide.llm import alignment
from jobtide.llm.bpe import byte_letters
from jobtide.llm.fragments import Fragment, fragment

SF_DIR = "/root/testdata/sf0.001"
PATHS = tuple(map(public_tokenizers.path, ("byte_bpe_50k.json", "piece_bpe_32k.model")))


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(PATHS[0])
    a.encode_special_tokens = True
    letters = {letter: byte for byte, letter in byte_letters().items()}
    return a, letters, sentencepiece.SentencePieceProcessor(model_file=PATHS[1])


def groups_of(libraries, text):
    """Groups as (ids of A, ids of B), from the whole text at once."""
    a, letters, b = libraries
    if not text:
        return []
    found = a.encode(" " + text, add_special_tokens=False)
    a_parts = [bytes(letters[c] for c in token) for token in found.tokens]
    b_ids = b.encode(text)
    b_parts = [bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode() for i, p in ((i, b.id_to_piece(i)) for i in b_ids)]
    if not b"".join(a_parts) == b"".join(b_parts) == (" " + text).encode():
        return []

    def ends(parts):
        at = 0
        for p in parts:
            at += len(p)
            yield at

    a_ends, b_ends = list(ends(a_parts)), list(ends(b_parts))
    out, start = [], 0
    for end in sorted(set(a_ends) & set(b_ends)):
        out.append(([i for i, e in zip(found.ids, a_ends) if start < e <= end], [i for i, e in zip(b_ids, b_ends) if start < e <= end]))
        start = end
    return out


def expected(libraries, rows):
    grouped = [(i, groups_of(libraries, t)) for i, t in rows]
    links = [[(x, y) for a, b in g for x in a for y in b] for _, g in grouped]
    counts = collections.Counter(pair for found in links for pair in set(found))
    best = collections.defaultdict(int)
    for (x, _), n in counts.items():
        best[x] = max(best[x], n)
    out = []
    for (i, g), found in zip(grouped, links):
        text = ";".join(f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b in g)
        sha = hashlib.sha256(text.encode()).hexdigest() if g else ""
        sizes = (sum(len(a) for a, _ in g), sum(len(b) for _, b in g), len(g), len(found))
        out.append((i, *sizes, sum(counts[p] == best[p[0]] for p in found), sum(counts[p] for p in found), sha))
    return out


ODD = [
    None, "", " ", "  two  spaces ", "tabs\tand\nlines\r\n\n  x", "a\x00b", "▁ mark", "x ▁y", "<|endoftext|> <s> </s> <0x41>", "naïve ﬁ Å é",
    "日本語 テキスト　全角", "🙂🙃 emoji 👩‍👩‍👧", "a b c d", "'s 'S don't", "x" * 300, "﻿z", "🙂" * 50 + " end",
]


@pytest.mark.parametrize("size", [37, alignment.LONG])
def test_alignment(spark, libraries, monkeypatch, size):
    monkeypatch.setattr(alignment, "PART_BYTES", 20_000)
    monkeypatch.setattr(alignment, "REACH", 20)
    rng = random.Random(3)
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").limit(60).collect()]
    rows += [(10**6 + n, t) for n, t in enumerate(ODD)] + [(None, "no id"), (7, "twice"), (7, "twice")]
    rows.append((8, "".join(rng.choice(["word", " ", "  ", "\n", "é", "日本", "🙂", "x1", ".", " the"]) for _ in range(3000))))
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"row": F.lit(1), "part": F.lit("p"), "n_a": F.lit(0)}).repartition(3)
    got = alignment.align(docs, *PATHS, size=size)
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, expected(libraries, rows)))


def test_alignment_of_an_empty_table(spark):
    assert alignment.align(spark.createDataFrame([], "doc_id long, text string"), *PATHS).count() == 0


def test_fragments_compose_in_any_tree():
    """Byte ranges of random token streams, composed in random order, give the fragment of the whole."""
    rng = random.Random(9)
    for _ in range(300):
        length = rng.randint(1, 40)
        ends = [sorted({length, *(rng.randint(1, length) for _ in range(rng.randint(0, 30)))}) for _ in range(2)]
        ids = [[rng.randint(0, 5) for _ in e] for e in ends]
        whole = fragment(ids[0], ends[0], ids[1], ends[1]).whole()
        edges = [0, *sorted(rng.sample(range(1, length), rng.randint(0, min(6, length - 1)))), length]
        parts = []
        for low, high in zip(edges, edges[1:]):
            inside = [[(i, e) for i, e in zip(ids[s], ends[s]) if low < e <= high] for s in (0, 1)]
            parts.append(fragment(*(list(x) for s in inside for x in (zip(*s) if s else ([], [])))))
        while len(parts) > 1:
            at = rng.randrange(len(parts) - 1)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        got = (parts[0] + Fragment()).whole()
        assert b";".join(got.groups) == b";".join(whole.groups) and got.n_groups == whole.n_groups and got.suffix == ([], [])
        assert got.pairs.tolist() == whole.pairs.tolist() and got.counts.tolist() == whole.counts.tolist()
