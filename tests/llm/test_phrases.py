"""Phrases against plain counting, and the T-occurrence search and its join against comparing everything."""

from __future__ import annotations

import collections
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_documents import near_groups, near_rows

from jobtide.llm import divide_skip, grams, ngram_join, phrases

UPPER = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def expected(rows, threshold, longest, top):
    counts = collections.defaultdict(collections.Counter)
    for lang, text in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(UPPER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            for k in range(1, longest + 1):
                counts[lang or "und" if lang is None else lang].update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, f in counts.items():
        n = sum(c for p, c in f.items() if len(p) == 1)
        candidates = {p: c for p, c in f.items() if len(p) > 1 and c >= threshold}
        kept = []
        for p, a in candidates.items():
            around = [c for q, c in candidates.items() if len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))]
            if any(100 * c >= 80 * a for c in around):
                continue
            score, cut = min((2000000 * a // (f[p[:k]] + f[p[k:]]), k) for k in range(1, len(p)))
            kept.append((-score, -a, " ".join(p).encode(), f[p[:cut]], f[p[cut:]]))
        for rank, (score, a, p, left, right) in enumerate(sorted(kept)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n, -score))
    return out


def phrase_rows():
    rng = random.Random(6)
    vocabulary = ["New", "york", "city", "of", "The", "é", "日本", "x1", "a b", "\x00", "hall", "in"]
    fixed = ["New York City", "city hall of new york", "x1 x1 x1 x1 x1", "日本 é"]
    rows = []
    for i in range(300):
        words = [rng.choice(vocabulary if rng.random() < 0.6 else fixed) for _ in range(rng.randint(0, 40))]
        text = "".join(w + rng.choice([" ", "  ", "\t", " ", ". ", "\n", ",", "!?"]) for w in words)
        rows.append((rng.choice(["en", "en", "en", "de", None, ""]), text))
    return [*rows, ("en", None), ("en", ""), ("fr", "... \n"), ("en", "once upon " * 4000), *[("xx", "tie one. tie two.")] * 30]


@pytest.mark.parametrize(("threshold", "shards", "top"), [(30, 3, 2000), (2, 4, 7), (1, 1, 50)])
def test_collocations(spark, monkeypatch, threshold, shards, top):
    monkeypatch.setattr(phrases, "GATHERED", 500)
    rows = phrase_rows()
    docs = spark.createDataFrame(rows, "lang string, text string").withColumns({"shard": F.lit(0), "k": F.lit("x"), "n": F.lit(1)})
    got = phrases.collocations(docs.repartition(3), threshold=threshold, top=top, shards=shards)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(map(tuple, got.collect())) == sorted(expected(rows, threshold, 4, top))


def test_shared_cells_change_no_count(spark, monkeypatch):
    """With two cells for all phrases, nearly everything becomes active early."""
    monkeypatch.setattr(phrases, "CELL_BITS", 1)
    rows = phrase_rows()
    got = phrases.collocations(spark.createDataFrame(rows, "lang string, text string").repartition(2))
    assert sorted(map(tuple, got.collect())) == sorted(expected(rows, 30, 4, 2000))


def test_collocations_of_an_empty_table(spark):
    assert phrases.collocations(spark.createDataFrame([], "lang string, text string")).count() == 0


def test_word_hashes_do_not_depend_on_their_place():
    blank = grams.table(b" \n")
    data = "one two  one\nthree é one".encode()
    starts, ends, h = grams.words(data, blank)
    assert [data[a:b].decode() for a, b in zip(starts, ends)] == ["one", "two", "one", "three", "é", "one"]
    assert h[0] == h[2] == h[5] and len(set(h.tolist())) == 4
    assert len(grams.words(b"", blank)[2]) == 0 and len(grams.words(b" \n", blank)[2]) == 0
    long = b"w " * (grams.BUFFER + 5)
    assert len(np.unique(grams.words(long, blank)[2])) == 1


@pytest.mark.parametrize("weight", [0.0085, 1, 100, 0])
def test_occurrences(monkeypatch, weight):
    monkeypatch.setattr(divide_skip, "PROBE_WEIGHT", weight)
    rng = random.Random(1)
    for _ in range(1500):
        lists = [sorted(rng.sample(range(30), rng.randint(0, rng.choice([3, 20])))) for _ in range(rng.randint(0, 12))]
        needed = rng.randint(1, 8)
        counts = collections.Counter(x for part in lists for x in part)
        assert sorted(divide_skip.occurrences(lists, needed)) == sorted((x, n) for x, n in counts.items() if n >= needed)


def passages():
    """Texts that share a passage for the most part, some just above and some below the similarity asked."""
    rng = random.Random(2)
    passage = [f"p{n}" for n in range(100)]
    rows = []
    for i in range(120):
        own = [f"o{i}_{n}" for n in range(rng.choice([3, 9, 10, 11, 14, 30]))]
        rows.append((2000 + i, " ".join(own + passage if i % 2 else passage + own)))
    return rows


@pytest.mark.parametrize(("words", "percent"), [(4, 85), (5, 70)])
def test_jaccard_join(spark, monkeypatch, words, percent):
    monkeypatch.setattr(ngram_join, "BLOCK", 4)
    rows = [*near_rows(), *passages()]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"key": F.lit(1), "tie": F.lit("x"), "component": F.lit(2)})
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngram_join.jaccard_join(docs, words, percent).collect()}
    assert got == near_groups(rows, words, percent)


def test_jaccard_join_of_odd_rows(spark):
    text = " ".join(f"w{n}" for n in range(40))
    rows = [(1, text), (1, "x y z u v"), (None, text), (2, "X y z u v"), (3, None), (None, None), (5, f"{text} more"), (5, f"{text} more"), (9, "é É"), (8, "É É")]
    got = ngram_join.jaccard_join(spark.createDataFrame(rows, "doc_id long, text string"), 4, 85)
    want = [(1, 37, 1), (1, 2, 1), (None, 37, None), (2, 2, 1), (3, 0, 3), (None, 0, None), (5, 38, 1), (5, 38, 1), (9, 1, 9), (8, 1, 8)]
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, want))
    assert ngram_join.jaccard_join(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_members_of_a_block_bring_only_the_lists_before_it_long_ones_first(spark, monkeypatch):
    frames, by_group = [], ngram_join.by_group

    def seen(df, *rest):
        frames.append(df)
        return by_group(df, *rest)

    monkeypatch.setattr(ngram_join, "by_group", seen)
    lists = {5: [1, 2], 6: [1, 2, 3], 7: [1, 2, 3, 4]}
    members = spark.createDataFrame([(k, rep, 0, 10) for k, reps in lists.items() for rep in reps], "key long, rep long, tie long, n long")
    classes = spark.createDataFrame([(rep, 0, rep, rep) for rep in (1, 2, 3, 4)], "rep long, tie long, h1 long, h2 long")
    docs = spark.createDataFrame([(rep, "a b c d") for rep in (1, 2, 3, 4)], "doc_id long, text string")
    none = spark.createDataFrame([], "key long, b long, b_tie long, node long, component long")
    ngram_join.remaining(docs, members, none.select("key", "b", "b_tie"), classes, none.select("node", "component"), 4, 85)
    (brought,) = {c for c, kind in frames[0].dtypes if kind == "array<bigint>"}
    got = {(r["key"], r["rep"]): list(r[brought]) for r in frames[0].collect()}
    assert got == {(k, rep): [longer for longer in (7, 6) if longer > k] for k, reps in lists.items() for rep in reps}


def test_lists_keep_members_near_another_in_size(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "BLOCK", 4)
    lists = {5: [10, 85], 6: [84, 100, 200, 235], 7: [10, 20, 40, 80, 160]}
    classes = [(10 * key + i, 0, n, [key]) for key, sizes in lists.items() for i, n in enumerate(sizes)]
    sizes = spark.createDataFrame([(key, len(of)) for key, of in lists.items()], "key long, size long")
    got = ngram_join.members_of(spark.createDataFrame(classes, "rep long, tie long, n_shingles long, keys array<long>"), sizes, 85)
    want = [(6, 200), (6, 235), *[(7, n) for n in lists[7]]]  # lists longer than a block stay whole
    assert sorted((r["key"], r["n"]) for r in got.collect()) == want


@pytest.mark.parametrize("percent", [70, 85])
def test_marks_rule_out_no_link_and_most_unrelated_pairs(percent):
    rng, out = np.random.default_rng(3), 0
    for n in (1, 2, 20, 127, 255, 256, 300, 512, 700, 1024, 3000):
        for own in (0, 1, n // 12, n // 6):
            both = rng.integers(0, 1 << 63, n, dtype=np.uint64)
            a, b = (np.unique(np.concatenate([both, rng.integers(0, 1 << 63, own, dtype=np.uint64)])) for _ in range(2))
            b = b[rng.random(len(b)) < 0.97] if len(b) > 100 else b
            may = ngram_join.may_link(ngram_join.mark(a)[None], np.array([len(a)]), ngram_join.mark(b), len(b), percent)
            assert may[0] or not ngram_join.linked(a, b, percent)
        other = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64))
        assert not len(ngram_join.may_link(np.zeros((0, 64), dtype=np.uint8), np.zeros(0, dtype=np.int64), ngram_join.mark(a), len(a), percent))
        out += not ngram_join.may_link(ngram_join.mark(a)[None], np.array([len(a)]), ngram_join.mark(other), n, 85)[0]
    assert out >= 9


def test_only_sets_of_likely_pairs_travel(spark, monkeypatch):
    wanted, full_sets = [], ngram_join.full_sets

    def seen(docs, asked, width):
        wanted.append(asked.count())
        return full_sets(docs, asked, width)

    monkeypatch.setattr(ngram_join, "full_sets", seen)
    texts = [" ".join(["rare of all runs", *(f"w{i}_{n}" for n in range(300))]) for i in range(6)]
    rows = [*enumerate(texts), (9, f"{texts[3]} more")]
    got = ngram_join.jaccard_join(spark.createDataFrame(rows, "doc_id long, text string"), 4, 85)
    assert {r["doc_id"]: r["component_id"] for r in got.collect()} == {**{i: i for i in range(6)}, 9: 3}
    assert sum(wanted) <= 3
