"""Lines, near duplicates, quality and mixtures against plain Python."""

from __future__ import annotations

import collections
import hashlib
import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from jobtide.llm import components, line_dedup, mixing, near_dup, quality, superminhash

SF_DIR = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
BLANKS = "\x20\x09\x0a\x0b\x0c\x0d"
UPPER = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def lines_kept(rows, min_chars=40, min_docs=5):
    holders = collections.defaultdict(set)
    for i, text in rows:
        for line in (text or "").split("\n"):
            key = line.strip(BLANKS).translate(UPPER)
            if len(key) >= min_chars:
                holders[key].add(i)
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        kept = []
        for line in lines:
            by = holders.get(line.strip(BLANKS).translate(UPPER), ())
            if len(by) < min_docs or i == max(by, key=lambda x: (x is not None, x or 0)):
                kept.append(line)
        out.append((i, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return out


SHARED = "É Shared line of more than forty code points, with a Kelvin sign K"


def line_rows():
    rng = random.Random(5)
    pool = [f"{SHARED} {n}" for n in range(6)] + ["short", "", "  ", "another line that is long enough to count as one " * 3]
    rows = []
    for i in range(40):
        lines = [rng.choice(pool) for _ in range(rng.randint(0, 12))]
        lines = [rng.choice(["", " ", "\t\x0b"]) + (line.upper() if line.isascii() and rng.random() < 0.3 else line) + rng.choice(["", "\r", " \x0c"]) for line in lines]
        rows.append((i, "\n".join(lines)))
    rows += [(100, None), (101, ""), (None, "\n".join(pool)), (None, pool[0]), (7, "\n".join(pool)), (7, "\n".join(pool))]
    rows += [(102, "\n".join([pool[0], "own"] * 3000)), (103, pool[0].replace("K", "k"))]
    return rows


@pytest.mark.parametrize("batches", [1, 4])
def test_lines(spark, batches):
    rows = line_rows()
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"drop": F.lit("mine"), "h1": F.lit(1), "n_lines": F.lit("old"), "id": F.lit(0)})
    got = line_dedup.dedup_lines(docs, batches=batches)
    assert got.columns == ["doc_id", "text", "drop", "h1", "id", "n_lines", "n_dropped"]
    have = sorted(map(repr, [(r["doc_id"], r["text"], r["n_lines"], r["n_dropped"]) for r in got.collect()]))
    assert have == sorted(map(repr, lines_kept(rows)))
    assert got.where("drop = 'mine' and h1 = 1").count() == len(rows)


def test_runs_are_compacted(spark):
    runs = line_dedup.Runs(spark, fanout=2)
    for n in range(4):
        runs.add(spark.createDataFrame([(100 - n, 1, 1), (100 - n, 2, n)], "id long, h1 long, h2 long"))
    assert [len(level) for level in runs.levels] == [0, 0, 1]
    rows = {(r["h1"], r["h2"]): (r["docs"], r["keeper"]) for r in line_dedup.combined(runs.all()).collect()}
    assert rows[1, 1] == (4, 100) and rows[2, 3] == (1, 97)


def test_lines_of_an_empty_table(spark):
    assert line_dedup.dedup_lines(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(1)
    pool = rng.integers(1, 2**63, 3000, dtype=np.uint64)
    errors = []
    for n, both in ((5, 3), (60, 40), (400, 300), (1500, 200)):
        for _ in range(30):
            some = rng.permutation(pool)[: 2 * n - both]
            a, b = np.sort(some[:n]), np.sort(some[n - both :])
            s = superminhash.signatures([a, b])
            errors.append((s[0] == s[1]).mean() - both / (2 * n - both))
    assert abs(np.mean(errors)) < 0.01 and np.std(errors) < 0.05


def test_signatures_do_not_depend_on_their_batch():
    rng = np.random.default_rng(2)
    sets = [np.sort(rng.integers(1, 2**63, n, dtype=np.uint64)) for n in (1, 3, 50, 2000)]
    together = superminhash.signatures(sets)
    for s, row in zip(sets, together):
        assert (superminhash.signatures([s])[0] == row).all()


def shingle_set(text, words):
    found = WORD.findall((text or "").translate(UPPER))
    n = min(words, len(found))
    return frozenset(tuple(found[k : k + n]) for k in range(len(found) - n + 1)) if found else frozenset()


def near_groups(rows, words, percent):
    """Links between all rows, by plain comparison of all pairs."""
    sets = {i: shingle_set(t, words) for i, t in rows}
    trees = components.Union()
    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b]:
                both = len(sets[a] & sets[b])
                if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                    trees.join(a, b)
    return {i: (len(sets[i]), trees.root(i)) for i in ids}


def near_rows():
    rng = random.Random(8)
    words = [f"w{n}" for n in range(500)]
    rows, i = [], 0
    for group in range(12):
        base = [rng.choice(words) for _ in range(rng.choice([1, 2, 4, 40, 120, 300]))]
        for _ in range(rng.choice([1, 2, 3, 25])):
            copy = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 4])):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            rows.append((i, " \t".join(w.upper() if rng.random() < 0.1 else w for w in copy)))
            i += rng.randint(1, 3)
    return [*rows, (900, None), (901, ""), (902, " \n"), (903, "one"), (904, "ONE"), (905, "long " * 5000), (906, "é É"), (907, "É É")]


@pytest.mark.parametrize(("words", "percent"), [(3, 85), (5, 80)])
def test_near_duplicates(spark, monkeypatch, words, percent):
    monkeypatch.setattr(near_dup, "BLOCK", 4)
    rows = near_rows()
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"rep": F.lit(1), "bands": F.lit("x"), "kept": F.lit(2)})
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in near_dup.near_duplicates(docs, words, percent).collect()}
    assert got == near_groups(rows, words, percent)


def test_near_duplicates_of_odd_rows(spark):
    rows = [(1, "a b c d e f"), (1, "a b c d e f"), (None, "a b c d e f"), (2, "a b c d e f"), (3, None), (None, None)]
    got = near_dup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 3, 85)
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(
        map(repr, [(1, 4, 1, True), (1, 4, 1, True), (None, 4, None, True), (2, 4, 1, False), (3, 0, 3, True), (None, 0, None, True)])
    )
    assert near_dup.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_near_duplicates_of_one_id_over_different_texts(spark):
    """An id with two texts links the near copies of both, whichever stands for a class."""
    def text(name, change=""):
        return " ".join([f"{name}{n}" for n in range(60)] + [change])

    rows, want = [], {}
    for k in range(0, 400, 10):
        rows += [(k, text(f"x{k}_")), (k, text(f"y{k}_")), (k + 1, text(f"x{k}_", "more")), (k + 2, text(f"y{k}_", "other"))]
        rows += [(k + 4, text(f"z{k}_")), (k + 5, text(f"z{k}_")), (k + 5, text(f"y{k}_")), (k + 6, text(f"u{k}_"))]
        want |= {k + n: k for n in (0, 1, 2, 4, 5)} | {k + 6: k + 6}
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = near_dup.near_duplicates(docs).select("doc_id", "component_id").collect()
    assert len(got) == len(rows) and {tuple(r) for r in got} == set(want.items())


def test_components_of_a_long_chain(spark):
    rng = random.Random(4)
    links = [(n, n + 1) for n in range(200)] + [(1000 + n, 1000) for n in range(1, 300)] + [(5000, 4000)]
    rng.shuffle(links)
    frame = spark.createDataFrame([rng.sample(link, 2) for link in links], "a long, b long").repartition(7)
    got = {r["node"]: r["component"] for r in components.components(frame).collect()}
    assert got == {**{n: 0 for n in range(201)}, **{1000 + n: 1000 for n in range(300)}, 4000: 4000, 5000: 4000}


def base_counts(text):
    text = text or ""
    found = WORD.findall(text)
    windows = collections.Counter(zip(found, found[1:], found[2:]))
    covered = {p for k in range(len(found) - 2) if windows[tuple(found[k : k + 3])] > 1 for p in (k, k + 1, k + 2)}
    lines = [line for line in text.split("\n") if WORD.search(line)]
    failed = len(found) < 50 or 100 * len(covered) > 50 * len(found)
    return len(found), sum(map(len, found)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered), failed


def quality_rows(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()]
    odd = ["a b c " * 40, "x " * 60, " ".join(map(str, range(49))), " ".join(map(str, range(50))), "   é\x85a\n" * 60, "#*$%&|<> " * 3]
    long = "one two three four five " * 9000 + " ".join(f"u{n}" for n in range(60_000))
    return [*rows, (10**9, None), (10**9 + 1, ""), (10**9 + 2, long), (None, "no id"), (7, "twice"), *((10**9 + 5 + n, t) for n, t in enumerate(odd))]


def test_base_rules(spark):
    rows = quality_rows(spark)
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"hashes": F.lit(1), "kept": F.lit("old"), "row": F.lit(0)})
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    got = quality.judge(docs, labels).collect()
    columns = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    have = sorted(repr((r["doc_id"], *(r[c] for c in columns))) for r in got)
    assert have == sorted(repr((i, *base_counts(t))) for i, t in rows)
    assert not any(r["kept"] for r in got if r["base_failed"]) and {r["hashes"] for r in got} == {1}


def test_trained_rules_on_held_out_labels(spark):
    sf_dir = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    held_out = F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 0
    judged = quality.judge(docs, labels.where(~held_out)).join(labels.where(held_out), "doc_id").where("not base_failed")
    by = {r["quality"]: r for r in judged.groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("kept"), F.count("*").alias("n")).collect()}
    assert by[1]["n"] > 100 and by[1]["kept"] >= 0.98
    assert by[0]["kept"] <= 0.25


def test_the_threshold_follows_trusted_documents_left_out(spark):
    """Of two languages, one is rare among the trusted: its documents stay."""
    rng = random.Random(6)
    languages = [[f"{name}{n}" for n in range(300)] for name in ("a", "b")]
    rows = [(i, " ".join(rng.choices(languages[i % 2], k=80))) for i in range(400)]
    rows += [(1000 + i, " ".join(w + "!!" for w in rng.choices(languages[0], k=80))) for i in range(80)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1, 0) for i in range(400) if i % 2 == 0 and i < 80 or i % 8 == 1], "doc_id long, quality int, toxic int")
    assert quality.FLOOR <= quality.threshold_of(quality.scored(docs, labels), labels) <= quality.THRESHOLD
    kept = {r["doc_id"] for r in quality.judge(docs, labels).where("kept").collect()}
    assert kept == set(range(400))


def test_the_threshold_covers_all_trusted_documents(spark):
    """The documents after the first 4,000 by id hash are of a language that the corpus has more of than the trusted."""
    rng = random.Random(7)
    ids = [r[0] for r in spark.range(4100).orderBy(F.xxhash64("id"), "id").collect()]
    rows = [(i, " ".join(f"{'a' if n < 4000 else 'b'}{rng.randrange(50)}" for _ in range(55))) for n, i in enumerate(ids)]
    rows += [(5000 + n, " ".join(f"b{rng.randrange(50)}" for _ in range(55))) for n in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1, 0) for i in ids], "doc_id long, quality int, toxic int")
    assert quality.threshold_of(quality.scored(docs, labels), labels) == quality.FLOOR


def test_scores_are_log_likelihood_ratios(spark):
    """Every score, with and without the document's half of the target, by plain Python over the same buckets."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    words = [(r["doc_id"], WORD.findall(r["text"] or "")) for r in docs.collect()]
    grams = spark.createDataFrame([(i, n, w, nxt) for i, ws in words for n, (w, nxt) in enumerate(zip(ws, [*ws[1:], None]))], "i long, n int, w string, x string")
    of = F.xxhash64("w"), F.xxhash64(F.xxhash64("w"), F.xxhash64("x"))
    held = collections.defaultdict(list)
    for r in grams.select("i", *[h.bitwiseAND(F.lit(quality.BUCKETS - 1)) for h in of], F.col("x").isNotNull().alias("pair")).collect():
        held[r[0]] += [r[1], r[2]] if r["pair"] else [r[1]]
    halves = {r["of_id"]: r["half"] for r in quality.trusted_ids(labels).collect()}
    half_of = {r[0]: r[1] for r in docs.select("doc_id", quality._half(F.col("doc_id"))).collect()}
    raw, targets = collections.Counter(), [collections.Counter(), collections.Counter()]
    for i, buckets in held.items():
        raw.update(buckets)
        if i in halves:
            targets[halves[i]].update(buckets)

    def score(buckets, parts):
        target = sum(parts, collections.Counter())
        share = target.total() / raw.total()
        logs = [round(math.log((target[b] + quality.PRIOR) / (raw[b] * share + quality.PRIOR)) * quality.UNIT) for b in buckets]
        return sum(logs) / max(len(buckets), 1) / quality.UNIT

    rows = quality.scored(docs, labels).select("of_id", "score", "left_out").collect()
    assert len(rows) == len(words) and targets[0] and targets[1]
    for i, whole, left_out in rows:
        assert whole == pytest.approx(score(held[i], targets), abs=1e-5)
        assert left_out == pytest.approx(score(held[i], [targets[1 - half_of[i]]]), abs=1e-5)


def test_the_percentile_is_exact(spark):
    rng = random.Random(8)
    for scores in ([], [-0.5], [0.25] * 7, [rng.gauss(0, 1) for _ in range(501)], [rng.choice([-1.0, 0.5, 0.5004]) for _ in range(90)]):
        frame = spark.createDataFrame([(x,) for x in scores], "score double")
        for share in (0.01, 0.5):
            want = frame.agg(F.percentile("score", share)).first()[0]
            assert quality._percentile(frame, share) == (want if want is None else pytest.approx(want, abs=1e-12))


def test_without_labels_the_base_rules_decide(spark):
    docs = spark.createDataFrame([(1, " ".join(map(str, range(60)))), (2, "few")], "doc_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r["doc_id"]: (r["score"], r["kept"]) for r in quality.judge(docs, labels).collect()} == {1: (0.0, True), 2: (0.0, False)}
    assert quality.judge(docs.limit(0), labels).count() == 0


def test_the_verdict_does_not_depend_on_the_partitions(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    rows = [sorted(map(tuple, quality.judge(d, labels).select("doc_id", "score", "kept").collect())) for d in (docs, docs.repartition(13, "text"))]
    assert rows[0] == rows[1]


def simulated(blocks, weights):
    """Slot by slot: of the sources' next blocks released, the one with the earliest deadline."""
    order, cycle = [], 0
    while len(order) < sum(blocks):
        here = [max(0, min(w, n - cycle * w)) for n, w in zip(blocks, weights)]
        length, taken, start = sum(here), [0] * len(here), len(order)
        for t in range(length):
            ready = [i for i, b in enumerate(here) if taken[i] < b and taken[i] * length // b <= t]
            i = min(ready, key=lambda i: (-(-(taken[i] + 1) * length // here[i]), i))
            order.append((i, cycle * weights[i] + taken[i]))
            taken[i] += 1
        assert len(order) == start + length
        cycle += 1
    return order


@pytest.mark.parametrize("blocks", [[7, 40, 3], [100, 1, 30, 55, 16], [5]])
def test_slots_are_those_of_the_simulation(blocks):
    weights = [3, 10, 2, 4, 1][: len(blocks)]
    schedule = mixing.Schedule(np.array(blocks), np.array(weights))
    source = np.repeat(np.arange(len(blocks)), blocks)
    block = np.concatenate([np.arange(n) for n in blocks])
    placed = schedule.place(source, block)
    assert sorted(placed["slot"]) == list(range(sum(blocks)))
    assert {s: (i, k) for s, i, k in zip(placed["slot"], source, block)} == dict(enumerate(simulated(blocks, weights)))
    assert ((placed["release"] <= placed["slot"]) & (placed["slot"] < placed["deadline"])).all()


def test_each_source_stays_within_a_block_of_its_share():
    weights = np.array([311, 17, 512, 1, 183])
    schedule = mixing.Schedule(weights * 3, weights)
    source = np.repeat(np.arange(5), weights * 3)
    slots = schedule.place(source, np.concatenate([np.arange(3 * w) for w in weights]))["slot"].to_numpy()
    order = source[np.argsort(slots)]
    t = np.arange(1, len(order) + 1)
    for i, w in enumerate(weights):
        assert np.abs(np.cumsum(order == i) - t * w / weights.sum()).max() < 1


def test_mixture(spark):
    rows = [(n, ["hot", "hot", "b", "c", None][n % 5] if n < 900 else "rare", n) for n in range(905)] + [(3, "hot", 3), (None, "b", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, slot long").withColumns({"number": F.lit(0), "group": F.lit("g"), "place": F.lit(1)})
    mixed = mixing.mix(docs, {"hot": 1.0, "b": 2.0, "c": 1.0}, block_rows=4, cycle=16, group_rows=50)
    out = mixed.collect()
    assert sorted(map(repr, ((r["doc_id"], r["source"]) for r in out))) == sorted(map(repr, ((i, s) for i, s, _ in rows)))
    assert len({(r["slot"], r["place"]) for r in out}) == len(rows) and {r["group"] for r in out} == {"g"}
    assert len({(r["slot"], r["source"], r["block"]) for r in out}) == len({r["slot"] for r in out})
    assert sorted({r["slot"] for r in out}) == list(range(len({r["slot"] for r in out})))
    early = collections.Counter(r["source"] for r in out if r["slot"] < 18)
    assert abs(early["b"] - 2 * early["hot"]) <= 8
    ordered = mixing.in_order(mixed).select("doc_id", "source").collect()
    assert [tuple(r) for r in ordered] == [(r["doc_id"], r["source"]) for r in sorted(out, key=lambda r: (r["slot"], r["place"]))]
    assert mixing.mix(docs.limit(0)).count() == 0


def test_lines_of_the_whole_table(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text")
    rows = [tuple(r) for r in docs.collect()]
    got = line_dedup.dedup_lines(docs).select("doc_id", F.sha2("text", 256)).collect()
    assert sorted(map(tuple, got)) == sorted((i, hashlib.sha256(t.encode()).hexdigest()) for i, t, _, _ in lines_kept(rows))
