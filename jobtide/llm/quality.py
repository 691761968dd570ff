"""Quality rules: plain counts, and a hashed n-gram log-likelihood ratio. DataFrame expressions only.

Words and word pairs are hashed to a fixed number of buckets. Two multinomials over the buckets are
compared: that of trusted documents and that of the whole corpus, both smoothed by the same share of
prior mass. A document's score is the mean log ratio of its n-grams; below a threshold it goes. The
threshold is a fixed one unless trusted documents score lower under the counts of the others: of a small
sample, the languages and topics of the rest may not have their due share. All trusted documents count
for the threshold. Ratios are whole numbers of a small unit, so that sums do not depend on their order.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobtide.llm.common import BLANKS, present, stored, without, words

BUCKETS = 1 << 17
#: Target n-grams that each bucket is given in advance; the corpus gets the same share.
PRIOR = 5.0
UNIT = 1 << 20
#: Mean log ratio per n-gram below which a document is unlike the trusted ones. It is lowered to what all but
#: one in a hundred trusted documents reach when their half is left out of the target, less a margin, but no
#: further than the floor.
THRESHOLD, FLOOR = -0.15, -0.6
LEAST_SHARE, MARGIN = 0.01, 0.05
#: Trusted documents that the target is fitted on, those with the smallest id hashes.
MOST_TRUSTED = 20_000
#: Fixed: characters counted as symbols.
SYMBOLS = "#*$%&|<>"
LEAST_WORDS = 50
PLACE_BITS = 30


def _hashes(text: Column) -> Column:
    return F.transform(words(text), lambda w: F.xxhash64(w))


def _buckets() -> Column:
    """The buckets of the row's words and word pairs, from the word hashes in ``hashes``."""
    pairs = F.transform(
        F.when(F.size("hashes") > 1, F.sequence(F.lit(0), F.size("hashes") - 2)).otherwise(F.array().cast("array<int>")),
        lambda i: F.xxhash64(F.get("hashes", i), F.get("hashes", i + 1)),
    )
    return F.transform(F.concat("hashes", pairs), lambda h: h.bitwiseAND(F.lit(BUCKETS - 1)).cast("int"))


def _half(of_id: Column) -> Column:
    return F.pmod(F.xxhash64(of_id, F.lit(1)), F.lit(2))


def all_trusted(labels: DataFrame) -> DataFrame:
    """Ids labelled good and not toxic."""
    return labels.where("quality = 1 and coalesce(toxic, 0) = 0 and doc_id is not null").select("doc_id").distinct()


def trusted_ids(labels: DataFrame, most: int = MOST_TRUSTED) -> DataFrame:
    """Trusted ids, at most ``most``, in two halves: the bounded sample for the target."""
    chosen = all_trusted(labels).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    return chosen.select(F.col("doc_id").alias("of_id"), _half(F.col("doc_id")).alias("half"))


def _score(ratios: Column) -> Column:
    """The mean ratio of the row's n-grams; 0 for a row without any."""
    total = F.aggregate(_buckets(), F.lit(0).cast("long"), lambda a, b: a + F.get(ratios, b))
    return total / (F.greatest(2 * F.size("hashes").cast("long") - 1, F.lit(1).cast("long")) * UNIT)


def _percentile(scores: DataFrame, share: float) -> float | None:
    """The exact percentile of column ``score``, between ranks in proportion; None without rows.

    Scores are counted by narrow bins; only the distinct scores of the bins that hold the ranks are sorted.
    """
    bins = scores.groupBy(F.floor(F.col("score") * 1000).alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    counts = sorted((r["bin"], r["n"]) for r in bins.collect())
    if not counts:
        return None
    place = share * (sum(n for _, n in counts) - 1)
    ranks, before, wanted = (math.floor(place), math.ceil(place)), 0, {}
    for at, n in counts:
        if any(before <= rank < before + n for rank in ranks):
            wanted[at] = before
        before += n
    held = scores.where(F.floor(F.col("score") * 1000).isin(*wanted)).groupBy("score").agg(F.count(F.lit(1)).alias("n"))
    values, at = [], min(wanted.values())
    found = sorted((r["score"], r["n"]) for r in held.collect())
    for rank in ranks:
        upto = at
        for value, n in found:
            upto += n
            if rank < upto:
                values.append(value)
                break
    return values[0] + (values[1] - values[0]) * (place - ranks[0])


def gram_counts(docs: DataFrame, labels: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """Per bucket its n-grams in all documents, and in each half of the target."""
    trusted = stored(trusted_ids(labels).coalesce(1), "trusted")  # of bounded size
    hashed = docs.select(F.col(id_column).alias("id"), present(text_column).alias("text"))
    marked = hashed.join(F.broadcast(trusted), F.col("id") == F.col("of_id"), "left").select("half", _hashes(F.col("text")).alias("hashes"))
    grams = marked.select("half", F.explode(_buckets()).alias("bucket"))
    targets = [F.count_if(F.col("half") == half).alias(f"half_{half}") for half in (0, 1)]
    return stored(grams.groupBy("bucket").agg(F.count(F.lit(1)).alias("raw"), *targets), "gram-counts")


def log_ratios(counts: DataFrame) -> DataFrame:
    """One row: an array of the log ratio of every bucket, in units, for the target and for it without each half.

    It is a table, which plans refer to, as constants of its size would make each plan megabytes long.
    """
    sums = counts.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("raw", "half_0", "half_1")]).first()
    whole = counts.sparkSession.range(BUCKETS).select(F.col("id").cast("int").alias("bucket")).join(counts, "bucket", "left").na.fill(0)

    def ratio(target: Column, of_all: int) -> Column:
        expected = F.col("raw") * F.lit(float(of_all)) / F.lit(float(max(sums["raw"], 1)))
        return F.round(F.log((target + PRIOR) / (expected + PRIOR)) * UNIT).cast("int") if of_all else F.lit(0)

    all_of = {"both": ("half_0", "half_1"), "without_0": ("half_1",), "without_1": ("half_0",)}
    columns = [ratio(sum(map(F.col, names[1:]), F.col(names[0])), sum(sums[n] for n in names)).alias(name) for name, names in all_of.items()]
    placed = F.array_sort(F.collect_list(F.struct("bucket", *columns)))
    held = whole.agg(placed.alias("rows"))
    return stored(held.select(*[F.col(f"rows.{name}").alias(name) for name in all_of]).coalesce(1), "ratios")


def scored(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text", keep_text: bool = True) -> DataFrame:
    """Every row (in ``row``) with its counts, its score, and its score without its half of the target; stored.

    Texts are read twice, once for the counts of the corpus and once here.
    """
    ratios = log_ratios(gram_counts(docs, labels, id_column, text_column))
    ruled = with_rules(docs.drop(*RULES), id_column, text_column)
    ruled = ruled.select("*", *[ratios.select(name).scalar().alias(f"ratios_{name}") for name in ratios.columns])
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    half = _half(F.col(f"row.`{id_column}`").cast(labels.schema["doc_id"].dataType))  # as in the target, whose ids are those of the labels
    others = [F.when(half == n, _score(F.col(f"ratios_without_{n}"))) for n in (0, 1)]
    row = F.col("row") if keep_text else F.col("row").dropFields(text_column)
    numbers = [c for c in RULES if c not in ("base_failed", "score", "kept")]
    return stored(
        ruled.select(
            row.alias("row"), F.col(f"row.`{id_column}`").alias("of_id"), *numbers, failed.alias("base_failed"),
            _score(F.col("ratios_both")).alias("score"), F.coalesce(*others).alias("left_out"),
        ),
        "scored",
    )


def threshold_of(scores: DataFrame, labels: DataFrame) -> float:
    """The threshold, fitted to what all trusted documents score without their half of the target."""
    known = scores.where(F.col("n_words") >= LEAST_WORDS).select("of_id", F.col("left_out").alias("score"))
    trusted = all_trusted(labels).withColumnRenamed("doc_id", "trusted")
    left_out = known.join(trusted, F.col("of_id") == F.col("trusted")).select("score")
    least = _percentile(stored(left_out, "left-out"), LEAST_SHARE)
    return THRESHOLD if least is None else max(FLOOR, min(THRESHOLD, least - MARGIN))


def _near(array: str, i: Column, of, value: Column) -> Column:
    """Whether the element before or after equals this one, as seen through a function."""
    same = [F.coalesce(of(F.get(array, at)) == value, F.lit(False)) for at in (i - 1, i + 1)]
    return same[0] | same[1]


def with_rules(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``row`` (the document), ``n_words`` and the counts of the base rules, and ``hashes`` of its words.

    Words in repeated windows: windows are sorted by the low bits of their hash with their place in one
    number, which leaves few candidates; these are compared by their whole hash.
    """
    text = present(F.col(f"row.`{text_column}`"))
    bytes_ = F.octet_length(text)
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    out = docs.select(F.struct("*").alias("row"))
    out = out.select(
        "row",
        _hashes(text).alias("hashes"),
        (F.char_length(text) - bytes_ + F.octet_length(without(text, BLANKS))).cast("long").alias("word_chars"),
        (bytes_ - F.octet_length(without(text, SYMBOLS))).cast("long").alias("n_symbols"),
        lines.alias("lines"),
    )

    def window(i: Column) -> Column:
        return F.xxhash64(F.get("hashes", i), F.get("hashes", i + 1), F.get("hashes", i + 2))

    starts = F.when(F.size("hashes") > 2, F.sequence(F.lit(0), F.size("hashes") - 3)).otherwise(F.array().cast("array<int>"))
    low = F.sort_array(F.transform(starts, lambda i: F.shiftleft(window(i), PLACE_BITS).bitwiseOR(i.cast("long"))))
    out = out.select("*", F.size("hashes").cast("long").alias("n_words"), low.alias("low"))
    nexts = F.when(F.size("low") > 1, F.sequence(F.lit(0), F.size("low") - 2)).otherwise(F.array().cast("array<int>"))
    alike = F.filter(nexts, lambda i: F.shiftright(F.get("low", i).bitwiseXOR(F.get("low", i + 1)), PLACE_BITS) == 0)
    candidates = F.array_distinct(F.flatten(F.transform(alike, lambda i: F.array(F.get("low", i), F.get("low", i + 1)))))
    places = F.transform(candidates, lambda x: x.bitwiseAND(F.lit((1 << PLACE_BITS) - 1)).cast("int"))
    whole = F.sort_array(F.transform(places, lambda i: F.struct(window(i).alias("h"), i.alias("i"))))
    out = out.select("*", whole.alias("whole")).drop("low")
    repeated = F.filter("whole", lambda w, i: _near("whole", i, lambda y: y["h"], w["h"]))
    out = out.select("*", F.sort_array(F.transform(repeated, lambda w: w["i"])).alias("at")).drop("whole")
    covered = F.transform("at", lambda p, i: F.least(F.lit(3), F.coalesce(F.get("at", i + 1) - p, F.lit(3))).cast("long"))
    return out.select(
        "row",
        "hashes",
        "n_words",
        "word_chars",
        "n_symbols",
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.aggregate(covered, F.lit(0).cast("long"), lambda a, b: a + b).alias("n_repeat_words"),
    )


RULES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "score", "kept")


def judge(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text", keep_text: bool = True) -> DataFrame:
    """Every row with its counts, ``base_failed``, ``score`` and ``kept``; without its text if ``keep_text`` is off.

    A null or empty text has no words: it fails the base rules, and its score is 0. Without documents or
    without trusted ones all ratios are 0 and the base rules alone decide. Repeated rows and null ids
    are judged by their own text; columns named as those added here are replaced by them.
    """
    scores = scored(docs, labels, id_column, text_column, keep_text)
    kept = ~F.col("base_failed") & (F.col("score") >= threshold_of(scores, labels))
    return scores.select("row.*", *RULES[:-1], kept.alias("kept"))
