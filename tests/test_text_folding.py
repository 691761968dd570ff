"""Case folding looks up only the characters that need it."""

from __future__ import annotations

from pyspark.sql import functions as F

from jobtide.functions import text as T

WORDS = ("Straße", "ΟΔΟΣ", "οδος ΑΣ", "İstanbul", "ﬁrst ÉTÉ", "ŉ\nẞ", "ᾘ😀Ж", "plain", "", "Σ")


def test_texts_are_folded_as_python_does(spark):
    rows = spark.createDataFrame([(w,) for w in WORDS], "t string").select("t", T.fold(F.col("t")).alias("folded")).collect()
    assert {r["t"]: r["folded"] for r in rows} == {w: w.casefold() for w in WORDS}


def test_text_between_special_characters_stays_in_one_piece(spark):
    """Each piece costs a look-up: one for every character made a text of n characters cost n."""
    rows = spark.createDataFrame([("Straßenbahn und Großmarkt ÉTÉ",)], "t string")
    pieces = rows.select(F.regexp_extract_all("t", F.lit(T._pieces()), F.lit(0))).first()[0]
    assert pieces == ["Stra", "ß", "enbahn und Gro", "ß", "markt ÉTÉ"]
