"""Text normalisation."""

from __future__ import annotations

import sys
from functools import cache

from pyspark.sql import Column
from pyspark.sql import functions as F


def label_key(text: Column) -> Column:
    """Case- and padding-insensitive grouping key."""
    return F.lower(F.trim(text))


@cache
def _folds() -> dict[str, str]:
    """Characters whose case folding is not their lower case, by the Unicode rules that Python has."""
    return {c: c.casefold() for c in map(chr, range(0x80, sys.maxunicode + 1)) if c.casefold() != c.lower()}


@cache
def _pieces() -> str:
    """A pattern of the characters that are looked up, each alone, and of the runs between them.

    A capital sigma is among them: its lower case depends on the letters around it, its folding does not.
    """
    ranges: list[list[int]] = []
    for code in sorted({*map(ord, _folds()), ord("Σ")}):
        if ranges and ranges[-1][1] == code - 1:
            ranges[-1][1] = code
        else:
            ranges.append([code, code])
    listed = "".join(f"{chr(first)}-{chr(last)}" for first, last in ranges)
    return f"[{listed}]|[^{listed}]+"


def fold(text: Column) -> Column:
    """Full Unicode case folding, which may lengthen a text (ß is ss); ASCII text takes the short way.

    Only the characters with a folding of their own are looked up; the text between them is lowered as a whole.
    """
    pairs = {**_folds(), "Σ": "σ"}
    table = F.create_map(*[F.lit(part) for pair in pairs.items() for part in pair])
    pieces = F.regexp_extract_all(text, F.lit(_pieces()), F.lit(0))
    folded = F.transform(pieces, lambda p: F.when(F.char_length(p) > 1, F.lower(p)).otherwise(F.coalesce(F.try_element_at(table, p), F.lower(p))))
    return F.when(text.rlike(r"\A\p{ASCII}*\z"), F.lower(text)).otherwise(F.array_join(folded, ""))


def same_text(left: Column, right: Column) -> Column:
    """Equality that ignores case."""
    return fold(left) == fold(right)


def null_if(text: Column, value: str) -> Column:
    return F.nullif(text, F.lit(value))


def not_blank(text: Column) -> Column:
    """True for text with something besides spaces; NULL stays NULL, so a filter drops it."""
    return F.trim(text) != ""


def flag(text: Column) -> Column:
    """Text flag to boolean; NULL stays NULL."""
    return text.isin("1", "true")
