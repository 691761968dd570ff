"""Byte-level BPE on units: stretches of text that are tokenised independently of what surrounds them.

The pre-tokeniser of the byte-level vocabulary always starts a new piece at a space followed by a
character that is no white space, whatever stands before, and looks no further back. Texts can be cut
there and the parts encoded alone. The strings of added tokens are cut out before that.
"""

from __future__ import annotations

import heapq
import json
import os
import re

from jobtide.llm.common import Bounded

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

#: Fixed: where one unit ends and the next begins; the space belongs to the next.
UNIT_START = re.compile(r" (?=\S)")
UNITS_KEPT = 800_000

#: Fixed: the pieces of the byte-level pre-tokeniser, as a regular expression.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Texts on which every Unicode table agrees about letters, numbers and white space. Others are left to the library.
KNOWN = re.compile(r"[\t\n\r -~\u00a1-\u00ac\u00ae-\u024f]*\Z")


class Irregular(Exception):
    """A space stands before another white space, so that plain splitting at spaces is wrong."""


def units(text: str) -> list[str]:
    """The units after the first lack their leading space."""
    return UNIT_START.split(text)


def read_tokenizer(path: str) -> dict:
    with open(path, encoding="utf-8") as file:
        return json.load(file)


def byte_letters() -> dict[int, str]:
    """The letter that stands for each byte: itself where printable in Latin-1, else from U+0100 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(printable)]
    return {b: chr(b) for b in printable} | {b: chr(0x100 + i) for i, b in enumerate(others)}


class Merges:
    """Merge ranks over symbol numbers; counts the symbols left by merging, without token ids."""

    def __init__(self, spec: dict):
        vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
        letters = byte_letters()
        self.first = [vocab[letters[b]] for b in range(256)]
        self.rank, self.merged = {}, []
        for left, right in (m if isinstance(m, list) else m.split(" ") for m in merges):
            self.rank.setdefault(vocab[left] << 20 | vocab[right], len(self.merged))
            self.merged.append(vocab[left + right])

    def count(self, data: bytes) -> int:
        """Symbols minus merges: the lowest-rank adjacent pair, leftmost first, is merged until none is left."""
        rank, merged = self.rank, self.merged
        symbols = [self.first[b] for b in data]
        left = n = len(symbols)
        following, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [
            (r, i)
            for i in range(n - 1)
            if (r := rank.get(symbols[i] << 20 | symbols[i + 1])) is not None
        ]
        heapq.heapify(heap)
        while heap:
            r, i = heapq.heappop(heap)
            j = following[i]
            if symbols[i] < 0 or j >= n or rank.get(symbols[i] << 20 | symbols[j]) != r:
                continue  # one of the two has been merged with another since
            symbols[i], symbols[j] = merged[r], -1
            left -= 1
            k = following[i] = following[j]
            if k < n:
                before[k] = i
                if (r := rank.get(symbols[i] << 20 | symbols[k])) is not None:
                    heapq.heappush(heap, (r, i))
            h = before[i]
            if h >= 0 and (r := rank.get(symbols[h] << 20 | symbols[i])) is not None:
                heapq.heappush(heap, (r, h))
        return left


class Library:
    """Ids of units by the tokenizers library, each as little-endian unsigned 32-bit integers."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()

    def ids(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def batch(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]


_LOADED: dict[tuple, object] = {}


def loaded(kind: type, path: str):
    """One per Python worker, whatever number of tasks it runs."""
    if (kind, path) not in _LOADED:
        _LOADED[kind, path] = kind(path)
    return _LOADED[kind, path]


class Counter:
    """Token counts of whole texts with a byte-level vocabulary."""

    def __init__(self, path: str):
        import regex

        spec = read_tokenizer(path)
        self.merges = Merges(spec)
        self.library = Library(path)
        added = [t["content"] for t in spec["added_tokens"]]
        self.added = re.compile("|".join(map(re.escape, added))) if added else None
        self.pieces = regex.compile(PIECES)
        self.piece = Bounded(lambda piece: self.merges.count(piece.encode()), UNITS_KEPT)
        self.first = Bounded(self._unit, UNITS_KEPT // 10)
        self.later = Bounded(self._later, UNITS_KEPT)

    def _unit(self, unit: str) -> int:
        if KNOWN.match(unit):
            return sum(self.piece[p] for p in self.pieces.findall(unit))
        split = self.library.tokenizer.pre_tokenizer.pre_tokenize_str(unit)
        return sum(self.piece[unit[a:b]] for a, b in _whole(split, len(unit)))

    def _later(self, unit: str) -> int:
        if not unit or unit[0].isspace():
            raise Irregular
        return self._unit(" " + unit)

    def _segment(self, text: str) -> int:
        if not text:
            return 0
        try:
            first, *rest = text.split(" ")
            return self.first[first] + sum(map(self.later.__getitem__, rest))
        except Irregular:
            first, *rest = units(text)
            return self.first[first] + sum(map(self.later.__getitem__, rest))

    def count(self, text: str) -> int:
        segments = self.added.split(text) if self.added else [text]
        return len(segments) - 1 + sum(map(self._segment, segments))


def _whole(split, length: int) -> list[tuple[int, int]]:
    """The pieces' places; together they cover the unit."""
    places = [place for _, place in split]
    if "".join("." * (b - a) for a, b in places) != "." * length:
        raise ValueError("the pre-tokeniser left characters out")
    return places
