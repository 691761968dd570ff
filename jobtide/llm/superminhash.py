"""Word shingles of whole texts, and their SuperMinHash signatures, for batches of documents.

Each element visits the signature's places in a random order of its own and leaves, at step ``j``, the
rank ``j + r`` with a random fraction ``r``; a place keeps the smallest rank. A place is equal in two
signatures with the sets' Jaccard similarity as probability, and as an element's ranks at all places
are correlated, the estimate varies less than with independent hashes. Once every place of a document
holds a rank below the next step, no later step can lower any, and the document is done: long texts
after a step or two. The orders are ``(a j + b) mod m`` with a prime ``m`` and random ``a`` and ``b``:
any two places are reached as by a random permutation, on which alone mean and variance rest.
"""

from __future__ import annotations

import numpy as np
import xxhash

from jobtide.llm.chunk_bpe import mixed
from jobtide.llm.common import Bounded

PLACES = 127
BANDS, ROWS = 25, 5
WORDS_KEPT = 200_000
_STEP = np.uint64(0x9E3779B97F4A7C15)

_word = Bounded(lambda word: xxhash.xxh3_64_intdigest(word), WORDS_KEPT)


def shingles(data: bytes, words: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of all runs of so many words; of the whole sequence if it is shorter.

    Words are what stands between blanks (space and U+0009 to U+000D), with A-Z lower-cased.
    """
    sequence = data.lower().split()  # of bytes: ASCII letters and these blanks only
    if not sequence:
        return np.zeros(0, dtype=np.uint64)
    w = np.fromiter(map(_word.__getitem__, sequence), dtype=np.uint64, count=len(sequence))
    words = min(words, len(w))
    with np.errstate(over="ignore"):
        h = np.full(len(w) - words + 1, words, dtype=np.uint64)
        for i in range(words):
            h = mixed(h * _STEP + w[i : len(w) - words + 1 + i])
    return np.unique(h)


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """A row of :data:`PLACES` ranks for each set, none of them empty: step in the high half, fraction in the low."""
    m = np.uint64(PLACES)
    out = np.full((len(sets), PLACES), np.iinfo(np.uint64).max, dtype=np.uint64)
    flat = out.reshape(-1)
    sizes = np.array([len(s) for s in sets])
    elements = np.concatenate(sets) if sets else np.zeros(0, dtype=np.uint64)
    owner = np.repeat(np.arange(len(sets)), sizes)
    with np.errstate(over="ignore"):
        a = mixed(elements + np.uint64(1)) % (m - np.uint64(1)) + np.uint64(1)
        b = mixed(elements + np.uint64(2)) % m
    for j in range(PLACES):
        step = np.uint64(j)
        with np.errstate(over="ignore"):
            rank = (step << np.uint64(32)) | (mixed(elements ^ (_STEP * (step + np.uint64(3)))) >> np.uint64(32))
        place = ((a * step + b) % m).astype(np.int64)
        np.minimum.at(flat, owner * PLACES + place, rank)
        open_sets = (out >> np.uint64(32)).max(axis=1) > j
        if not open_sets.any():
            break
        left = open_sets[owner]
        elements, owner, a, b = elements[left], owner[left], a[left], b[left]
    return out


def bands(signature: np.ndarray) -> np.ndarray:
    """A hash for each band of places, its number included."""
    with np.errstate(over="ignore"):
        h = np.broadcast_to(mixed(np.arange(1, BANDS + 1, dtype=np.uint64) * _STEP), (len(signature), BANDS))
        for i in range(ROWS):
            h = mixed(h * _STEP + signature[:, i : BANDS * ROWS : ROWS])
    return h.view(np.int64)


def shared(a: np.ndarray, b: np.ndarray) -> int:
    """Common elements of two sorted sets."""
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    at[at == len(b)] = len(b) - 1
    return int(np.count_nonzero(b[at] == a)) if len(b) else 0
