"""Words of many texts at once: their places and 64-bit hashes, without a loop over words or texts.

A word's hash is a polynomial in its bytes, each replaced by a random 64-bit number, taken from running
sums over the whole buffer, so that equal words hash alike wherever they stand.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

from jobtide.llm.chunk_bpe import mixed

#: Bytes that are hashed together; a longer text is a buffer of its own.
BUFFER = 1 << 20
_STEP = np.uint64(0x9E3779B97F4A7C15)
_BASE = np.uint64(0xD1342543DE82EF95)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_BYTES = mixed(np.arange(1, 257, dtype=np.uint64) * _STEP)


class _Powers:
    """Powers of an odd number and of its inverse, as many as the longest buffer so far needs."""

    def __init__(self):
        self.up = self.down = np.ones(0, dtype=np.uint64)

    def upto(self, n: int) -> None:
        if n > len(self.up):
            size = max(n, BUFFER)
            with np.errstate(over="ignore"):
                self.up, self.down = (
                    np.cumprod(np.concatenate([[np.uint64(1)], np.full(size - 1, base)]), dtype=np.uint64)
                    for base in (_BASE, _INVERSE)
                )


_powers = _Powers()


def table(blanks: bytes) -> np.ndarray:
    """Which bytes stand between words."""
    out = np.zeros(256, dtype=bool)
    out[list(blanks)] = True
    return out


def words(data: bytes, blank: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where each word starts and ends, and its hash."""
    view = np.frombuffer(data, dtype=np.uint8)
    gap = np.ones(len(view) + 2, dtype=bool)
    gap[1:-1] = blank[view]
    edges = np.flatnonzero(gap[1:] != gap[:-1])
    starts, ends = edges[0::2], edges[1::2]
    _powers.upto(len(view) + 1)
    sums = np.zeros(len(view) + 1, dtype=np.uint64)
    with np.errstate(over="ignore"):
        np.cumsum(_BYTES[view] * _powers.up[: len(view)], out=sums[1:])
        hashes = (sums[ends] - sums[starts]) * _powers.down[starts]
        return starts, ends, mixed(hashes + (ends - starts).astype(np.uint64) * _STEP)


def joined(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """A hash of two hashes in their order."""
    with np.errstate(over="ignore"):
        return mixed(left * _STEP + right)


def buffers(texts: list[bytes], gap: bytes = b"\n") -> Iterator[tuple[int, bytes, np.ndarray]]:
    """Texts joined by a blank up to :data:`BUFFER` bytes: number of the first, the bytes, where each ends."""
    held, size, first = [], 0, 0
    for i, text in enumerate(texts):
        if held and size + len(text) > BUFFER:
            yield first, gap.join(held), np.cumsum([len(t) + 1 for t in held]) - 1
            held, size, first = [], 0, i
        held.append(text)
        size += len(text) + 1
    if held:
        yield first, gap.join(held), np.cumsum([len(t) + 1 for t in held]) - 1
