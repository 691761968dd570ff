"""A monoid of alignment fragments: what a byte range holds of the groups that two tokenizers cut together.

A group ends where a token of either tokenizer ends. A range may begin and end inside groups: its fragment
holds an open prefix (the tokens up to the first common end), the closed groups, and an open suffix; or
open tokens alone, if it has no common end. A token belongs to the range it ends in. Composing the
fragments of neighbouring ranges closes the group between them; the order of composition does not matter,
so that fragments can be composed in a tree. Only the pairs of linked ids are summed up in a fragment, and
the groups' text grows with the range.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np

NO_PAIRS = np.zeros(0, dtype=np.uint64)
Tokens = tuple[list[int], list[int]]


def group_text(a: Sequence[int], b: Sequence[int]) -> bytes:
    return f"{','.join(map(str, a))}|{','.join(map(str, b))}".encode()


def group_pairs(a: Sequence[int], b: Sequence[int]) -> list[int]:
    """All pairs of ids of a group, each as one number."""
    return [x << 32 | y for x in a for y in b]


def summed(pairs: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    distinct, at = np.unique(pairs, return_inverse=True)
    return distinct, np.bincount(at, weights=None if not len(at) else counts, minlength=len(distinct)).astype(np.int64)


@dataclass
class Fragment:
    """The identity by default: an empty range."""

    prefix: Tokens = field(default_factory=lambda: ([], []))
    closed: bool = False
    groups: list[bytes] = field(default_factory=list)
    n_groups: int = 0
    pairs: np.ndarray = field(default_factory=lambda: NO_PAIRS)
    counts: np.ndarray = field(default_factory=lambda: np.zeros(0, dtype=np.int64))
    suffix: Tokens = field(default_factory=lambda: ([], []))

    def __add__(self, other: Fragment) -> Fragment:
        if not other.closed:  # open tokens alone, held as its prefix
            if not self.closed:
                return Fragment(_both(self.prefix, other.prefix))
            return Fragment(self.prefix, True, self.groups, self.n_groups, self.pairs, self.counts, _both(self.suffix, other.prefix))
        if not self.closed:
            return Fragment(_both(self.prefix, other.prefix), True, other.groups, other.n_groups, other.pairs, other.counts, other.suffix)
        a, b = _both(self.suffix, other.prefix)
        between = np.array(group_pairs(a, b), dtype=np.uint64)
        pairs = np.concatenate([self.pairs, between, other.pairs])
        counts = np.concatenate([self.counts, np.ones(len(between), dtype=np.int64), other.counts])
        middle = [group_text(a, b)] if a or b else []  # nothing is open where both end at a common end
        groups = [*self.groups, *middle, *other.groups]
        return Fragment(self.prefix, True, groups, self.n_groups + len(middle) + other.n_groups, *summed(pairs, counts), other.suffix)

    def whole(self) -> Fragment:
        """As that of a whole text, where the prefix is the first group."""
        start = Fragment(closed=True)
        return start + self if self.closed else start


def _both(left: Tokens, right: Tokens) -> Tokens:
    return left[0] + right[0], left[1] + right[1]


def fragment(a: Sequence[int], a_ends: Sequence[int], b: Sequence[int], b_ends: Sequence[int]) -> Fragment:
    """The fragment of a range from its tokens and where they end."""
    common = np.intersect1d(a_ends, b_ends)
    if not len(common):
        return Fragment((list(a), list(b)))
    cut_a = (np.searchsorted(a_ends, common) + 1).tolist()
    cut_b = (np.searchsorted(b_ends, common) + 1).tolist()
    spans = [(a[i:j], b[k:m]) for i, j, k, m in zip(cut_a, cut_a[1:], cut_b, cut_b[1:])]
    pairs = np.array([p for span in spans for p in group_pairs(*span)], dtype=np.uint64)
    return Fragment(
        (list(a[: cut_a[0]]), list(b[: cut_b[0]])),
        True,
        [group_text(*span) for span in spans],
        len(spans),
        *summed(pairs, np.ones(len(pairs), dtype=np.int64)),
        (list(a[cut_a[-1] :]), list(b[cut_b[-1] :])),
    )
