"""Siblings of wrappers are aligned exactly, however many there are."""

from __future__ import annotations

import random

import pytest

from jobtide.llm import wrappers


def nodes(labels):
    return [[label, label, [], "", [], 0] for label in labels]


def longest(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(new[j], row[j + 1]))
        row = new
    return row[-1]


@pytest.mark.parametrize(("n", "m", "kinds"), [(40, 30, 5), (520, 510, 40), (700, 600, 10_000)])
def test_siblings_are_aligned_by_the_longest_common_sequence_at_any_size(n, m, kinds):
    draw = random.Random(n)
    a, b = [[f"x{draw.randrange(kinds)}" for _ in range(k)] for k in (n, m)]
    common = wrappers.Common(a, b)
    i = j = shared = 0
    while i < n or j < m:
        if i < n and j < m and a[i] == b[j]:
            i, j, shared = i + 1, j + 1, shared + 1
        elif j == m or i < n and common.without_first(i, j):
            i += 1
        else:
            j += 1
    assert shared == longest(a, b)


def test_neither_side_of_a_long_alignment_is_lost():
    a = [f"a{k}" for k in range(600)] + ["main"]
    b = [f"b{k}" for k in range(500)] + ["main"]
    out = wrappers.aligned(nodes(a), nodes(b), False)
    assert {x[0] for x in out} == {*a, *b}
    assert [x[3] for x in out if x[0] == "main"] == [""]
    assert {x[3] for x in out if x[0] != "main"} == {"?"}
