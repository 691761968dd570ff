"""T-occurrence search: which numbers stand in at least so many of some sorted lists.

DivideSkip: the longest lists are set aside. The short ones are merged by a heap whose lists jump, by
binary search, to the next number that can still reach what the long lists cannot add. A number that
does is looked up in the long lists one by one, until it has enough or cannot have enough any more.
"""

from __future__ import annotations

import heapq
import math
from bisect import bisect_left
from collections.abc import Iterator, Sequence

#: Weight of a binary search in a long list against a step in a short one.
PROBE_WEIGHT = 0.0085


def set_aside(lists: Sequence[Sequence[int]], needed: int) -> int:
    """How many of the longest lists are probed instead of merged."""
    longest = max(map(len, lists), default=0)
    return min(needed - 1, int(needed / (PROBE_WEIGHT * math.log2(longest + 1) + 1))) if longest else 0


def occurrences(lists: Sequence[Sequence[int]], needed: int) -> Iterator[tuple[int, int]]:
    """Each number in at least ``needed`` (one or more) of the sorted lists, and in how many it is."""
    lists = sorted((part for part in lists if len(part)), key=len)
    if len(lists) < needed:
        return
    aside = set_aside(lists, needed)
    short, long = lists[: len(lists) - aside], lists[len(lists) - aside :]
    least = needed - aside
    at = [0] * len(short)
    heap = [(part[0], k) for k, part in enumerate(short)]
    heapq.heapify(heap)
    while len(heap) >= least:
        number, taken = heap[0][0], []
        while heap and heap[0][0] == number:
            taken.append(heapq.heappop(heap)[1])
        if len(taken) >= least:
            count, left = len(taken), len(long)
            for part in long:
                if count + left < needed:
                    break
                place = bisect_left(part, number)
                count += place < len(part) and part[place] == number
                left -= 1
            if count >= needed:
                yield number, count
            target = number + 1
        else:
            while heap and len(taken) < least - 1:
                taken.append(heapq.heappop(heap)[1])
            if not heap:
                return
            target = heap[0][0]
        for k in taken:
            at[k] = bisect_left(short[k], target, at[k])
            if at[k] < len(short[k]):
                heapq.heappush(heap, (short[k][at[k]], k))
