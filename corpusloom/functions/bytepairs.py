"""Byte-pair merging of one piece: the helper behind every encoder here."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from heapq import heapify, heappop, heappush


def merge_pairs(parts: Sequence, rank: Callable[[object, object], int | None]) -> list:
    """Join adjacent parts (strings or bytes), the pair of lowest rank first, the leftmost of equals, until no pair has a rank.

    A heap of ranked pairs over a linked list: n log n for n parts. An entry whose parts have been joined
    to others meanwhile no longer fits and is passed over.
    """
    parts = list(parts)
    n = len(parts)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = [(r, i, parts[i], parts[i + 1]) for i in range(n - 1) if (r := rank(parts[i], parts[i + 1])) is not None]
    heapify(heap)
    while heap:
        _, i, left, right = heappop(heap)
        j = after[i]
        if parts[i] != left or j >= n or parts[j] != right:
            continue
        parts[i], parts[j], after[i] = left + right, None, after[j]
        if after[i] < n:
            before[after[i]] = i
        for a, b in ((before[i], i), (i, after[i])):
            if a >= 0 and b < n and (r := rank(parts[a], parts[b])) is not None:
                heappush(heap, (r, a, parts[a], parts[b]))
    return [p for p in parts if p is not None]
