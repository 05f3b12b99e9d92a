"""Merging of adjacent parts by rank, as byte-pair encoders do: the lowest rank first, the leftmost of equals."""

from __future__ import annotations

import heapq
from collections.abc import Callable
from typing import Any

#: Parts up to which a plain scan for each merge is quicker than a heap.
SHORT = 64
#: The rank of a pair that doesn't merge.
NEVER = 1 << 60


class KeptPieces(dict):
    """A cache of what ``make`` gives for byte strings: two generations of bounded size, so frequent pieces stay.

    Results don't depend on its size. A piece longer than ``longest`` isn't kept.
    """

    def __init__(self, size: int = 300_000, longest: int = 64):
        super().__init__()
        self.size, self.longest, self.older = size, longest, {}

    def make(self, piece: bytes) -> Any:
        raise NotImplementedError

    def __missing__(self, piece: bytes) -> Any:
        made = self.older.get(piece)
        if made is None:
            made = self.make(piece)
        if len(piece) <= self.longest:
            if len(self) >= self.size:
                self.older = dict(self)
                self.clear()
            self[piece] = made
        return made


def merge(parts: list, rank: Callable[[Any, Any], int]) -> list:
    """The parts after all merges; ``rank`` gives a pair's rank or NEVER. Time is n log n for long inputs."""
    return _scan(parts, rank) if len(parts) <= SHORT else _heap(parts, rank)


def _scan(parts: list, rank: Callable[[Any, Any], int]) -> list:
    ranks = [*map(rank, parts, parts[1:]), NEVER]
    while (best := min(ranks)) != NEVER:
        i = ranks.index(best)
        parts[i] += parts.pop(i + 1)
        del ranks[i]
        if i:
            ranks[i - 1] = rank(parts[i - 1], parts[i])
        if i + 1 < len(parts):
            ranks[i] = rank(parts[i], parts[i + 1])
    return parts


def _heap(parts: list, rank: Callable[[Any, Any], int]) -> list:
    """Positions are linked both ways; a heap entry counts only while both of its parts are as they were."""
    n = len(parts)
    after, before, version = list(range(1, n + 1)), list(range(-1, n - 1)), [0] * n
    heap = [(r, i, i + 1, 0, 0) for i, r in enumerate(map(rank, parts, parts[1:])) if r != NEVER]
    heapq.heapify(heap)
    while heap:
        _, i, j, was_i, was_j = heapq.heappop(heap)
        if version[i] != was_i or version[j] != was_j:
            continue
        parts[i] += parts[j]
        parts[j] = None
        version[i] += 1
        version[j] = -1
        after[i] = after[j]
        if after[i] < n:
            before[after[i]] = i
        for a, b in ((before[i], i), (i, after[i])):
            if a >= 0 and b < n and (r := rank(parts[a], parts[b])) != NEVER:
                heapq.heappush(heap, (r, a, b, version[a], version[b]))
    return [p for p in parts if p is not None]
