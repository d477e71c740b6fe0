"""Which coordinates, and so which chunks, filters leave.

Along each dimension, filters leave a set of closed intervals; a chunk is read if
it meets one in every dimension. Filters are conjunctions, and each intersects its
dimension's set, which is at least as tight as testing chunks by each filter.
"""

from __future__ import annotations

import math
from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np

from gridframe.functions.dtypes import literal

Intervals = tuple[tuple[int, int], ...]


def united(spans: Iterable[tuple[int, int]]) -> Intervals:
    """The same coordinates in disjoint intervals, ascending."""
    out: list[list[int]] = []
    for low, high in sorted(s for s in spans if s[0] <= s[1]):
        if out and low <= out[-1][1] + 1:
            out[-1][1] = max(out[-1][1], high)
        else:
            out.append([low, high])
    return tuple((p, q) for p, q in out)


def intersected(a: Intervals, b: Iterable[tuple[int, int]]) -> Intervals:
    other = list(b)
    return united((max(p, r), min(q, s)) for p, q in a for r, s in other)


def admitted(op: str, value: object, last: int) -> list[tuple[int, int]] | None:
    """Intervals of 0..last that a filter leaves; None for a filter that can't be told."""
    if op == "is_null":
        return []
    if op == "is_not_null":
        return [(0, last)]
    if op == "in":
        points = {literal(v) for v in value if v is not None}
        return [(int(v), int(v)) for v in sorted(points) if v == math.floor(v)]
    if value is None:
        return []
    v = literal(value)
    if isinstance(v, bool) or not isinstance(v, int | float):
        return None
    if isinstance(v, float) and not math.isfinite(v):
        return None
    whole = v == math.floor(v)
    if op == "eq":
        return [(int(v), int(v))] if whole else []
    if op == "ne":
        return [(0, int(v) - 1), (int(v) + 1, last)] if whole else [(0, last)]
    low, high = math.floor(v), math.ceil(v)
    return {"lt": [(0, high - 1)], "le": [(0, low)], "gt": [(low + 1, last)], "ge": [(high, last)]}.get(op)


@dataclass(frozen=True)
class Selection:
    """The intervals that are left along each dimension of `shape`."""

    shape: tuple[int, ...]
    intervals: tuple[Intervals, ...]

    @classmethod
    def whole(cls, shape: tuple[int, ...]) -> Selection:
        return cls(shape, tuple(((0, n - 1),) if n else () for n in shape))

    def narrowed(self, dim: int, ranges: Iterable[tuple[int, int]]) -> Selection:
        new = list(self.intervals)
        new[dim] = intersected(new[dim], list(ranges))
        return Selection(self.shape, tuple(new))

    def filtered(self, dim: int, op: str, value: object) -> Selection:
        found = admitted(op, value, self.shape[dim] - 1)
        return self if found is None else self.narrowed(dim, found)

    def chunk_ranges(self, chunks: tuple[int, ...]) -> tuple[tuple[tuple[int, int], ...], ...]:
        """Along each dimension the ranges (first, one past the last) of chunk indices that are left."""
        out = []
        for spans, c in zip(self.intervals, chunks, strict=True):
            merged: list[list[int]] = []
            for low, high in spans:
                first, stop = low // c, high // c + 1
                if merged and first <= merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], stop)
                else:
                    merged.append([first, stop])
            out.append(tuple((a, b) for a, b in merged))
        return tuple(out)

    def within(self, dim: int, start: int, size: int) -> np.ndarray | slice:
        """Which of `size` places from `start` on are left: a slice where they are in one piece."""
        parts = [(max(a, start) - start, min(b, start + size - 1) - start + 1) for a, b in self.intervals[dim]]
        parts = [(a, b) for a, b in parts if a < b]
        if len(parts) == 1:
            return slice(*parts[0])
        return np.concatenate([np.arange(a, b) for a, b in parts]) if parts else np.zeros(0, np.int64)


@dataclass(frozen=True)
class ChunkSet:
    """A product of chunk index ranges, addressed by flat position: never listed as a whole."""

    ranges: tuple[tuple[tuple[int, int], ...], ...]

    @property
    def sizes(self) -> tuple[int, ...]:
        return tuple(sum(b - a for a, b in spans) for spans in self.ranges)

    def __len__(self) -> int:
        return math.prod(self.sizes)

    def coords(self, position: int) -> tuple[int, ...]:
        out = []
        for spans, n in zip(reversed(self.ranges), reversed(self.sizes), strict=True):
            position, k = divmod(position, n)
            for a, b in spans:
                if k < b - a:
                    out.append(a + k)
                    break
                k -= b - a
        return tuple(reversed(out))
