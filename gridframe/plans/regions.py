"""Unions of boxes: what conditions with OR, NOT and several dimensions leave of an array.

A region's boxes may overlap. Chunks and cells come from disjoint parts made of them, so that
each chunk file is opened once and each cell read once; neither is ever listed as a whole.
"""

from __future__ import annotations

import bisect
import itertools
from collections.abc import Iterable
from dataclasses import dataclass

from gridframe.plans.pruning import ChunkSet, Intervals, Selection, intersected, united

#: Boxes of a region at most. More become the smallest box around them, which leaves no cell out.
MOST_BOXES = 256

Product = tuple[Intervals, ...]


def without(a: Intervals, b: Intervals) -> Intervals:
    """The coordinates of `a` that aren't in `b`."""
    out = []
    for low, high in a:
        for p, q in b:
            if q < low or p > high:
                continue
            if p > low:
                out.append((low, p - 1))
            low = q + 1
        if low <= high:
            out.append((low, high))
    return tuple(out)


def cut(a: Product, b: Product) -> list[Product]:
    """Disjoint parts of the product `a` that lie outside `b`."""
    out, rest = [], list(a)
    for d, spans in enumerate(b):
        if outside := without(rest[d], spans):
            out.append((*rest[:d], outside, *rest[d + 1 :]))
        rest[d] = intersected(rest[d], spans)
        if not rest[d]:
            break
    return out


def disjoint(products: Iterable[Product]) -> list[Product]:
    """The same places in parts of which no two share one."""
    done: list[Product] = []
    for p in products:
        parts = [p]
        for earlier in done:
            parts = [x for part in parts for x in cut(part, earlier)]
        done += parts
    return done


@dataclass(frozen=True)
class ChunkUnion:
    """Disjoint chunk sets one after another, addressed by flat position."""

    sets: tuple[ChunkSet, ...]

    def __post_init__(self) -> None:
        object.__setattr__(self, "ends", tuple(itertools.accumulate(map(len, self.sets))))

    def __len__(self) -> int:
        return self.ends[-1] if self.ends else 0

    def coords(self, position: int) -> tuple[int, ...]:
        k = bisect.bisect_right(self.ends, position)
        return self.sets[k].coords(position - (self.ends[k - 1] if k else 0))


@dataclass(frozen=True)
class Region:
    """Cells of an array of `shape` that lie in one of the boxes. A `loose` one may have more cells than what it was made for."""

    shape: tuple[int, ...]
    boxes: tuple[Selection, ...]
    loose: bool = False

    @classmethod
    def whole(cls, shape: tuple[int, ...]) -> Region:
        return cls(shape, (Selection.whole(shape),))

    @classmethod
    def nothing(cls, shape: tuple[int, ...]) -> Region:
        return cls(shape, ())

    @classmethod
    def along(cls, shape: tuple[int, ...], dim: int, spans: Iterable[tuple[int, int]]) -> Region:
        """Cells whose coordinate of one dimension is in the intervals."""
        return cls(shape, (Selection.whole(shape).narrowed(dim, spans),)).simple()

    def simple(self) -> Region:
        """The same region in fewer boxes: none empty, and those that differ in one dimension alone joined."""
        boxes = [b.intervals for b in self.boxes if all(b.intervals)]
        joined = True
        while joined:
            joined = False
            for i, j in itertools.combinations(range(len(boxes)), 2):
                apart = [d for d, (x, y) in enumerate(zip(boxes[i], boxes[j], strict=True)) if x != y]
                if len(apart) > 1:
                    continue
                if apart:
                    d = apart[0]
                    boxes[i] = (*boxes[i][:d], united([*boxes[i][d], *boxes[j][d]]), *boxes[i][d + 1 :])
                del boxes[j]
                joined = True
                break
        if many := len(boxes) > MOST_BOXES:
            boxes = [tuple(united(s for b in boxes for s in b[d]) for d in range(len(self.shape)))]
        return Region(self.shape, tuple(Selection(self.shape, b) for b in boxes), self.loose or many)

    def __or__(self, other: Region) -> Region:
        return Region(self.shape, self.boxes + other.boxes, self.loose or other.loose).simple()

    def __and__(self, other: Region) -> Region:
        both = [Selection(self.shape, tuple(intersected(x, y) for x, y in zip(a.intervals, b.intervals, strict=True))) for a in self.boxes for b in other.boxes]
        return Region(self.shape, tuple(both), self.loose or other.loose).simple()

    def narrowed(self, dim: int, ranges: Iterable[tuple[int, int]]) -> Region:
        spans = list(ranges)
        return Region(self.shape, tuple(b.narrowed(dim, spans) for b in self.boxes), self.loose)

    def filtered(self, dim: int, op: str, value: object) -> Region:
        return Region(self.shape, tuple(b.filtered(dim, op, value) for b in self.boxes), self.loose)

    def inside(self, origin: tuple[int, ...], size: tuple[int, ...]) -> Region:
        """What lies in the box of `size` at `origin`."""
        out = self
        for dim, (at, n) in enumerate(zip(origin, size, strict=True)):
            out = out.narrowed(dim, [(at, at + n - 1)])
        return Region(self.shape, tuple(b for b in out.boxes if all(b.intervals)))

    def chunks(self, chunks: tuple[int, ...]) -> ChunkUnion:
        """The chunks of this shape that hold a cell of the region, each once."""
        closed = [tuple(tuple((a, b - 1) for a, b in spans) for spans in box.chunk_ranges(chunks)) for box in self.boxes if all(box.intervals)]
        return ChunkUnion(tuple(ChunkSet(tuple(tuple((a, b + 1) for a, b in spans) for spans in p)) for p in disjoint(closed)))

    def parts(self, origin: tuple[int, ...], size: tuple[int, ...]) -> list[Selection]:
        """Disjoint selections that make up what lies in the box of `size` at `origin`."""
        return [Selection(self.shape, p) for p in disjoint(b.intervals for b in self.inside(origin, size).boxes)]
