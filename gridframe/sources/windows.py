"""Rectangular windows of an array, put together from the chunks that they touch."""

from __future__ import annotations

import itertools
import math
from collections import OrderedDict
from collections.abc import Iterator

import numpy as np

from gridframe.functions import dtypes
from gridframe.plans import layout
from gridframe.plans.metadata import Array
from gridframe.sources import codecs
from gridframe.sources.stores import open_store

#: Decoded bytes, and opened shards, that a task keeps for windows that follow.
CACHE_BYTES, CACHE_SHARDS = 64 << 20, 64


class WindowReader:
    """Windows of one array. Chunks that were used last are kept, so that windows in storage order decode each about once."""

    def __init__(self, root: str, array: Array) -> None:
        self.root, self.array, self.kind = root, array, dtypes.parse(array.dtype)
        self.store = open_store(root)
        self.shape = layout.cell_chunks(array)
        self.fill = None if array.fill is None else dtypes.fill_of(array.fill, self.kind, array.path)
        self.decoded: OrderedDict[tuple[int, ...], np.ndarray | None] = OrderedDict()
        self.shards: OrderedDict[tuple[int, ...], codecs.Shard | None] = OrderedDict()
        self.last: tuple[tuple[int, ...] | None, bytes | None] = (None, None)
        self.opened = self.unpacked = 0

    def chunk(self, coords: tuple[int, ...]) -> np.ndarray | None:
        """A chunk's values (an inner chunk's, of a sharded array), or None where there is none."""
        if coords in self.decoded:
            self.decoded.move_to_end(coords)
            return self.decoded[coords]
        values = self._unpacked(self.raw(coords))
        self._keep(coords, values)
        return values

    def _keep(self, coords: tuple[int, ...], values: np.ndarray | None) -> None:
        self.decoded[coords] = values
        room = max(1, CACHE_BYTES // max(1, math.prod(self.shape) * self.kind.stored.itemsize))
        while len(self.decoded) > room:
            self.decoded.popitem(last=False)

    def _shard(self, of: tuple[int, ...]) -> codecs.Shard | None:
        if of not in self.shards:
            path = layout.chunk_path(self.array, of)
            self.shards[of] = codecs.Shard.open(self.store, path, f"{self.root}/{path}", self.array.sharding, self.array.chunks)
            self.opened += 1
            while len(self.shards) > CACHE_SHARDS:
                self.shards.popitem(last=False)
        return self.shards[of]

    def raw(self, coords: tuple[int, ...]) -> bytes | None:
        """A chunk's bytes as they are stored."""
        if coords == self.last[0]:
            return self.last[1]
        if self.array.sharding is None:
            found = self.store.get(layout.chunk_path(self.array, coords))
            self.opened += 1
        else:
            per_shard = tuple(o // i for o, i in zip(self.array.chunks, self.shape, strict=True))
            shard = self._shard(tuple(c // n for c, n in zip(coords, per_shard, strict=True)))
            found = None if shard is None else shard.inner(tuple(c % n for c, n in zip(coords, per_shard, strict=True)))
        self.last = coords, found
        return found

    def _unpacked(self, raw: bytes | None) -> np.ndarray | None:
        if raw is None:
            return None
        self.unpacked += 1
        array = self.array
        order, compression = (array.order, array.compression) if array.sharding is None else ("C", array.sharding.compression)
        return codecs.decoded(raw, self.kind.stored, self.shape, order, compression)

    def _chunks(self, wanted: list[tuple[int, ...]]) -> Iterator[tuple[tuple[int, ...], np.ndarray | None]]:
        """Chunks with their values. Inner chunks that lie side by side in a shard are one read."""
        if self.array.sharding is None:
            yield from ((c, self.chunk(c)) for c in wanted)
            return
        per_shard = tuple(o // i for o, i in zip(self.array.chunks, self.shape, strict=True))
        by_shard: dict[tuple[int, ...], list[tuple[int, ...]]] = {}
        for c in wanted:
            if c in self.decoded:
                yield c, self.chunk(c)
            else:
                by_shard.setdefault(tuple(k // n for k, n in zip(c, per_shard, strict=True)), []).append(tuple(k % n for k, n in zip(c, per_shard, strict=True)))
        for of, inner in by_shard.items():
            shard = self._shard(of)
            for c, raw in ((c, None) for c in inner) if shard is None else shard.inners(inner):
                at = tuple(o * n + k for o, n, k in zip(of, per_shard, c, strict=True))
                values = self._unpacked(raw)
                self._keep(at, values)
                yield at, values

    def read(self, origin: tuple[int, ...], size: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray | None]:
        """Values of a window, and which of them there are (None for all). The window may reach beyond the array."""
        low = [max(0, o) for o in origin]
        high = [min(n, o + s) for n, o, s in zip(self.array.shape, origin, size, strict=True)]
        out, there = np.zeros(size, self.kind.stored), np.zeros(size, bool)
        if all(a < b for a, b in zip(low, high, strict=True)):
            touched = itertools.product(*(range(a // c, (b - 1) // c + 1) for a, b, c in zip(low, high, self.shape, strict=True)))
            for coords, values in self._chunks(list(touched)):
                first = [max(a, k * c) for a, k, c in zip(low, coords, self.shape, strict=True)]
                last = [min(b, k * c + c) for b, k, c in zip(high, coords, self.shape, strict=True)]
                to = tuple(slice(a - o, b - o) for a, b, o in zip(first, last, origin, strict=True))
                if values is not None:
                    out[to] = values[tuple(slice(a - k * c, b - k * c) for a, b, k, c in zip(first, last, coords, self.shape, strict=True))]
                elif self.fill is not None:
                    out[to] = self.fill
                else:
                    continue
                there[to] = True
        return out, None if there.all() else there
