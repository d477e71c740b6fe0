"""The relations of a store, as Arrow batches: their schemas, and the reading of a part of one."""

from __future__ import annotations

import json
import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import types as T

from gridframe.functions import dtypes
from gridframe.plans import layout
from gridframe.plans.metadata import Array, StoreError
from gridframe.plans.pruning import Selection
from gridframe.plans.regions import ChunkUnion, Region
from gridframe.sources import codecs
from gridframe.sources.discovery import Listing
from gridframe.sources.stores import Store, open_store

#: Rows of a batch at most.
BATCH = 1 << 20
#: Rows up to which batches of small chunks are put together.
GATHERED = 1 << 15
_LONGS = T.ArrayType(T.LongType(), False)


def _schema(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(n, t, False) for n, t in columns.items()])


_S, _L = T.StringType(), T.LongType()
GROUPS = _schema(store_path=_S, group_path=_S, zarr_format=_L, metadata_path=_S)
ARRAYS = _schema(store_path=_S, array_path=_S, zarr_format=_L, rank=_L, shape=_LONGS, chunk_shape=_LONGS, dtype=_S, order=_S, compressor=_S, chunk_key_encoding=_S, dimension_separator=_S, metadata_path=_S)
CHUNKS = _schema(store_path=_S, array_path=_S, chunk_key=_S, chunk_coords=_LONGS, file_path=_S, file_size_bytes=_L)


def group_rows(listing: Listing) -> list[tuple]:
    return [(listing.path, g.path, g.zarr_format, g.metadata_path) for g in listing.groups]


def array_rows(listing: Listing) -> list[tuple]:
    return [(listing.path, a.path, a.zarr_format, len(a.shape), list(a.shape), list(a.chunks), a.dtype, a.order, a.compressor, a.key_encoding, a.separator, a.metadata_path) for a in listing.arrays]


def chunk_rows(root: str, array: Array, start: int, stop: int) -> Iterator[tuple]:
    """The chunk files that exist, among flat positions of the array's chunk grid."""
    store, grid = open_store(root), layout.counts(array.shape, array.chunks)
    for position in range(start, stop):
        coords = layout.coords_at(position, grid)
        path = layout.chunk_path(array, coords)
        if (size := store.size(path)) is not None:
            yield root, array.path, layout.chunk_key(array, coords), list(coords), f"{root}/{path}", size


def listed_chunks(root: str, array: Array, folders: tuple[str, ...] | None = None, share: tuple[int, int] = (0, 1)) -> list[tuple]:
    """The chunk files that a store's listing has, below some folders or below the array's own, by coordinates.

    share: of so many like shares of the names (second) the one with this number (first).
    """
    store, found, mine = open_store(root), [], lambda path: zlib.crc32(path.encode()) % share[1] == share[0]
    for folder in (array.path,) if folders is None else folders:
        for path, size in store.files(folder) if share[1] == 1 else store.files(folder, mine):
            key = path[len(array.path) + 1 :] if array.path else path
            if (coords := layout.coords_of(array, key)) is not None:
                found.append((root, array.path, key, list(coords), f"{root}/{path}", size))
    return sorted(found, key=lambda r: r[3])


def all_chunks(root: str, array: Array) -> list[tuple] | Iterator[tuple]:
    if open_store(root).pages:
        return listed_chunks(root, array)
    return chunk_rows(root, array, 0, math.prod(layout.counts(array.shape, array.chunks)))


def cells_schema(array: Array) -> T.StructType:
    """dim_0, dim_1, ... and value. Raises where the array's cells can't be read."""
    if array.problem:
        raise StoreError(f"{array.problem}: {array.path}")
    kind = dtypes.parse(array.dtype)
    columns = {f"dim_{k}": _L for k in range(len(array.shape))} | {"value": kind.spark}
    # No cell is null. The columns may be all the same, so that Spark doesn't drop IS NOT NULL (see the data source).
    return T.StructType([T.StructField(n, t, True) for n, t in columns.items()])


def gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same rows, with batches of small chunks put together: Spark takes each batch by itself, at a cost of its own."""
    held: list[pa.RecordBatch] = []
    rows = 0
    for b in batches:
        if held and rows + b.num_rows > GATHERED:
            yield pa.concat_batches(held)
            held, rows = [], 0
        held.append(b)
        rows += b.num_rows
    if held:
        yield pa.concat_batches(held)


@dataclass(frozen=True)
class CellScan:
    """What to read of an array. `parts`: chunk files, as a product of ranges."""

    root: str
    array: Array
    region: Region
    columns: tuple[str, ...]

    @cached_property
    def parts(self) -> ChunkUnion:
        return self.region.chunks(self.array.chunks)

    def check(self) -> None:
        """Raises what can be told from metadata alone."""
        kind = dtypes.parse(self.array.dtype)
        layout.checked_size(layout.cell_chunks(self.array), kind.stored.itemsize)
        if self.array.fill is not None:
            dtypes.fill_of(self.array.fill, kind, self.array.path)

    def read(self, start: int, stop: int) -> Iterator[pa.RecordBatch]:
        """Batches of the chunk files at flat positions start..stop - 1 of `parts`, in that order."""
        store, parts = open_store(self.root), self.parts
        yield from gathered(b for position in range(start, stop) for b in self._file(store, parts.coords(position)))

    def _file(self, store: Store, coords: tuple[int, ...]) -> Iterator[pa.RecordBatch]:
        array, kind = self.array, dtypes.parse(self.array.dtype)
        path = layout.chunk_path(array, coords)
        origin = tuple(k * c for k, c in zip(coords, array.chunks, strict=True))
        if array.sharding is None:
            raw = store.get(path)
            values = None if raw is None else codecs.decoded(raw, kind.stored, array.chunks, array.order, array.compression)
            yield from self._cells(values, origin, array.chunks)
            return
        shard = codecs.Shard.open(store, path, f"{self.root}/{path}", array.sharding, array.chunks)
        if shard is None:
            yield from self._cells(None, origin, array.chunks)
            return
        inner = array.sharding.inner
        chosen = self.region.inside(origin, array.chunks).chunks(inner)
        first = tuple(o // i for o, i in zip(origin, inner, strict=True))
        within = (tuple(a - f for a, f in zip(chosen.coords(k), first, strict=True)) for k in range(len(chosen)))
        for at, raw in shard.inners(within):
            values = None if raw is None else codecs.decoded(raw, kind.stored, inner, "C", array.sharding.compression)
            yield from self._cells(values, tuple((a + f) * i for a, f, i in zip(at, first, inner, strict=True)), inner)

    def _cells(self, values: np.ndarray | None, origin: tuple[int, ...], shape: tuple[int, ...]) -> Iterator[pa.RecordBatch]:
        """The selected cells of one chunk; of a missing one the fill value, or nothing."""
        array, kind = self.array, dtypes.parse(self.array.dtype)
        if values is None:
            if array.fill is None:
                return
            values = np.broadcast_to(dtypes.fill_of(array.fill, kind, array.path), shape)
        for selection in self.region.parts(origin, shape):
            chosen, axes = values, []
            for dim, (at, size, n) in enumerate(zip(origin, shape, array.shape, strict=True)):
                left = selection.within(dim, at, min(size, n - at))
                chosen = chosen[(slice(None),) * dim + (left,)]
                axes.append(np.arange(at, at + size)[left])
            yield from self._batches(chosen, axes, kind)

    def _batches(self, values: np.ndarray, axes: list[np.ndarray], kind: dtypes.ValueType) -> Iterator[pa.RecordBatch]:
        if values.size > BATCH:
            dim = next(d for d, n in enumerate(values.shape) if n > 1)
            step = max(1, values.shape[dim] * BATCH // values.size)
            for at in range(0, values.shape[dim], step):
                cut = slice(at, at + step)
                yield from self._batches(values[(slice(None),) * dim + (cut,)], [a[cut] if d == dim else a for d, a in enumerate(axes)], kind)
            return
        if not values.size:
            return
        out = []
        for name in self.columns:
            if name == "value":
                out.append(kind.to_arrow(np.ascontiguousarray(values).ravel()))
            else:
                dim = int(name[4:])
                wide = axes[dim].reshape(tuple(-1 if d == dim else 1 for d in range(values.ndim)))
                out.append(pa.array(np.broadcast_to(wide, values.shape).ravel(), pa.int64()))
        fields = [pa.field(n, a.type) for n, a in zip(self.columns, out, strict=True)]
        yield pa.RecordBatch.from_arrays(out, schema=pa.schema(fields))


def boxes_text(region: Region) -> str:
    return json.dumps([b.intervals for b in region.boxes])


def boxes_of(shape: tuple[int, ...], text: str) -> Region:
    return Region(shape, tuple(Selection(shape, tuple(tuple((a, b) for a, b in spans) for spans in box)) for box in json.loads(text)))


def region_of(array: Array, dim_ranges: str | None = None, boxes: str | None = None) -> Region:
    region = boxes_of(array.shape, boxes) if boxes else Region.whole(array.shape)
    for dim, ranges in json.loads(dim_ranges or "{}").items():
        if not 0 <= int(str(dim).removeprefix("dim_")) < len(array.shape):
            raise StoreError(f"array {array.path} has no dimension {dim}")
        region = region.narrowed(int(str(dim).removeprefix("dim_")), [(int(a), int(b)) for a, b in ranges])
    return region


def cell_scan(listing: Listing, array_path: str, columns: str | None = None, dim_ranges: str | None = None, boxes: str | None = None) -> CellScan:
    """columns: names with commas. dim_ranges: JSON like {"0": [[2, 5], [8, 8]]}, closed ranges of coordinates. boxes: a region, as `boxes_text` gives it."""
    array = listing.array(array_path)
    names = cells_schema(array).names
    wanted = tuple(c.strip() for c in columns.split(",")) if columns else tuple(names)
    if unknown := [c for c in wanted if c not in names]:
        raise StoreError(f"unknown columns of {array_path}: {', '.join(unknown)}")
    scan = CellScan(listing.path, array, region_of(array, dim_ranges, boxes), wanted)
    scan.check()
    return scan
