"""Operators that work chunk by chunk inside one scan, and so need no exchange.

Each is a row of run numbers, one a task, and a `mapInArrow` over it that reads the chunks of its
run. What is read is bound to the DataFrame: `where` becomes a region of chunks when it is made,
and Spark tests the condition itself on the rows.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import replace
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridframe.functions import dtypes
from gridframe.operators.tables import _tasks, chosen, register, zarr_chunks
from gridframe.plans import conditions, layout
from gridframe.plans.metadata import StoreError
from gridframe.plans.pruning import Selection
from gridframe.plans.regions import Region
from gridframe.shipping import ship
from gridframe.sources import scan
from gridframe.sources.discovery import discover
from gridframe.sources.windows import WindowReader

Batches = Iterator[pa.RecordBatch]
_LONG = T.LongType()


def over_runs(spark: SparkSession, n: int, read: Callable[[int, int], Batches], schema: T.StructType, tasks: int = 0) -> DataFrame:
    """What `read` gives for runs start..stop - 1 of n positions, a task for each run."""
    ship(spark)
    parts = max(1, min(tasks or _tasks(spark), n))

    def run(batches: Batches) -> Batches:
        for b in batches:
            for k in b.column(0).to_pylist():
                yield from read(n * k // parts, n * (k + 1) // parts)

    return spark.range(0, parts, 1, parts).mapInArrow(run, schema)


def _scan(path: str | None, array: str | None, version: str | None = None) -> scan.CellScan:
    if path is None or array is None:
        raise StoreError("zarr_cells needs the paths of a store and of an array, neither NULL")
    return scan.cell_scan(discover(path, version, "zarr_cells"), array)


def _tested(df: DataFrame, where: str | Column | None, columns: Sequence[str]) -> DataFrame:
    return (df if where is None else df.where(where)).select(*columns)


def _flat(schema: T.StructType, axes: Sequence[np.ndarray], columns: Sequence[tuple[np.ndarray, dtypes.ValueType, np.ndarray | None]], keep: np.ndarray | None) -> Batches:
    """Rows of a block: coordinates, then values with their types and where they are there, of the cells to keep."""
    from pyspark.sql.pandas.types import to_arrow_schema

    shape = tuple(map(len, axes))
    arrow, chosen_ = to_arrow_schema(schema), None if keep is None else np.flatnonzero(keep.ravel())
    flat = lambda x: x.ravel() if chosen_ is None else x.ravel()[chosen_]
    wide = lambda d: np.broadcast_to(axes[d].reshape(tuple(-1 if k == d else 1 for k in range(len(axes)))), shape)
    out = [pa.array(flat(wide(d)), pa.int64()) for d in range(len(axes))]
    for values, kind, there in columns:
        made = kind.to_arrow(np.ascontiguousarray(flat(values)))
        if there is not None:
            made = pc.if_else(pa.array(flat(there)), made, pa.scalar(None, made.type))
        out.append(made)
    for at in range(0, len(out[0]), scan.BATCH):
        yield pa.RecordBatch.from_arrays([c.slice(at, scan.BATCH).cast(f.type) for c, f in zip(out, arrow, strict=True)], schema=arrow)


def _blocks(region: Region, block: tuple[int, ...]) -> tuple[int, Callable[[int], tuple[int, ...]]]:
    """How many blocks of this shape hold a cell of the region, and the origin of each."""
    found = region.chunks(block)
    return len(found), lambda k: tuple(c * b for c, b in zip(found.coords(k), block, strict=True))


def joined_cells(spark: SparkSession, arrays: Mapping[str, tuple[str, str]], how: str = "inner", where: str | Column | None = None) -> DataFrame:
    """Cells of several arrays of one rank by coordinates: dim_0, ..., and a column for each array (its name: path, array).

    how: `inner`, cells that all arrays have; `left`, those of the first; `full`, those of any, with
    null where an array has none. Chunk grids needn't agree: blocks are the chunks of the array with
    the largest, and the others' chunks are put together to them; grids that nest decode each chunk
    once. where: a condition on coordinates and on the columns; coordinates prune.
    """
    if how not in ("inner", "left", "full"):
        raise ValueError(f"how must be inner, left or full, not {how}")
    scans = {name: _scan(*place) for name, place in arrays.items()}
    shapes = [c.array.shape for c in scans.values()]
    if len({len(s) for s in shapes}) != 1:
        raise StoreError(f"arrays of different rank can't be joined by coordinates: {', '.join(arrays)}")
    shape = shapes[0] if how == "left" else tuple(map(min if how == "inner" else max, zip(*shapes, strict=True)))
    dims = [f"dim_{d}" for d in range(len(shape))]
    kinds = [dtypes.parse(c.array.dtype) for c in scans.values()]
    schema = T.StructType([*(T.StructField(d, _LONG) for d in dims), *(T.StructField(name, k.spark) for name, k in zip(scans, kinds, strict=True))])
    region = Region.whole(shape) if where is None else conditions.region_of(spark, schema, shape, where)
    block = max((layout.cell_chunks(c.array) for c in scans.values()), key=math.prod)
    n, origin_of = _blocks(region, block)
    places = [(c.root, c.array) for c in scans.values()]

    def read(start: int, stop: int) -> Batches:
        readers = [WindowReader(*p) for p in places]
        for k in range(start, stop):
            origin = origin_of(k)
            size = tuple(min(b, s - o) for b, s, o in zip(block, shape, origin, strict=True))
            found = [r.read(origin, size) for r in readers]
            there = [m for _, m in found]
            keep = _kept(region, origin, size)
            if how == "inner":
                keep = _both(keep, *there)
            elif how == "left":
                keep = _both(keep, there[0])
            elif all(m is not None for m in there):
                keep = _both(keep, np.logical_or.reduce(there))
            axes = [np.arange(o, o + s) for o, s in zip(origin, size, strict=True)]
            yield from _flat(schema, axes, [(v, kind, None if how == "inner" else m) for (v, m), kind in zip(found, kinds, strict=True)], keep)

    return _tested(over_runs(spark, n, read, schema), where, schema.names)


def _both(*masks: np.ndarray | None) -> np.ndarray | None:
    known = [m for m in masks if m is not None]
    return np.logical_and.reduce(known) if known else None


def _kept(region: Region, origin: tuple[int, ...], size: tuple[int, ...]) -> np.ndarray | None:
    """Which cells of a block are in the region; None for all."""
    out = np.zeros(size, bool)
    for part in region.parts(origin, size):
        spots = [np.arange(s)[part.within(d, o, s)] for d, (o, s) in enumerate(zip(origin, size, strict=True))]
        out[np.ix_(*spots)] = True
    return None if out.all() else out


def neighbours(
    spark: SparkSession, path: str, array: str, dim: int, shifted: Mapping[str, int | Sequence[int]] | None = None, sums: Mapping[str, tuple[int, int]] | None = None, lows: Mapping[str, tuple[int, int]] | None = None,
    highs: Mapping[str, tuple[int, int]] | None = None, where: str | Column | None = None, version: str | None = None,
) -> DataFrame:
    """Cells with what lies around them along one dimension: dim_0, ..., value and the columns asked for.

    shifted: the value so many places further (negative: before), null where there is none; a list has a
    number of places for each dimension, so that stencils of any shape can be read.
    sums, lows, highs: of the values from `before` places before to `after` places after, as
    {"around": (1, 1)}; sums of whole numbers are long, of others double. Windows are told by
    coordinates: a cell that doesn't exist adds nothing. A task reads the cells beyond its chunks'
    borders from the chunks that hold them, so nothing is exchanged, however long the dimension.
    A column may be narrower than a window: chunks as far away as the window reaches are read.
    """
    cells = _scan(path, array, version)
    shifted, sums, lows, highs = (dict(x or {}) for x in (shifted, sums, lows, highs))
    rank, kind = len(cells.array.shape), dtypes.parse(cells.array.dtype)
    if not 0 <= dim < rank:
        raise StoreError(f"array {array} has no dimension {dim}")
    if (sums or lows or highs) and (kind.kind == "b" or kind.text[1] == "b"):
        raise StoreError(f"booleans have no sums or extremes: {array}")
    total = dtypes.parse("<f8" if kind.kind == "f" else "<i8")
    if sums and kind.text[1:] == "u8":
        raise StoreError(f"sums of unsigned 64-bit values aren't supported: {array}")
    along = lambda n: tuple(n if d == dim else 0 for d in range(rank))
    offsets = {name: along(o) if isinstance(o, int) else tuple(o) for name, o in shifted.items()}
    if any(len(o) != rank for o in offsets.values()):
        raise StoreError(f"array {array} has {rank} dimensions, and a shift needs a number for each")
    spans_ = [s for x in (sums, lows, highs) for s in x.values()]
    reach = [(0,) * rank, *offsets.values(), *(along(-b) for b, _ in spans_), *(along(a) for _, a in spans_)]
    before = tuple(max(0, -min(o[d] for o in reach)) for d in range(rank))
    after = tuple(max(0, max(o[d] for o in reach)) for d in range(rank))
    own = scan.cells_schema(cells.array)
    more = [(n, kind) for n in shifted] + [(n, total) for n in sums] + [(n, kind) for n in (*lows, *highs)]
    schema = T.StructType([*own.fields, *(T.StructField(n, k.spark) for n, k in more)])
    region = Region.whole(cells.array.shape) if where is None else conditions.region_of(spark, schema, cells.array.shape, where)
    block = layout.cell_chunks(cells.array)
    n, origin_of = _blocks(region, block)
    root, of = cells.root, cells.array

    def read(start: int, stop: int) -> Batches:
        reader = WindowReader(root, of)
        for k in range(start, stop):
            origin = origin_of(k)
            size = tuple(min(b, s - o) for b, s, o in zip(block, of.shape, origin, strict=True))
            wide = tuple(s + x + y for s, x, y in zip(size, before, after, strict=True))
            values, there = reader.read(tuple(o - x for o, x in zip(origin, before, strict=True)), wide)
            if there is None:
                there = np.ones(wide, bool)
            at = lambda x, o: x[tuple(slice(b + s, b + s + n) for b, s, n in zip(before, o, size, strict=True))]  # noqa: B023, E731
            columns = [(at(values, along(0)), kind, None), *((at(values, o), kind, at(there, o)) for o in offsets.values())]
            for spans, fold, blank, as_ in ((sums, np.add, 0, total), (lows, np.fmin, _extreme(kind, True), kind), (highs, np.maximum, _extreme(kind, False), kind)):
                filled = np.where(there, values, np.array(blank, kind.stored)).astype(as_.stored) if spans else None
                for b, a in spans.values():
                    got, some = at(filled, along(-b)), at(there, along(-b))
                    for s in range(1 - b, a + 1):
                        got, some = fold(got, at(filled, along(s))), some | at(there, along(s))
                    columns.append((got, as_, some))
            axes = [np.arange(o, o + s) for o, s in zip(origin, size, strict=True)]
            own_there = at(there, along(0))
            yield from _flat(schema, axes, columns, _both(_kept(region, origin, size), None if own_there.all() else own_there))

    return _tested(over_runs(spark, n, read, schema), where, schema.names)


def _extreme(kind: dtypes.ValueType, low: bool) -> object:
    """A value that changes no minimum (`low`) or maximum."""
    if kind.kind == "f":
        return math.nan if low else -math.inf
    limits = np.iinfo(kind.stored)
    return limits.max if low else limits.min


def aggregated(spark: SparkSession, path: str, array: str, by: Mapping[str, tuple[int, int]] | None = None, where: str | Column | None = None, version: str | None = None) -> DataFrame:
    """Count, sum, min and max of the values by coordinates: the columns of `by`, then n, total, low, high.

    by: {"block": (0, 10), "dim_1": (1, 1)} groups by dim_0 div 10 and by dim_1. Chunks become partial
    results in their task, at most one row for each group that a chunk meets, and Spark merges those:
    no coordinate column is made and no cell leaves the scan. where: a condition on coordinates alone,
    which regions express exactly (AND, OR, NOT, comparisons, BETWEEN, IN). Totals of whole numbers
    are long (unsigned 64-bit: decimal), of others double; NaN counts as Spark counts it.
    Without any group the result has one row, as an aggregate without GROUP BY has.
    """
    cells = _scan(path, array, version)
    kind, by = dtypes.parse(cells.array.dtype), dict(by or {})
    if kind.text[1] == "b":
        raise StoreError(f"booleans have no sums or extremes: {array}")
    for name, (dim, width) in by.items():
        if not 0 <= dim < len(cells.array.shape) or width < 1:
            raise StoreError(f"array {array} can't be grouped by {name}: dimension {dim}, width {width}")
    if len({d for d, _ in by.values()}) != len(by):
        raise StoreError("a dimension can be grouped by once")
    region = cells.region if where is None else exact(spark, cells, where)
    sum_type = T.DoubleType() if kind.kind == "f" else T.DecimalType(38, 0) if kind.text[1:] == "u8" else _LONG
    schema = T.StructType([*(T.StructField(n, _LONG) for n in by), T.StructField("n", _LONG), T.StructField("total", sum_type), T.StructField("low", kind.spark), T.StructField("high", kind.spark)])
    block = layout.cell_chunks(cells.array)
    n, origin_of = _blocks(region, block)
    root, of, groups = cells.root, cells.array, [by[k] for k in by]

    def read(start: int, stop: int) -> Batches:
        from pyspark.sql.pandas.types import to_arrow_schema

        reader, arrow = WindowReader(root, of), to_arrow_schema(schema)
        for k in range(start, stop):
            origin = origin_of(k)
            values = reader.chunk(tuple(o // b for o, b in zip(origin, block, strict=True)))
            if values is None:
                if reader.fill is None:
                    continue
                values = np.broadcast_to(reader.fill, block)
            size = tuple(min(b, s - o) for b, s, o in zip(block, of.shape, origin, strict=True))
            for part in region.parts(origin, size):
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) if not isinstance(c, pa.Array) else c.cast(f.type) for c, f in zip(_partial(values, origin, size, part, groups, kind), arrow, strict=True)], schema=arrow)

    merged = over_runs(spark, n, read, schema).groupBy(*by) if by else over_runs(spark, n, read, schema).groupBy()
    return merged.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.sum("total").cast(sum_type).alias("total"), F.min("low").alias("low"), F.max("high").alias("high"))


def _partial(values: np.ndarray, origin: tuple[int, ...], size: tuple[int, ...], part: Selection, groups: list[tuple[int, int]], kind: dtypes.ValueType) -> list:
    """Group keys, counts, sums, minima and maxima of one chunk's selected cells."""
    axes = []
    for d, (o, s) in enumerate(zip(origin, size, strict=True)):
        left = part.within(d, o, s)
        values = values[(slice(None),) * d + (left,)]
        axes.append(np.arange(o, o + s)[left])
    keys, counts, starts = [], [], []
    for dim, width in groups:
        of, first, n = np.unique(axes[dim] // width, return_index=True, return_counts=True)
        keys.append(of)
        counts.append(n)
        starts.append(first)
    rest = tuple(d for d in range(values.ndim) if d not in {g for g, _ in groups})
    n_rest = math.prod(values.shape[d] for d in rest)
    # Sums that 64 bits may not hold are Python's: Spark then says that they overflow.
    widest = max(abs(int(values.min())), abs(int(values.max()))) if values.size and kind.kind != "f" else 0
    exact_sums = kind.text[1:] == "u8" or widest * values.size >= 2**63
    sums = values.astype(object if exact_sums else np.float64 if kind.kind == "f" else np.int64).sum(axis=rest)
    low, high = np.fmin.reduce(values, axis=rest) if rest else values, np.maximum.reduce(values, axis=rest) if rest else values
    order = sorted(range(len(groups)), key=lambda g: groups[g][0])
    for axis, g in enumerate(order):
        sums, low, high = (f.reduceat(x, starts[g], axis=axis) for f, x in ((np.add, sums), (np.fmin, low), (np.maximum, high)))
    back = tuple(order.index(g) for g in range(len(groups)))
    sums, low, high = (np.asarray(x).transpose(back).ravel() if groups else np.asarray(x).reshape(1) for x in (sums, low, high))
    grid = np.meshgrid(*keys, indexing="ij") if keys else []
    n = np.full(1, n_rest, np.int64)
    for c in counts:
        n = np.multiply.outer(n, c)
    total = [Decimal(int(x)) for x in sums] if kind.text[1:] == "u8" else [int(x) for x in sums] if exact_sums else sums
    return [*(g.ravel() for g in grid), n.ravel(), total, kind.to_arrow(np.ascontiguousarray(low)), kind.to_arrow(np.ascontiguousarray(high))]


def exact(spark: SparkSession, cells: scan.CellScan, where: str | Column) -> Region:
    """The region of a condition on coordinates. Raises where a region can't say just what the condition says."""
    found = chosen(spark, cells, where)
    if found.loose:
        raise StoreError(f"only conditions on coordinates can be tested inside the scan: {where}")
    return found


def packed_cells(spark: SparkSession, path: str, array: str, where: str | Column | None = None, version: str | None = None) -> DataFrame:
    """The rows of `zarr_cells`, of which only values leave Python: dim_0, dim_1, ..., value.

    The scan gives a box of values and its place for each chunk; coordinates are expressions over a
    value's place in it, so that Catalyst makes those that a query uses and no others, in SQL as well
    (`createOrReplaceTempView`). where: prunes chunks, as elsewhere; filters that come later don't.
    """
    cells = _scan(path, array, version)
    kind, region = dtypes.parse(cells.array.dtype), chosen(spark, cells, where)
    block = layout.cell_chunks(cells.array)
    rank = len(block)
    n, origin_of = _blocks(region, block)
    root, of = cells.root, cells.array
    schema = T.StructType([T.StructField("first", T.ArrayType(_LONG)), T.StructField("size", T.ArrayType(_LONG)), T.StructField("box", T.ArrayType(kind.spark))])

    def read(start: int, stop: int) -> Batches:
        from pyspark.sql.pandas.types import to_arrow_schema

        reader, arrow = WindowReader(root, of), to_arrow_schema(schema)
        for k in range(start, stop):
            origin = origin_of(k)
            values = reader.chunk(tuple(o // b for o, b in zip(origin, block, strict=True)))
            if values is None:
                if reader.fill is None:
                    continue
                values = np.broadcast_to(reader.fill, block)
            size = tuple(min(b, s - o) for b, s, o in zip(block, of.shape, origin, strict=True))
            for part in region.parts(origin, size):
                for spans in itertools.product(*part.intervals):
                    # A box of at most a batch's cells: whole slices along the first dimension, if it has many.
                    step = max(1, scan.BATCH // max(1, math.prod(b - a + 1 for a, b in spans[1:])))
                    for at in range(spans[0][0], spans[0][1] + 1, step) if rank else (0,):
                        box = ((at, min(at + step - 1, spans[0][1])), *spans[1:]) if rank else ()
                        chosen_ = np.ascontiguousarray(values[tuple(slice(a - o, b - o + 1) for (a, b), o in zip(box, origin, strict=True))]).ravel()
                        made = kind.to_arrow(chosen_).cast(arrow.field("box").type.value_type)
                        lists = pa.ListArray.from_arrays(pa.array([0, len(made)], pa.int32()), made)
                        yield pa.RecordBatch.from_arrays([pa.array([[a for a, _ in box]], arrow.field("first").type), pa.array([[b - a + 1 for a, b in box]], arrow.field("size").type), lists.cast(arrow.field("box").type)], schema=arrow)

    boxes = over_runs(spark, n, read, schema)
    rows = boxes.select("first", "size", F.posexplode("box").alias("at", "value"))
    dims, stride = [], F.lit(1).cast("long")
    for d in reversed(range(rank)):
        dims.insert(0, (F.col("first")[d] + F.call_function("div", F.col("at"), stride) % F.col("size")[d]).alias(f"dim_{d}"))
        stride = stride * F.col("size")[d]
    rows = rows.select(*dims, "value")
    return rows if where is None else rows.where(where)


def cell_count(spark: SparkSession, path: str, array: str, version: str | None = None) -> DataFrame:
    """The number of cells, as n: from metadata, or from the listing of chunk files where missing ones have no cells; no chunk is read but those of sharded arrays without a fill value."""
    cells = _scan(path, array, version)
    of = cells.array
    if of.fill is not None:
        register(spark)
        return spark.range(0, 1, 1, 1).select(F.lit(math.prod(of.shape)).cast("long").alias("n"))
    if of.sharding is not None:
        return aggregated(spark, path, array, version=version).select("n")
    files = zarr_chunks(spark, path, version).where(F.col("array_path") == of.path)
    n = F.lit(1).cast("long")
    for d, (size, chunk) in enumerate(zip(of.shape, of.chunks, strict=True)):
        n = n * F.least(F.lit(chunk).cast("long"), F.lit(size) - F.col("chunk_coords")[d] * chunk)
    return files.agg(F.coalesce(F.sum(n), F.lit(0)).cast("long").alias("n"))


def cells_at(spark: SparkSession, path: str, array: str, keys: DataFrame, how: str = "inner", version: str | None = None, value: str = "value") -> DataFrame:
    """`keys`, rows with dim_0, dim_1, ... and anything else, with the array's value at each one's coordinates as `value`.

    how: `inner` drops rows whose cell doesn't exist (a null coordinate, one beyond the array, a missing
    chunk without a fill value), `left` keeps them with null. The keys are sorted by chunk into ranges
    and read the array as they come: only chunks with a key are opened, and no cell is exchanged. Ranges
    are by chunk and coordinates, so that a chunk with many keys is split as well; rows that repeat all
    coordinates may be many in one range.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"how must be inner or left, not {how}")
    cells = _scan(path, array, version)
    of, root, kind = cells.array, cells.root, dtypes.parse(cells.array.dtype)
    dims = [f"dim_{d}" for d in range(len(of.shape))]
    if missing := [d for d in dims if d not in keys.columns]:
        raise StoreError(f"keys lack the columns {', '.join(missing)}")
    if value in keys.columns:
        raise StoreError(f"keys already have a column {value}")
    chunk = layout.cell_chunks(of)
    register(spark)
    order = [F.floor(F.col(d) / F.lit(c)).alias(f"__chunk_{k}") for k, (d, c) in enumerate(zip(dims, chunk, strict=True))]
    sorted_ = keys.repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), *order, *dims).sortWithinPartitions(*order, *dims) if dims else keys
    schema = T.StructType([*keys.schema.fields, T.StructField(value, kind.spark)])
    places = [keys.columns.index(d) for d in dims]

    def look(batches: Batches) -> Batches:
        reader = WindowReader(root, of)
        for b in batches:
            at = [b.column(p).cast(pa.int64()) for p in places]
            known = np.ones(b.num_rows, bool)
            spots = []
            for a, n in zip(at, of.shape, strict=True):
                known &= a.is_valid().to_numpy(zero_copy_only=False)
                spot = a.fill_null(-1).to_numpy(zero_copy_only=False)
                known &= (spot >= 0) & (spot < n)
                spots.append(spot)
            out = np.zeros(b.num_rows, kind.stored)
            rows = np.flatnonzero(known)
            if len(rows):
                of_chunk = np.stack([s[rows] // c for s, c in zip(spots, chunk, strict=True)], axis=1) if dims else np.zeros((len(rows), 0), np.int64)
                edges = np.flatnonzero((of_chunk[1:] != of_chunk[:-1]).any(axis=1)) + 1
                for part in np.split(np.arange(len(rows)), edges):
                    coords = tuple(int(x) for x in of_chunk[part[0]])
                    values = reader.chunk(coords)
                    mine = rows[part]
                    if values is not None:
                        out[mine] = values[tuple(s[mine] - k * c for s, k, c in zip(spots, coords, chunk, strict=True))]
                    elif reader.fill is not None:
                        out[mine] = reader.fill
                    else:
                        known[mine] = False
            made = kind.to_arrow(out)
            made = pc.if_else(pa.array(known), made, pa.scalar(None, made.type))
            found = pa.RecordBatch.from_arrays([*b.columns, made], names=[*b.schema.names, value])
            yield found if how == "left" else found.filter(pa.array(known))

    return sorted_.mapInArrow(look, schema)


def stacked_cells(spark: SparkSession, arrays: Mapping[str, tuple[str, str]], where: str | Column | None = None, name: str = "level") -> DataFrame:
    """Cells of several arrays of one rank and type, such as the levels of a pyramid, as one relation: `name`, dim_0, ..., value.

    All arrays' chunk files are one row of positions that tasks share evenly, whichever array is
    the largest. where: a condition on coordinates, values and the name; coordinates prune each array.
    """
    scans = {key: _scan(*place) for key, place in arrays.items()}
    schemas = {key: scan.cells_schema(c.array) for key, c in scans.items()}
    first = next(iter(schemas.values()))
    if unlike := [key for key, s in schemas.items() if s != first]:
        raise StoreError(f"arrays of different rank or type can't be stacked: {', '.join([next(iter(schemas)), *unlike])}")
    schema = T.StructType([T.StructField(name, T.StringType(), False), *first.fields])
    if where is not None:
        scans = {key: replace(c, region=c.region & conditions.region_of(spark, schema, c.array.shape, where)) for key, c in scans.items()}
    ends = list(itertools.accumulate(len(c.parts) for c in scans.values()))
    kept = list(scans.items())

    def read(start: int, stop: int) -> Batches:
        for (key, c), end in zip(kept, ends, strict=True):
            begin = end - len(c.parts)
            if start < end and stop > begin:
                for b in c.read(max(start, begin) - begin, min(stop, end) - begin):
                    yield pa.RecordBatch.from_arrays([pa.array([key] * b.num_rows, pa.string()), *b.columns], names=schema.names)

    return _tested(over_runs(spark, ends[-1] if ends else 0, read, schema), where, schema.names)


def changed_cells(spark: SparkSession, old: tuple[str, str], new: tuple[str, str], where: str | Column | None = None) -> DataFrame:
    """Cells that differ between two arrays of one rank: dim_0, ..., old, new; null where an array has no such cell.

    Where both arrays are laid out alike, chunks of equal bytes are passed over before anything is
    decoded, inner chunks of shards too. NaN is equal to NaN. where: a condition on coordinates, old and new.
    """
    a, b = _scan(*old), _scan(*new)
    if len(a.array.shape) != len(b.array.shape):
        raise StoreError(f"arrays of different rank can't be compared: {old[1]}, {new[1]}")
    shape = tuple(map(max, a.array.shape, b.array.shape))
    kinds = [dtypes.parse(c.array.dtype) for c in (a, b)]
    schema = T.StructType([*(T.StructField(f"dim_{d}", _LONG) for d in range(len(shape))), *(T.StructField(n, k.spark) for n, k in zip(("old", "new"), kinds, strict=True))])
    region = Region.whole(shape) if where is None else conditions.region_of(spark, schema, shape, where)
    block = max((layout.cell_chunks(c.array) for c in (a, b)), key=math.prod)
    n, origin_of = _blocks(region, block)
    places = [(c.root, c.array) for c in (a, b)]

    def read(start: int, stop: int) -> Batches:
        readers = [WindowReader(*p) for p in places]
        for k in range(start, stop):
            origin = origin_of(k)
            yield from _differing(readers, kinds, schema, region, origin, tuple(min(x, s - o) for x, s, o in zip(block, shape, origin, strict=True)))

    return _tested(over_runs(spark, n, read, schema), where, schema.names)


def _alike(a: WindowReader, b: WindowReader) -> bool:
    """Whether equal bytes mean equal cells in all chunks of both arrays."""
    x, y = a.array, b.array
    same = (x.shape, x.chunks, x.dtype, x.order, x.compression, x.sharding) == (y.shape, y.chunks, y.dtype, y.order, y.compression, y.sharding)
    return same and (a.fill is None) == (b.fill is None) and (a.fill is None or a.fill.tobytes() == b.fill.tobytes())


def _differing(readers: list[WindowReader], kinds: list[dtypes.ValueType], schema: T.StructType, region: Region, origin: tuple[int, ...], size: tuple[int, ...]) -> Batches:
    if _alike(*readers):
        coords = tuple(o // c for o, c in zip(origin, readers[0].shape, strict=True))
        if readers[0].raw(coords) == readers[1].raw(coords):
            return
    (x, in_x), (y, in_y) = (r.read(origin, size) for r in readers)
    differ = (x != y) & ~((x != x) & (y != y))
    if in_x is not None or in_y is not None:
        here, there = (np.ones(size, bool) if m is None else m for m in (in_x, in_y))
        differ = (differ & here & there) | (here != there)
    if differ.any():
        axes = [np.arange(o, o + s) for o, s in zip(origin, size, strict=True)]
        yield from _flat(schema, axes, [(x, kinds[0], in_x), (y, kinds[1], in_y)], _both(_kept(region, origin, size), differ))


def labelled_cells(spark: SparkSession, path: str, array: str, labels: Mapping[str, tuple[int, str, str]], where: str | Column | None = None, version: str | None = None) -> DataFrame:
    """Cells with the values of arrays of one dimension that belong to their dimensions: dim_0, ..., value and a column for each label.

    labels: {"time": (0, path, array)} gives each cell the value of that array at its dim_0, null where
    the array is shorter. The labels of a chunk's rows are read in the task that reads the chunk: no join
    and no exchange. where: a condition on coordinates, value and labels. Its conjuncts that use one
    label alone are tested first, on that label's array by Spark; only chunks along that dimension in
    which a label passes are opened. What is collected for that is one row for each of them.
    """
    cells = _scan(path, array, version)
    tags = {name: (dim, _scan(*place)) for name, (dim, *place) in labels.items()}
    shape = cells.array.shape
    for name, (dim, c) in tags.items():
        if not 0 <= dim < len(shape) or len(c.array.shape) != 1:
            raise StoreError(f"label {name} needs an array of one dimension, and a dimension of {array}")
    kind = dtypes.parse(cells.array.dtype)
    kinds = {name: dtypes.parse(c.array.dtype) for name, (_, c) in tags.items()}
    own = scan.cells_schema(cells.array)
    if clash := set(tags) & set(own.names):
        raise StoreError(f"the cells already have the columns {', '.join(sorted(clash))}")
    schema = T.StructType([*own.fields, *(T.StructField(n, kinds[n].spark) for n in tags)])
    block = layout.cell_chunks(cells.array)
    region = cells.region
    if where is not None:
        region = region & conditions.region_of(spark, schema, shape, where)
        for name, (dim, c) in tags.items():
            for alone in conditions.conjuncts_on(spark, schema, where, name):
                region = region & Region.along(shape, dim, _passing(spark, c, kinds[name], name, alone, block[dim], shape[dim]))
    n, origin_of = _blocks(region, block)
    root, of = cells.root, cells.array
    places = {name: (dim, c.root, c.array) for name, (dim, c) in tags.items()}

    def read(start: int, stop: int) -> Batches:
        reader = WindowReader(root, of)
        beside = {name: (dim, WindowReader(r, a)) for name, (dim, r, a) in places.items()}
        for k in range(start, stop):
            origin = origin_of(k)
            size = tuple(min(b, s - o) for b, s, o in zip(block, of.shape, origin, strict=True))
            values, there = reader.read(origin, size)
            columns = [(values, kind, None)]
            for name, (dim, r) in beside.items():
                tag, known = r.read((origin[dim],), (size[dim],))
                along = tuple(-1 if d == dim else 1 for d in range(len(size)))
                columns.append((np.broadcast_to(tag.reshape(along), size), kinds[name], None if known is None else np.broadcast_to(known.reshape(along), size)))
            axes = [np.arange(o, o + s) for o, s in zip(origin, size, strict=True)]
            yield from _flat(schema, axes, columns, _both(_kept(region, origin, size), there))

    return _tested(over_runs(spark, n, read, schema), where, schema.names)


def _passing(spark: SparkSession, c: scan.CellScan, kind: dtypes.ValueType, name: str, condition: str, block: int, n: int) -> list[tuple[int, int]]:
    """Intervals of a dimension of n places, whole chunks of it, outside of which a label's condition doesn't hold."""
    schema = T.StructType([T.StructField("dim_0", _LONG), T.StructField("value", kind.spark)])
    found = over_runs(spark, len(c.parts), replace(c, columns=("dim_0", "value")).read, schema)
    chunks = found.withColumnRenamed("value", name).where(condition).select(F.floor(F.col("dim_0") / block).alias("chunk")).distinct()
    spans = [(r["chunk"] * block, r["chunk"] * block + block - 1) for r in chunks.where(F.col("chunk") * block < n).collect()]
    beyond = c.array.shape[0]
    # Cells beyond the label's array, or in its missing chunks, have a null label, of which a condition may hold.
    if spark.range(1).select(F.lit(None).cast(kind.spark).alias(name)).where(condition).count():
        spans = [(0, n - 1)] if c.array.fill is None else [*spans, (beyond, n - 1)]
    return spans
