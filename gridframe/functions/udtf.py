"""SQL table functions.

zarr_groups, zarr_arrays, zarr_chunks, zarr_cells and zarr take a path, and run in one task, as
Spark runs a function without a table argument: they are for metadata and small arrays. For
arrays of any size there are zarr_runs, which cuts an array into runs of chunks, and functions
made by `cells_function`, which read the runs of a table, each task those it is dealt:

    SELECT * FROM temps(TABLE(SELECT /*+ REPARTITION(24) */ * FROM zarr_runs('/data/s.zarr', 't', 24, '{"0": [[5, 9]]}')))
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import SparkSession
from pyspark.sql import types as T
from pyspark.sql.udtf import AnalyzeArgument, AnalyzeResult

from gridframe.plans.metadata import StoreError
from gridframe.sources import scan
from gridframe.sources.discovery import discover, version_of


def _rows(name: str, path: str | None, array: str | None, version: str | None) -> Iterator[tuple]:
    listing = discover(path, version, name)
    if name == "zarr_groups":
        yield from scan.group_rows(listing)
    elif name == "zarr_arrays" or (name == "zarr" and array is None):
        yield from scan.array_rows(listing)
    elif name == "zarr_chunks":
        for a in listing.arrays:
            yield from scan.all_chunks(listing.path, a)
    else:
        cells = scan.cell_scan(listing, array)
        for b in cells.read(0, len(cells.parts)):
            yield from zip(*(c.to_pylist() for c in b.columns), strict=True)


def _schema(name: str, path: str | None, array: str | None, version: str | None) -> T.StructType:
    fixed = {"zarr_groups": scan.GROUPS, "zarr_arrays": scan.ARRAYS, "zarr_chunks": scan.CHUNKS}
    if path is None:
        raise StoreError(f"{name} needs the path of a store, not NULL")
    version_of(version, name)
    if name in fixed:
        return fixed[name]
    if name == "zarr" and array is None:
        return scan.ARRAYS
    return scan.cells_schema(discover(path, version, name).array(array))


def _text(argument: AnalyzeArgument, what: str) -> str | None:
    if not argument.isConstantExpression:
        raise StoreError(f"{what} must be a constant")
    return argument.value


def table_function(name: str, cells: bool) -> type:
    """A table function. Metadata functions take (path[, version]), cells (path, array[, version]); zarr takes either."""

    class Function:
        @staticmethod
        def analyze(*args: AnalyzeArgument) -> AnalyzeResult:
            values = [_text(a, f"{name} arguments") for a in args]
            alone = name == "zarr" and len(values) == 1
            if not 1 <= len(values) <= (3 if cells else 2) or (cells and len(values) < 2 and not alone):
                raise StoreError(f"{name} takes {'path, array and an optional version' if cells else 'path and an optional version'}")
            if cells and not alone and None in values[:2]:
                raise StoreError("zarr_cells needs the paths of a store and of an array, neither NULL")
            return AnalyzeResult(_schema(name, *_split(values)))

        def eval(self, *args: str | None) -> Iterator[tuple]:
            yield from _rows(name, *_split(list(args)))

    def _split(values: list) -> tuple:
        path, *rest = values
        if cells:
            return path, rest[0] if rest else None, rest[1] if len(rest) > 1 else None
        return path, None, rest[0] if rest else None

    return Function


class Runs:
    """zarr_runs(path, array, n[, ranges[, version]]): n runs of the array's chunk files that `ranges` leave, fewer where there are fewer files.

    ranges: JSON like {"0": [[2, 5], [8, 8]]}, closed ranges of coordinates by dimension, or null.
    """

    def eval(self, path: str | None, array: str | None, n: int, ranges: str | None = None, version: str | None = None) -> Iterator[tuple]:
        if path is None or array is None:
            raise StoreError("zarr_cells needs the paths of a store and of an array, neither NULL")
        cells = scan.cell_scan(discover(path, version, "zarr_cells"), array, None, ranges)
        files = len(cells.parts)
        parts = max(1, min(n, files))
        for k in range(parts if files else 0):
            yield files * k // parts, files * (k + 1) // parts, json.dumps(json.loads(ranges)) if ranges else None


def cells_function(spark: SparkSession, name: str, path: str, array: str, version: str | None = None, columns: Sequence[str] | None = None) -> None:
    """Makes `name` a table function that reads an array's cells by the runs of its table argument.

    It takes TABLE(SELECT ... FROM zarr_runs(...)) of the same array: each task reads the runs in its
    partition, as Arrow batches, and makes only `columns`. As many tasks work as the argument has
    partitions; a REPARTITION hint sets them.
    """
    from pyspark.sql.functions import arrow_udtf

    cells = scan.cell_scan(discover(path, version, "zarr_cells"), array, ",".join(columns) if columns else None)
    whole = scan.cells_schema(cells.array)
    root, of, wanted = cells.root, cells.array, cells.columns

    class Function:
        def eval(self, runs: pa.RecordBatch) -> Iterator[pa.Table]:
            for start, stop, ranges in zip(*(runs.column(c).to_pylist() for c in ("first", "stop", "ranges")), strict=True):
                part = scan.CellScan(root, of, scan.region_of(of, ranges), wanted)
                for b in part.read(start, stop):
                    yield pa.Table.from_batches([b])

    spark.udtf.register(name, arrow_udtf(Function, returnType=T.StructType([whole[c] for c in wanted])))


def register(spark: SparkSession) -> None:
    from pyspark.sql.functions import udtf

    spark.udtf.register("zarr_runs", udtf(Runs, returnType="first bigint, stop bigint, ranges string"))

    for name, cells in (("zarr_groups", False), ("zarr_arrays", False), ("zarr_chunks", False), ("zarr_cells", True), ("zarr", True)):
        spark.udtf.register(name, udtf(table_function(name, cells)))
