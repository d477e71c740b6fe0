"""DataFrames over array stores: groups, arrays, chunks and cells.

`register(spark)` makes the data source, and the SQL table functions of the same
names, known to a session; every function here calls it.
"""

from __future__ import annotations

import atexit
import json
import shutil
import tempfile
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridframe.plans import conditions
from gridframe.plans.metadata import StoreError
from gridframe.plans.regions import Region
from gridframe.shipping import ship
from gridframe.sources import scan
from gridframe.sources.discovery import discover, version_of

_READY: set[int] = set()
_PUSHED: list[str] = []


def register(spark: SparkSession) -> None:
    """Ships the package to the executors and registers the data source and the table functions."""
    if id(spark) in _READY and "zarr_cells" in _registered(spark):
        return
    from gridframe.functions import udtf
    from gridframe.sources.datasource import GridframeSource

    ship(spark)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(GridframeSource)
    udtf.register(spark)
    _READY.add(id(spark))


def _registered(spark: SparkSession) -> set[str]:
    return {"zarr_cells"} if spark.conf.get("spark.sql.python.filterPushdown.enabled", "false") == "true" and spark.catalog.functionExists("zarr_cells") else set()


def _pushed_folder() -> str:
    """Where this application's relations keep what was pushed for them: on the driver's machine, until it ends."""
    if not _PUSHED:
        _PUSHED.append(tempfile.mkdtemp(prefix="gridframe-pushed-"))
        atexit.register(shutil.rmtree, _PUSHED[0], ignore_errors=True)
    return _PUSHED[0]


def _tasks(spark: SparkSession) -> int:
    return 3 * spark.sparkContext.defaultParallelism


def _load(spark: SparkSession, kind: str, path: str | None, version: str | None, **options: str | None) -> DataFrame:
    if path is None:
        raise StoreError(f"zarr_{kind} needs the path of a store, not NULL")
    version_of(version, f"zarr_{kind}")
    register(spark)
    known = {k: v for k, v in (options | {"version": version}).items() if v is not None}
    return spark.read.format("gridframe").options(kind=kind, path=path, partitions=str(_tasks(spark)), **known).load()


def zarr_groups(spark: SparkSession, path: str, version: str | None = None) -> DataFrame:
    """One row per group: store_path, group_path, zarr_format, metadata_path."""
    return _load(spark, "groups", path, version)


def zarr_arrays(spark: SparkSession, path: str, version: str | None = None) -> DataFrame:
    """One row per array, with its shape, chunk shape, type, order, compressor and key encoding."""
    return _load(spark, "arrays", path, version)


def zarr_chunks(spark: SparkSession, path: str, version: str | None = None) -> DataFrame:
    """One row per chunk file that exists: its key, coordinates, path and size."""
    return _load(spark, "chunks", path, version)


def chosen(spark: SparkSession, cells: scan.CellScan, where: str | Column | None) -> Region:
    """The cells of a scan's array that a condition can hold for."""
    return cells.region if where is None else cells.region & conditions.region_of(spark, scan.cells_schema(cells.array), cells.array.shape, where)


def zarr_cells(
    spark: SparkSession, path: str, array: str, version: str | None = None, columns: Sequence[str] | None = None, dim_ranges: Mapping[int, Sequence[tuple[int, int]]] | None = None,
    where: str | Column | None = None,
) -> DataFrame:
    """One row per cell: dim_0, dim_1, ..., value.

    columns: only these are made (Spark's own column pruning stops above the scan).
    dim_ranges: closed ranges of coordinates by dimension.
    where: a condition, in SQL or as a Column. Only chunks that it can hold for are opened: it may
    have OR, NOT, IN and coordinates with constants added. What it leaves belongs to this
    DataFrame, whatever filters follow; filters that follow prune a DataFrame without `where`.
    """
    if path is None or array is None:
        raise StoreError("zarr_cells needs the paths of a store and of an array, neither NULL")
    ranges = json.dumps({str(k): [list(r) for r in v] for k, v in dim_ranges.items()}) if dim_ranges else None
    if where is None:
        cells = _load(spark, "cells", path, version, array=array, columns=",".join(columns) if columns else None, dim_ranges=ranges, pushed=_pushed_folder())
        return cells.where(F.col(cells.columns[0]).isNotNull())
    found = scan.cell_scan(discover(path, version, "zarr_cells"), array, ",".join(columns) if columns else None, ranges)
    schema = scan.cells_schema(found.array)
    used = conditions.named(spark, schema, where)
    read = [c for c in schema.names if c in found.columns or c in used]
    cells = _load(spark, "cells", path, version, array=array, columns=",".join(read), boxes=scan.boxes_text(chosen(spark, found, where)))
    return cells.where(where).select(*found.columns)


def zarr(spark: SparkSession, path: str, array: str | None = None, version: str | None = None) -> DataFrame:
    """`zarr_arrays` of a store, or with an array `zarr_cells` of it."""
    return zarr_arrays(spark, path) if array is None else zarr_cells(spark, path, array, version)


def cells_view(spark: SparkSession, name: str, path: str, array: str, version: str | None = None, columns: Sequence[str] | None = None) -> None:
    """A temporary view of an array's cells, pruned by filters in SQL.

    The view names a table of the session's catalog, which each statement loads for itself: what one
    statement's filters leave is no other's concern. `drop_view` removes both.
    """
    if path is None or array is None:
        raise StoreError("zarr_cells needs the paths of a store and of an array, neither NULL")
    cells = scan.cell_scan(discover(path, version, "zarr_cells"), array, ",".join(columns) if columns else None)
    register(spark)
    known = {"kind": "cells", "store": path, "array": array, "columns": ",".join(cells.columns), "version": version, "partitions": str(_tasks(spark)), "pushed": _pushed_folder()}
    table = f"gridframe_{uuid.uuid4().hex}"
    options = ", ".join(f"`{k}` = {_quoted(v)}" for k, v in known.items() if v is not None)
    spark.sql(f"CREATE TABLE {table} USING gridframe OPTIONS ({options})")
    # Spark gives a scan the options of the statement, not the table's.
    spark.sql(f"CREATE OR REPLACE TEMPORARY VIEW `{name}` AS SELECT * FROM {table} WITH ({options}) WHERE `{cells.columns[0]}` IS NOT NULL")
    _VIEWS.setdefault(name, []).append(table)


_VIEWS: dict[str, list[str]] = {}


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def drop_view(spark: SparkSession, name: str) -> None:
    """Removes a view of `cells_view` and the tables that it has named."""
    spark.catalog.dropTempView(name)
    for table in _VIEWS.pop(name, ()):
        spark.sql(f"DROP TABLE IF EXISTS {table}")


def cells_function(spark: SparkSession, name: str, path: str, array: str, version: str | None = None, columns: Sequence[str] | None = None) -> None:
    """A SQL table function for an array of any size, which reads runs of chunks that zarr_runs lists, in many tasks."""
    from gridframe.functions import udtf

    if path is None or array is None:
        raise StoreError("zarr_cells needs the paths of a store and of an array, neither NULL")
    register(spark)
    udtf.cells_function(spark, name, path, array, version, columns)
