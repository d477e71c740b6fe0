"""The Spark data source `gridframe`: relations groups, arrays, chunks and cells of a store.

Options: path (or store), kind (cells unless told otherwise), array, version, columns, dim_ranges,
boxes, partitions, pushed. Cells are read in parallel: a partition is a run of chunk files in
storage order, and a task reads only the files that filters leave. With `pushed`, filters on
dimensions prune chunks and cut cells; all filters go back to Spark, which tests them again.
Nothing is read of a chunk that is pruned, not even whether it exists.

Spark 4.1 keeps one plan of partitions for a loaded relation, that of the filters it
pushed last, and uses it for every scan of the relation. So pruning is bound to a relation:

* `boxes` (what the functions' `where` becomes) is part of the relation itself and no later
  filter changes it;
* a SQL view names a table, which each statement loads anew: its pushes are its own;
* within one loaded relation (a statement that reads a view twice, a DataFrame that is used
  twice) each push plans for all that was pushed for it so far, so the latest plan covers
  every scan, and Spark's own filters choose the rows. What was pushed is kept in the folder
  `pushed` of the driver's machine, where Spark plans, and goes with the application;
* a scan without any filter would push nothing. The DataFrame functions and views
  therefore add `dim_0 IS NOT NULL`, which is always pushed. A relation loaded without
  them has no such filter, and so no pushing unless it names a folder.
"""

from __future__ import annotations

import fcntl
import json
import math
import os
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, replace

import pyarrow as pa
from pyspark.sql import types as T
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    EqualTo,
    Filter,
    GreaterThan,
    GreaterThanOrEqual,
    In,
    InputPartition,
    IsNotNull,
    IsNull,
    LessThan,
    LessThanOrEqual,
    Not,
)

from gridframe.functions import dtypes
from gridframe.plans import layout
from gridframe.plans.metadata import StoreError
from gridframe.plans.regions import Region
from gridframe.sources import scan
from gridframe.sources.discovery import Listing, discover
from gridframe.sources.stores import open_store

#: Decoded bytes of a cells partition, and chunk files that a task of the chunks relation looks for, at most.
PARTITION_BYTES, PARTITION_FILES = 128 << 20, 10_000


@dataclass
class Run(InputPartition):
    """Flat positions start..stop - 1 of what `source` (a scan, or an array's number) counts."""

    source: object
    start: int
    stop: int


@dataclass
class Folders(InputPartition):
    """Folders of chunk files of the array with this number; None for the array's own. Of its files, this share (see `listed_chunks`)."""

    array: int
    folders: tuple[str, ...] | None
    share: tuple[int, int] = (0, 1)


def runs(source: object, n: int, parts: int) -> list[Run]:
    """n positions in at most `parts` runs of like length."""
    parts = max(1, min(parts, n))
    return [Run(source, n * k // parts, n * (k + 1) // parts) for k in range(parts)] if n else []


class Pushed:
    """The regions pushed for one loaded relation, joined: a small file in a folder of the driver's machine."""

    def __init__(self, folder: str) -> None:
        self.path = os.path.join(folder, f"{uuid.uuid4().hex}.json")

    def joined(self, new: Region) -> Region:
        """The new region widened to cover the ones before, and recorded."""
        with open(self.path, "a+") as f:
            fcntl.flock(f, fcntl.LOCK_EX)
            f.seek(0)
            known = f.read()
            both = (scan.boxes_of(new.shape, known) | new) if known else new
            f.truncate(0)
            f.write(scan.boxes_text(both))
        return both


class GridframeSource(DataSource):
    def __init__(self, options: dict[str, str]) -> None:
        super().__init__(options)
        folder = options.get("pushed")
        self.pushed = Pushed(folder) if folder else None

    @classmethod
    def name(cls) -> str:
        return "gridframe"

    def _option(self, name: str, default: str | None = None) -> str | None:
        return self.options.get(name, default)

    @property
    def store(self) -> str | None:
        """`path`, or `store` where a catalog would take the path for a table's own folder."""
        return self._option("store") or self._option("path")

    @property
    def kind(self) -> str:
        kind = self._option("kind", "cells").lower()
        if kind not in ("groups", "arrays", "chunks", "cells"):
            raise StoreError(f"kind must be groups, arrays, chunks or cells, not {kind}")
        return kind

    def listing(self) -> Listing:
        return discover(self.store, self._option("version"), f"zarr_{self.kind}")

    def cells(self) -> scan.CellScan:
        if self.store is None or self._option("array") is None:
            raise StoreError("zarr_cells needs the paths of a store and of an array, neither NULL")
        return scan.cell_scan(self.listing(), self._option("array"), self._option("columns"), self._option("dim_ranges"), self._option("boxes"))

    def schema(self) -> T.StructType:
        if self.kind != "cells":
            return {"groups": scan.GROUPS, "arrays": scan.ARRAYS, "chunks": scan.CHUNKS}[self.kind]
        cells = self.cells()
        whole = scan.cells_schema(cells.array)
        return T.StructType([whole[c] for c in cells.columns])

    def reader(self, schema: T.StructType) -> DataSourceReader:
        parts = int(self._option("partitions", "0"))
        return CellsReader(self.cells(), parts, self.pushed) if self.kind == "cells" else MetadataReader(self.kind, self.listing(), parts)


class MetadataReader(DataSourceReader):
    def __init__(self, kind: str, listing: Listing, parts: int) -> None:
        self.kind, self.listing, self.parts = kind, listing, parts

    def partitions(self) -> list[Run | Folders]:
        if self.kind != "chunks":
            return [Run(None, 0, 0)]
        store, out = open_store(self.listing.path), []
        for k, a in enumerate(self.listing.arrays):
            if not store.pages:
                n = math.prod(layout.counts(a.shape, a.chunks))
                out += runs(k, n, -(-n // PARTITION_FILES))
                continue
            # What is listed grows with the files that exist, not with the grid.
            top = layout.chunk_folder(a)
            names = [layout.joined(top, x) for x in store.folders(top)] if a.separator == "/" and len(a.shape) > 1 else []
            parts = min(len(names), self.parts or 8)
            # Names in one folder come one after the other, and fast; what is asked of each file is shared out.
            n = -(-math.prod(layout.counts(a.shape, a.chunks)) // PARTITION_FILES) if store.shares else 1
            shares = max(1, min(n, self.parts or 8))
            out += [Folders(k, tuple(names[i::parts])) for i in range(parts)] or [Folders(k, None, (i, shares)) for i in range(shares)]
        return out or [Run(None, 0, 0)]

    def read(self, partition: Run | Folders) -> Iterator[tuple]:
        if isinstance(partition, Folders):
            yield from scan.listed_chunks(self.listing.path, self.listing.arrays[partition.array], partition.folders, partition.share)
        elif self.kind == "groups":
            yield from scan.group_rows(self.listing)
        elif self.kind == "arrays":
            yield from scan.array_rows(self.listing)
        elif partition.source is not None:
            yield from scan.chunk_rows(self.listing.path, self.listing.arrays[partition.source], partition.start, partition.stop)


#: Spark's filters by the names that pruning knows.
_OPS = {EqualTo: "eq", LessThan: "lt", LessThanOrEqual: "le", GreaterThan: "gt", GreaterThanOrEqual: "ge", In: "in", IsNull: "is_null", IsNotNull: "is_not_null"}


class CellsReader(DataSourceReader):
    def __init__(self, cells: scan.CellScan, parts: int, pushed: Pushed | None) -> None:
        self.cells, self.parts, self.pushed = cells, parts, pushed

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        region = self.cells.region
        for f in filters:
            negated = isinstance(f, Not) and isinstance(f.child, EqualTo)
            test = f.child if negated else f
            op = "ne" if negated else _OPS.get(type(test))
            name = test.attribute[0] if op and len(test.attribute) == 1 else ""
            if name.startswith("dim_"):
                region = region.filtered(int(name[4:]), op, getattr(test, "value", None))
            yield f
        if self.pushed is not None:
            self.cells = replace(self.cells, region=self.pushed.joined(region.simple()))

    def partitions(self) -> list[Run]:
        array, n = self.cells.array, len(self.cells.parts)
        width = dtypes.parse(array.dtype).stored.itemsize
        least = -(-n * math.prod(array.chunks) * width // PARTITION_BYTES)
        # An empty list of partitions is no relation for Spark: one empty run stands for it.
        return runs(None, n, max(self.parts or 8, least)) or [Run(None, 0, 0)]

    def read(self, partition: Run) -> Iterator[pa.RecordBatch]:
        yield from self.cells.read(partition.start, partition.stop)


