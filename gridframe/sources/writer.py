"""Writes array stores, for tests and for the registered queries. Not a sink for users.

Metadata is written by the driver; an array's cells by Spark: rows are sorted by the
chunk file that they belong to, and each chunk becomes one file, written whole and
renamed. A task holds one chunk, whatever the array's size.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridframe.functions import dtypes
from gridframe.plans import layout, metadata
from gridframe.plans.metadata import Array
from gridframe.shipping import ship
from gridframe.sources import codecs
from gridframe.sources.stores import ArrowStore, LocalStore, open_store


def store_at(path: str) -> LocalStore | ArrowStore:
    return open_store(path)


def _put(path: str, at: str, doc: dict) -> None:
    store_at(path).write(at, json.dumps(doc).encode())


def v2_array(path: str, name: str, shape: tuple, chunks: tuple, dtype: str, order: str = "C", compressor: dict | None = None, fill: object = None, separator: str | None = None) -> dict:
    doc = {"zarr_format": 2, "shape": list(shape), "chunks": list(chunks), "dtype": dtype, "order": order, "compressor": compressor, "fill_value": fill, "filters": None}
    doc |= {"dimension_separator": separator} if separator else {}
    _put(path, layout.joined(name, ".zarray"), doc)
    return doc


def v2_group(path: str, name: str = "") -> dict:
    _put(path, layout.joined(name, ".zgroup"), doc := {"zarr_format": 2})
    return doc


def consolidate(path: str, groups: dict[str, dict], arrays: dict[str, dict]) -> None:
    entries = {layout.joined(n, ".zgroup"): d for n, d in groups.items()} | {layout.joined(n, ".zarray"): d for n, d in arrays.items()}
    _put(path, ".zmetadata", {"zarr_consolidated_format": 1, "metadata": entries})


def v3_group(path: str, name: str = "") -> None:
    _put(path, layout.joined(name, "zarr.json"), {"zarr_format": 3, "node_type": "group"})


BYTES = {"name": "bytes", "configuration": {"endian": "little"}}


def sharding(inner: tuple, codecs_: list[dict], at: str = "end", crc: bool = True) -> dict:
    index = [BYTES, *([{"name": "crc32c"}] if crc else [])]
    return {"name": "sharding_indexed", "configuration": {"chunk_shape": list(inner), "codecs": codecs_, "index_codecs": index, "index_location": at}}


def blosc(shuffle: str, typesize: int) -> dict:
    return {"name": "blosc", "configuration": {"cname": "zstd", "clevel": 5, "shuffle": shuffle, "typesize": typesize, "blocksize": 0}}


def v3_array(path: str, name: str, shape: tuple, chunks: tuple, data_type: str, codecs_: list[dict] | None = None, fill: object = None, encoding: str = "default", separator: str | None = None) -> None:
    key = {"name": encoding} | ({"configuration": {"separator": separator}} if separator else {})
    grid = {"name": "regular", "configuration": {"chunk_shape": list(chunks)}}
    _put(path, layout.joined(name, "zarr.json"), {"zarr_format": 3, "node_type": "array", "shape": list(shape), "data_type": data_type, "chunk_grid": grid, "chunk_key_encoding": key, "fill_value": fill, "codecs": codecs_ or [BYTES]})


def node(path: str, name: str) -> Array:
    """An array's metadata as a reader sees it."""
    store = store_at(path)
    for at, read in ((layout.joined(name, ".zarray"), metadata.v2_array), (layout.joined(name, "zarr.json"), metadata.v3_node)):
        if (blob := store.open(at)) is not None:
            return read(json.loads(blob.whole()), name, f"{path}/{at}")
    raise FileNotFoundError(f"{path}/{name}")


def write_chunk(path: str, array: Array, coords: tuple[int, ...], chunk: np.ndarray, present: np.ndarray | None = None) -> None:
    store_at(path).write(layout.chunk_path(array, coords), codecs.encoded(chunk, array, present))


def write_values(path: str, name: str, values: np.ndarray, skip: set[tuple[int, ...]] = frozenset()) -> None:
    """A small array from memory; chunks at the coordinates `skip` aren't written."""
    array = node(path, name)
    dtype = dtypes.parse(array.dtype).stored
    for coords in np.ndindex(*layout.counts(array.shape, array.chunks)):
        if coords not in skip:
            chunk = np.zeros(array.chunks, dtype)
            part = values[tuple(slice(k * c, (k + 1) * c) for k, c in zip(coords, array.chunks, strict=True))]
            chunk[tuple(map(slice, part.shape))] = part
            write_chunk(path, array, coords, chunk)


def stored(given: np.ndarray, kind: dtypes.ValueType, name: str) -> np.ndarray:
    """Values as the array stores them; raises ValueError for integers that its type can't hold."""
    whole = np.array([int(v) for v in given], object) if given.dtype == object and kind.kind != "b" else given
    if kind.kind in "iu" and len(whole):
        limits = np.iinfo(kind.stored)
        if whole.min() < limits.min or whole.max() > limits.max:
            raise ValueError(f"array {name} of type {kind.text} can't hold values from {whole.min()} to {whole.max()}")
    return whole.astype(kind.stored)


#: Chunk files, and cells, that are worth a task of their own.
TASK_FILES, TASK_CELLS = 256, 1 << 18


def write_cells(cells: DataFrame, path: str, name: str) -> int:
    """Writes rows (dim_0, ..., value) as the array's chunk files; chunks without rows stay absent. Gives the number of files.

    Cells of a written chunk that no row has, or one with a null value, get the fill value, or zero. Integers beyond the
    array's type raise. Chunks are dealt out by hash, and sorted in each task, which fills one after the other.
    """
    array = node(path, name)
    kind = dtypes.parse(array.dtype)
    rank = len(array.shape)
    grid = layout.counts(array.shape, array.chunks)
    chunk = F.lit(0).cast("long")
    for k in range(rank):
        chunk = chunk * grid[k] + F.floor(F.col(f"dim_{k}") / array.chunks[k])
    empty = dtypes.fill_of(array.fill, kind, name) if array.fill is not None else np.zeros((), kind.stored)

    def save(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        position, values, files = -1, None, 0

        def filled() -> int:
            """Writes the chunk that is held, now that all its rows are in it."""
            if values is None:
                return 0
            write_chunk(path, array, layout.coords_at(position, grid), values)
            return 1

        for b in batches:
            if not b.num_rows:
                continue
            positions = b.column(0).to_numpy()
            dims = [b.column(1 + k).to_numpy() % array.chunks[k] for k in range(rank)]
            given = b.column(1 + rank)
            there = np.asarray(given.is_valid())
            new = np.zeros(b.num_rows, kind.stored)
            new[there] = stored(given.drop_null().to_pandas().to_numpy(), kind, name)
            edges = [0, *(np.flatnonzero(np.diff(positions)) + 1).tolist(), b.num_rows]
            for start, stop in zip(edges, edges[1:], strict=False):
                if positions[start] != position:
                    files += filled()
                    position, values = int(positions[start]), np.full(array.chunks, empty, kind.stored)
                of = slice(start, stop) if there[start:stop].all() else start + np.flatnonzero(there[start:stop])
                values[tuple(d[of] for d in dims)] = new[of]
        files += filled()
        yield pa.RecordBatch.from_pydict({"files": pa.array([files], pa.int64())})

    spark = cells.sparkSession
    ship(spark)
    most = max(3 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    tasks = max(1, min(most, max(math.prod(grid) // TASK_FILES, math.prod(array.shape) // TASK_CELLS)))
    dims = [F.col(f"dim_{k}").cast("long").alias(f"dim_{k}") for k in range(rank)]
    dealt = cells.select(chunk.cast("long").alias("__chunk"), *dims, "value").repartition(tasks, "__chunk").sortWithinPartitions("__chunk")
    return dealt.mapInArrow(save, "files long").agg(F.sum("files")).first()[0] or 0
