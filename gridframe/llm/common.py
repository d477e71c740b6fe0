"""What several of the text operators use."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridframe.shipping import ship


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(column: pa.Array) -> list[str]:
    """A text column's values, null as the empty text."""
    return [x or "" for x in column.to_pylist()]


#: Bytes of text, and rows, that tasks hold as Python strings at a time; a longer text is held alone.
SLICE_BYTES, SLICE_ROWS = 2 << 20, 1000


def slices(batches: Iterator[pa.RecordBatch], column: str | int = "text", size: int = SLICE_BYTES, rows: int = SLICE_ROWS) -> Iterator[pa.RecordBatch]:
    """The batches in parts of about `size` bytes of text, as Python strings of a whole batch may take much memory."""
    for b in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(b.column(column)), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
        at = 0
        while at < b.num_rows:
            before = int(ends[at - 1]) if at else 0
            stop = max(at + 1, min(at + rows, int(np.searchsorted(ends, before + size, side="right"))))
            yield b.slice(at, stop - at)
            at = stop


def give_back() -> None:
    """Returns a worker's unused memory to the machine, as far as its allocators allow."""
    pa.default_memory_pool().release_unused()
    if hasattr(libc := ctypes.CDLL(None), "malloc_trim"):
        libc.malloc_trim(0)


def released(*clear: Callable[[], None]) -> Callable:
    """A function over batches, after which worker-wide caches are cleared and unused memory goes back.

    Spark keeps Python workers for later stages: what a stage leaves in them counts for all that follow.
    """

    def wrap(fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            try:
                yield from fn(batches)
            finally:
                for f in clear:
                    f()
                give_back()

        return run

    return wrap


def digest(text: str | Column) -> Column:
    """128 bits that tell a text, null as the empty one, from others."""
    return F.unhex(F.md5(F.coalesce(text if isinstance(text, Column) else F.col(text), F.lit(""))))


def keyed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the id and the text, as `doc_id` and `text`: no other column's name can clash."""
    return docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"))


def mapped(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: T.StructType) -> DataFrame:
    """`mapInArrow` with the package on the executors. Batches are as large as the session's settings say: functions take `slices` of them."""
    ship(df.sparkSession)
    return df.mapInArrow(fn, schema)


def batch(schema: T.StructType, *columns: object) -> pa.RecordBatch:
    """A record batch of `schema` from lists, NumPy arrays or Arrow arrays."""
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(schema)
    return pa.RecordBatch.from_arrays([x if isinstance(x, pa.Array) else pa.array(x, f.type) for x, f in zip(columns, arrow, strict=True)], schema=arrow)


#: Rows of ids, hashes or the like that are broadcast at most.
MAX_BROADCAST = 1_000_000


def small(df: DataFrame, most: int = MAX_BROADCAST) -> DataFrame:
    """`df`, a written table, to be broadcast if it has at most `most` rows, which are counted first; else it is joined by shuffles."""
    return F.broadcast(df) if df.count() <= most else df


def words(text: Column) -> Column:
    """The text's words: maximal runs of letters and digits, lower-cased; no words for null."""
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), "")
