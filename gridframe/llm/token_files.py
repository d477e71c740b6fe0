"""Token ids of documents in files of compressed blocks, and back.

Writing: documents are dealt by ranges of their id and sorted; each partition encodes
its texts, ends each with the end id, and cuts the stream into blocks of 4096 ids,
which are coded by `range_coder` independently of each other. A file is a Parquet
file with one row a block, in order:

    part, block     the partition and the block's place in it
    n_ids           ids in the block
    data            the block: 4 bytes magic, then little-endian unsigned 32-bit
                    numbers: version, n_ids, crc32 of the ids, crc32 of the code;
                    then the code
    docs            what the block holds of which document: doc (its place in the
                    partition), doc_id, start (ids of it before), length, total

Spark commits the files, so a lost executor's blocks are written anew and never twice.

Reading: any block decodes without its neighbours; checksums of code and ids are
verified, and a wrong one raises. Null text counts as empty: its document is the end
id alone. Rows that repeat an id are kept, in the order of their texts. Other columns
are ignored. An empty table gives an empty file set.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridframe.llm import range_coder
from gridframe.llm.common import batch, keyed, mapped, slices
from gridframe.llm.tokens import word_encoder

MAGIC, VERSION = b"GFTB", 1
#: Bytes, and rows, of texts that are encoded together.
ENCODED, ENCODED_ROWS = 4 << 20, 10_000
_HEADER = struct.Struct("<4sIIII")


def pack_block(ids: np.ndarray, code: bytes) -> bytes:
    return _HEADER.pack(MAGIC, VERSION, len(ids), zlib.crc32(ids.astype("<u4")), zlib.crc32(code)) + code


def unpack_blocks(blocks: list[bytes]) -> list[np.ndarray]:
    """The blocks' ids; raises ValueError for what is damaged."""
    heads = []
    for x in blocks:
        magic, version, n, ids_crc, code_crc = _HEADER.unpack_from(x)
        if magic != MAGIC or version != VERSION or zlib.crc32(memoryview(x)[_HEADER.size :]) != code_crc:
            raise ValueError("damaged block of token ids")
        heads.append((n, ids_crc))
    found = range_coder.decode([x[_HEADER.size :] for x in blocks], [n for n, _ in heads])
    for ids, (_, ids_crc) in zip(found, heads, strict=True):
        if zlib.crc32(ids.astype("<u4")) != ids_crc:
            raise ValueError("a block's ids do not match their checksum")
    return found


def _segments(id_field: T.StructField) -> T.ArrayType:
    numbers = [T.StructField(n, T.LongType()) for n in ("start", "length", "total")]
    return T.ArrayType(T.StructType([T.StructField("doc", T.LongType()), T.StructField("doc_id", id_field.dataType), *numbers]))


def write(docs: DataFrame, tokenizer_path: str, out: str, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Writes the documents' ids to `out`, a new folder that Spark can write to."""
    docs = keyed(docs, id_col, text_col)
    schema = T.StructType([T.StructField("part", T.LongType()), T.StructField("block", T.LongType()), T.StructField("n_ids", T.LongType()), T.StructField("data", T.BinaryType()), T.StructField("docs", _segments(docs.schema["doc_id"]))])

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, list[tuple]]]:
        encoder, parts, segments, held, doc = word_encoder(tokenizer_path), [], [], 0, 0
        for b in slices(batches, size=ENCODED, rows=ENCODED_ROWS):
            found, ends = encoder.encode_column(b.column(1))
            found = np.insert(found, ends, end_id)
            for doc_id, ids in zip(b.column(0).to_pylist(), np.split(found, ends[:-1] + np.arange(1, len(ends))), strict=True):
                at, n = 0, len(ids)
                while at < n:
                    take = min(n - at, range_coder.BLOCK - held)
                    parts.append(ids[at : at + take])
                    segments.append((doc, doc_id, at, take, n))
                    at, held = at + take, held + take
                    if held == range_coder.BLOCK:
                        yield np.concatenate(parts), segments
                        parts, segments, held = [], [], 0
                doc += 1
        if held:
            yield np.concatenate(parts), segments

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, first, group = TaskContext.get().partitionId(), 0, []

        def coded(group: list) -> pa.RecordBatch:
            codes = range_coder.encode([ids for ids, _ in group])
            numbers = list(range(first, first + len(group)))
            return batch(schema, [part] * len(group), numbers, [len(ids) for ids, _ in group], [pack_block(ids, c) for (ids, _), c in zip(group, codes, strict=True)], [[dict(zip(("doc", "doc_id", "start", "length", "total"), s, strict=True)) for s in segments] for _, segments in group])

        for x in blocks(batches):
            group.append(x)
            if len(group) == range_coder.LANES:
                yield coded(group)
                first, group = first + len(group), []
        if group:
            yield coded(group)

    mapped(docs.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text"), apply, schema).write.parquet(out)


def read_segments(spark: SparkSession, path: str) -> DataFrame:
    """One row per document and block: part, doc, doc_id, start, length, total, ids."""
    stored = spark.read.parquet(path)
    one = stored.schema["docs"].dataType.elementType
    schema = T.StructType([T.StructField("part", T.LongType()), *one.fields, T.StructField("ids", T.BinaryType())])

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, range_coder.LANES):
                b = whole.slice(at, range_coder.LANES)
                rows = []
                for part, ids, segments in zip(b.column(0).to_pylist(), unpack_blocks(b.column(1).to_pylist()), b.column(2).to_pylist(), strict=True):
                    raw, k = ids.astype("<u4").tobytes(), 0
                    for s in segments:
                        rows.append((part, *s.values(), raw[4 * k : 4 * (k + s["length"])]))
                        k += s["length"]
                yield batch(schema, *zip(*rows, strict=True))

    return mapped(stored.select("part", "data", "docs"), apply, schema)


def _moved(rows: list[int], v: int) -> int:
    """The 32-bit number v times a matrix of bits, given by rows."""
    out = 0
    while v:
        low = v & -v
        out ^= rows[low.bit_length() - 1]
        v ^= low
    return out


_ZEROS: list[list[int]] = []


def _zeros(crc: int, n: int) -> int:
    """What crc32's state `crc` becomes by n bytes of zero: by matrices for 1, 2, 4, ... bytes, each the square of the one before."""
    if not _ZEROS:
        rows = [0xEDB88320] + [1 << k for k in range(31)]  # one bit's step: x >> 1, and the polynomial for a lost bit
        for _ in range(3):
            rows = [_moved(rows, r) for r in rows]
        _ZEROS.append(rows)
        for _ in range(47):
            _ZEROS.append([_moved(_ZEROS[-1], r) for r in _ZEROS[-1]])
    k = 0
    while n and crc:
        if n & 1:
            crc = _moved(_ZEROS[k], crc)
        n, k = n >> 1, k + 1
    return crc


def joined_crc(parts: list[tuple[int, int]]) -> int:
    """The crc32 of joined byte strings, from each one's (crc32, number of bytes)."""
    crc = 0
    for c, n in parts:
        crc = _zeros(crc, n) ^ c
    return crc


def summary(spark: SparkSession, path: str) -> DataFrame:
    """One row per document, from the files: doc_id, start (ids of all documents before it), n_tokens, ids_crc32.

    Where a partition's ids begin follows from the partitions' totals, one number for
    each. Only documents that lie in several blocks are brought together, as checksums.
    """
    totals = spark.read.parquet(path).groupBy("part").agg(F.sum("n_ids").alias("n")).orderBy("part").collect()
    begins = np.concatenate([[0], np.cumsum([r["n"] for r in totals])]).tolist()
    offsets = spark.createDataFrame([(r["part"], int(b)) for r, b in zip(totals, begins)], "part long, offset long")
    stored = spark.read.parquet(path)
    one = stored.schema["docs"].dataType.elementType
    schema = T.StructType([T.StructField("part", T.LongType()), T.StructField("begin", T.LongType()), *one.fields, T.StructField("crc", T.LongType())])

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, range_coder.LANES):
                b = whole.slice(at, range_coder.LANES)
                rows = []
                for part, block, ids, segments in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), unpack_blocks(b.column(2).to_pylist()), b.column(3).to_pylist(), strict=True):
                    raw, k = memoryview(ids.astype("<u4").tobytes()), 0
                    for s in segments:
                        rows.append((part, block * range_coder.BLOCK + k - s["start"], *s.values(), zlib.crc32(raw[4 * k : 4 * (k + s["length"])])))
                        k += s["length"]
                yield batch(schema, *zip(*rows, strict=True))

    segments = mapped(stored.select("part", "block", "data", "docs"), apply, schema)

    @F.pandas_udf("long")
    def join_crc(crcs: pd.Series, lengths: pd.Series) -> pd.Series:
        return pd.Series([joined_crc([(int(c), 4 * int(n)) for c, n in zip(*x, strict=True)]) if len(x[0]) > 1 else int(x[0][0]) for x in zip(crcs, lengths, strict=True)])

    parts = F.array_sort(F.collect_list(F.struct("start", "length", "crc")))
    docs = segments.groupBy("part", "doc", "doc_id", "begin", "total").agg(parts.alias("parts"))
    return docs.join(F.broadcast(offsets), "part").select("doc_id", (F.col("begin") + F.col("offset")).alias("start"), F.col("total").alias("n_tokens"), join_crc("parts.crc", "parts.length").alias("ids_crc32"))


def round_trip(docs: DataFrame, tokenizer_path: str, out: str) -> DataFrame:
    """Writes the documents' ids to `out` and gives the summary of what was read back."""
    write(docs, tokenizer_path, out)
    return summary(docs.sparkSession, out)
