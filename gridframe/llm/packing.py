"""Packing of documents into training sequences by an order-preserving dynamic program.

Documents are dealt by ranges of their id and sorted, so that each partition holds
one stretch of the corpus' token stream. Cuts may lie at document ends (free) and
at sentence ends (a penalty); inside a sentence only where it is longer than a
window (a larger penalty). With g(i) = cost(i) + i, the cheapest way to a cut at j is

    cost(j) = penalty(j) + window - j + min of g(i) over cuts i with j - window <= i < j,

a minimum over a sliding window, which a monotone queue gives in constant time.
Sequences whose length is a power of two need no padding: for those, cuts at
j - 2^k are looked up directly. A partition's stream ends in a remainder shorter
than a window; it is padded or cut into powers of two, whichever is cheaper.

Memory is bounded: after `horizon` tokens the program is solved, all but its last
windows are emitted, and the rest is carried on.

Null text counts as empty: such a document is its end id alone. Rows that repeat
an id are packed one by one, in the order of their texts. Other columns are
ignored. An empty table gives no pieces.
"""

from __future__ import annotations

import re
import zlib
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from gridframe.llm.common import batch, keyed, mapped, released, slices
from gridframe.llm.tokens import CACHE_BYTES, forget_encoders, forget_words, word_encoder

#: Bytes, and rows, of texts that are encoded together.
ENCODED, ENCODED_ROWS = 8 << 20, 10_000
#: Costs of a cut, in tokens of padding.
SENTENCE, INSIDE = 4, 64
#: The shortest sequence without padding that the program asks for besides a partition's last.
LEAST_POWER = 256


def solve(positions: list[int], penalties: list[int], window: int, last: bool) -> list[int]:
    """Cuts from positions[0] to positions[-1], both included, at most `window` apart and of least cost.

    Neighbouring positions must be at most `window` apart. `last`: nothing
    follows the last position, so the remainder there may be cut anywhere.
    """
    n, end = len(positions), positions[-1]
    cost, back = [0.0] * n, [0] * n
    queue: deque[tuple[float, int]] = deque([(positions[0], 0)])
    where = np.array(positions)
    exact: list[tuple[int, ...]] = [()] * n  # the cuts that lie a power of two before a cut
    for p in (2**k for k in range(LEAST_POWER.bit_length() - 1, (window - 1).bit_length())):
        before = np.searchsorted(where, where - p, side="right") - 1
        for c in np.flatnonzero((before >= 0) & (where[before] == where - p)).tolist():
            exact[c] += (int(before[c]),)
    for c in range(1, n):
        here = positions[c]
        low = here - window
        while positions[queue[0][1]] < low:
            queue.popleft()
        g, i = queue[0]
        best = g + window - here
        for k in exact[c]:
            if cost[k] < best:
                best, i = cost[k], k
        best += penalties[c]
        cost[c], back[c] = best, i
        g = best + here
        while queue and queue[-1][0] >= g:
            queue.pop()
        queue.append((g, c))
    tail: list[int] = []
    c = n - 1
    if last and n > 1:
        best, ways = cost[c], None
        for k in range(n - 2, -1, -1):
            if (left := end - positions[k]) > window:
                break
            if (total := cost[k] + INSIDE * (left.bit_count() - 1)) < best:
                best, ways = total, k
        if ways is not None:
            c, x, left = ways, end, end - positions[ways]
            while left:
                tail.append(x)
                x -= left & -left
                left &= left - 1
    cuts = [positions[c]]
    while c:
        c = back[c]
        cuts.append(positions[c])
    return cuts[::-1] + tail[::-1]


class Packer:
    """The documents of one partition, in order, as pieces of sequences."""

    def __init__(self, path: str, end_id: int, window: int, horizon: int, cache_bytes: int = CACHE_BYTES) -> None:
        self.encoder, self.end_id, self.window, self.horizon = word_encoder(path, cache_bytes), end_id, window, horizon
        vocab = self.encoder.tokenizer.get_vocab()
        self.stops = np.zeros(len(self.encoder.ends), bool)
        self.stops[[i for t, i in vocab.items() if re.fullmatch(r"[.!?]+</w>", t)]] = True
        self.n = 0  # sequences so far
        self.ids: list[np.ndarray] = []
        self.docs: list[tuple[object, int, int]] = []  # id, tokens of it before the buffer, all tokens of it
        self.held = 0

    def add(self, doc_ids: list, column: pa.Array) -> Iterator[tuple]:
        found, ends = self.encoder.encode_column(column)
        found = np.insert(found, ends, self.end_id)
        for doc_id, ids in zip(doc_ids, np.split(found, ends[:-1] + np.arange(1, len(ends))), strict=True):
            self.ids.append(ids)
            self.docs.append((doc_id, 0, len(ids)))
            self.held += len(ids)
            if self.held >= self.horizon:
                yield from self.flush(False)

    def flush(self, last: bool) -> Iterator[tuple]:
        """Pieces: id, start in the document, length, ids, the document's tokens, sequence, offset."""
        if not self.held:
            return
        stream = np.concatenate(self.ids)
        ends = np.cumsum([n - before for _, before, n in self.docs])
        # The end id's place is no cut of its own: the sentence before it ends with the document.
        stops = np.flatnonzero(self.stops[stream]) + 1
        stops = np.setdiff1d(stops, np.concatenate([ends, ends - 1]), assume_unique=True)
        places = np.concatenate([[0], stops, ends])
        penalties = np.concatenate([[0], np.full(len(stops), SENTENCE), np.zeros(len(ends), int)])
        gaps = np.diff(np.sort(places))
        if (long := np.flatnonzero(gaps > self.window)).size:
            starts = np.sort(places)
            forced = np.concatenate([np.arange(starts[k] + self.window, starts[k + 1], self.window) for k in long])
            places, penalties = np.concatenate([places, forced]), np.concatenate([penalties, np.full(len(forced), INSIDE)])
        order = np.argsort(places, kind="stable")
        cuts = np.array(solve(places[order].tolist(), penalties[order].tolist(), self.window, last))
        if not last:
            cuts = cuts[: max(2, int(np.searchsorted(cuts, len(stream) - 2 * self.window)))]
        stop = int(cuts[-1])
        bounds = np.union1d(cuts, ends[ends < stop])
        starts, lengths = bounds[:-1], np.diff(bounds)
        doc = np.searchsorted(ends, starts, side="right")
        seq = np.searchsorted(cuts, starts, side="right") - 1
        wide = stream.astype("<u4")
        first = np.concatenate([[0], ends[:-1]])
        for s, n, d, q in zip(starts.tolist(), lengths.tolist(), doc.tolist(), seq.tolist(), strict=True):
            doc_id, before, total = self.docs[d]
            yield doc_id, before + s - int(first[d]), n, wide[s : s + n], total, self.n + q, s - int(cuts[q])
        self.n += len(cuts) - 1
        rest = int(np.searchsorted(ends, stop, side="right"))
        if rest < len(ends):
            doc_id, before, total = self.docs[rest]
            self.docs = [(doc_id, before + max(0, stop - int(first[rest])), total), *self.docs[rest + 1 :]]
        else:
            self.docs = []
        self.ids, self.held = [stream[stop:].copy()], len(stream) - stop


def pack(
    docs: DataFrame, path: str, end_id: int = 2, window: int = 4096, horizon: int = 2_000_000, with_ids: bool = True, id_col: str = "doc_id", text_col: str = "text", cache_bytes: int = CACHE_BYTES, keep_cache: bool = True, encoded: int = ENCODED
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset and, if asked for, ids.

    Sequences are numbered within their partition; the partition is in the upper 32 bits.
    A worker's word cache takes `cache_bytes`; a task gives it back at its end, and without
    `keep_cache` the tokenizer as well, for jobs whose other stages need the memory. `encoded`
    bytes of texts are encoded together; a worker takes many times that for it.
    """
    docs = keyed(docs, id_col, text_col)
    numbers = [T.StructField(n, T.LongType()) for n in ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")]
    schema = T.StructType([docs.schema["doc_id"], *numbers, *[T.StructField("ids", T.ArrayType(T.IntegerType()))] * with_ids])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        part = TaskContext.get().partitionId() << 32
        packer = Packer(path, end_id, window, horizon, cache_bytes)

        def pieces() -> Iterator[tuple]:
            for b in slices(batches, size=encoded, rows=ENCODED_ROWS):
                yield from packer.add(b.column(0).to_pylist(), b.column(1))
            yield from packer.flush(True)

        for doc_id, start, n, ids, total, seq, offset in pieces():
            yield doc_id, start, n, zlib.crc32(ids), total, part + seq, offset, *[ids.astype("i4")] * with_ids

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        buffer: list[tuple] = []
        most = 500 if with_ids else 5000
        for row in rows(batches):
            buffer.append(row)
            if len(buffer) == most:
                yield batch(schema, *zip(*buffer, strict=True))
                buffer = []
        if buffer:
            yield batch(schema, *zip(*buffer, strict=True))

    fn = released(forget_words if keep_cache else forget_encoders)(apply)
    return mapped(docs.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text"), fn, schema)
