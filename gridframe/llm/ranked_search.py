"""Ranked lexical search: WAND over shards of documents, whose heaps are merged.

Terms are runs of letters and digits, any character beyond ASCII counting as a letter,
with A-Z alone lower-cased. A first pass cuts each task's documents into shards of bounded
size and writes one row a shard: the postings of the terms that are asked for, and how
many documents and terms the shard has. Sums of these are the statistics of the corpus.
The second pass reads whole shards, no postings are shuffled. For each item it knows the
largest impact of each term in the shard; the lists' cursors are ordered by document, the
pivot is the first document up to which these maxima sum to more than the heap's least
score, all cursors before it skip to it, and it is scored if the maxima of the lists that
do hold it still sum to more. Many items take their steps side by side in NumPy. A task
takes its thresholds from shard to shard; tasks' heaps are merged by windows in two levels,
so that no group grows with the corpus but by its square root.

Items are answered in blocks of about `BLOCK`, each a pass over the documents; what is
sent to tasks is the terms of one block.

A null or empty text, or one without terms, is found by nothing and counts as no document.
A row without a doc_id counts in the statistics and is never an answer; ids are integers.
Rows that repeat an id or a text are documents of their own, equal scores come by
ascending doc_id. Long texts are cut into pieces at blanks, with the same result. Items
that repeat an id are answered each for itself, an item without terms gets no rows. Other
columns are never looked at.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridframe.llm.common import batch, give_back, mapped, slices, texts
from gridframe.shared import written

#: Items that are answered in one pass over the documents, about.
BLOCK = 1000
#: A shard ends at so many bytes of text or postings.
SHARD_BYTES, SHARD_POSTINGS = 64 << 20, 4_000_000
#: Groups of tasks whose heaps are merged first.
MERGE = 256
_PIECE = 1 << 20
#: Document number of a list that has ended.
_END = 1 << 40
#: Cells of the matrix of cursors that take a step together.
_CELLS = 1 << 16

_TERM_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def term_lists(text: str) -> Iterator[list[bytes]]:
    """The text's terms in order, in lists of bounded length."""
    blanked, at = text.encode().translate(_TERM_BYTES), 0
    while at < len(blanked):
        stop = blanked.find(b" ", at + _PIECE)
        stop = len(blanked) if stop < 0 else stop
        yield blanked[at:stop].split()
        at = stop


_SHARD = T.StructType([
    T.StructField("n_docs", T.LongType()), T.StructField("n_terms", T.LongType()), T.StructField("terms", T.ArrayType(T.IntegerType())), T.StructField("df", T.ArrayType(T.LongType())),
    *(T.StructField(c, T.BinaryType()) for c in ("sizes", "docs", "tf", "ids", "lengths")),
])


class ShardBuilder:
    """Postings of the known terms, gathered from slices of documents."""

    def __init__(self, terms: dict[bytes, int]) -> None:
        self.terms, self.found, self.ids, self.lengths = terms, [], [], []
        self.bytes = self.postings = self.n_docs = self.n_terms = 0

    @property
    def full(self) -> bool:
        return self.bytes >= SHARD_BYTES or self.postings >= SHARD_POSTINGS

    def add(self, ids: list[int | None], rows: list[str]) -> None:
        known, doc_of, lengths = [], [], []
        for k, text in enumerate(rows):
            n = 0
            for part in term_lists(text):
                hit = np.fromiter(map(self.terms.get, part, repeat(-1)), np.int64, len(part))
                n += len(part)
                hit = hit[hit >= 0]
                known.append(hit)
                doc_of.append(np.full(len(hit), k, np.int64))
            lengths.append(n)
            self.bytes += len(text)
        self.n_docs += sum(n > 0 for n in lengths)
        self.n_terms += sum(lengths)
        if known:
            pairs, tf = np.unique(np.concatenate(known) << 32 | np.concatenate(doc_of) + len(self.ids), return_counts=True)
            self.found.append((pairs, tf))
            self.postings += len(pairs)
        self.ids += ids
        self.lengths += lengths

    def row(self) -> tuple:
        """The shard, documents numbered by ascending id; those without one are in the document counts alone."""
        empty = np.zeros(0, np.int64)
        pairs, tf = (np.concatenate(x) for x in zip(*self.found, strict=True)) if self.found else (empty, empty)
        has_id = np.array([x is not None for x in self.ids], bool)
        ids = np.array([x or 0 for x in self.ids], np.int64)
        order = np.argsort(ids, kind="stable")
        order = order[has_id[order]]
        number = np.zeros(len(ids), np.int64)
        number[order] = np.arange(len(order))
        term, doc = pairs >> 32, pairs & 0xFFFFFFFF
        df_terms, df = np.unique(term, return_counts=True)
        term, doc, tf = (x[has_id[doc]] for x in (term, number[doc], tf)) if len(doc) else (term, doc, tf)
        place = np.lexsort((doc, term))
        sizes = np.bincount(np.searchsorted(df_terms, term), minlength=len(df_terms))
        return (self.n_docs, self.n_terms, df_terms.tolist(), df.tolist(), sizes.astype("<i8").tobytes(), doc[place].astype("<i4").tobytes(), tf[place].astype("<i4").tobytes(), ids[order].astype("<i8").tobytes(), np.array(self.lengths, "<i8")[order].tobytes())


def shards(docs: DataFrame, terms: dict[bytes, int]) -> DataFrame:
    """One row per shard of `docs` (doc_id, text), with postings of `terms`."""
    sent = docs.sparkSession.sparkContext.broadcast(terms)

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = ShardBuilder(sent.value)
        for b in slices(batches):
            shard.add(b.column(0).to_pylist(), texts(b.column(1)))
            if shard.full:
                yield batch(_SHARD, *([x] for x in shard.row()))
                shard = ShardBuilder(sent.value)
        if shard.ids:
            yield batch(_SHARD, *([x] for x in shard.row()))
        give_back()

    return mapped(docs, build, _SHARD)


@dataclass(frozen=True)
class Corpus:
    """Documents with terms, their terms with repeats, and the weights of the terms asked for."""

    n_docs: int
    n_terms: int
    weights: np.ndarray


class Postings:
    """A shard's lists with impacts, and each list's largest."""

    def __init__(self, row: dict, corpus: Corpus) -> None:
        of = lambda name, kind: np.frombuffer(row[name], kind).astype(np.int64)
        self.ids, lengths, self.docs, tf = of("ids", "<i8"), of("lengths", "<i8"), of("docs", "<i4"), of("tf", "<i4")
        sizes = of("sizes", "<i8")
        terms = np.array(row["terms"], np.int64)[sizes > 0]
        sizes = sizes[sizes > 0]
        self.slot = {int(t): k for k, t in enumerate(terms)}
        self.ends = np.cumsum(sizes)
        self.starts = self.ends - sizes
        mean = 50 + (50 * lengths * corpus.n_docs) // max(1, corpus.n_terms)
        self.impacts = np.repeat(corpus.weights[terms], sizes) * ((1_000_000_000 * tf) // (1000 * tf + 20 * mean[self.docs]))
        self.most = np.maximum.reduceat(self.impacts, self.starts) if len(terms) else np.zeros(0, np.int64)
        self.keys = np.repeat(np.arange(len(terms)), sizes) << 41 | self.docs

    def surely(self, k: int) -> np.ndarray:
        """For each list, a score that at least k documents reach by that term alone; 0 for shorter lists."""
        out = np.zeros(len(self.starts), np.int64)
        for j, (a, b) in enumerate(zip(self.starts, self.ends, strict=True)):
            if b - a >= k:
                out[j] = np.partition(self.impacts[a:b], b - a - k)[b - a - k]
        return out


def wand(lists: Postings, wanted: list[np.ndarray], k: int, least: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each item (its lists' slots) up to k best documents that score `least` or more: scores and document numbers, -1 where there are fewer."""
    n = len(wanted)
    scores, docs = np.full((n, k), -1, np.int64), np.full((n, k), -1, np.int64)
    order = sorted((j for j in range(n) if len(wanted[j])), key=lambda j: len(wanted[j]))
    while order:
        width = len(wanted[order[-1]])
        lanes, order = order[-max(1, _CELLS // width) :], order[: -max(1, _CELLS // width)]
        _steps(lists, np.array(lanes), [wanted[j] for j in lanes], k, least, scores, docs)
    return scores, docs


def _steps(lists: Postings, lane: np.ndarray, wanted: list[np.ndarray], k: int, least: np.ndarray, scores: np.ndarray, docs: np.ndarray) -> None:
    width = max(map(len, wanted))
    slot = np.array([[*w, *repeat(-1, width - len(w))] for w in wanted], np.int64)
    there = slot >= 0
    cur = np.where(there, lists.starts[slot], 0)
    end, bound = np.where(there, lists.ends[slot], 0), np.where(there, lists.most[slot], 0)
    at = np.where(there, lists.docs[cur], _END)
    # A document must score more than this: later ones of equal score lose against the heap, not against other shards'.
    over = least[lane] - 1
    while len(lane):
        by_doc = np.argsort(at, axis=1)
        reach = np.cumsum(np.take_along_axis(bound, by_doc, 1), axis=1) > over[:, None]
        rows = np.arange(len(lane))
        first = reach.argmax(axis=1)
        pivot = np.where(reach[rows, first], at[rows, by_doc[rows, first]], _END)
        if (pivot == _END).any():
            live = pivot < _END
            lane, slot, cur, end, bound, at, over, pivot = (x[live] for x in (lane, slot, cur, end, bound, at, over, pivot))
            if not len(lane):
                return
        # Cursors before the pivot skip to it.
        r, c = np.nonzero(at < pivot[:, None])
        cur[r, c] = np.searchsorted(lists.keys, slot[r, c] << 41 | pivot[r])
        at[r, c] = np.where(cur[r, c] < end[r, c], lists.docs[np.minimum(cur[r, c], len(lists.docs) - 1)], _END)
        hit = at == pivot[:, None]
        hopeful = np.flatnonzero((bound * hit).sum(axis=1) > over)
        if len(hopeful):
            r, c = np.nonzero(hit[hopeful])
            score = np.zeros(len(hopeful), np.int64)
            np.add.at(score, r, lists.impacts[cur[hopeful[r], c]])
            better = score > over[hopeful]
            rows, score = hopeful[better], score[better]
            if len(rows):
                heap = lane[rows]
                low = scores[heap].min(axis=1)
                out = np.where(scores[heap] == low[:, None], docs[heap], -2).argmax(axis=1)
                scores[heap, out], docs[heap, out] = score, pivot[rows]
                over[rows] = np.maximum(over[rows], scores[heap].min(axis=1))
        r, c = np.nonzero(hit)
        cur[r, c] += 1
        at[r, c] = np.where(cur[r, c] < end[r, c], lists.docs[np.minimum(cur[r, c], len(lists.docs) - 1)], _END)


def _best(k: int, scores: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    first = np.lexsort((ids, -scores))[:k]
    return scores[first], ids[first]


def _searched(index: DataFrame, asked: list[tuple[object, list[int]]], corpus: Corpus, k: int, item_type: T.DataType) -> DataFrame:
    """Rows of the tasks' heaps: place (of the item in `asked`), item_id, part, doc_id, score."""
    schema = T.StructType([T.StructField("place", T.IntegerType()), T.StructField("item_id", item_type), T.StructField("part", T.IntegerType()), T.StructField("doc_id", T.LongType()), T.StructField("score", T.LongType())])
    sent = index.sparkSession.sparkContext.broadcast((asked, corpus))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked, corpus = sent.value
        none = np.zeros(0, np.int64)
        heaps = [(none, none)] * len(asked)
        least = np.ones(len(asked), np.int64)
        for b in batches:
            for row in (r for j in range(b.num_rows) for r in b.slice(j, 1).to_pylist()):
                lists = Postings(row, corpus)
                wanted = [np.array([lists.slot[t] for t in terms if t in lists.slot], np.int64) for _, terms in asked]
                surely = lists.surely(k)
                least = np.maximum(least, [max(surely[w], default=0) for w in wanted])
                scores, docs = wand(lists, wanted, k, least)
                for j in np.flatnonzero(scores.max(axis=1) > 0):
                    got = scores[j] > 0
                    heaps[j] = _best(k, np.concatenate([heaps[j][0], scores[j][got]]), np.concatenate([heaps[j][1], lists.ids[docs[j][got]]]))
                    if len(heaps[j][0]) == k:
                        least[j] = max(least[j], heaps[j][0][-1])
        n = [len(h[0]) for h in heaps]
        part = TaskContext.get().partitionId()
        yield batch(schema, np.repeat(np.arange(len(asked), dtype=np.int32), n), [a for (a, _), x in zip(asked, n, strict=True) for _ in range(x)], np.full(sum(n), part, np.int32), np.concatenate([none, *(h[1] for h in heaps)]), np.concatenate([none, *(h[0] for h in heaps)]))

    return mapped(index.select("terms", "sizes", "docs", "tf", "ids", "lengths"), search, schema)


def _block(docs: DataFrame, items: list[tuple[object, list[bytes]]], k: int, item_type: T.DataType) -> DataFrame:
    terms: dict[bytes, int] = {}
    asked = [(item, [terms.setdefault(t, len(terms)) for t in own]) for item, own in items]
    index = written(shards(docs, terms), "shards")
    n_docs, n_terms = index.agg(F.coalesce(F.sum("n_docs"), F.lit(0)), F.coalesce(F.sum("n_terms"), F.lit(0))).first()
    holding = index.select(F.explode(F.arrays_zip("terms", "df")).alias("x")).groupBy("x.terms").agg(F.sum("x.df").alias("df"))
    weights = np.zeros(len(terms), np.int64)
    for r in holding.collect():  # at most one row for each term of the block
        weights[r["terms"]] = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * r["df"] + 1)))
    found = _searched(index, asked, Corpus(n_docs, n_terms, weights), k, item_type)
    best = (F.desc("score"), F.asc("doc_id"))
    first = Window.partitionBy("place", F.pmod("part", F.lit(MERGE))).orderBy(*best)
    last = Window.partitionBy("place").orderBy(*best)
    merged = found.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= k)
    return merged.withColumn("rank", F.row_number().over(last)).where(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")


def ranked(docs: DataFrame, items: DataFrame, k: int = 50, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """For each item its k best documents: item_id, rank (int, from 1), doc_id (long), score (long, above 0)."""
    docs = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text"))
    kind = items.schema[item_col].dataType
    schema = T.StructType([T.StructField("item_id", kind), T.StructField("terms", T.ArrayType(T.BinaryType()))])

    def distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 1):
            yield batch(schema, b.column(0), [sorted({t for part in term_lists(x) for t in part}) for x in texts(b.column(1))])

    own = written(mapped(items.select(items[item_col].alias("item_id"), items[item_text].alias("text")), distinct, schema), "items")
    blocks = max(1, -(-own.count() // BLOCK))
    own = own.withColumn("block", F.pmod(F.xxhash64("item_id", "terms"), F.lit(blocks)))
    found = [_block(docs, [(r["item_id"], r["terms"]) for r in own.where(F.col("block") == n).collect()], k, kind) for n in range(blocks)]
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


#: The same by SQL, scoring every document.
ORACLE = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t FROM documents
), i AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark
), s AS (
  SELECT count(*) AS n_docs, sum(len(t))::BIGINT AS n_terms FROM d WHERE len(t) > 0
), p AS (
  SELECT doc_id, term, count(*) AS tf, any_value(n) AS n FROM (SELECT doc_id, len(t) AS n, unnest(t) AS term FROM d) WHERE term IN (SELECT term FROM i) GROUP BY doc_id, term
), w AS (
  SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * df + 1))) AS BIGINT) AS w FROM (SELECT term, count(*) AS df FROM p GROUP BY term), s
), scored AS (
  SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * n_docs) // n_terms)))) AS BIGINT) AS score
  FROM i JOIN p USING (term) JOIN w USING (term), s GROUP BY item_id, doc_id
), placed AS (
  SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score FROM scored WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM placed WHERE rank <= 50
"""
