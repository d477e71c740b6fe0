"""Token counts of whole texts: a broadcast table of frequent pre-tokens, worker caches for the rest.

Two map-only passes. The first finds the frequent pre-tokens: each task keeps a
lossy count of its own, and reports only those that make up at least `share` of
its pre-tokens (so at most 1/share rows a task, however large the input); the
reports are summed and the `table_size` most frequent become the broadcast table.
Any pre-token with that share of the corpus has it in some task, so none is
missed. The second pass looks each pre-token up in the table, then in the
worker's cache, and asks the tokenizer only for words that neither has. No
pre-token is shuffled but for those few reports.

Null text counts as empty (0 tokens); repeated rows give repeated results; an
empty table gives an empty result; other columns are ignored. Texts of any
length are counted whole.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridframe.llm.common import batch, keyed, mapped, slices, texts
from gridframe.llm.tokens import SIMPLE, Cache, load

#: Runs of more than one white space need care: the tokenizer keeps the last one with what follows.
_RUNS = re.compile(r"\s\s")
_CUTS = re.compile(r"(?<=\S) (?=\S)")
_REPORT = T.StructType([T.StructField("pretoken", T.StringType()), T.StructField("n", T.LongType()), T.StructField("n_tokens", T.LongType())])


def pretokens(text: str) -> list[str]:
    """Parts of a text that the tokenizer never merges across, in order; their counts add up to the text's.

    A cut lies before a single space between two other characters, and before a
    line end that stands alone. A part keeps its space, so the same word at the
    start of a text is another part.
    """
    if _RUNS.search(text):
        first, *rest = _CUTS.split(text)
        return [first, *(" " + x for x in rest)]
    first, *rest = text.replace("\n", " \n").split(" ")
    return [first, *rest] if not rest else [first, *(x if x[:1] == "\n" else " " + x for x in rest)]


class PretokenCounter:
    """Token counts of pre-tokens by a byte-level tokenizer file, kept in a bounded worker cache."""

    def __init__(self, path: str, cache_bytes: int = 96 << 20) -> None:
        self.tokenizer, self.cache = load(path), Cache(cache_bytes)
        self._marks: dict[str, int] = {}

    def _count(self, text: str) -> int:
        return len(self.tokenizer.encode(text, add_special_tokens=False).ids) if text else 0

    def _learn(self, missing: set[str]) -> None:
        old, simple = self.cache.old, {}
        for p in missing:
            if p in old:
                self.cache.put(p, old[p], len(p) + 150)
            elif p[:1] == " " and (m := SIMPLE.fullmatch(p, 1)):
                simple[p] = (m[1], m[2])
            else:
                self.cache.put(p, self._count(p), len(p) + 150)
        if not simple:
            return
        cores = list({core for core, _ in simple.values()})
        # One text of words with a space before each: every word is one pre-token, so word numbers part the ids.
        encoded = self.tokenizer.encode(" " + " ".join(cores), add_special_tokens=False)
        counts = dict(zip(cores, np.bincount(np.array(encoded.word_ids, np.int64), minlength=len(cores)).tolist(), strict=True))
        for p, (core, tail) in simple.items():
            if tail and tail not in self._marks:
                if len(self._marks) > 10_000:
                    self._marks.clear()
                self._marks[tail] = self._count(tail)
            self.cache.put(p, counts[core] + (self._marks[tail] if tail else 0), len(p) + 150)

    def lengths(self, parts: list[str]) -> list[int]:
        self.cache.turn()
        if missing := set(parts).difference(self.cache.new):
            self._learn(missing)
        return list(map(self.cache.new.__getitem__, parts))


_COUNTERS: dict[str, PretokenCounter] = {}


def _counter(path: str) -> PretokenCounter:
    if path not in _COUNTERS:
        _COUNTERS[path] = PretokenCounter(path)
    return _COUNTERS[path]


class LossyCount:
    """Counts of frequent items in bounded memory: an item's count is short by at most n / width."""

    def __init__(self, width: int) -> None:
        self.width, self.counts, self.seen, self.floor = width, Counter(), 0, 0

    def add(self, items: list[str]) -> None:
        self.counts.update(items)
        self.seen += len(items)
        if len(self.counts) > 2 * self.width and (floor := self.seen // self.width) > self.floor:
            self.counts = Counter({k: n - (floor - self.floor) for k, n in self.counts.items() if n > floor - self.floor})
            self.floor = floor

    def frequent(self, share: float) -> list[tuple[str, int]]:
        least = max(2, share * self.seen - self.floor)
        return [(k, n + self.floor) for k, n in self.counts.items() if n >= least]


def frequent_pretokens(docs: DataFrame, path: str, share: float = 1e-4, table_size: int = 8192) -> dict[str, int]:
    """Token counts of the corpus' most frequent pre-tokens, at most `table_size`."""

    def report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = LossyCount(round(10 / share))
        for b in slices(batches, 0):
            for text in texts(b.column(0)):
                seen.add(pretokens(text))
        found = [(p, n) for p, n in seen.frequent(share) if len(p) <= 64]
        if found:
            yield batch(_REPORT, [p for p, _ in found], [n for _, n in found], _counter(path).lengths([p for p, _ in found]))

    reports = mapped(docs.select("text"), report, _REPORT)
    top = reports.groupBy("pretoken").agg(F.sum("n").alias("n"), F.first("n_tokens").alias("n_tokens")).orderBy(F.desc("n"), "pretoken").limit(table_size)
    return {r["pretoken"]: r["n_tokens"] for r in top.collect()}


def count_tokens(docs: DataFrame, path: str, limit: int = 512, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_bytes, n_tokens, over_limit (more than `limit` tokens)."""
    docs = keyed(docs, id_col, text_col)
    spark = docs.sparkSession
    table = spark.sparkContext.broadcast(frequent_pretokens(docs, path))
    schema = T.StructType([docs.schema["doc_id"], T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, counter = table.value, _counter(path)
        for b in slices(batches):
            n_tokens = []
            for text in texts(b.column(1)):
                parts = pretokens(text)
                found = list(map(known.get, parts))
                total = sum(filter(None, found))
                if rest := [p for p, n in zip(parts, found, strict=True) if n is None]:
                    total += sum(counter.lengths(rest))
                n_tokens.append(total)
            yield batch(schema, b.column(0), b.column(2), n_tokens)

    sized = docs.select("doc_id", "text", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"))
    return mapped(sized, count, schema).select("*", (F.col("n_tokens") > limit).alias("over_limit"))
