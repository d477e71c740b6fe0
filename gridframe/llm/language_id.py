"""Language identification by bit-sliced Bloom filters of character n-grams.

One Bloom filter per language, sliced by bit: slot k of the table holds, for every
language at once, bit k of that language's filter. So an n-gram's few slots, ANDed,
give all languages whose filter contains it. A text's n-grams are looked up
together; each language's popcount over them is its number of hits, of which its
filter's false positive rate f predicts f * n by chance:

    hits corrected = (hits - f * n) / (1 - f)

The language with the most corrected hits is predicted; the score is its share of
the text's n-grams.

Training takes labelled rows, about `per_language` texts of each language (chosen by
a hash of the id, so the same ones at every run), and keeps the n-grams that make up at
least `min_share` of their length's n-grams in a language. So at most
orders / min_share n-grams a language reach the driver, however large the corpus.

N-grams are of 1 to 4 code points within words: runs of letters in lower case with
a blank on both sides. A text without letters, or null, is `und` with score 0; so is
any text when nothing was learned. A text with letters always gets a learned language,
with score 0 if it has no n-gram of any. Ties go to the language that sorts first. Repeated rows give repeated results; other columns are
ignored by `predict` and kept by `speaking`.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridframe.llm.common import batch, mapped, released, slices, texts

UNKNOWN = "und"
ORDERS = (1, 2, 3, 4)
PROBES = 3
_OTHER = re.compile(r"[\W\d_]+")
_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))
_COUNTS = T.StructType([T.StructField("lang", T.StringType()), T.StructField("size", T.IntegerType()), T.StructField("gram", T.LongType()), T.StructField("n", T.LongType())])


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * _MIX[1]
    h = (h ^ (h >> np.uint64(27))) * _MIX[2]
    return h ^ (h >> np.uint64(31))


def letters(text: str) -> str:
    """The text's words in lower case, with single blanks around; empty without letters."""
    found = _OTHER.sub(" ", text.lower()).strip()
    return f" {found} " if any(map(str.isalpha, found)) else ""


def grams(joined: str) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each order: the hashes of the n-grams within words, and where each begins."""
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    blank = points == 32
    hashed = np.zeros(len(points), np.uint64)
    for n in range(1, max(ORDERS) + 1):
        hashed = hashed[: len(points) - n + 1] * _MIX[0] + points[n - 1 :] + np.uint64(n)
        if n in ORDERS:
            # A blank may be the first or the last code point, not one inside, nor the whole.
            inside = np.ones(len(hashed), bool)
            for k in range(n) if n < 3 else range(1, n - 1):
                inside &= ~blank[k : k + len(hashed)] if n != 2 else True
            at = np.flatnonzero(inside if n != 2 else ~(blank[:-1] & blank[1:]))
            yield n, _mixed(hashed[at]), at


@dataclass(frozen=True)
class Model:
    """languages: sorted. slots: masks[slot, word of 64 languages]. rates: each filter's false positive rate."""

    languages: tuple[str, ...]
    slots: np.ndarray
    rates: np.ndarray

    def masks(self, hashes: np.ndarray) -> np.ndarray:
        """For each n-gram the bit mask of all languages that contain it."""
        size = np.uint64(len(self.slots) - 1)
        step = (hashes >> np.uint64(32)) | np.uint64(1)
        found = self.slots[(hashes & size).astype(np.int64)]
        for k in range(1, PROBES):
            found &= self.slots[((hashes + np.uint64(k) * step) & size).astype(np.int64)]
        return found

    def predict(self, values: list[str]) -> list[tuple[str, float]]:
        words = [letters(x) for x in values]
        out: list[tuple[str, float]] = []
        group: list[str] = []
        held = 0
        for k, w in enumerate(words):
            group.append(w)
            held += len(w)
            if held > 400_000 or k == len(words) - 1:
                out += self._group(group)
                group, held = [], 0
        return out

    def _group(self, group: list[str]) -> list[tuple[str, float]]:
        starts = np.cumsum([0, *map(len, group)])
        total = np.zeros(len(group), np.int64)
        hits = np.zeros((len(group), len(self.languages)), np.int64)
        if starts[-1] and self.languages:
            for _, hashes, at in grams("".join(group)):
                masks = self.masks(hashes)
                bounds = np.searchsorted(at, starts)
                total += np.diff(bounds)
                for k in range(len(self.languages)):
                    counts = np.concatenate([[0], np.cumsum((masks[:, k // 64] >> np.uint64(k % 64)) & np.uint64(1), dtype=np.int64)])
                    hits[:, k] += np.diff(counts[bounds])
        if not self.languages:
            return [(UNKNOWN, 0.0)] * len(group)
        corrected = np.clip((hits - self.rates * total[:, None]) / (1 - self.rates), 0, total[:, None])
        best = corrected.argmax(axis=1)
        top = corrected[np.arange(len(group)), best]
        return [(self.languages[b], float(t / max(n, 1))) if w else (UNKNOWN, 0.0) for b, t, n, w in zip(best.tolist(), top.tolist(), total.tolist(), group, strict=True)]


def _report(counts: dict[tuple[str, int], dict[int, int]]) -> pa.RecordBatch:
    rows = [(lang, size, gram, n) for (lang, size), found in counts.items() for gram, n in found.items()]
    return batch(_COUNTS, *(list(zip(*rows, strict=True)) or [[]] * 4))


def _count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        by_lang: dict[str, list[str]] = {}
        for text, lang in zip(texts(b.column(0)), b.column(1).to_pylist(), strict=True):
            by_lang.setdefault(lang, []).append(letters(text))
        counts: dict[tuple[str, int], dict[int, int]] = {}
        for lang, parts in by_lang.items():
            if joined := "".join(parts):
                for size, hashes, _ in grams(joined):
                    values, n = np.unique(hashes.view(np.int64), return_counts=True)
                    counts[lang, size] = dict(zip(values.tolist(), n.tolist(), strict=True))
        yield _report(counts)


def train(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", per_language: int = 4000, min_share: float = 2e-5, max_slots_log2: int = 22) -> Model:
    """Learns from about `per_language` rows of each non-null label."""
    rows = labelled.select(labelled[id_col].cast("string").alias("key"), labelled[text_col].alias("text"), labelled[lang_col].alias("lang")).where(F.col("lang").isNotNull())
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return Model((), np.zeros((1, 1), np.uint64), np.zeros(0))
    languages = tuple(sorted(sizes))
    share = F.create_map(*(F.lit(x) for lang, n in sizes.items() for x in (lang, min(1.0, per_language / n))))
    drawn = F.pmod(F.xxhash64(F.coalesce("key", F.lit("")), F.lit("sample")), F.lit(1_000_003)) < F.element_at(share, F.col("lang")) * 1_000_003
    counts = mapped(rows.where(drawn).select("text", "lang"), released()(_count_grams), _COUNTS).groupBy("lang", "size", "gram").agg(F.sum("n").alias("n"))
    totals = counts.groupBy("lang", "size").agg(F.sum("n").alias("total"))
    kept = counts.join(F.broadcast(totals), ["lang", "size"]).where(F.col("n") >= F.col("total") * min_share).select("lang", "gram").collect()
    slots_log2 = min(max_slots_log2, max(12, (6 * len(kept)).bit_length()))
    slots = np.zeros((1 << slots_log2, (len(languages) + 63) // 64), np.uint64)
    at = {lang: k for k, lang in enumerate(languages)}
    for lang, k in at.items():
        hashes = np.array([r["gram"] for r in kept if r["lang"] == lang], np.int64).view(np.uint64)
        step = (hashes >> np.uint64(32)) | np.uint64(1)
        for p in range(PROBES):
            slots[((hashes + np.uint64(p) * step) & np.uint64(len(slots) - 1)).astype(np.int64), k // 64] |= np.uint64(1 << (k % 64))
    rates = np.array([np.mean((slots[:, k // 64] >> np.uint64(k % 64)) & np.uint64(1)) ** PROBES for k in range(len(languages))])
    return Model(languages, slots, np.minimum(rates, 0.99))


def held_out(key: Column) -> Column:
    """Whether a row is kept from training: crc32 of its id as text leaves remainder 1 by 3."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, lang_pred, score."""
    docs = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = T.StructType([docs.schema["doc_id"], T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            found = shared.value.predict(texts(b.column(1)))
            yield batch(schema, b.column(0), [x for x, _ in found], [s for _, s in found])

    return mapped(docs, released()(apply), schema)


def identify(docs: DataFrame) -> DataFrame:
    """Learns from the documents that aren't held out and predicts all: doc_id, held_out, lang_pred, score."""
    found = predict(docs, train(docs.where(~held_out(docs["doc_id"]))))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def speaking(docs: DataFrame, model: Model, least: float = 0.25, text_col: str = "text") -> DataFrame:
    """The documents in a learned language, with all columns: neither `und` nor with a score under `least`.

    When nothing was learned, no text can be told to be in another language: only texts without letters go.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    learned = bool(model.slots.any())
    at = docs.columns.index(text_col)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, at):
            if not learned:
                yield b.filter(pa.array([bool(letters(x)) for x in texts(b.column(at))], pa.bool_()))
                continue
            found = shared.value.predict(texts(b.column(at)))
            yield b.filter(pa.array([lang != UNKNOWN and score >= least for lang, score in found], pa.bool_()))

    return mapped(docs, released()(apply), docs.schema)
