"""Near-duplicate groups by ProbMinHash over weighted word shingles, banding and exact verification.

A text's shingles are its runs of five words (all of its words, if it has fewer),
weighted by how often they occur. Similarity is the probability Jaccard index

    J_P(x, y) = sum over common shingles i of 1 / sum over j of max(x_j / x_i, y_j / y_i),

which is the Jaccard index when all weights are equal. Each shingle is a Poisson
process whose rate is its weight; its arrivals fall into random registers, and a
register keeps the shingle that arrives first. Two texts agree in a register with
probability J_P. Once every register is taken, arrivals after the latest of them
change nothing, so processes stop there.

1. One map over the texts gives band keys (hashes of `rows` registers) and sketches.
2. Exact copies (equal digests) are one text from here on.
3. Each band key that several texts share gets a leader (a different choice in each
   band); texts are paired with their leaders: as many pairs as rows, however large a
   group. Links give components.
4. Band keys whose texts lie in several components are contested. A shingle that occurs
   in one component only is common to no pair of components: call it useless. If x has n
   distinct shingles of total weight w, c of them useless and those a share u of w, then x
   lacks in y at least a_x = max(u_x, (n_x - k) / w_x) of its weight, where x and y have at
   most k shingles in common, and J_P(x, y) <= 1 / (1 + o_x + o_y) where o = a / (1 - a).
   First k is n_y - c_y, which y has to share. Then it is what buckets of the shingles'
   hashes allow: texts with i and j shingles in a bucket share at most min(i, j) there.
   Buckets of at least one and of at least two shingles are bits, counted after an AND; what
   buckets hold beyond two is added up, and the lesser sum counts. For this k the bound is
   taken as k + max(w_x - n_x, w_y - n_y) >= (w_x + w_y) T / (1 + T), which follows from it.
   Texts whose u alone rules links out are dropped, which makes more shingles useless, so
   that is done twice. Of the texts that are left, those of one key and of different
   components are paired where the bound allows a link, and verified. Pairs within a
   component can't change the groups. The bound is exact: every pair of different
   components that shares a key is verified or can't be a link.
5. The class of a document is the least id of its text's component.

In a cloud of edits of one template, whose texts are like the template but not like each
other, edits in different places fill different buckets, so that the bound of step 4 is
close to the similarity itself. It weakens for texts of far more shingles than there are
buckets; then texts that share nearly all their shingles with other components, and yet
are near copies of none, still meet in pairs.

Verification first compares sketches (one byte of each register): pairs that agree in
fewer than `threshold` - 0.15 of them go; a pair of similarity 0.8 does with probability
1e-7. The texts of the others are read again, and their exact similarity decides; a
leader's text is sent once for every `RUN` of its members. With 36
bands of 6 registers a pair of similarity 0.8 shares no key with probability 2e-5.

Null text counts as empty; texts without words are duplicates only of equal texts.
After step 2 a text goes by 64 bits of its digest: of n texts, about one in 2^64 / n shares
them with another one by chance, and would be taken for it (5e-10 of ten billion).
Links hold between texts, not ids: where rows repeat an id, each row is in the class of
its own text. `classes` leaves out rows with a null id and ignores other columns.
`first_of_each` keeps all columns and one row of each class: rows without an id come
after all others, and of rows with the same id and text one stays. An empty table gives
no rows.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridframe.llm.common import batch, digest, keyed, mapped, released, slices, small, texts
from gridframe.llm.tokens import Cache
from gridframe.shared import written

SHINGLE = 5
BANDS, ROWS = 36, 6
REGISTERS = BANDS * ROWS
#: How far under the threshold sketches may agree. 0.15 is 5.5 standard deviations of 216 registers at 0.8.
MARGIN = 0.15
#: Buckets of shingle hashes that bound what two texts share, as a power of two; 64 of them are a word.
BUCKET_BITS = 9
_WORDS_A_LEVEL = 1 << BUCKET_BITS >> 6
#: Members of a leader that are verified together.
RUN = 500
_WORD = re.compile(r"[^\W_]+")
_M1, _M2, _GOLD = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15)
_WORDS = Cache(16 << 20)


def forget_words() -> None:
    _WORDS.clear()


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * _M1
    h = (h ^ (h >> np.uint64(27))) * _M2
    return h ^ (h >> np.uint64(31))


def shingles(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the text's distinct shingles, ascending, and how often each occurs."""
    words = _WORD.findall(text.lower())
    if not words:
        return np.zeros(0, np.uint64), np.zeros(0)
    _WORDS.turn()
    for w in set(words).difference(_WORDS.new):
        _WORDS.put(w, xxhash.xxh3_64_intdigest(w), len(w) + 130)
    h = np.fromiter(map(_WORDS.new.__getitem__, words), np.uint64, len(words))
    n = min(SHINGLE, len(words))
    total = np.zeros(len(words) - n + 1, np.uint64)
    for k in range(n):
        total = _mixed(total * _GOLD + h[k : len(h) - n + 1 + k])
    values, counts = np.unique(total, return_counts=True)
    return values, counts.astype(float)


def registers(elements: np.ndarray, weights: np.ndarray, m: int = REGISTERS) -> np.ndarray:
    """The element that arrives first in each of m registers, where element i arrives at rate weights[i]."""
    first, owner = np.full(m, np.inf), np.zeros(m, np.uint64)
    time, active, step = np.zeros(len(elements)), np.arange(len(elements)), 0
    # So many arrivals of each element are drawn at once that the registers fill in few rounds.
    block = max(1, int(2 * m * np.log(m) / max(1, len(elements))))
    while active.size:
        e, w = elements[active], weights[active]
        arrival = np.arange(step + 1, step + block + 1, dtype=np.uint64)
        random = _mixed(e[:, None] + arrival[None, :] * _GOLD)
        gaps = -np.log1p(-((random >> np.uint64(11)).astype(float) * 2.0**-53))
        at = time[active][:, None] + np.cumsum(gaps, axis=1) / w[:, None]
        slot = (_mixed(random ^ _GOLD) % np.uint64(m)).astype(np.int64)
        flat, who = at.ravel(), np.repeat(e, block)
        near = np.flatnonzero(flat < first.max()) if step else np.arange(flat.size)
        # Assigned from late to early, so that each register is left with its earliest arrival.
        near = near[np.argsort(-flat[near], kind="stable")]
        slots = slot.ravel()[near]
        best, own = np.full(m, np.inf), np.zeros(m, np.uint64)
        best[slots], own[slots] = flat[near], who[near]
        better = best < first
        first[better], owner[better] = best[better], own[better]
        time[active] = at[:, -1]
        active = active[time[active] < first.max()]
        step += block
        block = max(1, min(block, int(m * 4 / max(1, active.size))))
    return owner


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """J_P of two weighted sets, exactly, by sorting their elements by the ratio of weights."""
    (ea, wa), (eb, wb) = a, b
    if not len(ea) or not len(eb):
        return 0.0
    union = np.union1d(ea, eb)
    x, y = np.zeros(len(union)), np.zeros(len(union))
    x[np.searchsorted(union, ea)] = wa
    y[np.searchsorted(union, eb)] = wb
    with np.errstate(divide="ignore"):
        ratio = x / y  # infinite where only the first has it
    order = np.argsort(ratio, kind="stable")
    x, y, ratio = x[order], y[order], ratio[order]
    both = (x > 0) & (y > 0)
    # Elements of a larger ratio than i's count by x_j / x_i, the others by y_j / y_i.
    last = np.searchsorted(ratio, ratio[both], side="right")
    above = x.sum() - np.concatenate([[0.0], np.cumsum(x)])[last]
    upto = np.concatenate([[0.0], np.cumsum(y)])[last]
    return float(np.sum(1.0 / (above / x[both] + upto / y[both])))


def _digests(docs: DataFrame) -> DataFrame:
    """doc_id, copy (a digest of the text), keys (a list of band keys; empty without words), sketch (a byte of each register)."""
    schema = T.StructType([docs.schema["doc_id"], T.StructField("copy", T.BinaryType()), T.StructField("keys", T.ArrayType(T.LongType())), T.StructField("sketch", T.BinaryType())])

    @released(forget_words)
    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        multiply = np.arange(1, ROWS + 1, dtype=np.uint64)[None, :] * _GOLD
        band = np.arange(BANDS, dtype=np.uint64)
        for b in slices(batches, "text"):
            keys, sketches = [], []
            for text in texts(b.column("text")):
                found = shingles(text)
                if not len(found[0]):
                    keys.append([])
                    sketches.append(b"")
                    continue
                owners = registers(*found).reshape(BANDS, ROWS)
                sketches.append((owners >> np.uint64(56)).astype(np.uint8).tobytes())
                keys.append((_mixed(np.add.reduce(_mixed(owners ^ multiply) * multiply, axis=1)) + band).view(np.int64))
            yield batch(schema, b.column("doc_id"), b.column("copy"), keys, sketches)

    return mapped(docs, apply, schema)


_PAIR = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType())])


def _sketched(pairs: DataFrame, copies: DataFrame) -> DataFrame:
    """Pairs (a, b) of texts, with their sketches."""
    joined = pairs.join(copies.select(F.col("t").alias("b"), F.col("sketch").alias("sketch_b")), "b")
    joined = joined.join(copies.select(F.col("t").alias("a"), F.col("sketch").alias("sketch_a")), "a")
    return joined.select("a", "b", "sketch_a", "sketch_b")


def _like(threshold: float) -> Callable:
    """Of pairs with sketches, those that agree in about as many registers."""

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x, y = (np.frombuffer(b"".join(b.column(k).to_pylist()), np.uint8).reshape(-1, REGISTERS) for k in (2, 3))
            alike = (x == y).mean(axis=1) >= threshold - MARGIN
            yield batch(_PAIR, b.column(0), b.column(1)).filter(pa.array(alike))

    return apply


def _texts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(t, text), once for each of the wanted (copy, first)."""
    wanted = small(written(wanted.select(F.col("copy").alias("__copy"), F.col("first").alias("__first")), "wanted"))
    held = docs.join(wanted, (F.col("copy") == F.col("__copy")) & F.col("doc_id").eqNullSafe(F.col("__first")), "left_semi")
    return held.select(F.xxhash64("copy").alias("t"), "text").dropDuplicates(["t"])


def _verified(pairs: DataFrame, docs: DataFrame, copies: DataFrame, threshold: float) -> DataFrame:
    """Of pairs (a, b) of texts, those that are similar enough. Only texts with like sketches are read again."""
    pairs = written(mapped(_sketched(pairs.distinct(), copies), _like(threshold), _PAIR), "pairs")
    needed = pairs.select(F.explode(F.array("a", "b")).alias("t")).distinct()
    held = written(_texts(docs, copies.join(needed, "t")), "pair-texts")
    hot = written(pairs.groupBy("a").agg(F.count("*").alias("n")).where(F.col("n") > RUN), "hot-leaders")
    spread = pairs.join(small(hot), "a", "left").select("a", "b", F.when(F.col("n").isNull(), 0).otherwise(F.pmod(F.xxhash64("b"), F.ceil(F.col("n") / RUN))).cast("int").alias("run"))
    spread = written(spread, "runs")
    leaders = spread.select("a", "run").distinct().join(held.withColumnRenamed("t", "a"), "a").select("a", "run", F.lit(None).cast("long").alias("b"), "text")
    members = spread.join(held.withColumnRenamed("t", "b"), "b").select("a", "run", "b", "text")
    grouped = leaders.unionByName(members).repartition("a", "run").sortWithinPartitions("a", "run", "b")

    @released(forget_words)
    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # of the run's leader, whose row comes first
        for b in slices(batches, "text"):
            similar = []
            for member, text in zip(b.column("b").to_pylist(), texts(b.column("text")), strict=True):
                own = shingles(text)
                if member is None:
                    held = own
                similar.append(member is not None and similarity(held, own) >= threshold - 1e-9)
            yield batch(_PAIR, b.column("a"), b.column("b")).filter(pa.array(similar, pa.bool_()))

    return written(mapped(grouped, apply, _PAIR), "links")


def components(links: DataFrame) -> DataFrame:
    """(v, c): for each id in the links (a, b) the least id of its component.

    Each round takes the least label among neighbours, then the label of that label,
    so long chains shorten by half. Rounds are written to the shared folder.
    """
    both = written(links.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(links.select(F.col("b").alias("u"), F.col("a").alias("v"))).distinct(), "edges")
    labels = written(both.groupBy("v").agg(F.least(F.col("v"), F.min("u")).alias("c")), "labels")
    while True:
        near = both.join(labels.select(F.col("v").alias("u"), F.col("c").alias("cu")), "u").groupBy("v").agg(F.min("cu").alias("cu"))
        lower = labels.join(near, "v").select("v", F.col("c").alias("was"), F.least("c", "cu").alias("c"))
        jump = lower.join(labels.select(F.col("v").alias("c"), F.col("c").alias("cc")), "c", "left")
        after = written(jump.select("v", "was", F.least("c", F.coalesce("cc", "c")).alias("c")), "labels")
        labels = after.select("v", "c")
        if after.where(F.col("c") != F.col("was")).limit(1).count() == 0:
            return labels


def buckets(elements: np.ndarray) -> tuple[np.ndarray, int]:
    """Bits of the buckets with one, then of those with two elements or more, as words; and the elements beyond two."""
    counts = np.bincount((elements >> np.uint64(64 - BUCKET_BITS)).astype(np.int64), minlength=1 << BUCKET_BITS)
    bits = np.packbits(np.stack([counts >= 1, counts >= 2]), axis=1, bitorder="little")
    return bits.view("<i8").ravel(), int(np.maximum(counts - 2, 0).sum())


def shares_enough(threshold: float) -> Column:
    """Whether the buckets of texts x and y allow a link. The sum stands here once, so that the join's code stays short enough to be compiled."""
    both = [F.bit_count(F.col("marks_x")[k].bitwiseAND(F.col("marks_y")[k])) for k in range(2 * _WORDS_A_LEVEL)]
    spare = F.greatest(F.col("weight_x") - F.col("n_x"), F.col("weight_y") - F.col("n_y"))
    return sum(both, F.least("over_x", "over_y")) + spare >= (F.col("weight_x") + F.col("weight_y")) * (threshold / (1 + threshold)) - 1e-6


def _lacking(useless: Column, n: Column, other: Column, other_useless: Column, weight: Column) -> Column:
    """o_x of the bound, infinite where a text shares nothing."""
    a = F.greatest(useless, (n - other + other_useless) / weight)
    return F.when(a < 1, a / (1 - a)).otherwise(F.lit(float("inf")))


def _rivals(contested: DataFrame, docs: DataFrame, copies: DataFrame, threshold: float) -> DataFrame:
    """Pairs (a, b) of texts of one key and of different components that may be links, from (key, t, c)."""
    labels = written(contested.select("t", "c").distinct(), "contested-texts")
    held = _texts(docs, copies.join(labels, "t")).join(labels, "t").select("t", "c", "text")
    schema = T.StructType([T.StructField("t", T.LongType()), T.StructField("c", T.LongType()), T.StructField("s", T.ArrayType(T.LongType())), T.StructField("w", T.ArrayType(T.DoubleType())), T.StructField("n", T.IntegerType()), T.StructField("weight", T.DoubleType()), T.StructField("marks", T.ArrayType(T.LongType())), T.StructField("over", T.IntegerType())])

    @released(forget_words)
    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            found = [shingles(x) for x in texts(b.column("text"))]
            marks = [buckets(s) for s, _ in found]
            sets_of = [s.view(np.int64) for s, _ in found], [w for _, w in found], [len(s) for s, _ in found], [w.sum() for _, w in found]
            yield batch(schema, b.column("t"), b.column("c"), *sets_of, [m for m, _ in marks], [n for _, n in marks])

    sets = written(mapped(held, apply, schema), "shingle-sets")
    left = sets
    for _ in range(2):
        shared = left.select(F.explode("s").alias("s"), "c").groupBy("s").agg(F.min("c").alias("low"), F.max("c").alias("high")).where("low < high").select("s")
        places = left.select("t", F.explode(F.arrays_zip("s", "w")).alias("x")).select("t", F.col("x.s").alias("s"), F.col("x.w").alias("w"))
        useful = places.join(written(shared, "shared-shingles"), "s").groupBy("t").agg(F.sum("w").alias("useful"), F.count("*").alias("many"))
        kept = sets.select("t", "n", "weight", "marks", "over").join(useful, "t").where(F.col("useful") >= F.col("weight") * (threshold - 1e-9))
        kept = written(kept.select("t", "n", "weight", "marks", "over", (F.col("n") - F.col("many")).alias("none"), (1 - F.col("useful") / F.col("weight")).alias("u")), "rivals")
        left = sets.join(kept.select("t"), "t", "left_semi")
    rivals = written(contested.join(kept, "t"), "rival-keys")
    sizes = rivals.groupBy("key", "c").agg(F.count("*").alias("of_c"))
    largest = sizes.groupBy("key").agg(F.max(F.struct("of_c", "c")).alias("top"), F.count("*").alias("k")).where("k > 1").select("key", F.col("top.c").alias("main"))
    rivals = written(rivals.join(largest, "key"), "rivals-of-keys")
    x, y = (rivals.select(*(F.col(n).alias(f"{n}_{side}") for n in ("key", "main", "t", "c", "n", "weight", "marks", "over", "none", "u"))) for side in "xy")
    once = (F.col("c_y") == F.col("main_y")) | (F.col("t_x") < F.col("t_y"))
    lacks = [_lacking(*(F.col(n) for n in names)) for names in (("u_x", "n_x", "n_y", "none_y", "weight_x"), ("u_y", "n_y", "n_x", "none_x", "weight_y"))]
    may = (lacks[0] + lacks[1] <= 1 / threshold - 1 + 1e-6) & shares_enough(threshold)
    met = x.where("c_x != main_x").join(y, (F.col("key_x") == F.col("key_y")) & (F.col("c_x") != F.col("c_y")) & once & may)
    return met.select(F.least("t_x", "t_y").alias("a"), F.greatest("t_x", "t_y").alias("b")).distinct()


def _grouped(docs: DataFrame, threshold: float) -> tuple[DataFrame, DataFrame]:
    """Of documents (doc_id, text): (doc_id, copy) of each row, and (copy, first, c) of each text: its least id, and its component."""
    docs = docs.select("doc_id", digest("text").alias("copy"), "text")
    digests = written(_digests(docs), "digests")
    ids = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "keys", "sketch")
    firsts = digests.groupBy("copy").agg(F.min(ids).alias("first")).select("copy", F.xxhash64("copy").alias("t"), F.col("first.doc_id").alias("first"), "first.keys", "first.sketch")
    copies = written(firsts, "copies")
    banded = copies.select("t", F.explode("keys").alias("key"))
    leaders = banded.groupBy("key").agg(F.min_by("t", F.xxhash64("t", "key")).alias("leader"), F.count("*").alias("n")).where("n > 1").select("key", "leader")
    members = written(banded.join(leaders, "key"), "members")
    stars = members.where("t != leader").select(F.col("leader").alias("a"), F.col("t").alias("b"))
    links = _verified(stars, docs, copies, threshold)
    groups = components(links)
    labelled = members.join(groups, members["t"] == groups["v"], "left").select("key", "t", F.coalesce("c", "t").alias("c"))
    many = labelled.groupBy("key").agg(F.min("c").alias("low"), F.max("c").alias("high")).where("low < high").select("key")
    contested = written(labelled.join(many, "key"), "contested")
    merged = None
    if contested.limit(1).count():
        # A pair that a star has already tried is tried again: those are few here.
        more = _verified(_rivals(contested, docs, copies, threshold), docs, copies, threshold)
        # Only links between components matter now, so that the components are the nodes.
        ends = more.select(*(F.col(x) for x in "ab"))
        for x in "ab":
            ends = ends.join(groups.select(F.col("v").alias(x), F.col("c").alias(f"c_{x}")), x, "left").withColumn(x, F.coalesce(f"c_{x}", x)).select("a", "b")
        merged = components(ends.where("a != b").distinct()).select(F.col("v").alias("c"), F.col("c").alias("of"))
    found = copies.join(groups, copies["t"] == groups["v"], "left").select("copy", "first", F.coalesce("c", "t").alias("c"))
    if merged is not None:
        found = found.join(merged, "c", "left").select("copy", "first", F.coalesce("of", "c").alias("c"))
    return digests.select("doc_id", "copy"), found


def _classed(texts: DataFrame) -> DataFrame:
    """(copy, first, c, class_id): with the least id of the component."""
    least = texts.where(F.col("first").isNotNull()).groupBy("c").agg(F.min("first").alias("class_id"))
    return texts.join(least, "c", "left")


def classes(docs: DataFrame, threshold: float = 0.8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, class_id (the least id of its group), copy_of (the least id with the same text)."""
    rows, found = _grouped(keyed(docs, id_col, text_col).where(F.col("doc_id").isNotNull()), threshold)
    labels = _classed(found).select("copy", F.col("first").alias("copy_of"), "class_id")
    return rows.join(labels, "copy").select("doc_id", "class_id", "copy_of")


def first_of_each(docs: DataFrame, threshold: float = 0.8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`docs` with one document of each group, the one with the least id; all columns kept."""
    rows, found = _grouped(keyed(docs, id_col, text_col), threshold)
    order = F.struct(F.col("first").isNull().alias("none"), "first", "copy")
    best = found.groupBy("c").agg(F.min(order).alias("best")).select(F.col("best.copy").alias("copy"), F.col("best.first").alias("first"))
    # How often the row that stays occurs: only rows that repeat have to be brought together.
    counts = rows.groupBy("copy", "doc_id").agg(F.count("*").alias("n"))
    best = best.join(counts.withColumnRenamed("copy", "copy_n"), (F.col("copy") == F.col("copy_n")) & F.col("first").eqNullSafe(F.col("doc_id")))
    best = written(best.select(F.col("copy").alias("__copy"), F.col("first").alias("__first"), (F.col("n") > 1).alias("__repeated")), "winners")
    marked = docs.withColumn("__row", F.struct(digest(docs[text_col]).alias("copy"), docs[id_col].alias("id")))
    # An inner join: a text has one winner, and no winner has two rows here.
    kept = marked.join(small(best), (F.col("__row.copy") == F.col("__copy")) & F.col("__row.id").eqNullSafe(F.col("__first")))
    alone = kept.where(~F.col("__repeated")).select(docs.columns)
    repeated = kept.where("__repeated").dropDuplicates(["__row"]).select(docs.columns)
    return alone.unionByName(repeated)
