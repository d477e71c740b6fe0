"""Document fingerprints by randomised edit embedding.

A shared random walk embeds a text: at step j it emits the character under its
pointer, and a random bit that depends only on j and on that character tells
whether the pointer moves on. Texts a few edits apart fall back into step soon
after each edit, so their embeddings differ in few places: edit distance becomes
Hamming distance. As a character stays for a random run of steps, the walk is
followed character by character, with the run's length from a shared table.

The fingerprint samples the embedding at shared places: all of the first 32 steps,
then 32 random ones of each following octave [2^k, 2^(k+1)), each as one
hexadecimal digit that hashes the character there. It ends where the embedding
ends, so its size grows with the logarithm of the text's length, while every character
takes part in the walk. Likeness is the share of equal samples, each weighted by
the steps that it stands for, less the agreement that unrelated texts have by chance.

How soon two texts fall back into step is a matter of luck, and now and then it takes
very long. So there are three independent walks, a fingerprint has a part for each
(joined by points), and the likeness is that of the walk in which the texts agree best.

`compare` looks at two given pairs a document, its edited text and the next document,
with the whole method: shared band keys make them candidates, which are verified.

`near_pairs` finds the near texts of the whole corpus. A walk over a whole text is driven apart by
scattered edits, so here many short walks begin at places that the text itself tells (a hash
of the four characters before): what lies between two edits keeps its places and its walks. A key
is a few sampled characters of a walk's first steps; a text has its least keys by hash. Texts are candidates
if they share a third of them and are of like length, and are verified by edit distance alone. Keys
of a text that are too frequent to decide are left aside, which loses no candidate: texts that
share t of their keys share one that isn't among either's t - 1 most frequent. A key's texts
(of about one length) are first paired with the least id among them. Where they are then in several
components, those of different ones are paired as well, so that no candidate is left unjoined; what shared keys
and lengths exclude is dropped inside that join, but in it a key of many unlike texts still has work in the square of
their number.

Null text counts as empty: its fingerprint is empty, like that of other empty texts,
and unlike all others. Rows that repeat an id are ordered by text. Other columns are
ignored. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator
from math import isqrt

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridframe.llm import edits
from gridframe.llm.common import SLICE_BYTES, batch, digest, keyed, mapped, slices, small, texts
from gridframe.llm.near_dedup import components
from gridframe.shared import written
from gridframe.shipping import ship

SEED = 20_240_607
PERIOD = 4096
OCTAVE = 32
WALKS = 3
#: The share of samples that agree in unrelated texts: equal characters, or unequal ones with equal digits.
CHANCE = 0.13
#: Texts are walked side by side in groups of about so many characters; the last few go one by one.
GROUP, FEW = 4_000_000, 40

_random = np.random.default_rng(SEED)
#: Steps that a character of each of 256 classes stays in each walk, by the step at which it is reached.
STAY = _random.geometric(0.5, (WALKS, 256, PERIOD)).clip(max=30).astype(np.uint8)
_FLAT = STAY.ravel()
_LISTS: list[list[list[int]]] = []
DIGIT = _random.integers(0, 16, 256, dtype=np.uint8)
PLACES = np.concatenate([np.arange(OCTAVE), *(np.sort(_random.choice(2**k, OCTAVE, replace=False)) + 2**k for k in range(5, 24)), *(np.sort(_random.integers(0, 2**k, OCTAVE)) + 2**k for k in range(24, 40))]).astype(np.int64)
WEIGHTS = np.concatenate([np.ones(OCTAVE), *(np.full(OCTAVE, 2**k / OCTAVE) for k in range(5, 40))])
_HEX = np.frombuffer(b"0123456789abcdef", np.uint8)


def char_classes(text: str) -> np.ndarray:
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    return ((points * np.uint32(2654435761)) >> np.uint32(24)).astype(np.uint8)


def _walk_alone(walk: int, classes: np.ndarray, reached: np.ndarray, start: int, step: int) -> int:
    """One text's walk from its character `start`, reached at `step`; gives the step after the last."""
    if not _LISTS:
        _LISTS.extend([row.tolist() for row in one] for one in STAY)
    stay, steps, mask = _LISTS[walk], [], PERIOD - 1
    for c in classes[start:].tolist():
        steps.append(step)
        step += stay[c][step & mask]
    reached[start:] = steps
    return step


def walks(parts: list[np.ndarray]) -> list[list[np.ndarray]]:
    """For each text and walk, the step at which each character is reached, and at last the number of steps."""
    lengths = np.array([len(p) for p in parts], np.int64)
    order = np.argsort(-lengths, kind="stable")
    sizes = lengths[order]
    starts = np.concatenate([[0], np.cumsum(sizes + 1)])
    classes = np.zeros(int(starts[-1]), np.uint8)
    for k, i in enumerate(order):
        classes[starts[k] : starts[k] + sizes[k]] = parts[i]
    common = int(sizes[FEW]) if len(sizes) > FEW else 0
    out: list[list[np.ndarray]] = [[] for _ in parts]
    for walk in range(WALKS):
        reached = np.zeros(len(classes), np.int64)
        at = starts[:-1].copy()
        step = np.zeros(len(sizes), np.int64)
        base = (np.arange(256, dtype=np.int64) + 256 * walk) * PERIOD
        n = len(sizes)
        for i in range(common):
            while sizes[n - 1] <= i:
                n -= 1
            here, now = at[:n], step[:n]
            reached[here] = now
            now += _FLAT.take(base.take(classes.take(here)) + (now & (PERIOD - 1)))
            here += 1
        for k in range(len(sizes)):
            s, size = int(starts[k]), int(sizes[k])
            if size > common:
                step[k] = _walk_alone(walk, classes[s : s + size], reached[s : s + size], common, int(step[k]))
            reached[s + size] = step[k]
        for k, i in enumerate(order):
            out[i].append(reached[starts[k] : starts[k + 1]])
    return out


def _samples(classes: np.ndarray, reached: np.ndarray) -> str:
    places = PLACES[: np.searchsorted(PLACES, reached[-1])]
    at = np.searchsorted(reached, places, side="right") - 1
    return _HEX[DIGIT[classes[at]]].tobytes().decode()


def fingerprints(values: list[str]) -> list[str]:
    out: list[str] = []
    group: list[np.ndarray] = []
    held = 0
    for k, text in enumerate(values):
        group.append(char_classes(text))
        held += len(text)
        if held >= GROUP or k == len(values) - 1:
            out += [".".join(_samples(classes, r) for r in own) if len(classes) else "" for classes, own in zip(group, walks(group), strict=True)]
            group, held = [], 0
    return out


def _walk_likeness(a: str, b: str) -> float:
    n, m = min(len(a), len(b)), max(len(a), len(b))
    same = np.frombuffer(a[:n].encode(), np.uint8) == np.frombuffer(b[:n].encode(), np.uint8)
    share = float(WEIGHTS[:n][same].sum() / WEIGHTS[:m].sum())
    return max(0.0, (share - CHANCE) / (1 - CHANCE))


def likeness(a: str, b: str) -> float:
    """0 to 1; 1 for equal fingerprints."""
    if a == b:
        return 1.0
    return max(_walk_likeness(x, y) for x, y in zip(a.split("."), b.split("."), strict=True)) if a and b else 0.0


def edited(text: str, following: str) -> str:
    """The text with its last half replaced by as many of the first characters of the following one."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def stretched(docs: DataFrame) -> DataFrame:
    """The documents (doc_id, text) in partitions of ascending ids, each with a copy of the document that follows it.

    Column `part` numbers stretches of the ids; a stretch begins at an id that
    occurs. The rows of that id are copied into the stretch before (the first
    stretch's into the last), marked by `guest` and sorted behind the others. So
    a partition has all that it needs, and one document a stretch moves twice.
    """
    docs = docs.where(F.col("doc_id").isNotNull())
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if isinstance(docs.schema["doc_id"].dataType, T.IntegralType):
        row = docs.agg(F.percentile_approx("doc_id", [k / parts for k in range(parts)], 10_000).alias("bounds"), F.min("doc_id").alias("low")).first()
        bounds = sorted({*(row["bounds"] or []), row["low"]} - {None})
    else:
        # The least id of each range: at most one row a partition.
        ranged = docs.select("doc_id").repartitionByRange(parts, "doc_id").groupBy(F.spark_partition_id().alias("part")).agg(F.min("doc_id").alias("low"))
        bounds = sorted(r["low"] for r in ranged.collect())
    n = len(bounds)

    @F.pandas_udf("array<int>")
    def places(ids: pd.Series) -> pd.Series:
        """The stretch of each id, and for a stretch's first id the one before it."""
        at = [bisect_right(bounds, x) - 1 for x in ids.tolist()]
        return pd.Series([[k, (k - 1) % n] if bounds[k] == x else [k] for k, x in zip(at, ids.tolist(), strict=True)])

    placed = docs.select("doc_id", "text", F.posexplode(places("doc_id")).alias("guest", "part"))
    placed = placed.select("part", "guest", "doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return placed.repartitionById(max(1, n), F.col("part")).sortWithinPartitions("part", "guest", "doc_id", "text")


def candidate(a: tuple[str, str, set[str]], b: tuple[str, str, set[str]], near: float, least: float) -> tuple[int, bool]:
    """Of two texts with their fingerprints and band keys: how many keys they share, and whether they are verified."""
    shared = len(a[2] & b[2])
    return shared, shared > 0 and near >= least and near_texts(a[0], b[0], least)


def compare(docs: DataFrame, least: float = 0.8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next,
    bands_edited, bands_next (shared band keys) and verified_edited, verified_next (candidates by
    a shared key that are so like by fingerprint, and by edit distance, as `least` says).

    The edited text is `edited(text, next text)`, where the next document is that of
    the next higher id, and after the last one the first. Rows with a null id are left out.
    """
    docs = keyed(docs, id_col, text_col)
    strings = [T.StructField(n, T.StringType()) for n in ("edited_sha256", "fingerprint", "edited_fingerprint")]
    found = [T.StructField("near_edited", T.DoubleType()), T.StructField("near_next", T.DoubleType()), T.StructField("bands_edited", T.LongType()), T.StructField("bands_next", T.LongType()), T.StructField("verified_edited", T.BooleanType()), T.StructField("verified_next", T.BooleanType())]
    schema = T.StructType([docs.schema["doc_id"], T.StructField("n_chars", T.LongType()), *strings, *found])

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []  # the last row, whose next one is still to come
        for b in slices(batches, size=GROUP):
            values = b.column("text").to_pylist()
            marks = fingerprints(values)
            marked = [(v, m, set(band_keys(m))) for v, m in zip(values, marks, strict=True)]
            rows = [*held, *zip(b.column("guest").to_pylist(), b.column("doc_id").to_pylist(), marked, strict=True)]
            pairs = [(x, y) for x, y in zip(rows, rows[1:]) if not x[0]]
            held = rows[-1:]
            changed = [edited(x[2][0], y[2][0]) for x, y in pairs]
            changed = [(c, m, set(band_keys(m))) for c, m in zip(changed, fingerprints(changed), strict=True)]
            near = [(likeness(x[2][1], c[1]), likeness(x[2][1], y[2][1])) for (x, y), c in zip(pairs, changed, strict=True)]
            tried = [(candidate(x[2], c, n[0], least), candidate(x[2], y[2], n[1], least)) for (x, y), c, n in zip(pairs, changed, near, strict=True)]
            yield batch(
                schema,
                [x[1] for x, _ in pairs],
                [len(x[2][0]) for x, _ in pairs],
                [hashlib.sha256(c[0].encode()).hexdigest() for c in changed],
                [x[2][1] for x, _ in pairs],
                [c[1] for c in changed],
                *([n[k] for n in near] for k in (0, 1)),
                *([t[k][0] for t in tried] for k in (0, 1)),
                *([t[k][1] for t in tried] for k in (0, 1)),
            )

    ship(docs.sparkSession)
    return mapped(stretched(docs), apply, schema)


#: Bands of each walk's part of a fingerprint: so many keys, each of so many digits.
BANDS, DIGITS = 12, 6
_BAND_PLACES = np.stack([np.sort(np.random.default_rng(SEED + 1 + k).choice(OCTAVE, DIGITS, replace=False)) for k in range(BANDS)])


#: Samples in a key of a short text: of all places, and of the first few.
BLOCK, FIRST = 4, 2


def band_keys(mark: str) -> list[str]:
    """Keys of samples from each walk's last two whole octaves.

    A walk's part of under two octaves has every step's sample. Its keys are the
    whole part, its successive blocks of 4 samples (of 2, up to 8 samples) and, from
    one octave on, that octave's bands, which longer texts have too. Parts of likeness
    0.8 differ in at most 0.174 of their samples, which are fewer than their blocks:
    two such short parts always share a key.
    """
    out: list[str] = []
    for walk, part in enumerate(mark.split(".") if mark else []):
        whole = len(part) // OCTAVE
        if whole < 2:
            out.append(f"{walk}:{part}")
            for size in (BLOCK, FIRST) if len(part) <= 2 * BLOCK else (BLOCK,):
                out += [f"{walk}:at:{i}:{part[i : i + size]}" for i in range(0, len(part) - size + 1, size)]
        for octave in range(max(0, whole - 2), whole):
            out += [f"{walk}:{octave}:{k}:" + "".join(part[OCTAVE * octave + i] for i in places) for k, places in enumerate(_BAND_PLACES.tolist())]
    return out


#: Characters by class, of which a difference in number bounds an edit distance from below.
_BAG = 64


def _bag(text: str) -> np.ndarray:
    return np.bincount(char_classes(text) % _BAG, minlength=_BAG)


def _apart(a: np.ndarray, b: np.ndarray) -> int:
    """A lower bound of the edit distance of two texts with these bags."""
    more = a - b
    return max(int(more[more > 0].sum()), int(-more[more < 0].sum()))


def _few(n: int) -> int:
    """Edits up to which texts of n characters are compared along diagonals: their square takes about half of what n columns do."""
    return 4 + isqrt(n) // 2


def _alike(a: str, b: str, i: int, j: int) -> int:
    """How many characters a from i and b from j on have in common."""
    n, at, step = min(len(a) - i, len(b) - j), 0, 16
    while at < n and a[i + at : i + at + step] == b[j + at : j + at + step]:
        at, step = at + step, step * 2
    if at >= n:
        return n
    while step > 1:
        step //= 2
        if a[i + at : i + at + step] == b[j + at : j + at + step]:
            at += step
    return min(at, n)


def _few_edits(a: str, b: str, most: int, give_up: bool = False) -> int | None:
    """The edit distance if it is at most `most`, in the square of `most` comparisons of stretches; else None.

    give_up: None too where the first eight edits don't lead half as far as `most` edits would have to.
    """
    # For each diagonal i - j the furthest i that so many edits reach.
    end, reached = len(a) - len(b), {0: _alike(a, b, 0, 0)}
    for edits in range(most + 1):
        if reached.get(end, -1) >= len(a):
            return edits
        if give_up and edits == 8 and 2 * most * max(reached.values()) < 8 * len(a):
            return None
        after = {}
        for d in range(-edits - 1, edits + 2):
            # A replacement, a character of a left out, one of b put in.
            i = max(reached.get(d, -2) + 1, reached.get(d - 1, -2) + 1, reached.get(d + 1, -2))
            i = min(i, len(a), len(b) + d)
            if i >= max(0, d):
                after[d] = i + _alike(a, b, i, i - d)
        reached = after
    return None


def trimmed(a: str, b: str) -> tuple[str, str]:
    """The texts without what they have in common at both ends, the shorter first."""
    start = _alike(a, b, 0, 0)
    a, b = a[start:], b[start:]
    end = _alike(a[::-1], b[::-1], 0, 0)
    a, b = sorted((a[: len(a) - end], b[: len(b) - end]), key=len)
    return a, b


def edit_distances(pairs: list[tuple[str, str]], most: list[int]) -> list[int]:
    """`edit_distance` of each pair; texts of about one length are compared side by side where there are many."""
    found = [m + 1 for m in most]
    classes: dict[int, list[int]] = {}
    rest = []
    cut = [trimmed(a, b) for a, b in pairs]
    for k, (a, b) in enumerate(cut):
        if len(b) - len(a) > most[k]:
            continue
        if not a:
            found[k] = len(b)
            continue
        words = -(-len(a) // 64)
        # Words of 1, 2, 3, 4, 6, 8, 12, ...: a column is at most half as long again as it need be.
        size = next(s for p in range(words.bit_length() + 1) for s in (1 << p, 3 << p >> 1) if s >= words)
        classes.setdefault(size, []).append(k)
    for size, chosen in classes.items():
        if len(chosen) >= edits.LANES_A_WORD * size and size <= edits.MOST_WORDS:
            chosen = [k for k, far in zip(chosen, _far([cut[k] for k in chosen], [most[k] for k in chosen]), strict=True) if not far]
            # Of long texts first those that few edits may part.
            for reach in (4 * size, None) if size >= 8 else (None,):
                limits = [most[k] if reach is None else min(most[k], reach) for k in chosen]
                near = edits.distances([cut[k] for k in chosen], limits) if chosen else []
                found_here = [d <= m for d, m in zip(near, limits, strict=True)]
                for k, d, ok in zip(chosen, near, found_here, strict=True):
                    if ok:
                        found[k] = int(d)
                chosen = [k for k, ok in zip(chosen, found_here, strict=True) if not ok]
        else:
            rest += chosen
    for k in rest:
        found[k] = edit_distance(*cut[k], most[k])
    return found


def _far(pairs: list[tuple[str, str]], most: list[int]) -> list[bool]:
    """Whether each pair's characters differ in number by too much."""
    bags = [np.zeros((len(pairs), _BAG), np.int64) for _ in "ab"]
    for side, out in enumerate(bags):
        own = np.repeat(np.arange(len(pairs)), [len(p[side]) for p in pairs])
        out += np.bincount(own * _BAG + char_classes("".join(p[side] for p in pairs)) % _BAG, minlength=out.size).reshape(out.shape)
    more = bags[0] - bags[1]
    return (np.maximum(more.clip(min=0).sum(axis=1), -more.clip(max=0).sum(axis=1)) > np.array(most)).tolist()


def edit_distance(a: str, b: str, most: int) -> int:
    """Insertions, deletions and replacements between the texts; some number over `most` if there are more than that.

    Texts whose characters differ too much in number are told at once, and texts a few edits apart by
    comparing stretches along diagonals, both in about the texts' length. Others take its product with
    `most`, or less if they are nearer: the table of distances is filled bit-parallel along its diagonal, in bands that widen.
    """
    if abs(len(a) - len(b)) > most:
        return most + 1
    a, b = trimmed(a, b)
    if not a:
        return len(b)
    if len(a) >= 64:
        if _apart(_bag(a), _bag(b)) > most:
            return most + 1
        limit = _few(len(a))
        if (few := _few_edits(a, b, min(most, limit), most > limit)) is not None:
            return few
        if most <= limit:
            return most + 1
    at: dict[str, int] = {}
    for c in set(a):
        at[c] = int("".join("1" if x == c else "0" for x in reversed(a)), 2) if len(a) < 64 else int.from_bytes(np.packbits(np.frombuffer(a.encode("utf-32-le", "surrogatepass"), "<u4") == ord(c), bitorder="little").tobytes(), "little")
    most = min(most, len(b))
    for reach in sorted({min(most, max(64, len(a) // 32)), min(most, max(256, len(a) // 10)), most}):
        if (found := _banded(at, len(a), b, reach)) is not None:
            return found
    return most + 1


def _banded(at: dict[str, int], n: int, b: str, most: int) -> int | None:
    """The edit distance of a text of n characters, whose places are given by character as bits, and one no shorter, if it is at most `most`.

    Bits of long integers stand for the places i of column j that are at most `most` away from j,
    the least first; the distance is followed along the diagonal that ends in the last place, where it never falls.
    """
    if (over := len(b) - n) > most:
        return None
    width = 2 * most + 1
    full, end, found = (1 << width) - 1, 1 << (most - over), 0
    up, down = full ^ ((1 << most) - 1), 0
    for start in range(0, len(b), 512):
        # Places of the characters that the next columns look at.
        if start >= most:
            near = {c: x >> (start - most) & ((1 << (width + 512)) - 1) for c, x in at.items()}
        else:
            near = {c: (x << (most - start)) & ((1 << (width + 512)) - 1) for c, x in at.items()}
        for k, c in enumerate(b[start : start + 512]):
            same = near.get(c, 0) >> k & full
            across = (((same & up) + up) ^ up) & full | same | down
            if not across & end:
                found += 1
                if found > most:
                    return None
            rise, fall = down | (full ^ (across | up)), across & up
            across >>= 1
            up, down = fall | (full ^ (across | rise)), across & rise
    return found


def near_texts(a: str, b: str, least: float) -> bool:
    """Whether all but a share of 1 - `least` of the longer text's characters stay in the shortest edit."""
    most = int((1 - least) * max(len(a), len(b)) + 1e-9)
    return a == b or edit_distance(a, b, most) <= most


#: Places at which short walks begin: those where a hash of the WINDOW characters before is divisible by one of these, by the text's length.
WINDOW = 4
EVERY = ((0, 80, 1), (51, 640, 4), (410, 1 << 62, 16))
#: A walk's steps, how many of them are sampled, walks from each place, and keys that a text has of each density.
STEPS, SAMPLED, PIECE_WALKS, KEPT = 24, 10, 2, 32
#: Texts are candidates if they share one in so many of their keys; texts under so many characters, of which an edit changes most keys, one in so many.
SHARE, SHORT, SHARE_OF_SHORT = 3, 80, 8
_MOVES = _random.integers(0, 2, (PIECE_WALKS, STEPS, 256))
_SAMPLED = [np.sort(_random.choice(STEPS, SAMPLED, replace=False)) for _ in range(PIECE_WALKS)]


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def piece_keys(values: list[str]) -> list[np.ndarray]:
    """Keys of each text's short walks, as signed 64-bit numbers; none for an empty text."""
    parts = [np.frombuffer(v.encode("utf-32-le", "surrogatepass"), "<u4") for v in values]
    lengths = np.array([len(p) for p in parts], np.int64)
    ends = np.cumsum(lengths)
    starts = ends - lengths
    points = np.concatenate(parts) if parts else np.zeros(0, "<u4")
    classes = ((points * np.uint32(2654435761)) >> np.uint32(24)).astype(np.uint8)
    out = [np.zeros(0, np.uint64)] * len(values)
    if not len(points):
        return [x.view(np.int64) for x in out]
    window = np.zeros(len(points) + 1, np.uint64)  # at each place, of the characters before it
    for k in range(WINDOW, 0, -1):
        window[WINDOW:] = window[WINDOW:] * np.uint64(0x9E3779B97F4A7C15) ^ points[WINDOW - k : len(points) + 1 - k].astype(np.uint64)
    window = _mixed(window)
    for low, high, every in EVERY:
        chosen = np.flatnonzero((lengths >= max(1, low)) & (lengths < high))
        if not len(chosen):
            continue
        places = [np.concatenate([[starts[i]], np.arange(starts[i] + WINDOW, ends[i])[window[starts[i] + WINDOW : ends[i]] % np.uint64(every) == 0]]).astype(np.int64) if lengths[i] > WINDOW else starts[i : i + 1] for i in chosen]
        counts = [len(p) for p in places]
        begin, stop = np.concatenate(places), np.repeat(ends[chosen], counts)
        keys = np.zeros((PIECE_WALKS, len(begin)), np.uint64)
        for walk in range(PIECE_WALKS):
            at, key, sampled = begin.copy(), np.full(len(begin), walk + 1, np.uint64), set(_SAMPLED[walk].tolist())
            for step in range(STEPS):
                here = np.where(at < stop, classes[np.minimum(at, len(classes) - 1)], 0)
                if step in sampled:
                    key = (key ^ here) * np.uint64(0x9E3779B97F4A7C15)
                at += _MOVES[walk, step, here]
            keys[walk] = _mixed(key)
        at = 0
        for i, n in zip(chosen, counts, strict=True):
            out[i] = np.union1d(out[i], np.unique(keys[:, at : at + n])[:KEPT])
            at += n
    return [x.view(np.int64) for x in out]


_COPY = [T.StructField("copy", T.BinaryType()), T.StructField("n_chars", T.LongType()), T.StructField("keys", T.ArrayType(T.LongType()))]
#: Pairs that are verified together at most.
VERIFIED = 20_000
#: Texts whose lengths and short keys (some 200 bytes) are broadcast at most.
MAX_SHORT = 500_000


def _shared_enough() -> Column:
    """Whether the short keys of texts x and y allow a candidate: those in common, and those that short ones can't tell, bound the shared keys from above."""
    return F.size(F.array_intersect("short_x", "short_y")) + F.least("over_x", "over_y") >= F.greatest("least_x", "least_y")


def _verified(pairs: DataFrame, docs: DataFrame, least: float) -> DataFrame:
    """(a, b, near) of those pairs (copy_x, copy_y, a, b) whose texts are so near; near is the share of the longer text that stays."""
    kind = pairs.schema["a"].dataType
    fields = [T.StructField("a", kind), T.StructField("b", kind), T.StructField("near", T.DoubleType())]
    pairs = written(pairs, "candidates")
    needed = written(pairs.select(F.explode(F.array("copy_x", "copy_y")).alias("copy")).distinct(), "candidate-copies")
    held = docs.select(digest("text").alias("copy"), "text").join(small(needed), "copy", "left_semi").dropDuplicates(["copy"])
    held = written(held, "candidate-texts")
    for side in "xy":
        pairs = pairs.join(held.select(F.col("copy").alias(f"copy_{side}"), F.col("text").alias(f"text_{side}")), f"copy_{side}")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text_x", 2 * SLICE_BYTES, VERIFIED):
            both = list(zip(texts(b.column(2)), texts(b.column(3)), strict=True))
            sizes = [max(len(x), len(y)) for x, y in both]
            most = [int((1 - least) * n + 1e-9) for n in sizes]
            near = [1 - d / n if d <= m else -1.0 for d, m, n in zip(edit_distances(both, most), most, sizes, strict=True)]
            yield batch(T.StructType(fields), b.column(0), b.column(1), near).filter(pa.array([x >= 0 for x in near], pa.bool_()))

    # Texts of about one length together, which are compared side by side.
    pairs = pairs.select("a", "b", "text_x", "text_y").sortWithinPartitions(F.length("text_x"))
    found = mapped(pairs, verify, T.StructType(fields))
    return written(found.groupBy("a", "b").agg(F.max("near").alias("near")), "near")


def near_pairs(docs: DataFrame, least: float = 0.8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(a, b, near), a < b: pairs of near documents, that join all candidates that are near in chains.

    Documents are near if an edit of at most a share of 1 - `least` of the longer text makes one of
    the other, and candidates if they share keys (see above), or have the same text. Near is the
    share that stays. Rows that repeat an id are one document, near another one if any of its texts is.
    """
    docs = keyed(docs, id_col, text_col).where(F.col("doc_id").isNotNull())
    schema = T.StructType([docs.schema["doc_id"], *_COPY])

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            values = texts(b.column(1))
            yield batch(schema, b.column(0), [hashlib.md5(v.encode("utf-8", "surrogatepass")).digest() for v in values], [len(v) for v in values], piece_keys(values))

    marked = written(mapped(docs, mark, schema), "marked")
    first = marked.groupBy("copy").agg(F.min(F.struct("doc_id", "n_chars", "keys")).alias("first"))
    copies = first.select(F.monotonically_increasing_id().alias("text_no"), "copy", F.col("first.doc_id").alias("rep"), F.col("first.n_chars").cast("int").alias("n_chars"), "first.keys")
    short = F.array_distinct(F.transform("keys", lambda k: (k.bitwiseAND(F.lit(0xFFFF)) - 0x8000).cast("short")))
    copies = copies.withColumns({"least": F.greatest(F.lit(1), F.floor(F.size("keys") / F.when(F.col("n_chars") < SHORT, SHARE_OF_SHORT).otherwise(SHARE))).cast("int"), "short": short}).withColumn("over", F.size("keys") - F.size("short"))
    copies = written(copies, "copies")
    equal = marked.join(copies.select("copy", "rep"), "copy").where("rep < doc_id").select(F.col("rep").alias("a"), F.col("doc_id").alias("b"), F.lit(1.0).alias("near"))
    keys = copies.select("text_no", "n_chars", "least", F.explode("keys").alias("key"))
    often = keys.groupBy("key").agg(F.count("*").alias("times")).where("times > 1")
    placed = keys.join(often, "key").withColumn("place", F.row_number().over(Window.partitionBy("text_no").orderBy(F.desc("times"), "key")))
    # By length as well, each text in its own class and the next: near texts have one in common.
    size = F.floor(F.log(F.col("n_chars") + 1) / F.log(F.lit(1 / least)))
    members = written(placed.where(F.col("place") >= F.col("least")).select("text_no", F.explode(F.array(F.xxhash64("key", size), F.xxhash64("key", size + 1))).alias("group")), "groups")
    leaders = members.groupBy("group").agg(F.min("text_no").alias("no_x"), F.count("*").alias("n")).where("n > 1").select("group", "no_x")
    stars = members.join(leaders, "group").where("text_no != no_x").select("no_x", F.col("text_no").alias("no_y")).distinct()
    traits = copies.select("text_no", "copy", "rep", "n_chars", "least", "short", "over")
    side = lambda s: small(traits, MAX_SHORT).select(*(F.col(c).alias(f"no_{s}" if c == "text_no" else f"{c}_{s}") for c in traits.columns))
    like = F.least("n_chars_x", "n_chars_y") + 1e-9 >= F.greatest("n_chars_x", "n_chars_y") * least
    tested = stars.join(side("x"), "no_x").join(side("y"), "no_y").where(like & _shared_enough())
    ends = [F.least("copy_x", "copy_y").alias("copy_x"), F.greatest("copy_x", "copy_y").alias("copy_y"), F.least("rep_x", "rep_y").alias("a"), F.greatest("rep_x", "rep_y").alias("b")]
    pair = written(tested.where("rep_x != rep_y").select(*ends).distinct(), "stars")
    links = _verified(pair, docs, least)
    # What a leader leaves in other components is paired with the rest there: chains need no more pairs.
    joined = components(links.unionByName(equal).select("a", "b"))
    owned = traits.join(joined, traits["rep"] == joined["v"], "left").select("*", F.coalesce("c", "rep").alias("label")).drop("v", "c")
    labelled = written(members.join(owned.select("text_no", "label"), "text_no"), "labelled")
    mixed = labelled.groupBy("group").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low < high").select("group")
    held = written(labelled.join(mixed, "group", "left_semi").join(traits, "text_no"), "mixed")
    two = lambda s: held.select("group", *(F.col(c).alias(f"{c}_{s}") for c in held.columns if c != "group"))
    rest = two("x").join(two("y"), "group").where((F.col("label_x") != F.col("label_y")) & (F.col("rep_x") < F.col("rep_y")) & like & _shared_enough())
    more = _verified(rest.select(*ends).distinct().join(pair, ["copy_x", "copy_y"], "left_anti"), docs, least)
    return links.unionByName(more).unionByName(equal).groupBy("a", "b").agg(F.max("near").alias("near"))
