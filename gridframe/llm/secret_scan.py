"""Secrets in whole texts: three fixed patterns, and windows of high Shannon entropy.

The patterns (kinds assign, access, hex) are matched leftmost and without overlap,
each kind by itself, and matches that are too short are dropped. The method adds
spans of kind entropy: in each candidate string (a long run of key-like
characters) and for each character class, a window slides over the runs of that
class; its entropy follows from character counts that change by one in and one
out, and a window over the class' threshold is part of a secret. Windows that
overlap become one span. Candidates on the allow list (words, numbers, UUIDs,
paths, names, digests said to be such) are suppressed. What a span of the three
patterns covers is taken out of entropy spans, and the rest stays, however short it
is; only a rest before an assignment, which may be the head of the assigned name,
has to hold a hot window of its own.

Null text counts as empty and has no spans; repeated rows give repeated results;
other columns are ignored by `scan` and kept by `redact`. Positions are code
points, ends are exclusive.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from gridframe.llm.common import batch, keyed, mapped, released, slices, texts

Span = tuple[int, int, str]

#: The patterns of the three base kinds, in the order in which they are listed.
KINDS = ("assign", "access", "hex", "entropy")
ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")

CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{20,}")


@dataclass(frozen=True)
class CharClass:
    """A class of characters, the entropy in bits that a window of it has to reach, and what it must contain."""

    name: str
    chars: re.Pattern
    least: float
    mixed: tuple[str, ...]


#: Random strings of 20 characters have about 3.3 bits a character in hexadecimal and 4.1 in letters and digits.
CLASSES = (
    CharClass("hex", re.compile(r"[0-9a-fA-F]+"), 3.0, ("[0-9]", "[a-fA-F]")),
    CharClass("alnum", re.compile(r"[A-Za-z0-9]+"), 3.7, ("[0-9]", "[A-Za-z]")),
    CharClass("base64", re.compile(r"[A-Za-z0-9+/_=-]+"), 3.9, ("[0-9]", "[a-z]", "[A-Z]")),
)
WINDOW = 20
ALLOW = (
    re.compile(r"[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}"),
    re.compile(r"[A-Za-z][A-Za-z_/+=-]*"),
    re.compile(r"[0-9+/_=-]+"),
    re.compile(r"/?([a-z]+|[0-9]+)([-_/]([a-z]+|[0-9]+))*/?"),
    re.compile(r"(sha1|sha256|sha512|md5)[-_=].*"),
    re.compile(r"(.)\1*"),
)
_TERMS = [0.0] + [c * math.log2(c) for c in range(1, WINDOW + 2)]


def base_spans(text: str) -> list[Span]:
    """The three fixed kinds' spans, by start and then by kind."""
    found = [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    if "AKIA" in text:
        found += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    found += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2])))


def hot_windows(run: str, least: float) -> list[tuple[int, int]]:
    """Merged windows of the run whose entropy is at least `least` bits, found with running counts."""
    found: list[tuple[int, int]] = []
    counts: dict[str, int] = {}
    total = 0.0  # of c * log2(c) over the window's characters
    for i, c in enumerate(run):
        n = counts.get(c, 0)
        counts[c] = n + 1
        total += _TERMS[n + 1] - _TERMS[n]
        if i >= WINDOW:
            n = counts[out := run[i - WINDOW]]
            counts[out] = n - 1
            total += _TERMS[n - 1] - _TERMS[n]
        if i >= WINDOW - 1 and math.log2(WINDOW) - total / WINDOW >= least - 1e-9:
            start = i - WINDOW + 1
            if found and start <= found[-1][1]:
                found[-1] = (found[-1][0], i + 1)
            else:
                found.append((start, i + 1))
    return found


def _hot(part: str, at: int) -> list[tuple[int, int]]:
    """Places of the hot windows of all classes in a run of key-like characters that begins at `at`."""
    found: list[tuple[int, int]] = []
    for kind in CLASSES:
        for run in kind.chars.finditer(part):
            if run.end() - run.start() >= WINDOW and all(re.search(x, run[0]) for x in kind.mixed):
                found += [(at + run.start() + a, at + run.start() + b) for a, b in hot_windows(run[0], kind.least)]
    return found


def _merged(found: list[tuple[int, int]]) -> list[tuple[int, int]]:
    merged: list[tuple[int, int]] = []
    for a, b in sorted(found):
        if merged and a <= merged[-1][1]:
            merged[-1] = (merged[-1][0], max(merged[-1][1], b))
        else:
            merged.append((a, b))
    return merged


def entropy_spans(text: str, taken: list[Span]) -> list[Span]:
    """Spans of high entropy in candidate strings that no allow rule covers, without what spans in `taken` cover."""
    found: list[tuple[int, int]] = []
    for m in CANDIDATE.finditer(text):
        if not any(rule.fullmatch(m[0]) for rule in ALLOW):
            found += _hot(m[0], m.start())
    covered = _merged([(a, b) for a, b, _ in taken])
    names = {a for a, _, kind in taken if kind == "assign"}
    left: list[tuple[int, int]] = []
    k = 0
    for a, b in _merged(found):
        while k < len(covered) and covered[k][1] <= a:
            k += 1
        # A covered span that goes on beyond b is met by the next span again.
        for start, end in covered[k : bisect_left(covered, (b,))]:
            if a < start:
                # What precedes an assignment may be the head of its name, hot by the value alone.
                left += _hot(text[a:start], a) if start in names else [(a, start)]
            a = max(a, end)
        if a < b:
            left.append((a, b))
    return [(a, b, "entropy") for a, b in _merged(left)]


def find_secrets(text: str) -> tuple[list[Span], list[Span]]:
    """The base spans, and all spans, each by start and then by kind."""
    base = base_spans(text)
    return base, sorted([*base, *entropy_spans(text, base)], key=lambda s: (s[0], KINDS.index(s[2])))


def shown(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_assign, n_access, n_hex, n_entropy, base_sha256, spans."""
    docs = keyed(docs, id_col, text_col)
    counts = [T.StructField(f"n_{k}", T.LongType()) for k in KINDS]
    schema = T.StructType([docs.schema["doc_id"], *counts, T.StructField("base_sha256", T.StringType()), T.StructField("spans", T.StringType())])

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            rows = [find_secrets(x) for x in texts(b.column(1))]
            n = [[sum(s[2] == k for s in spans) for _, spans in rows] for k in KINDS]
            yield batch(schema, b.column(0), *n, [hashlib.sha256(shown(base).encode()).hexdigest() for base, _ in rows], [shown(spans) for _, spans in rows])

    return mapped(docs, released()(find), schema)


def masked(text: str, mask: str) -> str:
    """The text with `mask` in place of each secret; touching spans are one."""
    out, at = [], 0
    for start, end, _ in find_secrets(text)[1]:
        if start > at or not out:
            out += [text[at:start], mask]
        at = max(at, end)
    return "".join([*out, text[at:]]) if out else text


def redact(docs: DataFrame, mask: str = "[SECRET]", text_col: str = "text", length_col: str | None = "n_chars") -> DataFrame:
    """`docs` with secrets masked in its text, all rows and columns kept; changed texts get their new length."""
    schema, names = docs.schema, docs.columns

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = names.index(text_col)
        for b in slices(batches, at):
            old = b.column(at).to_pylist()
            new = [x and masked(x, mask) for x in old]
            columns = list(b.columns)
            columns[at] = pa.array(new, columns[at].type)
            if length_col in names:
                k = names.index(length_col)
                lengths = [len(y) if x != y else n for x, y, n in zip(old, new, columns[k].to_pylist(), strict=True)]
                columns[k] = pa.array(lengths, columns[k].type)
            yield batch(schema, *columns)

    return mapped(docs, released()(apply), schema)
