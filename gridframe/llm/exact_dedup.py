"""Exact dedup: compressed radix tries own the texts, partitioned by length and content hash.

A task inserts its documents' full byte strings into a Patricia trie, so that a text that
a third of all rows share leaves the task as one row with a count. These rows are
shuffled by length and content hash, sorted by both, and inserted into the partition's
trie; a terminal node holds the id that stays and the number of rows. As a hash's texts
come together, all nodes but those of the present hash are complete: when a trie is full,
its subtrees are spilled as final rows. In the first step subtrees are spilled at any time,
a text that comes again makes a row more. What a text's rows learn goes back to the
documents by the task and number under which they were counted, so no join has a key with
more than `MEMBERS` rows, however often a text is repeated.

Null texts count as empty ones and are equal to them. Texts are told apart by their UTF-8
bytes, by nothing less: hashes only say where they meet. Ties: of rows that repeat the id
that stays, the one that was read first is kept, and the others aren't. A null id loses
against all others; if a text has no other, `keep_id` is null. Very long texts are compared
whole. An empty table gives no rows. Other columns are never looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridframe.llm.common import batch, give_back, mapped, slices
from gridframe.shared import written

#: Bytes of texts in a task's trie, and rows that one entry of it stands for, at most.
TRIE_BYTES, MEMBERS = 32 << 20, 50_000
#: Of a text's node besides its bytes, about.
_NODE = 400


class Node:
    """An edge's label and what lies below. `owner` is set where a text ends."""

    __slots__ = ("label", "children", "owner")

    def __init__(self, label: bytes) -> None:
        self.label, self.children, self.owner = label, {}, None


def _shared(label: bytes, text: bytes, at: int) -> int:
    """How many bytes of `label` the text has from `at` on."""
    low, high = 0, min(len(label), len(text) - at)
    a, b = memoryview(label), memoryview(text)
    while low < high:
        middle = (low + high + 1) // 2
        if a[low:middle] == b[at + low : at + middle]:
            low = middle
        else:
            high = middle - 1
    return low


class Trie:
    """A Patricia trie of byte strings with an object at each string's end."""

    def __init__(self) -> None:
        self.root, self.bytes = Node(b""), 0

    def node(self, text: bytes) -> Node:
        """The node at which the text ends, made if it isn't there."""
        node, at = self.root, 0
        while at < len(text):
            child = node.children.get(text[at])
            if child is None:
                child = node.children[text[at]] = Node(text[at:])
                self.bytes += len(text) - at + _NODE
            elif not text.startswith(child.label, at):
                n = _shared(child.label, text, at)
                upper = node.children[text[at]] = Node(child.label[:n])
                child.label = child.label[n:]
                upper.children[child.label[0]] = child
                self.bytes += _NODE
                child = upper
            node, at = child, at + len(child.label)
        return node

    def items(self) -> Iterator[tuple[bytes, object]]:
        """All texts with their objects; each subtree is forgotten once it is passed."""
        open_ = [(self.root, b"")]
        self.root, self.bytes = Node(b""), 0
        while open_:
            node, before = open_.pop()
            text = before + node.label
            if node.owner is not None:
                yield text, node.owner
            open_ += [(child, text) for child in node.children.values()]
            node.children = {}


class Owner:
    """The rows of one text: how many, and the one that stays."""

    __slots__ = ("slot", "n", "best", "at", "parts")

    def __init__(self, slot: int = -1) -> None:
        self.slot, self.n, self.best, self.at, self.parts = slot, 0, None, None, []

    def add(self, doc_id: object, at: tuple[int, int], n: int, largest: bool) -> None:
        self.n += n
        if self.at is None or self._better(doc_id, at, largest):
            self.best, self.at = doc_id, at

    def _better(self, doc_id: object, at: tuple[int, int], largest: bool) -> bool:
        if doc_id is None or self.best is None:
            return doc_id is not None or (self.best is None and at < self.at)
        return at < self.at if doc_id == self.best else (doc_id > self.best) == largest


def _counted(docs: DataFrame, largest: bool) -> DataFrame:
    """Rows of two kinds. A document: part, slot, place, doc_id. A text of a task: part, slot, place and doc_id of the one that stays, n, text."""
    schema = T.StructType([T.StructField("part", T.IntegerType()), T.StructField("slot", T.IntegerType()), T.StructField("place", T.LongType()), T.StructField("doc_id", docs.schema["doc_id"].dataType), T.StructField("n", T.LongType()), T.StructField("text", T.BinaryType())])

    def spilled(trie: Trie, part: int) -> Iterator[pa.RecordBatch]:
        rows, size = [], 0
        for text, x in trie.items():
            rows.append((part, x.slot, x.at[1], x.best, x.n, text))
            size += len(text)
            if size > TRIE_BYTES // 8 or len(rows) == 10_000:
                yield batch(schema, *map(list, zip(*rows, strict=True)))
                rows, size = [], 0
        if rows:
            yield batch(schema, *map(list, zip(*rows, strict=True)))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, trie, slots, place = TaskContext.get().partitionId(), Trie(), 0, 0
        for b in slices(batches):
            ids, own = b.column(0).to_pylist(), []
            for doc_id, text in zip(ids, b.column(1).cast(pa.binary()).to_pylist(), strict=True):
                node = trie.node(text or b"")
                if node.owner is None:
                    node.owner, slots = Owner(slots), slots + 1
                node.owner.add(doc_id, (part, place), 1, largest)
                own.append(node.owner.slot)
                place += 1
                if node.owner.n == MEMBERS:
                    x, node.owner = node.owner, None
                    yield batch(schema, [part], [x.slot], [x.at[1]], [x.best], [x.n], [text or b""])
            n = len(ids)
            yield batch(schema, [part] * n, own, list(range(place - n, place)), ids, [None] * n, [None] * n)
            if trie.bytes > TRIE_BYTES:
                yield from spilled(trie, part)
        yield from spilled(trie, part)
        give_back()

    return mapped(docs, count, schema)


def _owned(texts: DataFrame, largest: bool) -> DataFrame:
    """part and slot of each text that a task counted, with what all tasks' rows of it come to."""
    schema = T.StructType([T.StructField("part", T.IntegerType()), T.StructField("slot", T.IntegerType()), T.StructField("keep_part", T.IntegerType()), T.StructField("keep_place", T.LongType()), T.StructField("keep_id", texts.schema["doc_id"].dataType), T.StructField("group_size", T.LongType()), T.StructField("text_sha256", T.StringType())])

    def final(trie: Trie) -> Iterator[pa.RecordBatch]:
        rows = []
        for text, x in trie.items():
            sha = hashlib.sha256(text).hexdigest()
            rows += [(part, slot, *x.at, x.best, x.n, sha) for part, slot in x.parts]
            if len(rows) >= 10_000:
                yield batch(schema, *map(list, zip(*rows, strict=True)))
                rows = []
        if rows:
            yield batch(schema, *map(list, zip(*rows, strict=True)))

    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, key = Trie(), None
        for b in slices(batches, "text"):
            columns = [b.column(c).to_pylist() for c in ("size", "hash", "part", "slot", "place", "doc_id", "n", "text")]
            for size, hashed, part, slot, place, doc_id, n, text in zip(*columns, strict=True):
                if (size, hashed) != key:
                    if trie.bytes > TRIE_BYTES:
                        yield from final(trie)
                    key = size, hashed
                node = trie.node(text)
                if node.owner is None:
                    node.owner = Owner()
                node.owner.add(doc_id, (part, place), n, largest)
                node.owner.parts.append((part, slot))
        yield from final(trie)
        give_back()

    n = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keyed = texts.withColumns({"size": F.octet_length("text"), "hash": F.xxhash64("text")})
    return mapped(keyed.repartition(n, "size", "hash").sortWithinPartitions("size", "hash"), own, schema)


def groups(docs: DataFrame, keep: str = "largest", normal: Callable[[Column], Column] | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, keep_id (its text's row that stays), group_size, kept, text_sha256.

    keep: which id of equal texts stays, the `largest` or the `smallest`. normal: a function of
    the text column; texts are equal when what it gives is.
    """
    if keep not in ("largest", "smallest"):
        raise ValueError(f"keep must be largest or smallest, not {keep}")
    text = docs[text_col] if normal is None else normal(docs[text_col])
    counted = written(_counted(docs.select(docs[id_col].alias("doc_id"), text.alias("text")), keep == "largest"), "texts")
    owned = written(_owned(counted.where(F.col("n").isNotNull()), keep == "largest"), "owners")
    members = counted.where(F.col("n").isNull()).select("part", "slot", "place", "doc_id")
    kept = (F.col("part") == F.col("keep_part")) & (F.col("place") == F.col("keep_place"))
    return members.join(owned, ["part", "slot"]).select("doc_id", "keep_id", "group_size", kept.alias("kept"), "text_sha256")


def without_copies(docs: DataFrame, keep: str = "largest", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`docs` with one row of each text, all columns kept. Of rows that repeat id and text, any one stays."""
    left = groups(docs, keep, None, id_col, text_col).where("kept").select(F.col("doc_id").alias("__id"), F.col("text_sha256").alias("__sha"))
    sha = F.sha2(F.coalesce(docs[text_col], F.lit("")), 256)
    named = docs.withColumn("__own", sha)
    stays = named.join(left, named[id_col].eqNullSafe(left["__id"]) & (named["__own"] == left["__sha"]), "left_semi")
    return stays.dropDuplicates([id_col, "__own"]).drop("__own")


#: The same by SQL.
ORACLE = """
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = max(doc_id) OVER w AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))
"""
