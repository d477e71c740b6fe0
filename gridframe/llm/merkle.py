"""A Merkle manifest of a dataset: a tree for each source, a tree of their roots, and proofs.

Leaves are hashed where the texts are read and written as narrow rows. Sorted by source
and id into ranges, each leaf's place follows from its place in its range and the counts of
the ranges before. Then each level is a table of its own: the rows of level k are runs of
16 nodes, (tree, run, n nodes of the tree there, their digests joined); the level above is
made by reading it once, and has a sixteenth of its rows. Proofs come from the top: a
run's siblings all the way up are those of its parent's run and one run more, found by a
merge join on (tree, run), which are coordinates and never skewed. Leaves meet the proof of
their run last, sixteen at a time, and it is never shuffled with them.

H is the lowercase hex SHA-256 of its inputs, concatenated; digests go in as hex text, and
are kept as bytes. A field counts as `-` if null, else as its UTF-8 byte count, a colon and
its value. Sources are in order of their bytes, null first. Rows that repeat an id are
leaves of their own, in order of their digests, a null id comes first. An empty text isn't a
null one; very long texts are hashed whole. An empty table has no root and gives no rows.
Columns that aren't fields don't count.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridframe.llm.common import small
from gridframe.shared import new_path, written

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: log2 of the nodes of a run.
_BITS = 4
_RUN = 1 << _BITS


def _hash(joined: Column) -> Column:
    """The digest of digests, all as bytes."""
    return F.unhex(F.sha2(F.lower(F.hex(joined)), 256))


def _field(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(fields: Sequence[Column]) -> Column:
    """The leaf of a row with these fields, in hex."""
    return F.sha2(F.concat(*map(_field, fields)), 256)


def _joined(digests: Column) -> Column:
    return F.aggregate(digests, F.unhex(F.lit("")), lambda a, x: F.concat(a, x))


def placed(rows: DataFrame, group: str | None, order: Sequence[str], name: str) -> DataFrame:
    """`rows` with tree (a number for each value of `group`, in its order), pos (0, 1, ... by `order` in the group) and n (rows of the group)."""
    spark = rows.sparkSession
    by = ([group] if group else []) + list(order)
    # Rows that are alike in all but the last column of the order are in one range.
    ranged = rows.repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), *(by[:-1] or by)).sortWithinPartitions(*by)
    rows = written(ranged.withColumn("__at", F.monotonically_increasing_id()), name)
    key = F.col(group) if group else F.lit(0)
    ranges = rows.groupBy(key.alias("__g"), F.shiftright("__at", 33).alias("__part")).agg(F.count("*").alias("__n"), F.min("__at").alias("__from"))
    own = Window.partitionBy("__g")
    before = F.coalesce(F.sum("__n").over(own.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ranges = written(ranges.select("__g", "__part", (before - F.col("__from")).alias("__shift"), F.sum("__n").over(own).alias("n"), F.min("__from").over(own).alias("tree")), f"{name}-ranges")
    rows = rows.withColumns({"__key": key, "__range": F.shiftright("__at", 33)})
    met = rows.join(small(ranges), F.col("__key").eqNullSafe(F.col("__g")) & (F.col("__range") == F.col("__part")))
    return met.withColumn("pos", F.col("__at") + F.col("__shift")).drop("__at", "__shift", "__g", "__part", "__key", "__range")


@dataclass
class Levels:
    """The run tables of one or more trees, from the leaves up, and the node in which each tree ends: tree, digest."""

    runs: list[DataFrame]
    tops: DataFrame


def levels(nodes: DataFrame, path: str) -> Levels:
    """The levels above `nodes` (tree, pos, n, digest), written below `path`. A tree of one node ends in it."""
    spark, runs, tops = nodes.sparkSession, [], []
    most = nodes.agg(F.max("n")).first()[0] or 0
    while True:
        tops.append(nodes.where("n = 1").select("tree", "digest"))
        if most <= 1:
            break
        of_run = F.transform(F.array_sort(F.collect_list(F.struct("pos", "digest"))), lambda x: x["digest"])
        level = nodes.where("n > 1").groupBy("tree", F.shiftright("pos", _BITS).alias("run")).agg(F.first("n").alias("n"), of_run.alias("digests"))
        level = level.select("tree", "run", "n", _joined(F.col("digests")).alias("joined"))
        level.write.parquet(f"{path}/level={len(runs)}")
        runs.append(spark.read.schema(level.schema).parquet(f"{path}/level={len(runs)}"))
        nodes = runs[-1].select("tree", F.col("run").alias("pos"), F.shiftright(F.col("n") + _RUN - 1, _BITS).alias("n"), _hash(F.col("joined")).alias("digest"))
        most = -(-most // _RUN)
    found = tops[0]
    for more in tops[1:]:
        found = found.unionByName(more)
    return Levels(runs, found)


def _siblings(joined: Column, place: Column) -> Column:
    """The digests before and after a place of a run."""
    at = place.cast("int") * 32
    return F.struct(F.substring(joined, F.lit(1), at).alias("before"), F.substring(joined, at + 33, F.lit(32 * _RUN)).alias("after"))


def opened(tree: Levels, above: DataFrame | None) -> list[DataFrame]:
    """For each level its runs with `path`: the siblings of the node that the run becomes, and of all that it lies in, upwards.

    above: tree, path of the tree's last node in what lies above it (and more columns, which are kept). None: nothing does.
    """
    out: list[DataFrame] = []
    for k in reversed(range(len(tree.runs))):
        runs = tree.runs[k]
        last = runs.where(F.col("n") <= _RUN).select("tree", "run", "joined")
        last = last.withColumn("path", _empty()) if above is None else last.join(above, "tree")
        if out:
            parents = out[-1].withColumnsRenamed({"run": "__run", "joined": "__joined", "path": "__path"})
            inner = runs.where(F.col("n") > _RUN).select("tree", "run", "joined", F.shiftright("run", _BITS).alias("__run")).join(parents, ["tree", "__run"])
            step = F.concat(F.array(_siblings(F.col("__joined"), F.col("run") % _RUN)), F.col("__path"))
            last = last.unionByName(inner.withColumn("path", step).drop("__run", "__joined", "__path"))
        out.append(written(last, f"paths-{k}"))
    return out[::-1]


def _empty() -> Column:
    return F.expr("cast(array() as array<struct<before: binary, after: binary>>)")


@dataclass
class Manifest:
    """A dataset's leaves (tree, pos, n, doc_id, leaf, altered), the levels of its trees and of their roots, and its root (None without rows)."""

    leaves: DataFrame
    trees: Levels
    roots: DataFrame
    top: Levels
    root: str | None


def manifest(docs: DataFrame, path: str, altered: Column | None = None, group_col: str = "source", id_col: str = "doc_id", fields: Sequence[str] = FIELDS, changed: dict[str, Column] | None = None) -> Manifest:
    """The trees of `docs`, stored below `path`.

    altered, changed: rows for which a leaf of other values, `changed` by field, is stored besides, for `proofs` to test.
    """
    leaf = F.unhex(leaf_digest([docs[f] for f in fields]))
    other = F.unhex(leaf_digest([(changed or {}).get(f, docs[f]) for f in fields]))
    other = F.when(altered, other) if altered is not None else F.lit(None).cast("binary")
    leaves = written(docs.select(docs[group_col].alias("source"), docs[id_col].alias("doc_id"), leaf.alias("digest"), other.alias("altered")), "leaves")
    leaves = placed(leaves, "source", ["doc_id", "digest"], "sorted-leaves")
    trees = levels(leaves.select("tree", "pos", "n", "digest"), f"{path}/sources")
    roots = _ranked(trees.tops)
    top = levels(roots.select(F.lit(0).alias("tree"), F.col("rank").alias("pos"), "n", "digest"), f"{path}/top")
    root = top.tops.first()
    return Manifest(leaves, trees, roots, top, None if root is None else bytes(root["digest"]).hex())


def _ranked(tops: DataFrame) -> DataFrame:
    """Subroots with their rank among the sources, in the order of `tree`, and how many there are."""
    rows = tops.select(F.col("tree").alias("source_tree"), "digest")
    found = placed(rows, None, ["source_tree"], "subroots")
    return found.select(F.col("source_tree").alias("tree"), "digest", F.col("pos").alias("rank"), "n")


def proofs(found: Manifest) -> DataFrame:
    """One row per leaf: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified.

    proof_sha256 is H of the leaf's siblings from its run up to the root, folded_root what the
    leaf (the altered one, where there is one) and these siblings come to.
    """
    tops = opened(found.top, None)
    roots = found.roots.select("tree", F.col("digest").alias("subroot"), "rank", F.shiftright("rank", _BITS).alias("__run"))
    if tops:
        up = tops[0].select(F.col("run").alias("__run"), "joined", F.col("path").alias("__path"))
        roots = roots.join(up, "__run").withColumn("path", F.concat(F.array(_siblings(F.col("joined"), F.col("rank") % _RUN)), F.col("__path")))
    else:
        roots = roots.withColumn("path", _empty())
    roots = written(roots.select("tree", "subroot", "path"), "root-paths")
    at = ["tree", "pos", "n", "doc_id", F.col("digest").alias("leaf"), "altered"]
    alone = found.leaves.where("n = 1").select(*at).join(roots, "tree").select("doc_id", "leaf", "altered", "subroot", "path")
    proved = alone
    if found.trees.runs:
        runs = opened(found.trees, roots)[0].withColumnsRenamed({"joined": "__joined", "path": "__path"})
        rows = found.leaves.where("n > 1").select(*at).groupBy("tree", F.shiftright("pos", _BITS).alias("run")).agg(F.collect_list(F.struct("pos", "doc_id", "leaf", "altered")).alias("nodes"))
        met = rows.join(runs, ["tree", "run"]).select("subroot", "__joined", "__path", F.explode("nodes").alias("x"))
        step = F.concat(F.array(_siblings(F.col("__joined"), F.col("x.pos") % _RUN)), F.col("__path"))
        proved = alone.unionByName(met.select("x.doc_id", "x.leaf", "x.altered", "subroot", step.alias("path")))
    text = lambda x: F.lower(F.hex(x))
    siblings = F.aggregate("path", F.lit(""), lambda a, x: F.concat(a, text(x["before"]), text(x["after"])))
    folded = F.aggregate("path", text(F.coalesce("altered", "leaf")), lambda a, x: F.sha2(F.concat(text(x["before"]), a, text(x["after"])), 256))
    root = F.lit(found.root).cast("string")
    proved = proved.select("doc_id", text(F.col("leaf")).alias("leaf"), text(F.col("subroot")).alias("subroot"), root.alias("root"), F.sha2(siblings, 256).alias("proof_sha256"), folded.alias("folded_root"))
    return proved.withColumn("verified", F.col("folded_root") == root)


def tampered(docs: DataFrame) -> DataFrame:
    """Proofs of all documents, of which those whose id's CRC 5 divides have their text's A-Z lower-cased after the fact."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    chosen = F.crc32(docs["doc_id"].cast("string").cast("binary")) % 5 == 0
    stored = manifest(docs, new_path(docs.sparkSession, "manifest"), chosen, changed={"text": F.translate(docs["text"], upper, upper.lower())})
    return proofs(stored)


def _oracle(below: int = 6, above: int = 3) -> str:
    """The same by SQL, with so many levels for sources' trees and for the tree of their roots."""
    field = lambda c: f"coalesce(strlen({c}::VARCHAR)::VARCHAR || ':' || {c}::VARCHAR, '-')"
    leaf = lambda t: f"sha256(concat({', '.join(field(t if f == 'text' else f) for f in FIELDS)}))"
    parts = [
        "crc_table AS (SELECT list(list_reduce(list_prepend(b, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END) ORDER BY b) AS t FROM (SELECT unnest(range(256)) AS b))",
        "picked AS (SELECT *, xor(list_reduce(list_prepend(4294967295, list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ord(x)::BIGINT)), lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8)), 4294967295) % 5 = 0 AS chosen FROM documents, crc_table)",
        "lowered AS (SELECT *, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low FROM picked)",
        f"leaves AS (SELECT doc_id, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS s, {leaf('text')} AS leaf, CASE WHEN chosen THEN {leaf('low')} ELSE {leaf('text')} END AS other FROM lowered)",
        "node0 AS (SELECT s, row_number() OVER (PARTITION BY s ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY s) AS n, leaf AS h, doc_id, other FROM leaves)",
        "fold0 AS (SELECT s, pos, doc_id, h AS leaf, other AS f, '' AS proof FROM node0)",
    ]
    for k in range(below + above):
        if k == below:
            parts.append(f"top AS (SELECT 0 AS s, s AS pos, count(*) OVER () AS n, h, s AS old FROM node{k})")
            parts.append(f"moved AS (SELECT 0 AS s, fold{k}.s AS pos, doc_id, leaf, f, proof, top.h AS subroot FROM fold{k} JOIN top ON fold{k}.s = top.old)")
        nodes, fold = ("top", "moved") if k == below else (f"node{k}", f"fold{k}")
        more = ", subroot" if k >= below else ""
        parts.append(f"side{k} AS (SELECT a.s, a.pos, any_value(a.n) AS n, coalesce(string_agg(b.h, '' ORDER BY b.pos) FILTER (b.pos < a.pos), '') AS bef, coalesce(string_agg(b.h, '' ORDER BY b.pos) FILTER (b.pos > a.pos), '') AS aft FROM {nodes} a JOIN {nodes} b ON a.s = b.s AND a.pos // 16 = b.pos // 16 GROUP BY a.s, a.pos)")
        parts.append(f"fold{k + 1} AS (SELECT x.s, CASE WHEN n = 1 THEN x.pos ELSE x.pos // 16 END AS pos, doc_id, leaf, CASE WHEN n = 1 THEN f ELSE sha256(bef || f || aft) END AS f, proof || bef || aft AS proof{more} FROM {fold} x JOIN side{k} y ON x.s = y.s AND x.pos = y.pos)")
        parts.append(f"node{k + 1} AS (SELECT s, pos // 16 AS pos, CAST(ceil(any_value(n) / 16) AS BIGINT) AS n, CASE WHEN any_value(n) = 1 THEN any_value(h) ELSE sha256(string_agg(h, '' ORDER BY pos)) END AS h FROM {nodes} GROUP BY s, pos // 16)")
    end = below + above
    return f"WITH {', '.join(parts)} SELECT doc_id, leaf, subroot, h AS root, sha256(proof) AS proof_sha256, f AS folded_root, f = h AS verified FROM fold{end}, node{end}"


ORACLE = _oracle()
