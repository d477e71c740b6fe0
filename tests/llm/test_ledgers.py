"""Ranked search, exact dedup and the Merkle manifest against brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import types as T

from gridframe.llm import exact_dedup, merkle, ranked_search
from tests.llm.conftest import DOCS, ODD, prose

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
ITEMS = T.StructType([T.StructField("item_id", T.LongType()), T.StructField("text", T.StringType())])
UPPER = {c: c + 32 for c in range(65, 91)}


def terms_of(text):
    return TERM.findall((text or "").translate(UPPER))


def brute_ranking(rows, items, k):
    """Sorted (item, rank, doc, score) of all documents that score."""
    docs = [(d, Counter(terms_of(t))) for d, t in rows]
    docs = [(d, c) for d, c in docs if c]
    n_docs, total = len(docs), sum(c.total() for _, c in docs)
    df = Counter(t for _, c in docs for t in c)
    out = []
    for item, text in items:
        scores = []
        for d, c in docs:
            m = 100 - 50 + (50 * c.total() * n_docs) // total
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((1_000_000_000 * c[t]) // (1000 * c[t] + 20 * m)) for t in set(terms_of(text)) if c[t])
            if score > 0 and d is not None:
                scores.append((-score, d))
        out += [(item, r + 1, d, -s) for r, (s, d) in enumerate(sorted(scores)[:k])]
    return sorted(out)


def ranking(spark, rows, items, k, parts=3):
    docs = spark.createDataFrame([(d, t, "en", "s", 0) for d, t in rows], DOCS).repartition(parts)
    found = ranked_search.ranked(docs, spark.createDataFrame(items, ITEMS), k)
    assert [t for _, t in found.dtypes] == ["bigint", "int", "bigint", "bigint"]
    return sorted(map(tuple, found.collect()))


CORPUS = [*enumerate([*ODD, *[prose(k, 20 + 7 * (k % 30)) for k in range(150)], *[prose(3, 40)] * 40])]
ASKED = [(0, prose(200, 12)), (1, prose(3, 40)), (2, "the of and"), (3, None), (4, ""), (5, "unheardof"), (5, "The STRASSE straße éaux"), (6, "日本語のテキスト")]


@pytest.mark.parametrize("k", [1, 5, 50, 500])
def test_ranking_equals_scoring_all(spark, k):
    assert ranking(spark, CORPUS, ASKED, k) == brute_ranking(CORPUS, ASKED, k)


def test_ranking_in_small_shards_blocks_and_pieces(spark, monkeypatch):
    monkeypatch.setattr(ranked_search, "BLOCK", 3)
    monkeypatch.setattr(ranked_search, "_PIECE", 100)
    monkeypatch.setattr(ranked_search, "SHARD_BYTES", 2000)
    assert ranking(spark, CORPUS, ASKED, 20, 7) == brute_ranking(CORPUS, ASKED, 20)


def test_ranking_of_repeated_ids_null_ids_and_nothing(spark):
    rows = [(1, "one two"), (1, "one two"), (1, "one"), (None, "one two three"), (0, "two two"), (2, "four")]
    assert ranking(spark, rows, [(9, "one two")], 3) == brute_ranking(rows, [(9, "one two")], 3)
    assert ranking(spark, [], [(9, "one")], 3) == [] and ranking(spark, rows, [], 3) == []


def test_ranking_ignores_other_columns(spark, clashing):
    found = ranked_search.ranked(clashing([t for _, t in CORPUS]), spark.createDataFrame(ASKED, ITEMS), 5)
    assert sorted(map(tuple, found.collect())) == brute_ranking(CORPUS, ASKED, 5)


def built(rows, terms):
    shard = ranked_search.ShardBuilder(terms)
    shard.add([d for d, _ in rows], [t or "" for _, t in rows])
    return dict(zip(ranked_search._SHARD.names, shard.row(), strict=True))


@settings(max_examples=150, deadline=None)
@given(data=st.data())
def test_wand_finds_the_best_of_a_shard(data):
    words = [b"a", b"b", b"c", b"d", b"e", b"f"]
    rows = [(d, " ".join(data.draw(st.lists(st.sampled_from("abcdefg"), max_size=8)))) for d in range(data.draw(st.integers(1, 40)))]
    weights = np.array(data.draw(st.lists(st.integers(0, 9), min_size=6, max_size=6)), np.int64)
    lists = ranked_search.Postings(built(rows, {w: k for k, w in enumerate(words)}), ranked_search.Corpus(len(rows), 100, weights))
    asked = data.draw(st.lists(st.sets(st.integers(0, 5)), min_size=1, max_size=5))
    k = data.draw(st.integers(1, 4))
    wanted = [np.array([lists.slot[t] for t in x if t in lists.slot], np.int64) for x in asked]
    scores, docs = ranked_search.wand(lists, wanted, k, np.ones(len(asked), np.int64))
    for j, slots in enumerate(wanted):
        total = defaultdict(int)
        for s in slots:
            for d, v in zip(lists.docs[lists.starts[s] : lists.ends[s]], lists.impacts[lists.starts[s] : lists.ends[s]], strict=True):
                total[int(d)] += int(v)
        best = sorted((-v, d) for d, v in total.items() if v > 0)[:k]
        assert sorted((-int(s), int(d)) for s, d in zip(scores[j], docs[j], strict=True) if s >= 0) == best


def test_wand_skips_documents(monkeypatch):
    """A rare word of large weight: documents that hold the frequent word alone are never scored once the heap is full."""
    rows = [(d, "common " * 3 + ("rare" if d % 500 == 0 else "")) for d in range(20_000)]
    lists = ranked_search.Postings(built(rows, {b"common": 0, b"rare": 1}), ranked_search.Corpus(20_000, 60_040, np.array([10, 6000])))
    steps, argsort = [], np.argsort
    monkeypatch.setattr(np, "argsort", lambda *a, **b: steps.append(1) or argsort(*a, **b))
    scores, docs = ranked_search.wand(lists, [np.array([0, 1])], 20, np.ones(1, np.int64))
    assert sorted(docs[0]) == [500 * d for d in range(20)] and len(steps) < 9_600


# Exact dedup.


def brute_groups(rows, largest=True):
    by = defaultdict(list)
    for d, t in rows:
        by[t or ""].append(d)
    out = []
    for text, ids in by.items():
        known = [d for d in ids if d is not None]
        keep = (max if largest else min)(known) if known else None
        sha = hashlib.sha256(text.encode()).hexdigest()
        kept = [d == keep for d in ids]
        first = kept.index(True)
        out += [(d, keep, len(ids), k == first if d == keep else False, sha) for k, d in enumerate(ids)]
    return sorted(out, key=repr)


def dedup(spark, rows, parts=3, **options):
    docs = spark.createDataFrame([(d, t, "en", "s", 0) for d, t in rows], DOCS).repartition(parts)
    return sorted(map(tuple, exact_dedup.groups(docs, **options).collect()), key=repr)


COPIES = [*enumerate([*ODD, *[prose(k % 13, 30) for k in range(120)], *[prose(1, 30) + "x", "", None, "x" * 49_999 + "y"]])]


@pytest.mark.parametrize("keep", ["largest", "smallest"])
def test_copies(spark, keep):
    assert dedup(spark, COPIES, keep=keep) == brute_groups(COPIES, keep == "largest")


def test_copies_in_full_tries_and_large_groups(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup, "TRIE_BYTES", 2_000)
    monkeypatch.setattr(exact_dedup, "MEMBERS", 7)
    rows = [*COPIES, *((k, "one of many") for k in range(1000, 1400))]
    assert dedup(spark, rows, 5) == brute_groups(rows)


def test_copies_with_repeated_and_null_ids(spark):
    rows = [(None, "a"), (None, "a"), (3, "a"), (None, "b"), (5, "c"), (5, "c"), (5, "d"), (4, "c")]
    assert dedup(spark, rows, 4) == brute_groups(rows)
    assert dedup(spark, []) == []


def test_copies_are_dropped_with_all_columns(spark, clashing):
    texts = [t for _, t in COPIES]
    docs = clashing(texts)
    left = exact_dedup.without_copies(docs, "smallest")
    assert left.columns == docs.columns
    seen = {}
    for k, t in enumerate(texts):
        seen.setdefault(t or "", k)
    assert sorted(r["doc_id"] for r in left.collect()) == sorted(seen.values())


def test_equal_by_a_normal_form(spark):
    from pyspark.sql import functions as F

    rows = [(1, "A b"), (2, "a B"), (3, "ab")]
    found = dedup(spark, rows, normal=lambda c: F.lower(c))
    assert [(r[0], r[1], r[2]) for r in found] == [(1, 2, 2), (2, 2, 2), (3, 3, 1)]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.binary(max_size=6) | st.sampled_from([b"aaaa", b"aaab", b"aa", b""]), max_size=40))
def test_trie_holds_what_went_in(texts):
    trie, want = exact_dedup.Trie(), Counter(texts)
    for t in texts:
        node = trie.node(t)
        node.owner = (node.owner or 0) + 1
    assert dict(trie.items()) == dict(want) and trie.bytes == 0


def test_trie_shares_prefixes():
    trie = exact_dedup.Trie()
    for k in range(200):
        trie.node(b"p" * 10_000 + bytes([k])).owner = 1
    assert trie.bytes < 20_000 + 500 * exact_dedup._NODE


# Merkle manifest.


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(row, text):
    values = [row[0], row[3], row[2], row[4], text]
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def climb(nodes):
    """The root above some digests and each one's (before, after) up to it."""
    paths = [[] for _ in nodes]
    at, level = list(range(len(nodes))), list(nodes)
    while len(level) > 1:
        for k, p in enumerate(at):
            run = level[p // 16 * 16 : p // 16 * 16 + 16]
            paths[k].append(("".join(run[: p % 16]), "".join(run[p % 16 + 1 :])))
        level, at = [h(*level[k : k + 16]) for k in range(0, len(level), 16)], [p // 16 for p in at]
    return level[0], paths


def brute_manifest(rows):
    trees = defaultdict(list)
    for r in rows:
        trees[r[3]].append(r)
    names = sorted(trees, key=lambda s: (s is not None, (s or "").encode()))
    made = []
    for s in names:
        leaves = sorted(((r, leaf_of(r, r[1])) for r in trees[s]), key=lambda x: (x[0][0] is not None, x[0][0] or 0, x[1]))
        made.append((leaves, *climb([x[1] for x in leaves])))
    root, up = climb([m[1] for m in made])
    out = []
    for (leaves, sub, paths), above in zip(made, up, strict=True):
        for (r, leaf), path in zip(leaves, paths, strict=True):
            tampered = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0
            folded = leaf_of(r, r[1].translate(UPPER)) if tampered and r[1] is not None else leaf
            for before, after in path + above:
                folded = h(before, folded, after)
            out.append((r[0], leaf, sub, root, h(*(b + a for b, a in path + above)), folded, folded == root))
    return sorted(out, key=repr)


def proved(spark, rows, parts=3):
    return sorted(map(tuple, merkle.tampered(spark.createDataFrame(rows, DOCS).repartition(parts)).collect()), key=repr)


def many(sources, n):
    rng = random.Random(n)
    return [(k, prose(k, 5) if k % 7 else (None, "", "Ä A")[k % 3], rng.choice(["en", None]), rng.choice(sources), rng.choice([None, k])) for k in range(n)]


@pytest.mark.parametrize(("sources", "n"), [(["s"], 1), (["s"], 16), (["s"], 17), (["s"], 257), ([None, "", "é", "z", "Z"], 300), ([f"s{k}" for k in range(40)], 90)])
def test_proofs_equal_hashing_in_order(spark, sources, n):
    rows = many(sources, n)
    assert proved(spark, rows, 4) == brute_manifest(rows)


def test_proofs_of_three_levels(spark):
    rows = [(k, f"Text {k}", "en", "hot" if k % 3 else f"s{k % 11}", None) for k in range(5000)]
    assert proved(spark, rows, 6) == brute_manifest(rows)


def test_proofs_of_odd_rows(spark):
    rows = [(k, t, None, "s", None) for k, t in enumerate(ODD)] + [(3, "again", "en", "s", 1), (3, "again", "en", "s", 1), (3, "Else", "en", "s", 1), (None, "A", None, None, None)]
    assert proved(spark, rows) == brute_manifest(rows)
    assert proved(spark, []) == []


def test_untouched_rows_verify_and_columns_do_not_clash(spark, clashing):
    docs = clashing([prose(k, 10) for k in range(50)])
    found = merkle.proofs(merkle.manifest(docs, merkle.new_path(spark, "manifest"))).collect()
    assert len(found) == 50 and all(r["verified"] for r in found)
