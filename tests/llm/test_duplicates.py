"""Near-duplicates, fingerprints and decontamination against brute force."""

import hashlib
import random
import time
from itertools import combinations

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gridframe.llm import decontaminate, fingerprints, near_dedup
from tests.llm.conftest import ODD, prose
from tests.oracle import TABLES


def changed(text, every, seed=0):
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(99)}" if k % every == every - 1 else w for k, w in enumerate(text.split(" ")))


WORDS = [f"{a}{b}{c}" for a in ("th", "on", "er", "in") for b in ("ea", "ou", "io") for c in ("nd", "st", "re", "ly", "sh", "ing")]
LONG = [prose(k, 300, WORDS) for k in range(12)]
TEXTS = [*ODD, *LONG, *LONG[:3], *(changed(LONG[k % 4], 60, k) for k in range(20)), *(changed(LONG[5], n, n) for n in (5, 20, 30, 45, 90)), "short text", "short text!", "short  text"]


def brute_classes(texts):
    sets = [near_dedup.shingles(t or "") for t in texts]
    parent = list(range(len(texts)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in combinations(range(len(texts)), 2):
        if (texts[a] or "") == (texts[b] or "") or near_dedup.similarity(sets[a], sets[b]) >= 0.8 - 1e-9:
            x, y = sorted((find(a), find(b)))
            parent[y] = x
    return [find(k) for k in range(len(texts))]


def test_classes(make):
    found = {r.doc_id: r for r in near_dedup.classes(make(TEXTS)).collect()}
    assert [found[k].class_id for k in range(len(TEXTS))] == brute_classes(TEXTS)
    assert len(found) == len(TEXTS)


def test_first_of_each(make):
    kept = near_dedup.first_of_each(make(TEXTS))
    assert kept.columns == make([]).columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(brute_classes(TEXTS)))


def test_chains_are_joined(spark):
    links = spark.createDataFrame([(k, k + 1) for k in range(0, 40)] + [(100, 101), (101, 102)], "a long, b long")
    assert {r.v: r.c for r in near_dedup.components(links).collect()} == {**dict.fromkeys(range(41), 0), 100: 100, 101: 100, 102: 100}


def test_dedup_odd_tables(make, clashing, spark):
    assert near_dedup.classes(make([])).count() == 0
    assert near_dedup.classes(clashing(["a b c", "a b c"])).columns == ["doc_id", "class_id", "copy_of"]
    assert near_dedup.first_of_each(clashing(["a b c", "a b c", "d"])).count() == 2
    nulls = spark.createDataFrame([(None, "a"), (None, "a"), (1, "a"), (2, "a")], "doc_id long, text string")
    assert sorted(r.doc_id for r in near_dedup.classes(nulls).collect()) == [1, 2]
    assert [r.doc_id for r in near_dedup.first_of_each(nulls).collect()] == [1]
    assert near_dedup.first_of_each(nulls.where("doc_id IS NULL")).count() == 1


def test_repeated_ids_and_rows(spark):
    a, b = LONG[0], LONG[1]
    rows = [(1, a), (1, b), (2, a + " tail end"), (3, b + " tail end"), (4, LONG[2]), (4, LONG[2]), (None, LONG[2]), (None, LONG[3]), (None, LONG[3])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(tuple(r)[:2] for r in near_dedup.classes(docs).collect()) == [(1, 1), (1, 1), (2, 1), (3, 1), (4, 4), (4, 4)]
    kept = near_dedup.first_of_each(docs).collect()
    assert sorted((r.doc_id or 0, r.text) for r in kept) == sorted([(1, a), (1, b), (4, LONG[2]), (0, LONG[3])])


def cloud(n, words=200):
    """Edits of one template: near copies, edits that are like the template alone, cut ones, and pairs of near copies of edits."""
    rng, base = random.Random(8), prose(600, words, WORDS).split(" ")
    texts = []
    for k in range(n):
        new = list(base)
        for _ in range((1, 3, 5, 6, 8, 12)[k % 6]):
            new[rng.randrange(words)] = f"edit{rng.randrange(10**6)}"
        if k % 11 == 10:
            new = new[: rng.randrange(words // 2, words)]
        texts.append(" ".join(new))
        if k % 4 == 3:
            new[rng.randrange(len(new))] = f"later{k}"
            texts.append(" ".join(new))
    return texts


def test_template_cloud(make, monkeypatch):
    texts = cloud(160)
    tried = []
    plain = near_dedup._rivals
    monkeypatch.setattr(near_dedup, "_rivals", lambda *a: tried.append(near_dedup.written(plain(*a), "tried")) or tried[-1])
    found = {r.doc_id: r.class_id for r in near_dedup.classes(make(texts)).collect()}
    wanted = brute_classes(texts)
    assert [found[k] for k in range(len(texts))] == wanted
    assert tried and tried[0].count() < 4 * len(texts)


def test_the_bound_holds(spark):
    rng, rows = np.random.default_rng(9), []
    for _ in range(300):
        sets = []
        for _ in range(2):
            e = np.unique(rng.integers(0, 24, rng.integers(6, 19))).astype(np.uint64)
            sets.append((e, rng.integers(1, 5, len(e)).astype(float)))
        (a, wa), (b, wb) = sets
        # Of what isn't common only a part is known to be useless.
        ua, ub = (~np.isin(x, y) & (rng.random(len(x)) < 0.7) for x, y in ((a, b), (b, a)))
        rows.append((slow_similarity(*sets), len(a), wa.sum(), int(ua.sum()), wa[ua].sum() / wa.sum(), len(b), wb.sum(), int(ub.sum()), wb[ub].sum() / wb.sum()))
    frame = spark.createDataFrame([tuple(map(float, r)) for r in rows], "j double, n double, w double, none double, u double, n2 double, w2 double, none2 double, u2 double")
    one, two = (near_dedup._lacking(*(F.col(x) for x in names)) for names in (("u", "n", "n2", "none2", "w"), ("u2", "n2", "n", "none", "w2")))
    assert frame.where(F.col("j") > 1 / (1 + one + two) + 1e-9).count() == 0


def slow_similarity(a, b):
    x, y = dict(zip(*map(list, a))), dict(zip(*map(list, b)))
    keys = x.keys() | y.keys()
    return sum(1 / sum(max(x.get(j, 0) / x[i], y.get(j, 0) / y[i]) for j in keys) for i in x.keys() & y.keys())


def test_similarity_is_the_index():
    rng = np.random.default_rng(1)
    for _ in range(40):
        sets = [(np.unique(rng.integers(0, 30, 20)).astype(np.uint64),) for _ in range(2)]
        a, b = [(e, rng.integers(1, 6, len(e)).astype(float)) for (e,) in sets]
        assert near_dedup.similarity(a, b) == pytest.approx(slow_similarity(a, b))
    e = np.arange(10, dtype=np.uint64)
    assert near_dedup.similarity((e[:8], np.ones(8)), (e[2:], np.ones(8))) == pytest.approx(6 / 10)
    assert near_dedup.similarity((e, np.ones(10)), (e, 3 * np.ones(10))) == pytest.approx(1)


def test_registers_agree_with_the_index():
    rng = np.random.default_rng(2)
    m = 4000
    for n in (3, 200):
        e = rng.integers(1, 2**62, n).astype(np.uint64)
        wa, wb = rng.integers(1, 5, n).astype(float), rng.integers(1, 5, n).astype(float)
        a, b = (e[: n - 1], wa[: n - 1]), (e[1:], wb[1:])
        agree = np.mean(near_dedup.registers(*a, m) == near_dedup.registers(*b, m))
        assert agree == pytest.approx(slow_similarity(a, b), abs=0.04)
    assert near_dedup.registers(e[:1], np.ones(1), 8).tolist() == [int(e[0])] * 8


def test_early_termination_changes_nothing():
    e = np.random.default_rng(3).integers(1, 2**62, 500).astype(np.uint64)
    w = np.ones(500)
    whole = near_dedup.registers(e, w, 64)
    order = np.random.default_rng(4).permutation(500)
    assert (near_dedup.registers(e[order], w, 64) == whole).all()


def test_fingerprints_by_a_plain_walk():
    text = prose(9, 400)
    classes = fingerprints.char_classes(text)
    parts = []
    for table in fingerprints.STAY:
        embedded, step = [], 0
        for c in classes.tolist():
            stay = int(table[c, step % fingerprints.PERIOD])
            embedded += [c] * stay
            step += stay
        parts.append("".join("0123456789abcdef"[fingerprints.DIGIT[embedded[p]]] for p in fingerprints.PLACES if p < step))
    digits = ".".join(parts)
    assert fingerprints.fingerprints(["", text, "x", text]) == ["", digits, fingerprints.fingerprints(["x"])[0], digits]


def test_many_texts_walk_as_one_does():
    texts = [prose(k, 5 + 7 * k) for k in range(90)] + ["", "é", "y" * 5000]
    assert fingerprints.fingerprints(texts) == [fingerprints.fingerprints([t])[0] for t in texts]


def test_compare(make):
    texts = TEXTS[:20]
    found = {r.doc_id: r for r in fingerprints.compare(make(texts)).collect()}
    assert len(found) == len(texts)
    for k, t in enumerate(texts):
        t, after = t or "", texts[(k + 1) % len(texts)] or ""
        half = len(t) // 2
        edit = t[: len(t) - half] + after[:half]
        mark, edited, following = fingerprints.fingerprints([t, edit, after])
        r = found[k]
        assert (r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint) == (len(t), hashlib.sha256(edit.encode()).hexdigest(), mark, edited)
        assert r.near_edited == fingerprints.likeness(mark, edited) and r.near_next == fingerprints.likeness(mark, following)
        for other, near, bands, verified, found_mark in ((edit, r.near_edited, r.bands_edited, r.verified_edited, edited), (after, r.near_next, r.bands_next, r.verified_next, following)):
            assert bands == len(set(fingerprints.band_keys(mark)) & set(fingerprints.band_keys(found_mark)))
            short = t == other or max(len(t), len(other)) < 4000 and slow_distance(t, other) <= 0.2 * max(len(t), len(other)) + 1e-9
            assert verified == (bands > 0 and near >= 0.8 and short)


def test_compare_verifies_near_neighbours(spark):
    texts = {"b": LONG[0], "c": LONG[0][:-40] + "other words now", "d": LONG[1], "é": LONG[1] + "!"}
    rows = spark.createDataFrame(list(texts.items()), "doc_id string, text string").repartition(3)
    found = {r.doc_id: r for r in fingerprints.compare(rows).collect()}
    assert {k: found[k].verified_next for k in texts} == {"b": True, "c": False, "d": True, "é": False}
    assert found["é"].near_next == fingerprints.likeness(*fingerprints.fingerprints([texts["é"], texts["b"]]))


def test_compare_odd_tables(make, clashing, spark):
    assert fingerprints.compare(make([])).count() == 0
    assert fingerprints.compare(make(["alone in here"])).first().near_next == 1.0
    assert fingerprints.compare(clashing(["a", "b"])).count() == 2
    repeated = spark.createDataFrame([(5, "a b"), (5, "a b"), (9, None), (None, "x")], "doc_id long, text string")
    assert sorted(r.doc_id for r in fingerprints.compare(repeated).collect()) == [5, 5, 9]


def test_likeness_falls_with_edits():
    means = []
    for every in (300, 60, 5):
        texts = [prose(k, 600, WORDS) for k in range(30)]
        near = [fingerprints.likeness(*fingerprints.fingerprints([t, changed(t, every, k)])) for k, t in enumerate(texts)]
        means.append(np.mean(near))
    other = [fingerprints.likeness(*fingerprints.fingerprints([t, prose(70 + k, 600, ["zu", "qui", "ver"])])) for k, t in enumerate(texts)]
    assert means[0] > 0.7 and means[0] > means[1] > means[2] and np.mean(other) < 0.1


def test_near_pairs(make):
    texts = [prose(k, 500, WORDS) for k in range(6)]
    texts += [t[:-9] + "x" + t[-8:] for t in texts]
    found = {(r.a, r.b) for r in fingerprints.near_pairs(make(texts)).collect()}
    assert found == {(k, k + 6) for k in range(6)}


def joined(pairs, n):
    label = list(range(n))
    for a, b in pairs:
        low, high = sorted((label[a], label[b]))
        label = [low if x == high else x for x in label]
    return label


def brute_pairs(texts, least=0.8):
    """All pairs that are near by edit distance, whatever keys they share."""
    for a, b in combinations(range(len(texts)), 2):
        x, y = texts[a] or "", texts[b] or ""
        most = int((1 - least) * max(len(x), len(y)) + 1e-9)
        if x == y or (abs(len(x) - len(y)) <= most and fingerprints.edit_distance(x, y, most) <= most):
            yield a, b


def recall(found, wanted, n):
    """The share of the wanted pairs that the found ones join in chains."""
    label = joined(found, n)
    return sum(label[a] == label[b] for a, b in wanted) / len(wanted)


def slow_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        last, row[0] = row[0], i + 1
        for j, y in enumerate(b):
            last, row[j + 1] = row[j + 1], min(row[j + 1] + 1, row[j] + 1, last + (x != y))
    return row[-1]


def test_near_pairs_of_a_hot_key_and_of_short_texts(make, monkeypatch):
    # All texts share a key, whose least id is unlike the rest.
    plain = fingerprints.piece_keys
    monkeypatch.setattr(fingerprints, "piece_keys", lambda values: [np.append(k, 7) for k in plain(values)])
    texts = ["unlike all the others, and first", None, "", *(prose(k, 40, WORDS) for k in range(5))]
    texts += [t[:60] + "x" + t[61:] for t in texts[3:]] + [texts[4]]
    short = ["call me at noon tomorrow", "see you", "abcdefghij klm"]
    texts += [*short, *(t[:-1] + "!" for t in short), *(t + "." for t in short), "ab", "ac", "x"]
    found = {(r.a, r.b): r.near for r in fingerprints.near_pairs(make(texts)).collect()}
    wanted = set(brute_pairs(texts))
    assert set(found) <= wanted and joined(found, len(texts)) == joined(wanted, len(texts))
    assert {(k, k + 5) for k in range(3, 8)} <= wanted and (4, 13) in wanted
    for (a, b), near in found.items():
        x, y = texts[a] or "", texts[b] or ""
        assert near == (1 - slow_distance(x, y) / max(len(x), len(y)) if x != y else 1.0)


def scattered(text, share, seed):
    """The text with so large a share of its characters replaced, dropped or doubled, anywhere."""
    rng, out = random.Random(seed), list(text)
    for k in rng.sample(range(len(out)), max(1, int(share * len(out)))):
        out[k] = rng.choice(["", "q", out[k] + rng.choice("aeiou")])
    return "".join(out)


@pytest.mark.parametrize("share", [0.01, 0.02, 0.05])
def test_recall_of_scattered_edits(make, share):
    texts = [prose(300 + k, 15 + 25 * k, WORDS) for k in range(30)]
    texts += [scattered(t, share, k) for k, t in enumerate(texts)]
    found = {(r.a, r.b) for r in fingerprints.near_pairs(make(texts)).collect()}
    wanted = set(brute_pairs(texts))
    assert {(k, k + 30) for k in range(30)} <= wanted and found <= wanted
    assert recall(found, wanted, len(texts)) >= 0.9


@pytest.mark.skipif(not TABLES.exists(), reason="the tables aren't here")
def test_recall_on_given_documents(spark):
    """All pairs by edit distance among the documents of up to 2,500 characters."""
    texts = sorted({r.text for r in spark.read.parquet(f"{TABLES}/documents.parquet").collect() if r.text and 20 <= len(r.text) <= 2500})
    found = {(r.a, r.b) for r in fingerprints.near_pairs(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    wanted = set(brute_pairs(texts))
    assert found <= wanted and len(wanted) >= 3 and recall(found, wanted, len(texts)) >= 0.9


def test_keys_of_all_densities():
    """Texts of about one length have keys in common wherever the densities change; keys don't depend on the other texts."""
    for n in (60, 79, 80, 410, 512, 640, 700):
        text = prose(n, n, WORDS)[:n]
        a, b = fingerprints.piece_keys([text, "other " * 20, text[: n - 3] + "zz"])[::2]
        assert len(set(a.tolist()) & set(b.tolist())) * 2 > min(len(a), len(b))
        assert fingerprints.piece_keys([text])[0].tolist() == a.tolist()
    assert [len(k) for k in fingerprints.piece_keys(["", "a", "", "日本"])] == [0, 2, 0, 2] and fingerprints.piece_keys([]) == []


def test_short_texts_share_keys_if_near():
    rng, met = random.Random(3), 0
    for n in (2, 3, 4, 5, 6, 7, 8, 9, 10, 12, 15, 18, 22, 26, 30) * 30:
        a = "".join(rng.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(n))
        k = rng.randrange(n)
        b = a[:k] + rng.choice(["", "Q", a[k] + "Q"]) + a[k + 1 :]
        x, y = fingerprints.fingerprints([a, b])
        if max(len(p) for p in f"{x}.{y}".split(".")) < 64 and fingerprints.likeness(x, y) >= 0.8:
            met += x != y
            assert set(fingerprints.band_keys(x)) & set(fingerprints.band_keys(y)), (a, b)
    assert met > 50


def test_edit_distance():
    rng = random.Random(4)
    for n in (0, 1, 5, 30, 63, 64, 65, 150) * 6:
        a = "".join(rng.choice("abé日") for _ in range(n))
        b = "".join(rng.choice([c, c, c, c, "", "z" + c, "b"]) for c in a)
        want = slow_distance(a, b)
        assert fingerprints.edit_distance(a, b, 10**6) == fingerprints.edit_distance(b, a, want) == want
        assert want == 0 or fingerprints.edit_distance(a, b, want - 1) > want - 1


@settings(max_examples=300, deadline=None)
@given(a=st.text("abc", max_size=40), b=st.text("abc", max_size=40), most=st.integers(0, 12))
def test_few_edits(a, b, most):
    want = slow_distance(a, b)
    assert fingerprints._few_edits(a, b, most) == (want if want <= most else None)


@pytest.mark.parametrize("size", [1, 2, 3, 9])
def test_edit_distances_side_by_side(monkeypatch, size):
    """Pairs of about one length are compared together, and as each alone."""
    rng = random.Random(size)
    pairs, most = [], []
    for _ in range(12 * size + 20):
        a = [rng.choice("abcdeé日𝒳 ") for _ in range(rng.randrange(64 * size - 40, 64 * size + 1))]
        b = list(a)
        for _ in range(rng.randrange(30 * size)):
            at = rng.randrange(len(b))
            b[at : at + rng.randrange(2)] = rng.choice(["", "a", "c", "日z"])
        pairs.append(("".join(a), "".join(b)))
        most.append(rng.choice([0, 3, 12 * size, 25 * size, 500]))
    pairs += [("", ""), ("", "abc"), ("same", "same")]
    most += [0, 3, 1]
    together, real = [], fingerprints.edits.distances
    monkeypatch.setattr(fingerprints.edits, "LANES_A_WORD", 1)
    monkeypatch.setattr(fingerprints.edits, "distances", lambda p, m: together.append(len(p)) or real(p, m))
    found = fingerprints.edit_distances(pairs, most)
    want = [fingerprints.edit_distance(a, b, 10**6) for a, b in pairs]
    assert together
    for d, m, w in zip(found, most, want, strict=True):
        assert d == w if w <= m else d > m


def test_edit_distance_of_long_texts():
    rng = random.Random(5)
    long = prose(9, 160_000, WORDS)[:1_000_000]
    few = list(long)
    for k in rng.sample(range(len(few)), 30):
        few[k] = rng.choice(["", "q", few[k] + "z"])
    few = "".join(few)
    began = time.time()
    d = fingerprints.edit_distance(long, few, 200_000)
    assert 1 <= d <= 40 and fingerprints.edit_distance(few, long, d) == d and fingerprints.edit_distance(long, few, d - 1) > d - 1
    assert fingerprints.edit_distance(long, "zq" * 500_000, 200_000) > 200_000
    assert time.time() - began < 20
    for n in (100, 300, 700):
        a = "".join(rng.choice("abcd") for _ in range(n))
        b = "".join(rng.choice([c, c, c, "", "z"]) for c in a)
        want = slow_distance(a, b)
        assert fingerprints.edit_distance(a, b, n) == want and fingerprints.edit_distance(b, a, want - 1) > want - 1


def test_equal_fingerprints_of_unlike_texts_are_no_pair(make):
    a = "the same digits"
    other = {}
    for c in map(chr, range(0x4E00, 0x9000)):
        other.setdefault(int(fingerprints.char_classes(c)[0]), c)
    b = "".join(other[int(x)] for x in fingerprints.char_classes(a))
    assert len(set(fingerprints.fingerprints([a, b]))) == 1
    assert fingerprints.near_pairs(make([a, b])).count() == 0


def test_near_pairs_odd_tables(make, clashing, spark):
    assert fingerprints.near_pairs(make([])).count() == 0
    assert [tuple(r) for r in fingerprints.near_pairs(clashing(["a b", "c d", "a b"])).collect()] == [(0, 2, 1.0)]
    repeated = spark.createDataFrame([(5, "a b"), (5, "a b"), (5, "zz"), (9, "zz"), (9, None), (None, "zz"), (12, "")], "doc_id long, text string")
    assert sorted(tuple(r) for r in fingerprints.near_pairs(repeated).collect()) == [(5, 9, 1.0), (9, 12, 1.0)]


def slow_containment(docs, items):
    def grams(t):
        w = [x for x in "".join(c.lower() if c.isalnum() else " " for c in t or "").split()]
        return {tuple(w[k : k + 5]) for k in range(len(w) - 4)}

    has = [grams(t) for t in docs]
    out = set()
    for i, t in enumerate(items):
        wants = grams(t)
        out |= {(d, i, len(wants), len(wants & h), len(wants & h) / len(wants)) for d, h in enumerate(has) if wants and len(wants & h) >= 0.8 * len(wants)}
    return out


def test_containment(make, spark):
    items = [prose(100 + k, 6 + 5 * k, WORDS) for k in range(9)] + ["too short", None, "", LONG[2]]
    docs = [*ODD, *LONG]
    docs += [LONG[k % 12] + " " + items[k].upper().replace(" ", ", ") + ". " + LONG[(k + 1) % 12] for k in range(9)]
    docs += [LONG[k % 12] + " " + changed(items[k], 25, k) for k in range(9)]
    frame = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    found = {tuple(r) for r in decontaminate.contained(make(docs), frame).collect()}
    assert found == slow_containment(docs, items)
    kept = decontaminate.without(make(docs), frame)
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(range(len(docs))) - {r[0] for r in found}) and kept.columns == make([]).columns


def test_containment_odd_tables(make, clashing, spark, monkeypatch):
    items = spark.createDataFrame([(0, LONG[0]), (0, LONG[0]), (None, LONG[1])], "item_id long, text string")
    assert decontaminate.contained(make([]), items).count() == 0
    assert decontaminate.contained(make(LONG), items.limit(0)).count() == 0
    assert [r.doc_id for r in decontaminate.contained(clashing(LONG), items).collect()] == [0]
    monkeypatch.setattr(decontaminate, "_small", lambda df, most=0: df)
    assert [r.doc_id for r in decontaminate.contained(make(LONG), items).collect()] == [0]


def test_buckets_never_rule_out_a_link(spark):
    """Against brute force: weighted sets around one template, small and far larger than the buckets are many."""
    rng = np.random.default_rng(5)
    rows = []
    for size, spread in ((40, 3), (40, 20), (150, 30), (150, 60), (4000, 500), (4000, 1800)):
        template = rng.integers(0, 2**64, size, dtype=np.uint64)
        sets = []
        for _ in range(12):
            own = np.unique(np.concatenate([rng.choice(template, size - rng.integers(0, spread), replace=False), rng.integers(0, 2**64, rng.integers(0, spread), dtype=np.uint64)]))
            sets.append((own, rng.choice([1.0, 3.0], len(own), p=[0.98, 0.02])))
        for x, y in combinations(sets, 2):
            (mx, ox), (my, oy) = near_dedup.buckets(x[0]), near_dedup.buckets(y[0])
            shared = sum(bin(int(p) & int(q) & (2**64 - 1)).count("1") for p, q in zip(mx, my)) + min(ox, oy)
            assert shared >= len(np.intersect1d(x[0], y[0]))
            rows.append((near_dedup.similarity(x, y), mx.tolist(), ox, len(x[0]), float(x[1].sum()), my.tolist(), oy, len(y[0]), float(y[1].sum())))
    held = spark.createDataFrame(rows, "s double, marks_x array<long>, over_x int, n_x int, weight_x double, marks_y array<long>, over_y int, n_y int, weight_y double")
    for threshold in (0.5, 0.8):
        links = sum(r[0] >= threshold for r in rows)
        assert 0 < links < len(rows)
        assert held.where(near_dedup.shares_enough(threshold)).where(f"s >= {threshold}").count() == links
