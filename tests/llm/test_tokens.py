"""Packing, token counts and token files against the tokenizers library."""

import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
import zstandard
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from gridframe.llm import packing, range_coder, token_counts, token_files
from gridframe.llm.tokens import Cache, WordEncoder
from tests.llm.conftest import ODD, prose
from tests.oracle import TABLES

WORD, BYTE = P.path("word_bpe_49k.json"), P.path("byte_bpe_50k.json")
TEXTS = [*ODD, *[prose(k, 40 * k) for k in range(25)], prose(3, 120)]


@pytest.fixture(scope="module")
def word():
    return Tokenizer.from_file(WORD)


@pytest.fixture(scope="module")
def byte():
    return Tokenizer.from_file(BYTE)


def ids_of(tokenizer, text):
    return np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 2], "<u4")


TEXT = st.text(st.sampled_from("aAbé \n\t.,!'sß<|>İǅ\u3000\u0301\x1c1²"), max_size=30)


@settings(max_examples=150, deadline=None)
@given(text=TEXT)
def test_word_encoder(word, text):
    assert WORD_ENCODER.encode(text).tolist() == word.encode(text, add_special_tokens=False).ids


def test_columns_are_encoded_in_three_calls(word):
    """Of words, marks and other chunks, each distinct one once; nulls and slices of columns as well."""

    class Counted:
        calls = 0

        def encode_batch_fast(self, *args, **kwargs):
            self.calls += 1
            return word.encode_batch_fast(*args, **kwargs)

    encoder = WordEncoder(WORD)
    encoder.tokenizer = Counted()
    column = pa.array(["left out", *TEXTS, "Word! word, WORD?! 12 a1 \n b-c Straße. straße"]).slice(1)
    ids, ends = encoder.encode_column(column)
    assert encoder.tokenizer.calls == 3
    found = np.split(ids, ends[:-1])
    assert [x.tolist() for x in found] == [word.encode(t or "", add_special_tokens=False).ids for t in column.to_pylist()]
    assert [x.tolist() for x in encoder.encode_column(pa.array([], pa.string()))] == [[], []]


@settings(max_examples=150, deadline=None)
@given(text=TEXT)
def test_pretoken_counts(byte, text):
    parts = token_counts.pretokens(text)
    assert sum(COUNTER.lengths(parts)) == len(byte.encode(text, add_special_tokens=False).ids)


WORD_ENCODER, COUNTER = WordEncoder(WORD, 2000), token_counts.PretokenCounter(BYTE, 2000)


def test_cache_is_bounded():
    cache = Cache(1000)
    for k in range(500):
        cache.turn()
        cache.put(str(k), k, 100)
    assert len(cache.new) + len(cache.old) < 40


def test_token_counts(make, byte):
    found = {r.doc_id: r for r in token_counts.count_tokens(make(TEXTS), BYTE).collect()}
    for k, t in enumerate(TEXTS):
        n = len(byte.encode(t or "", add_special_tokens=False).ids)
        assert (found[k].n_bytes, found[k].n_tokens, found[k].over_limit) == (len((t or "").encode()), n, n > 512)


def test_token_counts_clashing_and_empty(clashing, make):
    assert token_counts.count_tokens(clashing(["a b", "a b"]), BYTE).columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    assert token_counts.count_tokens(make([]), BYTE).count() == 0


def test_frequent_pretokens_are_those_of_the_corpus(make):
    found = token_counts.frequent_pretokens(make(["the cat sat on the mat the"] * 30 + ["other words here"]).select("text"), BYTE, table_size=3)
    assert set(found) <= {" the", " cat", " sat", " on", " mat", "the"} and found[" the"] == 1 and len(found) == 3


def test_lossy_count_keeps_frequent_items():
    seen = token_counts.LossyCount(50)
    for k in range(3000):
        seen.add(["often", f"once{k}"])
    found = dict(seen.frequent(0.3))
    assert found["often"] >= 2900 and len(found) < 100


def check_pieces(rows, texts, tokenizer, window=4096):
    by, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        by[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
    for k, t in enumerate(texts):
        ids, at = ids_of(tokenizer, t), 0
        for r in sorted(by[k], key=lambda r: r.start):
            assert (r.start, r.doc_tokens, r.ids_crc32) == (at, len(ids), zlib.crc32(ids[r.start : r.start + r.length])) and r.length > 0
            at += r.length
        assert at == len(ids)
    padding = 0
    for pieces in sequences.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= window
        padding += 0 if at & (at - 1) == 0 else window - at
    return padding


def test_packing(make, word):
    rows = packing.pack(make(TEXTS), WORD, horizon=20_000).collect()
    total = sum(len(ids_of(word, t)) for t in TEXTS)
    assert check_pieces(rows, TEXTS, word) < 0.1 * total
    order = sorted(rows, key=lambda r: (r.sequence_id, r.offset))
    assert [(r.doc_id, r.start) for r in order] == sorted((r.doc_id, r.start) for r in rows)
    assert all(zlib.crc32(np.array(r.ids, "<u4")) == r.ids_crc32 for r in rows)


def test_packing_odd_tables(make, clashing, spark, word):
    assert packing.pack(make([]), WORD).count() == 0
    assert packing.pack(clashing(["a b"]), WORD, with_ids=False).columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    repeated = spark.createDataFrame([(1, "a"), (1, "a"), (None, "b c")], "doc_id long, text string")
    assert sum(r.length for r in packing.pack(repeated, WORD).collect()) == 2 + 2 + 3


def brute(positions, penalties, window):
    """The least cost by trying every earlier cut."""
    cost = [0.0] * len(positions)
    for c in range(1, len(positions)):
        options = []
        for i in range(c):
            n = positions[c] - positions[i]
            if n <= window:
                free = n & (n - 1) == 0 and n >= packing.LEAST_POWER
                options.append(cost[i] + (0 if free else window - n))
        cost[c] = min(options) + penalties[c]
    return cost[-1]


@settings(max_examples=60, deadline=None)
@given(steps=st.lists(st.tuples(st.integers(1, 700), st.sampled_from([0, 4, 64])), min_size=1, max_size=40))
def test_the_program_is_optimal(steps):
    window = 1024
    positions, penalties = [0], [0]
    for n, p in steps:
        positions.append(positions[-1] + n)
        penalties.append(p)
    cuts = packing.solve(positions, penalties, window, False)
    price = dict(zip(positions, penalties, strict=True))
    cost = 0
    for a, b in zip(cuts, cuts[1:]):
        n = b - a
        assert 0 < n <= window
        cost += (0 if n & (n - 1) == 0 and n >= packing.LEAST_POWER else window - n) + price[b]
    assert cuts[0] == 0 and cuts[-1] == positions[-1] and cost == brute(positions, penalties, window)


def test_the_rest_is_cut_into_powers():
    cuts = packing.solve([0, 3000], [0, 0], 4096, True)
    assert cuts[-1] == 3000 and all((b - a) & (b - a - 1) == 0 for a, b in zip(cuts, cuts[1:]))
    assert packing.solve([0, 4090], [0, 0], 4096, True) == [0, 4090]


@settings(max_examples=25, deadline=None)
@given(blocks=st.lists(st.lists(st.one_of(st.integers(0, 65535), st.integers(0, 3)), max_size=60), max_size=6))
def test_range_coder(blocks):
    arrays = [np.array(b, np.int64) for b in blocks]
    found = range_coder.decode(range_coder.encode(arrays), [len(b) for b in blocks])
    assert [x.tolist() for x in found] == blocks


def test_range_coder_learns():
    text = np.array([7, 8, 9, 40_000, 5, 6] * 600)
    (code,) = range_coder.encode([text])
    assert len(code) < 0.1 * len(text)
    noise = np.random.default_rng(0).integers(0, 49_408, 4000)
    assert len(range_coder.encode([noise])[0]) < 2.5 * len(noise)


def test_range_coder_keeps_sums(monkeypatch):
    """The counts' running sums are kept, not made anew for each digit; the code is byte by byte that of files written before."""
    rng, rows, cumsum = np.random.default_rng(5), [], np.cumsum
    blocks = [rng.zipf(1.3, n) % 49_408 for n in (4096, 0, 1, 4096, 2500, 700)]
    monkeypatch.setattr(np, "cumsum", lambda x, *args, **kwargs: rows.append(len(x)) or cumsum(x, *args, **kwargs))
    codes = range_coder.encode(blocks)
    assert zlib.crc32(b"".join(codes)) == 2312631382
    assert [x.tolist() for x in range_coder.decode(codes, [len(b) for b in blocks])] == [b.tolist() for b in blocks]
    assert sum(rows) < sum(map(len, blocks)) // 2


@pytest.mark.skipif(not TABLES.exists(), reason="the tables aren't here")
def test_range_coder_beats_general_compression(word):
    found = pq.read_table(TABLES / "documents.parquet").column("text").to_pylist()
    ids = np.concatenate([ids_of(word, t) for t in found])
    blocks = [ids[at : at + range_coder.BLOCK].astype(np.int64) for at in range(0, len(ids), range_coder.BLOCK)]
    mixed = sum(map(len, range_coder.encode(blocks)))
    general = sum(len(zstandard.ZstdCompressor(level=19).compress(b.astype("<u2").tobytes())) for b in blocks)
    assert mixed < 0.9 * general


def test_token_files(make, word, tmp_path, monkeypatch):
    out = f"file://{tmp_path}/files"
    rows = {r.doc_id: r for r in token_files.round_trip(make(TEXTS), WORD, out).collect()}
    at = 0
    for k, t in enumerate(TEXTS):
        ids = ids_of(word, t)
        assert (rows[k].start, rows[k].n_tokens, rows[k].ids_crc32) == (at, len(ids), zlib.crc32(ids))
        at += len(ids)
    spark = make([]).sparkSession
    parts = defaultdict(dict)
    for r in token_files.read_segments(spark, out).collect():
        parts[r.doc_id][r.start] = bytes(r.ids)
    assert all(b"".join(parts[k][s] for s in sorted(parts[k])) == ids_of(word, t).tobytes() for k, t in enumerate(TEXTS))


def test_token_files_empty_repeated_clashing(make, clashing, spark, tmp_path):
    assert token_files.round_trip(make([]), WORD, f"file://{tmp_path}/none").count() == 0
    twice = spark.createDataFrame([(1, "a b"), (1, "a b"), (0, None)], "doc_id long, text string")
    found = sorted(tuple(r)[:3] for r in token_files.round_trip(twice, WORD, f"file://{tmp_path}/twice").collect())
    assert found == [(0, 0, 1), (1, 1, 3), (1, 4, 3)]
    assert token_files.round_trip(clashing(["x"]), WORD, f"file://{tmp_path}/clash").columns == ["doc_id", "start", "n_tokens", "ids_crc32"]


def test_damaged_blocks_are_refused():
    ids = np.arange(100)
    block = token_files.pack_block(ids, range_coder.encode([ids])[0])
    assert token_files.unpack_blocks([block])[0].tolist() == ids.tolist()
    for bad in (b"XXXX" + block[4:], block[:-1] + bytes([block[-1] ^ 1]), block[:-3]):
        with pytest.raises(ValueError, match="damaged"):
            token_files.unpack_blocks([bad])
    with pytest.raises(ValueError, match="checksum"):
        token_files.unpack_blocks([block[:12] + bytes(4) + block[16:]])


@given(parts=st.lists(st.binary(max_size=50), max_size=5))
def test_joined_crc(parts):
    assert token_files.joined_crc([(zlib.crc32(p), len(p)) for p in parts]) == zlib.crc32(b"".join(parts))
