"""Layouts, codecs and types against NumPy; pruning against no pruning."""

import itertools
import json
import struct

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from gridframe.functions import dtypes
from gridframe.operators import tables as z
from gridframe.plans.metadata import Compression, StoreError
from gridframe.plans.pruning import Selection
from gridframe.sources import codecs, discovery, scan
from gridframe.sources import writer as w

GZIP = {"name": "gzip", "configuration": {"level": 1}}


def table(scanned):
    """A scan's rows, read without Spark."""
    out = []
    for b in scanned.read(0, len(scanned.parts)):
        out += zip(*(c.to_pylist() for c in b.columns), strict=True)
    return out


def expected(values):
    return [(*at, values[at].item()) for at in np.ndindex(*values.shape)]


def cells(path, name="a", **options):
    return scan.cell_scan(discovery.discover(path), name, **options)


@pytest.mark.parametrize("dtype", ["|i1", "|u1", "|b1", *(e + t for e in "<>" for t in ("i2", "i4", "i8", "u2", "u4", "u8", "f2", "f4", "f8"))])
def test_types(tmp_path, dtype):
    kind = dtypes.parse(dtype)
    path = str(tmp_path / "t.zarr")
    if dtype[1] == "f":
        values = np.array([0.5, -2.0, np.inf, 6e-8, 0.0], kind.stored)
    elif dtype[1] == "b":
        values = np.array([0, 1, 1, 0, 1], "u1")
    else:
        values = np.array([np.iinfo(kind.stored).min, np.iinfo(kind.stored).max, 1, 2, 3], kind.stored)
    w.v2_array(path, "a", (5,), (2,), dtype)
    w.write_values(path, "a", values)
    wanted = [(k, bool(v) if dtype[1] == "b" else np.float32(v).item() if dtype[1:] == "f2" else v.item()) for k, v in enumerate(values)]
    assert [(k, int(v) if dtype[1:] == "u8" else v) for k, v in table(cells(path))] == wanted


@settings(max_examples=40, deadline=None)
@given(data=st.data())
def test_random_arrays(tmp_path_factory, data):
    rank = data.draw(st.integers(0, 4))
    shape = tuple(data.draw(st.integers(0 if rank > 1 else 1, 7)) for _ in range(rank))
    inner = tuple(data.draw(st.integers(1, 3)) for _ in range(rank))
    outer = tuple(i * data.draw(st.integers(1, 3)) for i in inner)
    kind = data.draw(st.sampled_from(["v2", "v3", "gzip", "fortran", "shard", "shard-gzip", "shard-shuffle", "shard-bits"]))
    values = np.random.default_rng(data.draw(st.integers(0, 99))).integers(-100, 100, shape).astype("i1" if kind == "shard-bits" else "<i4")
    path = str(tmp_path_factory.mktemp("r") / "x.zarr")
    if kind == "v2":
        w.v2_array(path, "a", shape, outer, "<i4", order=data.draw(st.sampled_from("CF")), compressor=data.draw(st.sampled_from([None, {"id": "gzip"}])))
    else:
        body = {"v3": [w.BYTES], "gzip": [w.BYTES, GZIP], "fortran": [{"name": "transpose", "configuration": {"order": list(range(rank))[::-1]}}, w.BYTES]}.get(kind)
        if body is None:
            own = {"shard": [], "shard-gzip": [GZIP], "shard-shuffle": [w.blosc("shuffle", 4)], "shard-bits": [w.blosc("bitshuffle", 1)]}[kind]
            body = [w.sharding(inner, [w.BYTES, *own], data.draw(st.sampled_from(["start", "end"])), data.draw(st.booleans()))]
        w.v3_group(path)
        w.v3_array(path, "a", shape, outer, "int8" if kind == "shard-bits" else "int32", body)
    w.write_values(path, "a", values)
    assert sorted(table(cells(path))) == expected(values)
    ranges = {str(d): [sorted(data.draw(st.tuples(st.integers(-1, 8), st.integers(-1, 8)))) for _ in range(data.draw(st.integers(1, 2)))] for d in range(rank) if data.draw(st.booleans())}
    inside = [r for r in expected(values) if all(any(a <= r[int(d)] <= b for a, b in spans) for d, spans in ranges.items())]
    assert sorted(table(cells(path, dim_ranges=json.dumps(ranges)))) == inside


def test_missing_chunks_and_empty_inner_chunks(tmp_path):
    for fill, wanted in ((7, 16), (None, 8)):
        path = str(tmp_path / f"m{fill}.zarr")
        w.v3_group(path)
        w.v3_array(path, "a", (8, 2), (4, 2), "int16", [w.sharding((2, 2), [w.BYTES, w.blosc("shuffle", 2)])], fill=fill)
        present = np.array([[True], [False]])
        for k in (0, 1):
            w.write_chunk(path, w.node(path, "a"), (k, 0), np.full((4, 2), k, "<i2"), present)
        found = table(cells(path))
        assert len(found) == wanted
        assert {r[2] for r in found if r[0] % 4 >= 2} == ({7} if fill else set())


def test_fill_values():
    f4, i1, u2, b1 = map(dtypes.parse, ("<f4", "|i1", "<u2", "|b1"))
    assert np.isnan(dtypes.fill_of("NaN", f4, "a")) and dtypes.fill_of(True, b1, "a") == 1 and dtypes.fill_of(-3, i1, "a") == -3
    for value, kind, message in ((-1, u2, "unsigned integers, but fill_value -1"), (1.5, i1, "signed integers, but fill_value 1.5"), ("x", f4, "floating-point values, but fill_value"), (None, b1, "booleans, but fill_value None")):
        with pytest.raises(ValueError, match=message):
            dtypes.fill_of(value, kind, "a")


@pytest.mark.parametrize("text", ["f8", "<x4", "<f16", "<i3", "!i4", "|i4", "<c8", "<i0", "<ix"])
def test_bad_types(text):
    with pytest.raises(ValueError):
        dtypes.parse(text)


def test_blosc_variants():
    raw = bytes(range(200)) * 3
    for shuffle, width in (("noshuffle", 1), ("shuffle", 4), ("bitshuffle", 1), ("shuffle", 7)):
        c = Compression("blosc", shuffle, width, "zstd")
        assert codecs.unblosc(codecs.blosc(raw, c, 128), len(raw), c) == raw
    c = Compression("blosc", "shuffle", 4, "zstd")
    stored = struct.pack("<BBBBIII", 2, 1, codecs.MEMCPY, 4, len(raw), 128, 16 + len(raw)) + raw
    assert codecs.unblosc(stored, len(raw), c) == raw
    good = codecs.blosc(raw, c)
    for bad, message in ((good[:10], "no Blosc chunk"), (good + b"x", "says that it has"), (good[:8] + bytes(4) + good[12:], "ends before its blocks")):
        with pytest.raises(StoreError, match=message):
            codecs.unblosc(bad, len(raw), c)
    with pytest.raises(StoreError, match="instead of 5"):
        codecs.unblosc(good, 5, c)


def test_crc32c():
    assert codecs.crc32c(b"123456789") == 0xE3069283


def test_damaged_chunks(tmp_path):
    path = str(tmp_path / "d.zarr")
    w.v2_group(path)
    w.v2_array(path, "raw", (4,), (4,), "<i4")
    w.v2_array(path, "gz", (4,), (4,), "<i4", compressor={"id": "gzip"})
    w.v2_array(path, "lz", (4,), (4,), "<i4", compressor={"id": "lz4"})
    for name in ("raw", "gz", "lz"):
        w.store_at(path).write(f"{name}/0", b"abc")
    for name, message in (("raw", "without compression has 3 bytes instead of 16"), ("gz", "gzip"), ("lz", "compressor lz4")):
        with pytest.raises(StoreError, match=message):
            table(cells(path, name))


def test_large_chunks_come_in_batches(tmp_path):
    path = str(tmp_path / "big.zarr")
    w.v2_group(path)
    w.v2_array(path, "a", (3, 1000, 1000), (3, 1000, 1000), "|u1", fill=5)
    sizes = [b.num_rows for b in cells(path).read(0, 1)]
    assert sum(sizes) == 3_000_000 and max(sizes) <= scan.BATCH


OPS = {"eq": lambda x, v: x == v, "ne": lambda x, v: x != v, "lt": lambda x, v: x < v, "le": lambda x, v: x <= v, "gt": lambda x, v: x > v, "ge": lambda x, v: x >= v}


@given(op=st.sampled_from(sorted(OPS)), value=st.one_of(st.integers(-3, 12), st.floats(-3, 12)), chunk=st.integers(1, 4))
def test_pruning_keeps_what_filters_keep(op, value, chunk):
    left = Selection.whole((9,)).filtered(0, op, value)
    kept = {x for a, b in left.intervals[0] for x in range(a, b + 1)}
    assert kept == {x for x in range(9) if OPS[op](x, value)}
    chunks = {k for a, b in left.chunk_ranges((chunk,))[0] for k in range(a, b)}
    assert chunks == {x // chunk for x in kept}


def test_selective_scans_open_few_files(tmp_path):
    path = str(tmp_path / "p.zarr")
    w.v2_group(path)
    w.v2_array(path, "a", (10**9, 10**6), (10, 10), "<f8", fill=0)
    found = cells(path, dim_ranges='{"0": [[5, 5]], "1": [[77, 77]]}')
    assert len(found.parts) == 1 and table(found) == [(5, 77, 0.0)]


def test_reused_frames(spark, tmp_path):
    path = str(tmp_path / "u.zarr")
    w.v2_group(path)
    w.v2_array(path, "a", (6, 6), (2, 2), "<i4")
    w.write_values(path, "a", np.arange(36).reshape(6, 6))
    for order in itertools.permutations(["dim_0 = 1", "dim_1 >= 4", "true"]):
        frame = z.zarr_cells(spark, path, "a")
        assert {c: frame.where(c).count() for c in order} == {"dim_0 = 1": 6, "dim_1 >= 4": 12, "true": 36}
    frame = z.zarr_cells(spark, path, "a")
    assert frame.where("dim_0 = 0").unionByName(frame.where("dim_0 = 5")).count() == 12
    assert frame.where("dim_0 = 0").rdd.getNumPartitions() >= 1
    assert frame.where("dim_0 IS NULL").count() == 0 and frame.select("value").count() == 36
    assert z.zarr_cells(spark, path, "a", columns=["value"]).agg({"value": "sum"}).first()[0] == sum(range(36))


def test_pruned_plan_has_few_partitions(spark, tmp_path):
    path = str(tmp_path / "q.zarr")
    w.v2_group(path)
    w.v2_array(path, "a", (400,), (10,), "<i4", fill=1)
    assert z.zarr_cells(spark, path, "a").where("dim_0 BETWEEN 15 AND 25").rdd.getNumPartitions() == 2


def by_hand(raw, width, block, split):
    """A Blosc container as the format describes it, not by the package: shuffled blocks, of one stream each or of one for each byte of an element."""
    import zstandard

    flags = 1 | 4 << 5 | (0 if split else 16)
    blocks = []
    for at in range(0, len(raw), block):
        part = raw[at : at + block]
        whole = len(part) // width * width
        planes = [part[k:whole:width] for k in range(width)]
        shuffled = b"".join(planes) + part[whole:]
        # A last block that is short is never split.
        streams = [shuffled[k * len(part) // width : (k + 1) * len(part) // width] for k in range(width)] if split and len(part) == block else [shuffled]
        packed = b""
        for s in streams:
            frame = zstandard.ZstdCompressor(level=3).compress(s)
            frame = s if len(frame) >= len(s) else frame
            packed += struct.pack("<i", len(frame)) + frame
        blocks.append(packed)
    starts = np.cumsum([16 + 4 * len(blocks), *map(len, blocks)])
    return struct.pack("<BBBBIII", 2, 1, flags, width, len(raw), block, int(starts[-1])) + starts[:-1].astype("<u4").tobytes() + b"".join(blocks)


@pytest.mark.parametrize("split", [False, True])
@pytest.mark.parametrize("width", [1, 2, 4, 8])
def test_blosc_of_another_encoder(width, split):
    rng = np.random.default_rng(width)
    # High bytes that compress, low bytes that don't.
    values = (np.arange(3000) // 7 * 256 ** (width - 1) + rng.integers(0, 256, 3000)).astype(f"<u{width}")
    stored = by_hand(values.tobytes(), width, 1024, split and width > 1)
    c = Compression("blosc", "shuffle", width, "zstd")
    assert codecs.unblosc(stored, values.nbytes, c) == values.tobytes()
