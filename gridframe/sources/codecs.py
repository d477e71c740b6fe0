"""Chunk bytes to NumPy arrays, and back for the fixture writer."""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterable, Iterator

import numpy as np

from gridframe.plans.metadata import Array, Compression, Sharding, StoreError
from gridframe.sources.stores import Blob, Store

try:
    import zstandard
except ImportError:  # pyarrow has the same codec
    zstandard = None

_ZSTD = b"\x28\xb5\x2f\xfd"
_EMPTY = 2**64 - 1
#: Flags of a Blosc header.
SHUFFLE, MEMCPY, BITSHUFFLE, UNSPLIT = 1, 2, 4, 16


def _unzstd(data: bytes, size: int) -> bytes:
    try:
        if zstandard:
            out = zstandard.ZstdDecompressor().decompress(data, max_output_size=size)
        else:
            import pyarrow as pa

            out = pa.decompress(data, decompressed_size=size, codec="zstd", asbytes=True)
    except Exception:
        raise StoreError("a Zstandard stream of a Blosc chunk is damaged") from None
    if len(out) != size:
        raise StoreError(f"a Zstandard stream of a Blosc chunk has {len(out)} bytes instead of {size}")
    return out


def unshuffle(data: bytes, width: int) -> bytes:
    """Bytes that were grouped by their place in an element; a part of an element at the end was left as it is."""
    whole = len(data) // width * width
    body = np.frombuffer(data, np.uint8, whole).reshape(width, -1).T
    return body.tobytes() + data[whole:]


def shuffle(data: bytes, width: int) -> bytes:
    whole = len(data) // width * width
    return np.frombuffer(data, np.uint8, whole).reshape(-1, width).T.tobytes() + data[whole:]


def bit_unshuffle(data: bytes) -> bytes:
    """Bytes that were grouped by bits, eight at a time; fewer at the end were left as they are."""
    whole = len(data) // 8 * 8
    bits = np.unpackbits(np.frombuffer(data, np.uint8, whole).reshape(8, -1), axis=1, bitorder="little")
    return np.packbits(bits, axis=0, bitorder="little").tobytes() + data[whole:]


def bit_shuffle(data: bytes) -> bytes:
    whole = len(data) // 8 * 8
    bits = np.unpackbits(np.frombuffer(data, np.uint8, whole)[None, :], axis=0, bitorder="little")
    return np.packbits(bits, axis=1, bitorder="little").tobytes() + data[whole:]


def unblosc(data: bytes, size: int, c: Compression) -> bytes:
    if len(data) < 20:
        raise StoreError(f"{len(data)} bytes are no Blosc chunk")
    if c.typesize is None or c.typesize < 1:
        raise StoreError("the metadata of Blosc lacks a typesize")
    if c.cname != "zstd":
        raise StoreError(f"of Blosc's compressors only zstd can be decoded, not {c.cname!r}")
    flags = data[2]
    nbytes, blocksize, cbytes = struct.unpack_from("<III", data, 4)
    if nbytes != size:
        raise StoreError(f"a Blosc chunk holds {nbytes} bytes instead of {size}")
    if cbytes != len(data):
        raise StoreError(f"a Blosc chunk of {len(data)} bytes says that it has {cbytes}")
    if flags & MEMCPY:
        if len(data) != 16 + size:
            raise StoreError(f"a Blosc chunk that is stored as it is has {len(data) - 16} bytes instead of {size}")
        return data[16:]
    if c.shuffle == "bitshuffle" and c.typesize != 1:
        raise StoreError(f"Blosc's bitshuffle of {c.typesize} bytes can't be undone")
    n_blocks = -(-nbytes // blocksize) if blocksize else 0
    if nbytes and (not blocksize or 16 + 4 * n_blocks > len(data)):
        raise StoreError("a Blosc chunk ends before its blocks")
    out = []
    for k, at in enumerate(struct.unpack_from(f"<{n_blocks}I", data, 16)):
        wanted, parts, got = min(blocksize, nbytes - k * blocksize), [], 0
        while got < wanted:
            if at + 4 > len(data):
                raise StoreError(f"a Blosc block would begin at {at}, beyond its chunk")
            (n,) = struct.unpack_from("<I", data, at)
            if not n or at + 4 + n > len(data):
                raise StoreError(f"a Blosc block at {at} can't be {n} bytes long")
            payload = data[at + 4 : at + 4 + n]
            if payload[:4] == _ZSTD:
                # A block is one stream, or one of each byte of an element.
                split = wanted // c.typesize if not flags & UNSPLIT and c.typesize > 1 and (got or _frame_size(payload) != wanted) else wanted
                payload = _unzstd(payload, split)
            parts.append(payload)
            got, at = got + len(payload), at + 4 + n
        block = b"".join(parts)
        if c.shuffle == "shuffle" and c.typesize > 1:
            block = unshuffle(block, c.typesize)
        elif c.shuffle == "bitshuffle":
            block = bit_unshuffle(block)
        out.append(block)
    return b"".join(out)


def _frame_size(data: bytes) -> int:
    """The decompressed size that a Zstandard frame states; 0 if it states none."""
    flag = data[4]
    width = (1 if flag & 32 else 0, 2, 4, 8)[flag >> 6]
    at = 5 + (0 if flag & 32 else 1) + (0, 1, 2, 4)[flag & 3]
    return int.from_bytes(data[at : at + width], "little") + (256 if width == 2 else 0)


def decompressed(data: bytes, size: int, c: Compression) -> bytes:
    if c.name == "":
        if len(data) != size:
            raise StoreError(f"a chunk without compression has {len(data)} bytes instead of {size}")
        return data
    if c.name == "gzip":
        try:
            out = zlib.decompress(data, wbits=31)
        except zlib.error as e:
            raise StoreError(f"a gzip chunk is damaged: {e}") from None
        if len(out) != size:
            raise StoreError(f"a gzip chunk holds {len(out)} bytes instead of {size}")
        return out
    if c.name == "blosc":
        return unblosc(data, size, c)
    raise StoreError(f"chunks of compressor {c.name} can't be decoded")


def decoded(data: bytes, dtype: np.dtype, shape: tuple[int, ...], order: str, c: Compression) -> np.ndarray:
    size = dtype.itemsize * int(np.prod(shape, dtype=object))
    return np.frombuffer(decompressed(data, size, c), dtype).reshape(shape, order=order)


#: Inner chunks with at most so many bytes between them are read at once, in spans of so many bytes at most.
GAP, SPAN = 64 << 10, 8 << 20


class Shard:
    """A chunk file of inner chunks; its index is read once, and of the rest only what is asked for."""

    def __init__(self, blob: Blob, raw: bytes, where: str, grid: tuple[int, ...], length: int) -> None:
        if len(raw) < length:
            raise StoreError(f"The file of {where} is shorter ({blob.size} bytes) than the index of its inner chunks ({length} bytes)")
        self.blob, self.where, self.grid = blob, where, grid
        n = int(np.prod(grid, dtype=np.int64))
        self.index = np.frombuffer(raw, "<u8", 2 * n).reshape(n, 2)

    @classmethod
    def open(cls, store: Store, path: str, where: str, sharding: Sharding, outer: tuple[int, ...]) -> Shard | None:
        """The shard, by one read for its index; None where there is no file."""
        grid = tuple(o // i for o, i in zip(outer, sharding.inner, strict=True))
        length = 16 * int(np.prod(grid, dtype=np.int64)) + 4 * sharding.index_crc
        found = store.edge(path, length, sharding.index_at_start)
        return None if found is None else cls(found[1], found[0], where, grid, length)

    def _entry(self, coords: tuple[int, ...]) -> tuple[int, int] | None:
        offset, length = map(int, self.index[np.ravel_multi_index(coords, self.grid) if coords else 0])
        if offset == length == _EMPTY:
            return None
        if offset + length > self.blob.size:
            raise StoreError(f"The index of {self.where} names bytes {offset} to {offset + length}, but the file has {self.blob.size}")
        return offset, length

    def inner(self, coords: tuple[int, ...]) -> bytes | None:
        """An inner chunk's bytes; None if it is marked as empty."""
        entry = self._entry(coords)
        return None if entry is None else self.blob.read(*entry)

    def inners(self, wanted: Iterable[tuple[int, ...]]) -> Iterator[tuple[tuple[int, ...], bytes | None]]:
        """Inner chunks with their bytes, first the empty ones, then in the file's order: neighbours in the file are one read."""
        stored = []
        for coords in wanted:
            entry = self._entry(coords)
            if entry is None:
                yield coords, None
            else:
                stored.append((*entry, coords))
        stored.sort()
        at = 0
        while at < len(stored):
            first = end = stored[at][0]
            stop = at
            while stop < len(stored) and (stop == at or (stored[stop][0] <= end + GAP and max(end, sum(stored[stop][:2])) - first <= SPAN)):
                end = max(end, sum(stored[stop][:2]))
                stop += 1
            data = self.blob.read(first, end - first)
            for offset, length, coords in stored[at:stop]:
                yield coords, data[offset - first : offset - first + length]
            at = stop


# What follows writes chunks, for fixtures and queries.


def compressed(data: bytes, c: Compression) -> bytes:
    if c.name == "gzip":
        pack = zlib.compressobj(1, zlib.DEFLATED, 31)
        return pack.compress(data) + pack.flush()
    if c.name == "blosc":
        return blosc(data, c)
    return data


def blosc(data: bytes, c: Compression, blocksize: int = 1 << 16) -> bytes:
    import pyarrow as pa

    width = c.typesize or 1
    blocksize = max(width, min(blocksize, len(data)) // width * width)
    blocks = []
    for at in range(0, len(data), blocksize):
        part = data[at : at + blocksize]
        part = shuffle(part, width) if c.shuffle == "shuffle" else bit_shuffle(part) if c.shuffle == "bitshuffle" else part
        blocks.append(pa.compress(part, codec="zstd", asbytes=True))
    offsets, at = [], 16 + 4 * len(blocks)
    for b in blocks:
        offsets.append(at)
        at += 4 + len(b)
    flags = UNSPLIT | (4 << 5) | {"shuffle": SHUFFLE, "bitshuffle": BITSHUFFLE}.get(c.shuffle, 0)
    head = struct.pack("<BBBBIII", 2, 1, flags, width, len(data), blocksize, at)
    return head + struct.pack(f"<{len(offsets)}I", *offsets) + b"".join(struct.pack("<I", len(b)) + b for b in blocks)


def _crc32c_table() -> list[int]:
    out = []
    for k in range(256):
        for _ in range(8):
            k = k >> 1 ^ (0x82F63B78 if k & 1 else 0)
        out.append(k)
    return out


def crc32c(data: bytes, table: list[int] = _crc32c_table()) -> int:  # noqa: B008
    crc = 0xFFFFFFFF
    for b in data:
        crc = crc >> 8 ^ table[(crc ^ b) & 255]
    return crc ^ 0xFFFFFFFF


def encoded(chunk: np.ndarray, array: Array, present: np.ndarray | None = None) -> bytes:
    """A whole chunk file. `present`: which inner chunks of a shard are stored, else all."""
    if array.sharding is None:
        return compressed(chunk.tobytes(order=array.order), array.compression)
    s = array.sharding
    grid = tuple(o // i for o, i in zip(array.chunks, s.inner, strict=True))
    length = 16 * int(np.prod(grid)) + 4 * s.index_crc
    index, bodies, at = [], [], length if s.index_at_start else 0
    for coords in np.ndindex(*grid):
        if present is not None and not present[coords]:
            index.append((_EMPTY, _EMPTY))
            continue
        body = compressed(chunk[tuple(slice(k * i, (k + 1) * i) for k, i in zip(coords, s.inner, strict=True))].tobytes(), s.compression)
        index.append((at, len(body)))
        bodies.append(body)
        at += len(body)
    raw = np.array(index, "<u8").tobytes()
    raw += struct.pack("<I", crc32c(raw)) if s.index_crc else b""
    return b"".join([raw, *bodies] if s.index_at_start else [*bodies, raw])
