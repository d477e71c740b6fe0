"""Where an array's chunks lie: keys, paths, grids and valid extents."""

from __future__ import annotations

import math

from gridframe.plans.metadata import Array

Coords = tuple[int, ...]


def counts(shape: Coords, chunks: Coords) -> Coords:
    """Chunks along each dimension."""
    return tuple(-(-n // c) for n, c in zip(shape, chunks, strict=True))


def chunk_key(array: Array, coords: Coords) -> str:
    if array.key_encoding == "default":
        return array.separator.join(["c", *map(str, coords)])
    # Format 2 stores write an array without dimensions as chunk 0.
    return array.separator.join(map(str, coords)) or "0"


def coords_of(array: Array, key: str) -> Coords | None:
    """The coordinates of a chunk key; None for names that aren't keys of the array's grid."""
    parts = key.split(array.separator)
    if array.key_encoding == "default":
        parts = parts[1:]
    elif not array.shape:
        parts = []
    if not all(p.isascii() and p.isdigit() for p in parts):
        return None
    coords, grid = tuple(map(int, parts)), counts(array.shape, array.chunks)
    known = len(coords) == len(grid) and all(k < n for k, n in zip(coords, grid, strict=True))
    return coords if known and chunk_key(array, coords) == key else None


def chunk_folder(array: Array) -> str:
    """The folder below which the chunk keys' first index is told by a name."""
    return joined(array.path, "c") if array.key_encoding == "default" and array.separator == "/" else array.path


def joined(*parts: str) -> str:
    return "/".join(p for p in parts if p)


def chunk_path(array: Array, coords: Coords) -> str:
    return joined(array.path, chunk_key(array, coords))


def extent(array_shape: Coords, chunks: Coords, coords: Coords) -> Coords:
    """How many cells of a chunk lie within the array, along each dimension."""
    return tuple(min(c, n - k * c) for n, c, k in zip(array_shape, chunks, coords, strict=True))


def coords_at(position: int, grid: Coords) -> Coords:
    """Coordinates of a flat position, the last dimension running fastest."""
    out = []
    for n in reversed(grid):
        position, k = divmod(position, n)
        out.append(k)
    return tuple(reversed(out))


def cell_chunks(array: Array) -> Coords:
    """The shape that is decoded at once: inner chunks if there are any."""
    return array.sharding.inner if array.sharding else array.chunks


def checked_size(shape: Coords, width: int) -> int:
    """Bytes of an uncompressed chunk, within what a signed 64-bit number holds."""
    size = math.prod(shape) * width
    if size > 2**63 - 1:
        raise ValueError(f"a chunk of {shape} values has more bytes than can be counted")
    return size
