"""Edit distances of many pairs of texts side by side.

The bit-parallel table of distances, a column at a time: of each pair the shorter text is the column, in words of
64 bits, and one NumPy operation takes the same word of all pairs. Words that no path of few enough edits
reaches are left out, which changes no distance up to `most`.
"""

from __future__ import annotations

import numpy as np

_U = np.uint64
_ONE, _TOP, _FULL = _U(1), _U(63), _U(2**64 - 1)
#: Bytes of the tables of characters' places that are held at a time.
TABLE_BYTES = 32 << 20
#: Pairs are compared side by side if there are so many for each word of their columns; columns have at most so many words.
LANES_A_WORD, MOST_WORDS = 12, 96
#: After so many characters pairs that are too far apart already are left out.
PAUSE = 32


def _points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    lengths = np.array([len(t) for t in texts], np.int64)
    return np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), "<u4"), lengths


def _padded(symbols: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Texts as columns of a matrix, filled up with symbol 0."""
    out = np.zeros((len(lengths), int(lengths.max())), np.int32)
    out[np.arange(out.shape[1]) < lengths[:, None]] = symbols
    return np.ascontiguousarray(out.T)


def distances(pairs: list[tuple[str, str]], most: list[int]) -> np.ndarray:
    """The edit distance of each pair, (shorter, longer) and neither empty; some number over its `most` if it is over that."""
    order = sorted(range(len(pairs)), key=lambda k: -len(pairs[k][1]))
    out = np.zeros(len(pairs), np.int64)
    points_a, sizes_a = _points([pairs[k][0] for k in order])
    points_b, sizes_b = _points([pairs[k][1] for k in order])
    symbols, found = np.unique(points_a, return_inverse=True)
    at = np.minimum(np.searchsorted(symbols, points_b), len(symbols) - 1)
    a, b = _padded(found.astype(np.int32) + 1, sizes_a), _padded(np.where(symbols[at] == points_b, at + 1, 0), sizes_b)
    limits = np.array([most[k] for k in order], np.int64)
    words = -(-a.shape[0] // 64)
    lanes = max(1, TABLE_BYTES // (8 * words * (len(symbols) + 1)))
    for s in range(0, len(order), lanes):
        part = slice(s, s + lanes)
        out[order[part]] = _columns(a[:, part], sizes_a[part], b[: int(sizes_b[part][0]), part], sizes_b[part], limits[part], len(symbols) + 1)
    return out


def _columns(a: np.ndarray, sizes_a: np.ndarray, b: np.ndarray, sizes_b: np.ndarray, most: np.ndarray, symbols: int) -> np.ndarray:
    """Distances of pairs that are sorted by the longer text's length, the longest first."""
    n = len(sizes_a)
    words = -(-a.shape[0] // 64)
    table = np.zeros((words, n * symbols), _U)
    base = np.arange(n) * symbols
    for i in range(a.shape[0]):
        # A padded place sets a bit of symbol 0 beyond the text's end, where nothing is read.
        table[i >> 6, base + a[i]] |= _ONE << _U(i & 63)
    last = (sizes_a - 1) >> 6
    bit = ((sizes_a - 1) & 63).astype(_U)
    up, down = np.full((words, n), _FULL), np.zeros((words, n), _U)
    # The distance at each pair's last place of its column, or, above that, at the end of the last word reached.
    score, out = np.zeros(n, np.int64), most + 1
    lanes, reach, reached = np.arange(n), int(most.max()), -1
    for t in range(b.shape[0]):
        while n and sizes_b[n - 1] <= t:
            n -= 1
            out[lanes[n]] = score[n]
        if not n:
            return out
        if t % PAUSE == PAUSE - 1:
            # What is left of the longer text can make up for so many edits at most.
            keep = (last[:n] > reached) | (score[:n] - (sizes_b[:n] - t) <= most[lanes[:n]])
            if (kept := np.flatnonzero(keep)).size < 0.8 * n:
                n = len(kept)
                if not n:
                    return out
                lanes, score, last, bit, base, sizes_b = (x[kept] for x in (lanes, score, last, bit, base, sizes_b))
                up, down, b = up[:, kept], down[:, kept], b[:, kept]
        first = max(0, t - reach) >> 6
        while reached < min(words - 1, (t + reach) >> 6):
            reached += 1
            new = last[:n] >= reached
            score[:n] += np.where(new, np.where(last[:n] == reached, bit[:n].astype(np.int64) + 1, 64), 0)
        at = base[:n] + b[t, :n]
        plus, minus = np.ones(n, _U), np.zeros(n, _U)
        for w in range(first, reached + 1):
            vp, vn = up[w, :n], down[w, :n]
            same = table[w].take(at)
            xv = same | vn
            same |= minus
            across = (((same & vp) + vp) ^ vp) | same
            rise, fall = vn | ~(across | vp), vp & across
            ends = np.minimum(last[:n], reached) == w
            if ends.any():
                place = np.where(last[:n] == w, bit[:n], _TOP)
                score[:n] += np.where(ends, ((rise >> place) & _ONE).astype(np.int64) - ((fall >> place) & _ONE).astype(np.int64), 0)
            out_plus, out_minus = rise >> _TOP, fall >> _TOP
            rise, fall = (rise << _ONE) | plus, (fall << _ONE) | minus
            up[w, :n], down[w, :n] = fall | ~(xv | rise), rise & xv
            plus, minus = out_plus, out_minus
    out[lanes[:n]] = score[:n]
    return out
