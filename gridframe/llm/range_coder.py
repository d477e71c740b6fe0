"""An adaptive context-mixing range coder for token ids, many blocks side by side.

Every block starts with a fresh model. For each id

* the order-2 table (the two ids before) and the order-1 table (the one before) each
  hold the id that last followed; the higher order that knows one makes the guess;
* whether the guess holds is one binary decision. Its probability is mixed in the
  logistic domain from three adaptive ones: by the order-2 entry's confidence, by
  the order-1 entry's confidence and agreement, and by the guessed id (order 0).
  The mixing weights are learned as the block goes;
* an id that wasn't guessed is coded by order-0 counts as four digits of 4 bits,
  each in the context of the digits before it.

Blocks are independent, so one NumPy operation takes the same step in hundreds of
them. All arithmetic is on integers: encoder and decoder agree to the bit.
"""

from __future__ import annotations

import numpy as np

#: Ids of a block, and blocks that are coded side by side.
BLOCK, LANES = 4096, 1536

_U = np.uint64
_TOP, _BOTTOM = _U(1 << 56), _U(1 << 48)
_SLOTS2, _SLOTS1 = 1 << 13, 1 << 12
_LAST_ROWS = 1024
_ROWS = 1 + 16 + 256 + _LAST_ROWS
_FIRST_ROW = (0, 1, 17, 273)
#: What a coded digit adds to its count, and the sum from which a row's counts are halved.
_STEP, _MOST = 24, 980
_ORDER0 = 1024
_ROW = np.dtype("V32")
#: What a digit adds to its row of sums: to its own and all above.
_ADDED = np.triu(np.full((16, 16), _STEP, np.uint16)).view(_U)

_p = np.arange(4096)
#: ln(p / (1 - p)) and its inverse, both in steps of 1/256.
STRETCH = np.round(256 * np.log((_p + 0.5) / (4095.5 - _p))).astype(np.int32)
SQUASH = np.clip(np.round(4096 / (1 + np.exp(-np.arange(-2047, 2048) / 256))), 16, 4080).astype(np.int32)


class _Coder:
    """Carryless range coders of 64 bits, one for each lane. With `data` they decode, else they encode.

    An id narrows a range by at most 2^48 (a decision of at least 2^-8, four digits of at
    least 2^-10), and `settle` then leaves at least 2^48: so one call of it an id is enough.
    """

    def __init__(self, lanes: int, data: list[bytes] | None, room: int) -> None:
        self.low, self.range = np.zeros(lanes, _U), np.full(lanes, _U(2**64 - 1))
        self.at = np.zeros(lanes, np.int64)
        self.decodes = data is not None
        if data is None:
            self.bytes = np.zeros((lanes, room), np.uint8)
        else:
            self.bytes = np.zeros((lanes, max(map(len, data), default=0) + 16), np.uint8)
            for k, x in enumerate(data):
                self.bytes[k, : len(x)] = np.frombuffer(x, np.uint8)
            self.code = np.zeros(lanes, _U)
            for k in range(8):
                self.code = self.code << _U(8) | self.bytes[:, k]
            self.at += 8

    def settle(self, n: int) -> None:
        """Moves the first n lanes' settled bytes out (or in)."""
        low, wide = self.low[:n], self.range[:n]
        move = np.flatnonzero(((low ^ (low + wide)) < _TOP) | (wide < _BOTTOM))
        while move.size:
            a, w = low.take(move), wide.take(move)
            short = np.flatnonzero((a ^ (a + w)) >= _TOP)
            if short.size:
                w[short] = (~a[short] + _U(1)) & (_BOTTOM - _U(1))
            at = self.at.take(move)
            if self.decodes:
                self.code[move] = self.code.take(move) << _U(8) | self.bytes[move, np.minimum(at, self.bytes.shape[1] - 1)]
            else:
                if at.max() + 16 > self.bytes.shape[1]:
                    self.bytes = np.concatenate([self.bytes, np.zeros_like(self.bytes)], axis=1)
                self.bytes[move, at] = a >> _U(56)
            self.at[move] = at + 1
            a, w = a << _U(8), w << _U(8)
            low[move], wide[move] = a, w
            move = move.take(np.flatnonzero(((a ^ (a + w)) < _TOP) | (w < _BOTTOM)))

    def streams(self) -> list[bytes]:
        return [self.bytes[k, :n].tobytes() + int(self.low[k]).to_bytes(8, "big") for k, n in enumerate(self.at.tolist())]


def _place(code: np.ndarray, low: np.ndarray, part: np.ndarray, total: int | np.ndarray) -> np.ndarray:
    """In which of `total` parts of a range, each `part` long, the code lies."""
    return np.minimum((code - low) // part, total - _U(1))


def _digits(coder: _Coder, sums: np.ndarray, u: np.ndarray, ids: np.ndarray | None) -> np.ndarray:
    """Codes ids as four digits with order-0 counts, which are kept as running sums: a row is four words of four sums."""
    value = np.zeros(len(u), np.int64)
    base = u * _ROWS
    pick = np.arange(0, 16 * len(u), 16)
    whole = sums.view(_ROW)
    low, wide = coder.low.take(u), coder.range.take(u)
    code = coder.code.take(u) if ids is None else None
    for level in range(4):
        at = base if level == 0 else base + (value + _FIRST_ROW[level] if level < 3 else _FIRST_ROW[3] + ((value * 40503 >> 6) & (_LAST_ROWS - 1)))
        rows = sums.take(at, axis=0)
        upto = rows.view(np.uint16)
        flat = upto.reshape(-1)
        total = upto[:, 15].astype(_U)
        wide //= total
        if ids is None:
            target = _place(code, low, wide, total).astype(np.uint16)
            passed = np.bitwise_count((upto <= target[:, None]).view(_U))
            digit = (passed[:, 0] + passed[:, 1]).astype(np.int64)
        else:
            digit = ids >> (12 - 4 * level) & 15
        place = pick + digit
        below = flat.take(place - 1) * (digit > 0)
        size = flat.take(place) - below
        low += below * wide
        wide *= size
        rows += _ADDED.take(digit, axis=0)
        full = np.flatnonzero(total > _U(_MOST))
        if full.size:
            old = upto.take(full, axis=0)
            old[:, 1:] -= old[:, :-1].copy()
            upto[full] = np.cumsum((old >> 1) | 1, axis=1, dtype=np.uint16)
        np.put(whole, at, rows.view(_ROW))
        value = value << 4 | digit
    coder.low[u], coder.range[u] = low, wide
    return value


def _run(lengths: np.ndarray, ids: np.ndarray | None, data: list[bytes] | None) -> tuple[_Coder, np.ndarray]:
    """The model over all lanes, which are sorted by length, the longest first."""
    n = len(lengths)
    steps = int(lengths[0]) if n else 0
    coder = _Coder(n, data, 2 * steps + 64)
    out = np.zeros((steps, n), np.int64) if ids is None else ids
    sums = np.tile(np.arange(1, 17, dtype=np.uint16).view(_U), (n * _ROWS, 1))
    # An entry of a table: the id that followed last plus one, and above it how often it was right on end. Both orders' tables
    # lie in one array, order 2 before order 1, as do the probabilities and weights of the three orders: one call takes all.
    table = np.zeros(n * (_SLOTS2 + _SLOTS1), np.int32)
    probs = np.full(n * (16 + 32 + _ORDER0), 2048, np.int32)
    weights = np.full((3, n), 1 << 15, np.int32)
    before, last = np.zeros(n, np.int64), np.zeros(n, np.int64)
    lanes = np.arange(n)
    slots = np.array([lanes * _SLOTS2, n * _SLOTS2 + lanes * _SLOTS1])
    base2, base1, base0 = lanes * 16, n * 16 + lanes * 32, n * 48 + lanes * _ORDER0
    for t in range(steps):
        if lengths[n - 1] <= t:
            while lengths[n - 1] <= t:
                n -= 1
            slots, weights = slots[:, :n], weights[:, :n]
            base2, base1, base0, before, last = base2[:n], base1[:n], base0[:n], before[:n], last[:n]
        s = slots.copy()
        s[0] += (before * 40503 + last * 30011) >> 3 & (_SLOTS2 - 1)
        s[1] += last * 40503 >> 4 & (_SLOTS1 - 1)
        e = table.take(s)
        g, sure = (e & 0x1FFFF) - 1, e >> 17
        known = g >= 0
        guess = np.where(known[0], g[0], g[1])
        x = np.empty((3, n), np.int64)
        np.add(base2, sure[0] + (known[0] << 3), out=x[0])
        np.add(base1, sure[1] + ((g[1] == guess) << 3) + (known[1] << 4), out=x[1])
        np.add(base0, guess & (_ORDER0 - 1), out=x[2])
        q = probs.take(x)
        far = STRETCH.take(q)
        parts = (weights >> 4) * far
        mixed = (parts[0] + parts[1] + parts[2]) >> 12
        p = SQUASH.take(np.maximum(np.minimum(mixed, 2047), -2047) + 2047)
        low, wide = coder.low[:n], coder.range[:n]
        wide >>= _U(12)
        hit = out[t, :n] == guess if ids is not None else _place(coder.code[:n], low, wide, _U(4096)) < p.astype(_U)
        low += np.where(hit, 0, p).astype(_U) * wide
        wide *= np.where(hit, p, 4096 - p).astype(_U)
        aim = hit * np.int32(4095)
        far *= aim - p
        far >>= 10
        weights += far
        np.maximum(np.minimum(weights, 1 << 17, out=weights), -(1 << 16), out=weights)
        probs[x] = q + ((aim - q) >> 5)
        miss = np.flatnonzero(~hit)
        if ids is not None:
            new = out[t, :n]
            _digits(coder, sums, miss, new.take(miss))
        else:
            new = guess.astype(np.int64)
            new[miss] = _digits(coder, sums, miss, None)
            out[t, :n] = new
        coder.settle(n)
        table[s] = (new + 1) | (np.minimum(sure + 1, 7) * (g == new)) << 17
        before, last = last, new
    return coder, out


def _groups(order: list[int]) -> list[list[int]]:
    """At most LANES numbers each, and about as many in each."""
    n = -(-len(order) // LANES)
    return [order[len(order) * k // n : len(order) * (k + 1) // n] for k in range(n)]


def encode(blocks: list[np.ndarray]) -> list[bytes]:
    """Each block's ids (below 65536) as bytes."""
    out: list[bytes] = [b""] * len(blocks)
    order = sorted(range(len(blocks)), key=lambda k: -len(blocks[k]))
    for part in _groups(order):
        lengths = np.array([len(blocks[k]) for k in part], np.int64)
        ids = np.zeros((int(lengths[0]), len(part)), np.int64)
        for i, k in enumerate(part):
            ids[: lengths[i], i] = blocks[k]
        for k, x in zip(part, _run(lengths, ids, None)[0].streams(), strict=True):
            out[k] = x
    return out


def decode(streams: list[bytes], sizes: list[int]) -> list[np.ndarray]:
    """The ids of blocks of the given sizes."""
    out: list[np.ndarray] = [np.zeros(0, np.int64)] * len(streams)
    order = sorted(range(len(streams)), key=lambda k: -sizes[k])
    for part in _groups(order):
        lengths = np.array([sizes[k] for k in part], np.int64)
        _, ids = _run(lengths, None, [streams[k] for k in part])
        for i, k in enumerate(part):
            out[k] = ids[: lengths[i], i].copy()
    return out
