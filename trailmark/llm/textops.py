"""Words and their hashes for whole Arrow batches, in numpy.

A word is a longest run of bytes other than space, tab, line feed, vertical tab, form feed and
carriage return. Hashes are chains: each eight bytes, and each half of a run of words, are mixed in by a
function that isn't linear, so that no pattern of bytes or words makes different texts collide.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash

U = np.uint64
SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
ONES = U(0xFFFFFFFFFFFFFFFF)
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
CLOSING = np.zeros(256, bool)
CLOSING[list(b".,;:!?\"')]}")] = True

#: Seeds of the two independent lanes, and multipliers of what is mixed in.
SEEDS = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)
_LEFT, _RIGHT = U(0x9FB21C651E98DF25), U(0xA24BAED4963EE407)
#: Words of more bytes than this are hashed one by one by XXH3.
LONG = 256


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits that spreads every bit (the finaliser of MurmurHash3)."""
    h = h ^ (h >> U(33))
    h = h * U(0xFF51AFD7ED558CCD)
    h ^= h >> U(33)
    h *= U(0xC4CEB9FE1A85EC53)
    h ^= h >> U(33)
    return h


def hash_ranges(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int) -> np.ndarray:
    """A 64-bit hash of data[start:end] for each pair, eight bytes at a time."""
    size = ends - starts
    h = mix(size.astype(U) * _RIGHT + U(seed & 0xFFFFFFFFFFFFFFFF))
    if not len(h):
        return h
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eight = np.ndarray((len(data) + 1,), "<u8", padded, strides=(1,))
    live = np.flatnonzero((size > 0) & (size <= LONG))
    at = 0
    while len(live):
        left = size[live] - at
        chunk = eight[starts[live] + at] & np.where(left >= 8, ONES, (U(1) << (U(8) * np.minimum(left, 7).astype(U))) - U(1))
        h[live] = mix((h[live] ^ chunk) * _LEFT + _RIGHT)
        at += 8
        live = live[left > 8]
    for i in np.flatnonzero(size > LONG).tolist():
        h[i] = xxhash.xxh3_64_intdigest(data[starts[i] : ends[i]].tobytes(), int(h[i]))
    return h


def combine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A hash of each pair of hashes, in order."""
    return mix(a * _LEFT + mix(b + _RIGHT))


def raw(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column's values one after another, and their n+1 bounds; null: empty."""
    if pa.types.is_dictionary(col.type):
        col = col.cast(col.type.value_type)
    if col.null_count:
        col = col.fill_null("")
    if not len(col):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    kind = np.int64 if pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type) else np.int32
    _, offsets, data = col.buffers()
    bounds = np.frombuffer(offsets, kind)[col.offset : col.offset + len(col) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8)[bounds[0] : bounds[-1]] if data is not None else np.zeros(0, np.uint8)
    return data, bounds - bounds[0]


class Words:
    """The words of a batch: starts and ends (bytes), first (n+1 bounds by document), doc (of each word)."""

    def __init__(self, col: pa.Array, lower: bool = False):
        self.data, self.bounds = raw(col)
        if lower:
            self.data = LOWER[self.data]
        n = len(self.data)
        ink = ~SPACE[self.data]
        edge = np.zeros(n + 1, bool)
        edge[self.bounds] = True
        opens, closes = ink.copy(), ink
        if n:
            opens[1:] &= ~ink[:-1] | edge[1:n]
            closes = ink.copy()
            closes[:-1] &= ~ink[1:] | edge[1:n]
        self.starts, self.ends = np.flatnonzero(opens), np.flatnonzero(closes) + 1
        self.first = np.searchsorted(self.starts, self.bounds)
        self.counts = np.diff(self.first)
        self.doc = np.repeat(np.arange(len(self.bounds) - 1), self.counts)

    def __len__(self) -> int:
        return len(self.starts)

    def hashes(self, lane: int = 0) -> np.ndarray:
        """A 64-bit hash of each word."""
        return hash_ranges(self.data, self.starts, self.ends, SEEDS[lane])

    def bare(self) -> np.ndarray:
        """Ends of the words without up to three closing punctuation marks; of each word one byte stays."""
        ends = self.ends.copy()
        for _ in range(3 if len(ends) else 0):
            ends = np.where((ends - self.starts > 1) & CLOSING[self.data[ends - 1]], ends - 1, ends)
        return ends

    def bare_hashes(self) -> np.ndarray:
        """A 64-bit hash of each word without closing punctuation."""
        return hash_ranges(self.data, self.starts, self.bare(), SEEDS[0])

    def whole(self, k: int) -> np.ndarray:
        """Whether the k words from each word on are of one document."""
        n = len(self.doc) - k + 1
        return self.doc[:n] == self.doc[k - 1 :] if n > 0 else np.zeros(0, bool)

    def joined(self) -> tuple[bytes, np.ndarray, np.ndarray]:
        """Every document's words joined by one space, one after another (one space between documents), with starts and ends of the words."""
        if not len(self):
            return b"", np.zeros(0, np.int64), np.zeros(0, np.int64)
        sizes = self.ends - self.starts
        new = np.zeros(len(self), np.int64)
        np.cumsum(sizes[:-1] + 1, out=new[1:])
        out = np.full(int(new[-1] + sizes[-1]), 0x20, np.uint8)
        ink = ~SPACE[self.data]
        place = np.ones(len(out), bool)
        place[new[1:] - 1] = False
        out[place] = self.data[ink]
        return out.tobytes(), new, new + sizes


def runs(h: np.ndarray, k: int) -> np.ndarray:
    """A hash of each k hashes in a row, by the first; of words, those that cross a document's end too."""
    n = len(h) - k + 1
    if n <= 0:
        return h[:0]
    out, at, width, have = np.full(n, U(k)), 0, 1, h
    while k >> (width.bit_length() - 1):
        if k & width:
            out = combine(out, have[at : at + n])
            at += width
        if k < 2 * width:
            break
        have, width = combine(have[:-width], have[width:]), 2 * width
    return out


def spans(h: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """A hash of h[lo:hi] for each pair, none empty: of its length and of the two longest runs of a power of two that begin and end it."""
    size = hi - lo
    out = size.astype(U)
    have, width = h, 1
    while len(size) and width <= size.max():
        now = np.flatnonzero((size >= width) & (size < 2 * width))
        out[now] = combine(combine(out[now], have[lo[now]]), have[hi[now] - width])
        have, width = combine(have[:-width], have[width:]) if len(have) > width else have[:0], 2 * width
    return out


def slide(a: np.ndarray, k: int, op: np.ufunc) -> np.ndarray:
    """op (minimum or maximum) over each k in a row, by the first."""
    if len(a) < k:
        return a[:0]
    have, width = a, 1
    while 2 * width <= k:
        have, width = op(have[:-width], have[width:]), 2 * width
    rest = k - width
    return op(have[: len(have) - rest], have[rest:]) if rest else have
