"""Vectorised words: byte ranges of a batch of texts, their 64-bit hashes, and
a growing table from hash to a run of integers.

A batch of texts is one byte array.  The hash of a byte range is a polynomial
over random byte codes modulo 2^64, read off a running sum, so every word of
the batch is hashed with a handful of array operations; ranges of
``LONG_RANGE`` bytes and more are hashed one by one with xxh3, since modulus
2^64 polynomials can be attacked on long ranges.  Two given words collide with
probability 2^-64.
"""

from __future__ import annotations

import numpy as np
import xxhash

from tastemap.llm.text import mix64

LONG_RANGE = 512
BATCH_BYTES = 1 << 18       # of texts handled at once; bounds the arrays of a task
SPACE = np.zeros(256, bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True
_CODES = np.random.default_rng(0x5EED).integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_powers: dict = {}


def _power(base: int, n: int) -> np.ndarray:
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = -(-n // 65536) * 65536
        steps = np.full(size, base, np.uint64)
        steps[0] = 1
        _powers[base] = have = np.multiply.accumulate(steps)
    return have[:n]


class Ranges:
    """Byte ranges of an array and their hashes."""

    def __init__(self, data: np.ndarray):
        self.data = data
        n = len(data)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(_CODES[data] * _power(_BASE, n), out=self.sums[1:])
        self.inverse = _power(pow(_BASE, -1, 1 << 64), n + 1)

    def hashes(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """64-bit hashes, never 0."""
        h = (self.sums[end] - self.sums[start]) * self.inverse[start]
        size = end - start
        h = mix64(h + size.astype(np.uint64))
        for i in np.flatnonzero(size >= LONG_RANGE).tolist():
            h[i] = xxhash.xxh3_64_intdigest(self.data[start[i]:end[i]].tobytes())
        h[h == 0] = 1
        return h


class Words(Ranges):
    """The words of a batch of byte strings: ``start``, ``end`` and the text
    (``doc``) each belongs to.  Words are parted by space and \\x09-\\x0D."""

    def __init__(self, texts: list[bytes], lower: bool = False):
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        joined = b" ".join(texts)
        super().__init__(np.frombuffer(joined.lower() if lower else joined, np.uint8))
        self.doc_end = np.cumsum(sizes + 1) - 1
        self.doc_start = self.doc_end - sizes
        inside = np.zeros(len(self.data) + 2, np.int8)
        inside[1:-1] = ~SPACE[self.data]
        edge = np.diff(inside)
        self.start, self.end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        first = np.searchsorted(self.start, self.doc_start)
        self.counts = np.searchsorted(self.start, self.doc_end) - first     # words of each text
        self.first = first                                                  # its first word
        self.doc = np.repeat(np.arange(len(texts)), self.counts)

    def word_hashes(self) -> np.ndarray:
        return self.hashes(self.start, self.end)

    def bytes_of(self, i: int) -> bytes:
        return self.data[self.start[i]:self.end[i]].tobytes()


class HashTable:
    """uint64 key (not 0) -> index in order of insertion; open addressing."""

    def __init__(self, bits: int = 12):
        self._make(bits)
        self.size = 0

    def _make(self, bits: int) -> None:
        self.shift, self.mask = np.uint64(64 - bits), np.int64((1 << bits) - 1)
        self.keys, self.vals = np.zeros(1 << bits, np.uint64), np.zeros(1 << bits, np.int32)

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint64(_BASE)) >> self.shift).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Indices, -1 for keys not held."""
        slot = self._slots(keys)
        found = self.keys[slot]
        out = np.where(found == keys, self.vals[slot], -1)
        todo = np.flatnonzero((found != keys) & (found != 0))
        while len(todo):
            slot[todo] = (slot[todo] + 1) & self.mask
            at, want = self.keys[slot[todo]], keys[todo]
            hit = at == want
            out[todo[hit]] = self.vals[slot[todo[hit]]]
            todo = todo[~hit & (at != 0)]
        return out

    def _put(self, keys: np.ndarray, vals: np.ndarray) -> None:
        slot, todo = self._slots(keys), np.arange(len(keys))
        while len(todo):
            free = todo[self.keys[slot[todo]] == 0]
            _, first = np.unique(slot[free], return_index=True)
            won = free[first]
            self.keys[slot[won]], self.vals[slot[won]] = keys[won], vals[won]
            todo = todo[self.keys[slot[todo]] != keys[todo]]
            slot[todo] = (slot[todo] + 1) & self.mask

    def add(self, keys: np.ndarray) -> None:
        """Inserts distinct keys not yet held."""
        total = self.size + len(keys)
        if 2 * total > len(self.keys):
            held = self.keys != 0
            old, vals = self.keys[held], self.vals[held]
            self._make(max(12, (2 * total).bit_length()))
            self._put(old, vals)
        self._put(keys, np.arange(self.size, total))
        self.size = total


class Growing:
    """An array that is appended to."""

    def __init__(self, dtype):
        self.data, self.n = np.empty(1024, dtype), 0

    def extend(self, more: np.ndarray) -> None:
        if self.n + len(more) > len(self.data):
            self.data = np.concatenate([self.data[:self.n], np.empty(max(len(more), self.n), self.data.dtype)])
        self.data[self.n:self.n + len(more)] = more
        self.n += len(more)


class _Generation:
    """Byte strings by their hash, each with its run of integers."""

    def __init__(self):
        self.table = HashTable()
        self.flat, self.at, self.size = Growing(np.dtype("<u4")), Growing(np.int64), Growing(np.int64)
        self.text, self.text_at, self.text_size = Growing(np.uint8), Growing(np.int64), Growing(np.int64)

    def add(self, keys: np.ndarray, data: np.ndarray, start: np.ndarray, end: np.ndarray, values: np.ndarray,
            sizes: np.ndarray) -> None:
        self.table.add(keys)
        self.at.extend(self.flat.n + np.cumsum(sizes) - sizes)
        self.size.extend(sizes)
        self.flat.extend(values)
        n = end - start
        self.text_at.extend(self.text.n + np.cumsum(n) - n)
        self.text_size.extend(n)
        self.text.extend(data[_spread(start, n)])

    def same(self, slot: np.ndarray, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Whether the bytes kept in ``slot`` are those of the ranges."""
        n = end - start
        ok = self.text_size.data[slot] == n
        at = np.flatnonzero(ok)
        here = _spread(start[at], n[at])
        differ = np.flatnonzero(data[here] != self.text.data[_spread(self.text_at.data[slot[at]], n[at])])
        if len(differ):
            ok[at[np.searchsorted(np.cumsum(n[at]), differ, side="right")]] = False
        return ok

    def take(self, slot: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        sizes = self.size.data[slot]
        return self.flat.data[_spread(self.at.data[slot], sizes)], sizes


def _spread(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """start, start + 1, .. of every range, one after the other."""
    ends = np.cumsum(size)
    return np.repeat(start - ends + size, size) + np.arange(ends[-1] if len(ends) else 0)


class Runs:
    """Byte string -> run of unsigned 32-bit integers, found by hash and held
    against the bytes kept, so equal hashes of different strings do no harm.

    Two generations of at most about ``limit / 2`` strings: a full one becomes
    the old one, and what is met again moves on to the new one, so frequent
    strings stay when rare ones are forgotten."""

    def __init__(self, limit: int):
        self.limit = limit
        self.old, self.new = _Generation(), _Generation()

    def lookup(self, ranges: Ranges, start: np.ndarray, end: np.ndarray, make) -> tuple[np.ndarray, np.ndarray]:
        """(values, sizes): the runs of all byte ranges one after the other.
        ``make(i)`` gets the positions of ranges not held and returns their
        runs as bytes."""
        if 2 * self.new.table.size > self.limit:
            self.old, self.new = self.new, _Generation()
        data, hashes = ranges.data, ranges.hashes(start, end)
        slot = self.new.table.find(hashes)
        missing = np.flatnonzero(slot < 0)
        if len(missing):
            keys, first = np.unique(hashes[missing], return_index=True)
            at = missing[first]
            held = self.old.table.find(keys)
            kept = np.flatnonzero(held >= 0)
            kept = kept[self.old.same(held[kept], data, start[at[kept]], end[at[kept]])]
            self.new.add(keys[kept], data, start[at[kept]], end[at[kept]], *self.old.take(held[kept]))
            rest = np.ones(len(keys), bool)
            rest[kept] = False
            keys, at = keys[rest], at[rest]
            self.new.add(keys, data, start[at], end[at], *_joined(make(at)))
            slot[missing] = self.new.table.find(hashes[missing])
        values, sizes = self.new.take(slot)
        other = np.flatnonzero(~self.new.same(slot, data, start, end))
        if len(other):                              # a hash that stands for another string
            each = np.split(values, np.cumsum(sizes)[:-1])
            for i, run in zip(other.tolist(), make(other)):
                each[i] = np.frombuffer(run, "<u4")
            values, sizes = np.concatenate(each), np.fromiter(map(len, each), np.int64, len(each))
        return values, sizes


def _joined(runs: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(b"".join(runs), "<u4"), np.fromiter(map(len, runs), np.int64, len(runs)) // 4


def by_bytes(texts: list, size: int = BATCH_BYTES):
    """(from, to) positions of consecutive texts of about ``size`` bytes in all."""
    start = total = 0
    for i, t in enumerate(texts):
        total += len(t)
        if total >= size:
            yield start, i + 1
            start, total = i + 1, 0
    if start < len(texts):
        yield start, len(texts)
