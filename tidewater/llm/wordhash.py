"""Words and word windows of whole Arrow columns, hashed with numpy.

A column's texts are treated as one byte array; words are found from a table
of 256 byte classes, hashed eight bytes at a time, and windows of L words get
Rabin-Karp hashes from running sums: with an odd base B,
sum(h[i+k] * B^(i+k)) * B^-i mod 2^64, so a window costs the same for any L.
"""

from __future__ import annotations

import numpy as np

M1, M2 = 0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9
BASES = (0xD6E8FEB86659FD93, 0xA0761D6478BD642F)

BREAKS = bytes([0x20, *range(0x09, 0x0E)])     # ASCII white space


def class_table(breaks: bytes) -> np.ndarray:
    """True for the bytes that are part of a word."""
    t = np.ones(256, bool)
    t[np.frombuffer(breaks, np.uint8)] = False
    return t


class Words:
    """Word positions in a column: byte ``start`` and ``end`` in ``buf``, and
    ``first``, the index of each text's first word (with the total at its end).

    A word is a longest run of bytes of one class other than 0."""

    def __init__(self, column, is_word: np.ndarray, lower: bool = False):
        import pyarrow as pa
        import pyarrow.compute as pc

        col = pc.fill_null(column.cast(pa.large_binary()), b"")
        n = len(col)
        off = np.frombuffer(col.buffers()[1], np.int64, n + 1, col.offset * 8) if n else np.zeros(1, np.int64)
        raw = np.frombuffer(col.buffers()[2], np.uint8)[off[0]:off[-1]] if n and col.buffers()[2] is not None else np.zeros(0, np.uint8)
        self.off = off - off[0]
        size = len(raw)
        self._padded = np.zeros(size + 8, np.uint8)
        self._padded[:size] = raw
        self.buf = self._padded[:size]
        if lower:
            upper = (self.buf >= 65) & (self.buf <= 90)
            self.buf[upper] += 32
        word = is_word[self.buf]
        begins, stops = word != 0, word != 0
        change = word[1:] != word[:-1]
        begins[1:] &= change
        stops[:-1] &= change
        inner = self.off[:-1][self.off[:-1] < size]
        begins[inner] = word[inner] != 0
        inner = self.off[1:][self.off[1:] > 0] - 1
        stops[inner] = word[inner] != 0
        self.start = np.flatnonzero(begins)
        self.end = np.flatnonzero(stops) + 1
        self.first = np.searchsorted(self.start, self.off)

    def hashes(self, seed: int = 0) -> np.ndarray:
        at = np.ndarray((len(self.buf) + 1,), "<u8", self._padded, strides=(1,))
        masks = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)
        left = self.end - self.start
        h = (left.astype(np.uint64) + np.uint64(seed)) * np.uint64(M2)
        live, pos = None, self.start
        while len(pos):
            part = at[pos] & masks[np.minimum(left, 8)]
            old = h if live is None else h[live]
            new = (old ^ part) * np.uint64(M1)
            new ^= new >> np.uint64(29)
            new *= np.uint64(M2)
            new ^= new >> np.uint64(32)
            if live is None:
                h = new
            else:
                h[live] = new
            more = left > 8
            live = np.flatnonzero(more) if live is None else live[more]
            pos, left = pos[more] + 8, left[more] - 8
        return h

    def prefix_hashes(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of the first ``size`` (at most 8) bytes of the words longer
        than that, and which words these are."""
        at = np.ndarray((len(self.buf) + 1,), "<u8", self._padded, strides=(1,))
        which = np.flatnonzero(self.end - self.start > size)
        h = (at[self.start[which]] & np.uint64((1 << 8 * size) - 1)) + np.uint64(size)
        for m, shift in ((M1, 29), (M2, 32), (M1, 30)):
            h *= np.uint64(m)
            h ^= h >> np.uint64(shift)
        return h, which

    def room(self) -> np.ndarray:
        """For each word, how many words of its text begin at it or after it."""
        counts = np.diff(self.first)
        return np.repeat(self.first[1:], counts) - np.arange(len(self.start))


_powers: dict = {}


def _power(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    have = _powers.get(base)
    if have is None or len(have[0]) < n:
        size = max(n, 1 << 16)
        up, down = np.full(size, base, np.uint64), np.full(size, pow(base, -1, 1 << 64), np.uint64)
        up[0] = down[0] = 1
        have = _powers[base] = np.cumprod(up), np.cumprod(down)
    return have[0][:n], have[1][:n]


def window_hashes(h: np.ndarray, length: int, base: int = BASES[0]) -> np.ndarray:
    """The hash of every run of ``length`` entries of ``h``, text borders ignored."""
    n = len(h)
    if n < length:
        return np.zeros(0, np.uint64)
    up, down = _power(base, n)
    run = np.zeros(n + 1, np.uint64)
    np.cumsum(h * up, out=run[1:])
    w = (run[length:] - run[:-length]) * down[:n - length + 1]
    w ^= w >> np.uint64(31)
    w *= np.uint64(M1)
    w ^= w >> np.uint64(29)
    return w


def range_hashes(h: np.ndarray, begin: np.ndarray, end: np.ndarray, base: int = BASES[1]) -> np.ndarray:
    """The hash of each run of entries [begin, end) of ``h``, lengths included."""
    up, down = _power(base, max(1, len(h)))
    run = np.zeros(len(h) + 1, np.uint64)
    np.cumsum(h * up[:len(h)], out=run[1:])
    w = (run[end] - run[begin]) * down[begin] + (end - begin).astype(np.uint64)
    for m, shift in ((M1, 31), (M2, 29)):
        w ^= w >> np.uint64(shift)
        w *= np.uint64(m)
    return w ^ (w >> np.uint64(32))
