"""Hamming neighbours by bit-sliced comparison.

Fingerprints that share a key lie next to each other. Their bits are stored as
vertical planes: plane j holds bit j of all rows. The rows are compared with
those d places further on, for d = 1, 2, ...: a lane is such a pair, planes are
XORed 64 lanes a word, and the distances of all lanes are counted at once in
carry-save counters, two planes for each full adder. The counters start so that
they overflow at radius + 1, and a block of lanes is abandoned once every lane
has overflowed.
"""

from __future__ import annotations

import numpy as np

GROUP = 8                 # planes between two looks at whether a block can be abandoned


def within(planes: np.ndarray, i: np.ndarray, j: np.ndarray, radius: int) -> np.ndarray:
    """Which of the lanes (i, j) are at most ``radius`` bits apart.

    ``planes`` has a row of 0/1 bytes for each bit."""
    lanes = len(i)
    words = -(-lanes // 64)
    full = np.uint64(0xFFFFFFFFFFFFFFFF)
    width = radius.bit_length()
    begin = (1 << width) - 1 - radius
    digits = [np.full(words, full if begin >> k & 1 else 0, np.uint64) for k in range(width)]
    over = np.zeros(words, np.uint64)
    for at in range(0, len(planes), GROUP):
        part = planes[at:at + GROUP]
        bits = np.packbits(part[:, i] ^ part[:, j], axis=1)
        block = np.zeros((len(part), words * 8), np.uint8)
        block[:, :bits.shape[1]] = bits
        block = block.view(np.uint64)
        for k in range(0, len(block), 2):
            a = block[k]
            b = block[k + 1] if k + 1 < len(block) else np.zeros(words, np.uint64)
            if not width:
                over |= a | b
                continue
            s = digits[0] ^ a
            carry = (digits[0] & a) | (s & b)
            digits[0] = s ^ b
            for n in range(1, width):
                digits[n], carry = digits[n] ^ carry, digits[n] & carry
            over |= carry
        if at + GROUP < len(planes):
            last = over[-1:].view(np.uint8).copy()
            used = np.packbits((np.arange(64) < lanes - 64 * (words - 1)).astype(np.uint8))
            if (over[:-1] == full).all() and (last & used == used).all():
                return np.zeros(lanes, bool)
    return np.unpackbits(over.view(np.uint8))[:lanes] == 0


def planes_of(fingerprints: np.ndarray, bits: int = 64) -> np.ndarray:
    """Vertical 0/1 planes of uint64 fingerprints, highest bit first."""
    rows = fingerprints.astype(">u8").view(np.uint8).reshape(-1, 8)
    return np.ascontiguousarray(np.unpackbits(rows, axis=1).T[64 - bits:])


def _relabel(label: np.ndarray, pairs) -> np.ndarray:
    parent = label.copy()

    def top(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x
    for x, y in pairs:
        x, y = top(x), top(y)
        if x != y:
            parent[max(x, y)] = min(x, y)
    while not np.array_equal(up := parent[parent], parent):
        parent = up
    return parent


def link(keys: np.ndarray, fingerprints: np.ndarray, radius: int, check=None, near=None) -> tuple[np.ndarray, np.ndarray]:
    """Links (row, row) that connect rows of equal key at most ``radius`` bits
    apart: a spanning forest, never all pairs. ``keys`` must be sorted.
    ``near(i, j)`` tells which pairs are that close (default: bit planes);
    ``check(i, j)`` may confirm the pairs found (an array of bool)."""
    n = len(keys)
    label = np.arange(n)
    if n < 2:
        return label[:0], label[:0]
    if near is None:
        planes = planes_of(fingerprints)
        near = lambda i, j: within(planes, i, j, radius)
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    ends = np.repeat(np.append(first[1:], n), np.diff(np.append(first, n)))
    rows = np.arange(n)
    d = 1
    while True:
        rows = rows[rows + d < ends[rows]]
        if not len(rows):
            break
        i = rows[label[rows] != label[rows + d]]
        if len(i):
            hit = i[near(i, i + d)]
            if check is not None and len(hit):
                hit = hit[check(hit, hit + d)]
            if len(hit):
                label = _relabel(label, zip(hit.tolist(), (hit + d).tolist()))
        d += 1
    loose = np.flatnonzero(label != np.arange(n))
    return loose, label[loose]
