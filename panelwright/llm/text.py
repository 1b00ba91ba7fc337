"""Words and shingles of many texts at once, as arrays of hashes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text worked on at once.
PIECE_BYTES = 1 << 19

_RANDOM = np.random.default_rng(20240229)
_BYTE = _RANDOM.integers(1, 2**63, 256, dtype=np.uint64)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers (a bijection)."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column one after the other (null: none), and where each row starts and ends."""
    column = column.cast(pa.large_string()).fill_null("")
    _, ends, data = column.buffers()
    n = len(column)
    offsets = np.frombuffer(ends, np.int64)[column.offset : column.offset + n + 1]
    return np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8), offsets


def pieces(offsets: np.ndarray, limit: int = PIECE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about `limit` bytes; a longer row makes a range of its own."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1)
        yield i, min(j, n)
        i = j


def word_spans(
    data: np.ndarray, offsets: np.ndarray, inside: np.ndarray = ~_SPACE
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of each word, and the first word of each row (one more for the end).

    Words are the longest runs of bytes that `inside` marks: by default all but space, tab, line feed, vertical tab,
    form feed and return.
    """
    base, stop = int(offsets[0]), int(offsets[-1])
    ink = inside[data[base:stop]]
    if not len(ink):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    edge = np.zeros(len(ink) + 1, bool)
    edge[offsets[:-1] - base] = True
    first = ink.copy()
    first[1:] &= ~ink[:-1] | edge[1:-1]
    last = ink.copy()
    last[:-1] &= ~ink[1:] | edge[1:-1]
    starts, ends = np.flatnonzero(first) + base, np.flatnonzero(last) + base + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word, A-Z as a-z."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    base, stop = int(starts[0]), int(ends[-1])
    coded = _BYTE[LOWER[data[base:stop]]]
    powers = np.full(stop - base, _BASE, np.uint64)
    powers[0] = 1
    np.multiply.accumulate(powers, out=powers)
    sums = np.zeros(stop - base + 1, np.uint64)
    np.cumsum(coded * powers, out=sums[1:])
    # Divide by the power of the start: the base is odd, so its powers have inverses modulo 2**64.
    inverse = np.full(stop - base, np.uint64(pow(int(_BASE), -1, 1 << 64)), np.uint64)
    inverse[0] = 1
    np.multiply.accumulate(inverse, out=inverse)
    return mix((sums[ends - base] - sums[starts - base]) * inverse[starts - base] + (ends - starts).astype(np.uint64))


def shingle_sets(data: np.ndarray, offsets: np.ndarray, size: int) -> list[np.ndarray]:
    """For each row its distinct shingles of `size` words as sorted hashes; a shorter text is one shingle."""
    starts, ends, rows = word_spans(data, offsets)
    hashes = word_hashes(data, starts, ends)
    n = len(hashes)
    joined = np.zeros(max(0, n - size + 1), np.uint64)
    for k in range(size):
        joined = joined * _BASE + hashes[k : n - size + 1 + k]
    joined = mix(joined)
    sets = []
    for a, b in zip(rows[:-1], rows[1:]):
        if b - a >= size:
            sets.append(np.unique(joined[a : b - size + 1]))
        elif b > a:
            whole = np.uint64(b - a)
            for h in hashes[a:b]:
                whole = np.uint64((int(whole) * int(_BASE) + int(h)) % (1 << 64))
            sets.append(mix(np.array([whole])))
        else:
            sets.append(np.zeros(0, np.uint64))
    return sets
