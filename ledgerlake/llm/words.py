"""Words of whole Arrow batches as 64-bit hashes, without a Python object per word.

A word is a run of bytes other than space and \\t to \\r, with A-Z lower-cased.
Its hash is a polynomial of its bytes (differences of one running sum per block
of texts), finalised by a mixing function; runs of words are hashed in order.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

BLOCK = 1 << 20  # bytes of text hashed together; a longer text is a block of its own
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A"):ord("Z") + 1] += 32
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


class Words(NamedTuple):
    """Of the texts of a block: first, the words' number of each text's first word (one more entry than texts)."""

    first: np.ndarray
    hashes: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    data: np.ndarray


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values whose bits all depend on all bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _pow(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        m = 1 << (n - 1).bit_length()
        for k, base in enumerate((_BASE, _INVERSE)):
            p = np.full(m, base, np.uint64)
            p[0] = 1
            _powers[k] = np.multiply.accumulate(p)
    return _powers[0][:n], _powers[1][:n]


def texts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and offsets of a string column (null: empty)."""
    column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset:column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int32)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data, offsets.astype(np.int64)


def blocks(column: pa.Array, lower: bool = True, cuts: np.ndarray | None = None) -> Iterator[tuple[int, int, Words]]:
    """(first row, row after the last, words) of consecutive texts; ``cuts``: further bytes (True) that end words."""
    data, offsets = texts(column)
    space = SPACE if cuts is None else SPACE | cuts
    row, n = 0, len(offsets) - 1
    while row < n:
        stop = max(row + 1, int(np.searchsorted(offsets, offsets[row] + BLOCK, "right")) - 1)
        part = data[offsets[row]:offsets[stop]]
        at = offsets[row:stop + 1] - offsets[row]
        yield row, stop, _words(LOWER[part] if lower else part, space[part], at)
        row = stop


def _words(part: np.ndarray, gap: np.ndarray, at: np.ndarray) -> Words:
    n = len(part)
    edge = np.zeros(n + 1, bool)
    edge[at] = True
    before = np.ones(n, bool)
    before[1:] = gap[:-1]
    after = np.ones(n, bool)
    after[:-1] = gap[1:]
    solid = ~gap
    starts = np.flatnonzero(solid & (before | edge[:n]))
    ends = np.flatnonzero(solid & (after | edge[1:])) + 1
    power, inverse = _pow(n + 1)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum((part.astype(np.uint64) + np.uint64(1)) * power[:n], out=total[1:])
    hashes = mixed((total[ends] - total[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))
    return Words(np.searchsorted(starts, at, "left"), hashes, starts, ends, part)


def runs(words: Words, size: int) -> np.ndarray:
    """The hash of ``size`` consecutive words from each word on (of two texts perhaps; see ``shingles``)."""
    h = words.hashes
    n = max(0, len(h) - size + 1)
    x = np.zeros(n, np.uint64)
    for j in range(size):
        x = mixed(x * np.uint64(_BASE) + h[j:j + n])
    return x


def shingles(words: Words, size: int) -> Iterator[np.ndarray]:
    """Sorted distinct hashes of each text's ``size``-word runs; of a shorter text, the hash of all its words."""
    every = runs(words, size)
    for a, b in zip(words.first[:-1].tolist(), words.first[1:].tolist(), strict=True):
        if b - a >= size:
            yield np.unique(every[a:b - size + 1])
        elif b > a:
            x = np.zeros(1, np.uint64)
            for h in words.hashes[a:b]:
                x = mixed(x * np.uint64(_BASE) + h)
            yield x
        else:
            yield every[:0]
