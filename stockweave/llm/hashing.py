"""Hashing of words and windows over whole Arrow batches, in numpy.

A prefix sum of byte values times powers of a constant gives the hash of any stretch of a
buffer in constant time, so words, word windows and byte windows cost a few operations per
byte whatever their length.  64-bit values choose candidates; exact results rest on checks
of the texts themselves or of 128-bit digests.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_GOLDEN = 0x9E3779B97F4A7C15
BASE = 0xD1342543DE82EF95
INVERSE = pow(BASE, -1, 1 << 64)
#: Bytes that separate words: space and \t \n \v \f \r.
SEPARATORS = b" \t\n\x0b\x0c\r"
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every input bit over the output."""
    x = x ^ (x >> np.uint64(30))
    x = x * _M1
    x = x ^ (x >> np.uint64(27))
    x = x * _M2
    return x ^ (x >> np.uint64(31))


BYTE_VALUE = mix((np.arange(1, 257, dtype=np.uint64) * np.uint64(_GOLDEN)))
_IS_WORD = np.ones(256, bool)
_IS_WORD[list(SEPARATORS)] = False
_powers = {BASE: np.ones(1, np.uint64), INVERSE: np.ones(1, np.uint64)}


def _power(base: int, n: int) -> np.ndarray:
    """base ** 0 .. base ** (n - 1) modulo 2 ** 64, kept per process up to 4 M entries."""
    if len(_powers[base]) < n:
        grown = np.full(n, base, np.uint64)
        grown[0] = 1
        grown = np.cumprod(grown, dtype=np.uint64)
        if n > 1 << 22:
            return grown
        _powers[base] = grown
    return _powers[base][:n]


class Stretches:
    """Hashes of stretches of one byte buffer."""

    def __init__(self, data: np.ndarray):
        n = len(data)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(BYTE_VALUE[data] * _power(BASE, n), out=self.sums[1:])
        self.inverse = _power(INVERSE, n + 1)

    def of(self, starts, ends) -> np.ndarray:
        return mix((self.sums[ends] - self.sums[starts]) * self.inverse[starts])

    def windows(self, width: int) -> np.ndarray:
        """Hash of the window of ``width`` bytes at each place."""
        return mix((self.sums[width:] - self.sums[:-width]) * self.inverse[: len(self.sums) - width])


def chunks(texts: pa.Array, limit: int = 1 << 20) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Split a column without nulls into runs of rows of about ``limit`` bytes (one row at
    least): (first row, bytes, offsets of the rows in them)."""
    texts = texts.cast(pa.large_binary())
    if not len(texts):
        return
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2], np.uint8) if texts.buffers()[2] else np.zeros(0, np.uint8)
    first = 0
    while first < len(texts):
        last = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
        last = min(max(last, first + 1), len(texts))
        yield first, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word, and the first word of each row (with the total at the
    end): words are runs of bytes that are no separators, cut at row borders."""
    inside = _IS_WORD[data]
    before = np.empty(len(data), bool)
    before[:1] = False
    before[1:] = inside[:-1]
    edges = offsets[:-1]
    before[edges[edges < len(data)]] = False
    starts = np.flatnonzero(inside & ~before)
    after = np.empty(len(data), bool)
    after[-1:] = False
    after[:-1] = inside[1:]
    edges = offsets[1:]
    after[edges[edges > 0] - 1] = False
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def grams(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of n consecutive values."""
    count = max(0, len(hashes) - n + 1)
    total = np.zeros(count, np.uint64)
    for j in range(n):
        total = total * np.uint64(BASE) + hashes[j : j + count]
    return mix(total)


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each window of ``width`` values, by doubling."""
    if len(values) < width:
        return values[:0]
    out, span = values, 1
    while span * 2 <= width:
        out = np.minimum(out[:-span], out[span:])
        span *= 2
    rest = width - span
    return np.minimum(out[: len(out) - rest], out[rest:]) if rest else out
