"""Words of many texts at once, as 64-bit hashes (numpy, on the UTF-8 bytes of an Arrow column)."""

from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa

#: Letters A-Z in lower case; other bytes as they are.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32
#: Bytes of the words of decontamination: digits, a-z, and all of any character above ASCII.
ALNUM = np.zeros(256, bool)
ALNUM[0x30:0x3A] = ALNUM[0x61:0x7B] = ALNUM[0x80:] = True
#: Bytes of words between white space.
SOLID = np.ones(256, bool)
SOLID[[0x20, *range(0x09, 0x0E)]] = False

_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_VALUE = np.random.default_rng(20240101).integers(1, 1 << 63, 256, dtype=np.uint64)
#: Bytes hashed at once; what is computed beside them is eight times as large, and the hashes do not depend on it.
_CHUNK = 1 << 18


@dataclass
class Words:
    """The words of ``len(first) - 1`` texts: those of text i are ``first[i]:first[i + 1]``."""

    hash: np.ndarray
    first: np.ndarray
    start: np.ndarray
    end: np.ndarray

    @property
    def text(self) -> np.ndarray:
        """The number of each word's text."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values; none becomes 0."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    x[x == 0] = 1
    return x


@cache
def _chunk_powers(base: np.uint64) -> np.ndarray:
    out = np.full(_CHUNK, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def _powers(base: np.uint64, n: int) -> np.ndarray:
    """Powers 0 to n - 1; longer ones only for a word beyond _CHUNK."""
    if n <= _CHUNK:
        return _chunk_powers(base)[:n]
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts, one after another, and the offsets of the texts; null is empty."""
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], np.int64)[
        column.offset : column.offset + len(column) + 1
    ]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def words(column: pa.Array, inside: np.ndarray = ALNUM, lower: bool = True) -> Words:
    """The longest runs of the bytes ``inside`` in each text."""
    data, offsets = text_bytes(column)
    if lower:
        data = LOWER[data]
    solid = inside[data]
    cuts = offsets[offsets < len(data)]
    before = np.concatenate([[False], solid[:-1]]) if len(solid) else solid.copy()
    before[cuts] = False
    after = np.concatenate([solid[1:], [False]]) if len(solid) else solid.copy()
    after[cuts[cuts > 0] - 1] = False
    start = np.flatnonzero(solid & ~before)
    end = np.flatnonzero(solid & ~after) + 1
    return Words(run_hashes(data, start, end), np.searchsorted(start, offsets), start, end)


def run_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A hash of each run of bytes; the runs follow one another and don't overlap.

    A run's sum of value times power, shifted to its own start, does not depend on its place.
    """
    hashes = np.zeros(len(start), np.uint64)
    i = 0
    while i < len(start):
        j = max(i + 1, int(np.searchsorted(end, start[i] + _CHUNK, side="right")))
        low, high = start[i], end[j - 1]
        n = int(high - low)
        total = np.concatenate(
            [np.zeros(1, np.uint64), np.cumsum(_VALUE[data[low:high]] * _powers(_BASE, n))]
        )
        a, b = start[i:j] - low, end[i:j] - low
        hashes[i:j] = (total[b] - total[a]) * _powers(_INVERSE, n)[a]
        i = j
    return mix(hashes)


def grams(h: np.ndarray, k: int) -> np.ndarray:
    """Hashes of ``k`` neighbours at each place that has so many."""
    n = max(0, len(h) - k + 1)
    out = np.zeros(n, np.uint64)
    for j in range(k):
        out = out * _BASE + h[j : j + n]
    return mix(out)
