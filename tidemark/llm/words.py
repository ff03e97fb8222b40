"""Words of a column of texts as arrays: hashes and byte places, without a loop over words.

A word is a run of bytes other than ASCII white space. Its hash is a polynomial over its
bytes modulo 2^64, taken from running sums over the whole buffer, then mixed.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa

_BASE = 0x9E3779B97F4A7C15 | 1
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
#: Bytes that are no part of a letter or digit, white space among them.
NO_LETTER = np.zeros(256, dtype=bool)
NO_LETTER[[*range(48), *range(58, 65), *range(91, 97), *range(123, 128)]] = True
#: The same bytes, A to Z as a to z.
FOLD = np.arange(256, dtype=np.uint8)
FOLD[65:91] += 32


class Words(NamedTuple):
    """Of the texts of a slice: each word's hash and first and last byte; ``bounds`` has
    where the words of each text begin, and one more; ``data`` and ``offsets`` the bytes;
    ``sums`` the polynomial's running sums, ``units`` what brings those of a word to one scale."""

    hashes: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    bounds: np.ndarray
    data: np.ndarray
    offsets: np.ndarray
    sums: np.ndarray
    units: np.ndarray

    def prefixes(self, size: int) -> np.ndarray:
        """Hashes of the first ``size`` bytes of each word, or of all if it has fewer."""
        stop = np.minimum(self.starts + size, self.ends)
        with np.errstate(over="ignore"):
            return mix((self.sums[stop] - self.sums[self.starts]) * self.units + np.uint64(size))

    def owners(self) -> np.ndarray:
        """The number of the text that each word stands in."""
        return np.repeat(np.arange(len(self.bounds) - 1), np.diff(self.bounds))


def mix(x: np.ndarray | np.uint64) -> np.ndarray:
    """A one-to-one scrambling of 64-bit numbers."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def powers(base: int, n: int) -> np.ndarray:
    """1, base, base^2, ... modulo 2^64."""
    made = np.full(n, np.uint64(base & (2**64 - 1)), dtype=np.uint64)
    made[:1] = 1
    with np.errstate(over="ignore"):
        return np.multiply.accumulate(made)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts end to end, and where each begins; nulls are empty."""
    column = column.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    buffer = column.buffers()[2]
    if buffer is None or len(offsets) == 0:
        return np.zeros(0, dtype=np.uint8), np.zeros(len(column) + 1, dtype=np.int64)
    data = np.frombuffer(buffer, dtype=np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def find_words(column: pa.Array, fold: np.ndarray | None = None, separators: np.ndarray = _SPACE) -> Words:
    """Words of each text; ``fold`` maps bytes before they are hashed."""
    data, offsets = text_bytes(column)
    inside = ~separators[data]
    before = np.empty_like(inside)
    before[:1], before[1:] = False, inside[:-1]
    after = np.empty_like(inside)
    after[-1:], after[:-1] = False, inside[1:]
    before[offsets[:-1][offsets[:-1] < len(data)]] = False
    after[offsets[1:][offsets[1:] > 0] - 1] = False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    values = (data if fold is None else fold[data]).astype(np.uint64)
    with np.errstate(over="ignore"):
        values += np.uint64(1)
        values *= powers(_BASE, len(values))
        sums = np.zeros(len(values) + 1, dtype=np.uint64)
        np.cumsum(values, out=sums[1:])
        units = powers(pow(_BASE, -1, 1 << 64), len(values) + 1)[starts]
        hashes = mix((sums[ends] - sums[starts]) * units)
    return Words(hashes, starts, ends, np.searchsorted(starts, offsets), data, offsets, sums, units)


def shingles(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, text) of each run of ``size`` words; a shorter text that has words is one run."""
    hashes, bounds = words.hashes, words.bounds
    counts = np.diff(bounds)
    runs = np.where(counts > 0, np.maximum(counts - size + 1, 1), 0)
    owner = np.repeat(np.arange(len(counts)), runs)
    first = np.arange(len(owner)) - np.repeat(np.cumsum(runs) - runs, runs) + bounds[:-1][owner]
    last = bounds[1:][owner]
    made = np.zeros(len(owner), dtype=np.uint64)
    padded = np.append(hashes, np.uint64(0))
    with np.errstate(over="ignore"):
        for k in range(size):
            at = np.minimum(first + k, len(hashes))
            made = made * np.uint64(0xD1342543DE82EF95) + np.where(first + k < last, padded[at], np.uint64(0))
    return mix(made), owner


def code_points(words: Words) -> np.ndarray:
    """For each byte place, the code points of the slice before it."""
    lead = (words.data & 0xC0) != 0x80
    return np.concatenate([[0], np.cumsum(lead)])
