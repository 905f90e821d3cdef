"""Word shingles of whole texts as sets of 64-bit hashes, for a batch of texts at a time."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

# ASCII white space: blank and \x09-\x0D. Everything else belongs to a word.
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers whose results look random (xor-shifts and odd multipliers)."""
    x = x.astype(np.uint64, copy=True)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x ^= x >> np.uint64(shift)
        x *= np.uint64(factor)
    x ^= x >> np.uint64(31)
    return x


def word_hashes(text: bytes) -> np.ndarray:
    """One 64-bit hash for each word; A-Z count as a-z.

    A word's hash is the sum of byte times a random odd number for its place, mixed with its length.
    """
    raw = _LOWER[np.frombuffer(text, dtype=np.uint8)]
    inside = np.concatenate(([False], ~_SPACE[raw], [False]))
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[::2], edges[1::2]
    if not len(starts):
        return np.empty(0, dtype=np.uint64)
    lengths = ends - starts
    letters = raw[inside[1:-1]].astype(np.uint64) + np.uint64(1)
    first = np.cumsum(lengths) - lengths
    place = np.arange(len(letters)) - np.repeat(first, lengths)
    sums = np.add.reduceat(letters * _factors(int(lengths.max()))[place], first)
    return mix(sums + lengths.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


_known_factors = np.empty(0, dtype=np.uint64)


def _factors(n: int) -> np.ndarray:
    global _known_factors
    if len(_known_factors) < n:
        _known_factors = mix((np.arange(max(n, 256)) + 1).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
    return _known_factors


def shingle_set(text: bytes, k: int) -> np.ndarray:
    """The sorted distinct hashes of the ``k``-word shingles; with fewer words, of the whole sequence; without words, none."""
    words = word_hashes(text)
    if not len(words):
        return words
    k = min(k, len(words))
    total = np.zeros(len(words) - k + 1, dtype=np.uint64)
    for i in range(k):
        total = total * np.uint64(0xD6E8FEB86659FD93) + words[i : len(words) - k + 1 + i]
    return np.unique(mix(total + np.uint64(k)))


def texts_of(column: pa.Array) -> list[bytes]:
    """The UTF-8 bytes of each text; null counts as empty."""
    return [text or b"" for text in column.cast(pa.large_binary()).to_pylist()]
