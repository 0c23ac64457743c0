"""Word shingles of whole texts as 64-bit hashes, and one-permutation MinHash signatures with optimal densification."""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import xxhash

WIDTH = 5
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class _Words(dict):
    """Hashes of words, made on first use; starts anew beyond ``limit`` words."""

    limit = 150_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.limit:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word)
        return h


_WORDS = _Words()


def shingles(text: str | None) -> np.ndarray:
    """Sorted distinct hashes of the 5-word shingles; of the whole sequence where it is shorter; none without words."""
    words = text.encode().lower().split() if text else []
    if not words:
        return np.zeros(0, np.uint64)
    w = np.fromiter(map(_WORDS.__getitem__, words), np.uint64, len(words))
    k = min(WIDTH, len(w))
    h = np.full(len(w) - k + 1, k, np.uint64)
    for i in range(k):
        h = h * _MULTIPLIER + w[i : len(w) - k + 1 + i]
    return np.unique(_mix(h))


@lru_cache(maxsize=2)
def _probes(bins: int) -> np.ndarray:
    """Row t: the bin that each bin asks at its t-th attempt, the same for every document."""
    return np.random.default_rng(0x0FEE).integers(0, bins, (64 * bins, bins))


def signature(s: np.ndarray, bins: int) -> np.ndarray:
    """The least hash (32 bits) in each of ``bins`` (a power of two) ranges of the sorted hashes ``s``.

    An empty bin takes the value of the first filled one in its own probe sequence.
    """
    shift = np.uint64(64 - (bins.bit_length() - 1))
    at = (s >> shift).astype(np.int64)
    first = np.flatnonzero(np.diff(at, prepend=-1))
    filled = np.zeros(bins, bool)
    filled[at[first]] = True
    out = np.zeros(bins, np.uint32)
    out[at[first]] = ((s[first] << np.uint64(bins.bit_length() - 1)) >> np.uint64(32)).astype(np.uint32)
    empty = np.flatnonzero(~filled)
    probes, t = _probes(bins), 0
    while len(empty):
        ask = probes[t % len(probes)][empty]
        ok = filled[ask]
        out[empty[ok]] = out[ask[ok]]
        empty, t = empty[~ok], t + 1
    return out


def band_keys(sig: np.ndarray, rows: int) -> np.ndarray:
    """One 64-bit key for each band of ``rows`` signature values, the band's number mixed in."""
    v = sig.reshape(-1, rows).astype(np.uint64)
    h = np.arange(1, len(v) + 1, dtype=np.uint64) * _MULTIPLIER
    for i in range(rows):
        h = _mix((h ^ v[:, i]) * _MULTIPLIER + np.uint64(i))
    return h.view(np.int64)


def linked(a: np.ndarray, b: np.ndarray) -> bool:
    """100 * intersection >= 75 * union, of sorted distinct hashes."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= 75 * (len(a) + len(b) - both)
