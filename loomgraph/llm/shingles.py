"""Word shingles as 64-bit hashes."""

from __future__ import annotations

import numpy as np
import xxhash

_word = xxhash.xxh3_64_intdigest


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers in which every bit depends on all (multiply and fold)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: str, n: int) -> np.ndarray:
    """Sorted hashes of the distinct runs of n words, A-Z in lower case; of fewer words, of the whole sequence
    as one; of no words, none."""
    words = text.encode("utf-8", "surrogatepass").lower().split()  # on bytes: ASCII letters and white space only
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(_word, words), np.uint64, len(words))
    size = min(n, len(h))
    out = np.full(len(h) - size + 1, size, np.uint64)
    for i in range(size):
        out = mix(out * np.uint64(0x9E3779B97F4A7C15) + h[i : len(h) - size + 1 + i])
    return np.unique(out)
