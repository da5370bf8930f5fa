"""Word shingles as 64-bit hashes."""

from __future__ import annotations

import numpy as np
import xxhash

from partnerlens.llm.common import forget, sole_memory

_MIX = np.uint64(0x9E3779B97F4A7C15)
_known: dict[bytes, int] = {}


def word_hashes(raw: bytes) -> np.ndarray:
    """A 64-bit hash of each word `[^\\x20\\x09-\\x0D]+`, A-Z lower-cased; remembered within a bound."""
    words = raw.lower().split()
    sole_memory("shingles", _known)
    forget(_known, 100_000)
    for w in set(words).difference(_known):
        _known[w] = xxhash.xxh3_64_intdigest(w)
    return np.fromiter(map(_known.__getitem__, words), np.uint64, len(words))


def shingles(raw: bytes, size: int) -> np.ndarray:
    """Hashes of the distinct shingles of `size` words, ascending; of fewer words the whole sequence is one; none without words."""
    words = word_hashes(raw)
    if not len(words):
        return words
    n = max(1, len(words) - size + 1)
    h = np.full(n, min(size, len(words)), np.uint64)
    for k in range(min(size, len(words))):
        h = (h ^ words[k : k + n]) * _MIX
        h ^= h >> np.uint64(31)
    return np.unique(h)
