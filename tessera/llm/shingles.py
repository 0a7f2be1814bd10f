"""Word n-gram sets as sorted arrays of 64-bit hashes."""

from __future__ import annotations

import numpy as np
import xxhash

#: Words whose hashes a worker remembers; a miss costs little.
MEMO_ENTRIES = 250_000

_MIX_A, _MIX_B = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
_SHIFT = np.uint64(33)
_STEP = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values (the public MurmurHash3 finaliser)."""
    x = x ^ (x >> _SHIFT)
    x = x * _MIX_A
    x = x ^ (x >> _SHIFT)
    x = x * _MIX_B
    return x ^ (x >> _SHIFT)


class WordHashes(dict):
    """word -> 64-bit hash, remembered for words met lately."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= MEMO_ENTRIES:
            self.clear()
        h = xxhash.xxh3_64_intdigest(word)
        if len(word) <= 64:
            self[word] = h
        return h


def word_hashes(text: bytes, memo: WordHashes) -> np.ndarray:
    """Hashes of a text's words, A-Z lower-cased, split at ASCII white space."""
    words = text.lower().split()
    return np.fromiter(map(memo.__getitem__, words), np.uint64, len(words))


def shingle_set(words: np.ndarray, k: int) -> np.ndarray:
    """Sorted distinct k-word shingles; a shorter, non-empty sequence is one shingle."""
    n = len(words)
    if n == 0:
        return words
    with np.errstate(over="ignore"):
        width = min(k, n)
        h = np.full(n - width + 1, np.uint64(width))
        for i in range(width):
            h = mix(h * _STEP + words[i : n - width + 1 + i])
    h.sort()
    return h[np.concatenate([[True], h[1:] != h[:-1]])]
