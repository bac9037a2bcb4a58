"""Word shingles of a text as sorted 64-bit hashes (used inside tasks)."""

from __future__ import annotations

import numpy as np
import xxhash

#: Word hashes remembered by a Python worker; beyond it they are computed anew.
CACHED_WORDS = 300_000
_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)
_M3, _S = np.uint64(0x94D049BB133111EB), np.uint64(31)


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        h = xxhash.xxh64_intdigest(word)
        if len(self) < CACHED_WORDS:
            self[word] = h
        return h


_WORDS = _WordHashes()


def words_of(text: str | None) -> list[bytes]:
    """Words of the text with A-Z lowered; separated by space, tab, LF, VT, FF, CR."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(_WORDS.__getitem__, words), dtype=np.uint64, count=len(words))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    x = x ^ (x >> np.uint64(30))
    x = x * _M2
    x = x ^ (x >> np.uint64(27))
    x = x * _M3
    return x ^ (x >> _S)


def shingle_set(text: str | None, size: int) -> np.ndarray:
    """Sorted distinct hashes of every run of ``size`` words.

    With fewer words the whole sequence is one shingle; no words, no shingle.
    """
    h = word_hashes(words_of(text))
    n = len(h)
    if n == 0:
        return h
    k = min(size, n)
    out = np.full(n - k + 1, np.uint64(k))
    for i in range(k):
        out = mix(out * _M1 + h[i:n - k + 1 + i])
    return np.unique(out)
