"""Word hashes and shingle sets of whole batches of texts, in numpy."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import xxhash

CACHE = 200_000
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)  # fixed values: splitmix64
_GOLD = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that scatters them."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


class WordHashes(dict):
    """64-bit hash by word, remembered up to a bound."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE:
            self.clear()
        out = self[word] = xxhash.xxh3_64_intdigest(word)
        return out


def word_hashes(texts: Sequence[bytes | None], known: WordHashes) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, A-Z in lower case, and the number of words by text.

    ``bytes.lower`` and ``bytes.split`` know ASCII only, as words are defined here.
    """
    parts, sizes = [], np.zeros(len(texts), np.int64)
    for i, text in enumerate(texts):
        words = (text or b"").lower().split()
        sizes[i] = len(words)
        parts.append(np.fromiter(map(known.__getitem__, words), np.uint64, len(words)))
    return (np.concatenate(parts) if parts else np.empty(0, np.uint64)), sizes


def shingle_sets(
    texts: Sequence[bytes | None], size: int, known: WordHashes
) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of ``size`` words: ``(row, hash)`` sorted by both.

    A text of fewer words has its whole sequence as its only shingle; one
    without words has none.
    """
    hashes, sizes = word_hashes(texts, known)
    row = np.repeat(np.arange(len(sizes)), sizes)
    ends = np.cumsum(sizes)
    left = ends[row] - np.arange(len(row))  # words from here to the end of the text
    first = np.arange(len(row)) == (ends - sizes)[row]
    out = mix(hashes + _GOLD)
    full = np.minimum(size, sizes[row])
    for k in range(1, size):
        more = left > k
        at = np.flatnonzero(more & (full > k))
        out[at] = mix(out[at] * _GOLD + hashes[at + k])
    keep = (left >= size) | (first & (sizes[row] < size))
    row, out = row[keep], out[keep]
    order = np.lexsort((out, row))
    row, out = row[order], out[order]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (out[1:] != out[:-1])
    return row[new], out[new]
