"""Word shingles as 64-bit hashes, for whole batches of texts at a time (numpy)."""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import xxhash

WORDS = 5
_CACHE_WORDS = 500_000
# Odd multipliers (golden-ratio and splitmix constants).
_STEP = np.uint64(0x9E3779B97F4A7C15)
_MIX_A = np.uint64(0xBF58476D1CE4E5B9)
_MIX_B = np.uint64(0x94D049BB133111EB)


class WordHashes(dict):
    """Hash of a word, kept for the words seen lately."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= _CACHE_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def words_of(text: str | None) -> list[bytes]:
    """Words in UTF-8: A-Z lower-cased, split at the six ASCII white-space characters."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX_A
    x = (x ^ (x >> np.uint64(27))) * _MIX_B
    return x ^ (x >> np.uint64(31))


def shingle_set(words: list[bytes], hashes: WordHashes, n: int = WORDS) -> np.ndarray:
    """Sorted distinct hashes of the n-word shingles; of fewer words, the one sequence."""
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    width = min(n, len(h))
    count = len(h) - width + 1
    total = np.full(count, np.uint64(width))
    for i in range(width):
        total = total * _STEP + h[i:i + count]
        total ^= total >> np.uint64(29)
    return np.unique(mix(total))


def shingle_sets(texts: Iterable[str | None], n: int = WORDS) -> list[np.ndarray]:
    hashes = WordHashes()
    return [shingle_set(words_of(t), hashes, n) for t in texts]
