"""Word shingles as 64-bit hashes, computed in tasks."""

from __future__ import annotations

import numpy as np
import xxhash

WIDTH = 5
MOST_CACHED = 400_000
MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))
FACTORS = [np.uint64(pow(0x9E3779B97F4A7C15, i + 1, 1 << 64) | 1) for i in range(WIDTH)]


class WordHashes(dict):
    """Hashes of words; forgets all once it holds ``MOST_CACHED`` of them."""

    def __missing__(self, word: bytes) -> int:
        found = xxhash.xxh3_64_intdigest(word)
        if len(word) <= 64:
            if len(self) >= MOST_CACHED:
                self.clear()
            self[word] = found
        return found


WORDS = WordHashes()


def mixed(values: np.ndarray) -> np.ndarray:
    """A one-to-one scrambling of 64-bit integers."""
    values = (values ^ (values >> np.uint64(30))) * MIX[1]
    values = (values ^ (values >> np.uint64(27))) * MIX[2]
    return values ^ (values >> np.uint64(31))


def shingles(text: bytes) -> np.ndarray:
    """Hashes of the 5-word shingles of a UTF-8 text, in order of place.

    Words are runs without ASCII white space, A to Z lower-cased. A text of fewer words is one
    shingle, a text without words has none.
    """
    words = text.lower().split()
    if not words:
        return np.empty(0, np.uint64)
    hashes = np.fromiter(map(WORDS.__getitem__, words), np.uint64, len(words))
    if len(words) < WIDTH:
        total = (hashes * np.array(FACTORS[: len(words)])).sum(keepdims=True) + np.uint64(len(words))
        return mixed(total)
    count = len(words) - WIDTH + 1
    total = np.full(count, WIDTH, np.uint64)
    for i, factor in enumerate(FACTORS):
        total += hashes[i : i + count] * factor
    return mixed(total)


def shingle_set(text: bytes) -> np.ndarray:
    """The distinct shingles, ascending."""
    return np.unique(shingles(text))
