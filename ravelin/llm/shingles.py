"""Hashes of word shingles, for many texts at once."""

from __future__ import annotations

import re
from functools import lru_cache

import numpy as np
import xxhash

WIDTH = 5
CACHE_WORDS = 100_000

_EDGE = re.compile(r"^[\W_]+|[\W_]+$")
_STEP = np.uint64(0x9E3779B97F4A7C15)


class WordHashes(dict):
    """Word to a 64-bit hash of it in lower case and without signs at its ends; forgets all beyond a bound."""

    def __missing__(self, word: str) -> int:
        if len(self) > CACHE_WORDS:
            self.clear()
        bare = _EDGE.sub("", word).lower() or word
        value = self[word] = xxhash.xxh3_64_intdigest(bare.encode("utf-8", "surrogatepass"))
        return value


@lru_cache(maxsize=1)
def _hashes() -> WordHashes:
    return WordHashes()


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(texts: list[str], width: int = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """All shingle hashes in text order, and their number for each text.

    A text of fewer words than `width` has one shingle, of all its words; a text without words has none.
    """
    known, parts = _hashes(), []
    for text in texts:
        words = text.split()
        parts.append(np.fromiter(map(known.__getitem__, words), dtype=np.uint64, count=len(words)))
    lengths = np.array([len(p) for p in parts], dtype=np.int64)
    word = np.concatenate([*parts, np.zeros(width - 1, dtype=np.uint64)])
    starts = np.cumsum(lengths) - lengths
    total = int(lengths.sum())
    rolled, powers = np.zeros(total, dtype=np.uint64), np.uint64(1)
    inside = np.repeat(starts + lengths, lengths) - np.arange(total)  # words from here to the text's end
    with np.errstate(over="ignore"):
        for k in range(width):
            rolled += np.where(inside > k, word[k : k + total], np.uint64(0)) * powers
            powers = powers * _STEP
        rolled = mix(rolled)
    at = np.arange(total) - np.repeat(starts, lengths)
    kept = (inside >= width) | (at == 0)
    sizes = np.where(lengths >= width, lengths - width + 1, np.minimum(lengths, 1))
    return rolled[kept], sizes
