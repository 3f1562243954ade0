"""Words, shingles and MinHash signatures of texts, vectorised per Arrow batch.

A word is an unbroken run of Unicode letters or digits of the lower-cased text; a shingle is a run of consecutive words.
"""

from __future__ import annotations

import re

import numpy as np
import xxhash
from pyspark.sql import Column

WORD = re.compile(r"[^\W_]+")
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


class WordHashes(dict):
    """word -> 64-bit hash; emptied when it holds `most` words, so that an open vocabulary can't fill memory."""

    def __init__(self, most: int = 1_000_000):
        super().__init__()
        self.most = most

    def __missing__(self, word: str) -> int:
        if len(self) >= self.most:
            self.clear()
        self[word] = value = xxhash.xxh3_64_intdigest(word)
        return value


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix), so that linear combinations of hashes spread over all bits."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def word_hashes(text: str, memo: WordHashes) -> np.ndarray:
    words = WORD.findall(text.lower())
    return np.fromiter(map(memo.__getitem__, words), dtype=np.uint64, count=len(words))


def shingles(h: np.ndarray, width: int) -> np.ndarray:
    """Hashes of the runs of `width` words, repeats included; empty where there are fewer words."""
    n = len(h) - width + 1
    if n <= 0:
        return h[:0]
    out = h[:n].copy()
    for k in range(1, width):
        out = out * _A + h[k : k + n] + _B
    return mix(out)


def text_key(h: np.ndarray) -> int:
    """Signed 64-bit key of the sequence of words: texts with equal words in equal order share it."""
    return int(np.int64(np.uint64(xxhash.xxh3_64_intdigest(h.tobytes())).astype(np.int64)))


def lowest(h: Column, share: Column) -> Column:
    """Whether a 64-bit hash is among that share of the lowest of all 2**64: a sample whose size does not depend on the number of rows it is drawn from."""
    return h.cast("double") < (share * float(2**64) - float(2**63))
