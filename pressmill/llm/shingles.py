"""Word shingles of whole texts as 64-bit numbers, in numpy.

Words are ``[^\\x20\\x09-\\x0D]+`` after lower-casing A-Z. Two shingles count as the same when
their 64-bit mixes agree.
"""

from __future__ import annotations

import numpy as np
import xxhash

WIDTH = 5
_STEP = np.array(
    [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F],
    dtype=np.uint64,
)


def word_hashes(text: str | None) -> np.ndarray:
    return hashes_of((text or "").encode("utf-8", "replace").lower().split())


def hashes_of(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(32))


def shingles(words: np.ndarray, width: int = WIDTH) -> np.ndarray:
    """Shingle at every place; with fewer words than ``width``, the whole as one."""
    if not len(words):
        return words
    size = min(width, len(words))
    places = len(words) - size + 1
    out = np.full(places, size, dtype=np.uint64)
    for k in range(size):
        out += mixed(words[k : k + places] + _STEP[k])
    return mixed(out)


def shingle_set(text: str | None) -> np.ndarray:
    """Sorted distinct shingles."""
    return np.unique(shingles(word_hashes(text)))
