"""Hashes of a text's word runs."""

from __future__ import annotations

import numpy as np
import xxhash

SEED = 42
#: Odd 64-bit multipliers of a published mixing function.
FIRST, SECOND = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mixed(x: np.ndarray) -> np.ndarray:
    """A one-to-one mixing of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * FIRST
    x = (x ^ (x >> np.uint64(27))) * SECOND
    return x ^ (x >> np.uint64(31))


def run_hashes(text: bytes | None, width: int) -> np.ndarray:
    """64-bit hashes of all runs of `width` words of a text in UTF-8, in order, A-Z lower-cased; of all its words, if they are fewer.

    Words are what ASCII white space parts. A run's hash is a sum of its words' XXH64, each times an odd number of its place.
    """
    words = (text or b"").lower().split()  # of bytes: ASCII letters and ASCII white space only
    if not words:
        return np.zeros(0, np.uint64)
    digest = xxhash.xxh64_intdigest
    own = np.fromiter((digest(w, SEED) for w in words), np.uint64, len(words))
    width = min(width, len(own))
    places = mixed(np.arange(1, width + 1, dtype=np.uint64)) | np.uint64(1)
    runs = own[: len(own) - width + 1] * places[0]
    for k in range(1, width):
        runs += own[k : k + len(runs)] * places[k]
    return mixed(runs)
