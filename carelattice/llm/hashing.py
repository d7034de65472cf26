"""Vectorised 64-bit hashing of words, for code inside Arrow tasks."""

from __future__ import annotations

import numpy as np
import xxhash

MIX_A, MIX_B = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
#: Distinct words a task remembers before it starts anew; bounds the memory of a worker.
REMEMBERED = 400_000


class WordHashes(dict):
    """Word (bytes) to its xxhash64; forgets everything when it grows too large."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective finaliser with good avalanche."""
    x = (x ^ (x >> np.uint64(30))) * MIX_A
    x = (x ^ (x >> np.uint64(27))) * MIX_B
    return x ^ (x >> np.uint64(31))


def constants(n: int, seed: int) -> np.ndarray:
    """``n`` odd 64-bit constants."""
    with np.errstate(over="ignore"):
        return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed)) | np.uint64(1)


def windows(hashes: np.ndarray, width: int, seed: int = 1) -> np.ndarray:
    """Hash of every window of ``width`` neighbours, in order."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    odd = constants(width, seed)
    total = np.zeros(n, np.uint64)
    for k in range(width):
        total += hashes[k : k + n] * odd[k]
    return mix(total)
