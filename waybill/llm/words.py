"""Words and their hashes, the same for every operator that compares word sequences.

A word is a run of bytes other than space and 0x09 to 0x0D, which is exactly how
``bytes.split()`` cuts.
"""

from __future__ import annotations

import contextlib
import ctypes

import numpy as np
import pyarrow as pa
import xxhash

CACHED = 100_000  # words remembered by one Python worker


class WordHashes(dict):
    """word -> 64-bit hash, remembered; forgets everything when it has CACHED words."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHED:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


_HASHES = WordHashes()


def hand_back() -> None:
    """Memory that earlier batches freed goes back to the system.

    Python workers live on when their stage is over, and several share an executor
    with its JVM.
    """
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def raw_texts(column: pa.Array | pa.ChunkedArray) -> list[bytes]:
    """The texts as UTF-8; null is the empty text."""
    return [t or b"" for t in column.cast(pa.binary()).to_pylist()]


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All words' hashes in order, and where each text's words begin (one more entry than texts)."""
    get = _HASHES.__getitem__
    parts, ends = [], np.zeros(len(texts) + 1, np.int64)
    for i, text in enumerate(texts):
        words = text.split()
        parts.append(np.fromiter(map(get, words), np.uint64, len(words)))
        ends[i + 1] = ends[i] + len(words)
    return (np.concatenate(parts) if parts else np.zeros(0, np.uint64)), ends


MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def scrambled(x: np.ndarray) -> np.ndarray:
    """A bijection that spreads polynomial hashes over all 64 bits (splitmix64's finish)."""
    x = x.copy()
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def rolling(hashes: np.ndarray, n: int) -> np.ndarray:
    """Rabin-Karp hash, modulo 2**64, of every run of ``n`` entries (those across texts too)."""
    count = len(hashes) - n + 1
    if count <= 0:
        return np.zeros(0, np.uint64)
    total = hashes[:count].copy()
    for k in range(1, n):
        total *= MULTIPLIER
        total += hashes[k:k + count]
    return scrambled(total)


def inside(ends: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts of the runs of ``n`` that stay in one text, and each one's text."""
    counts = np.maximum(np.diff(ends) - n + 1, 0)
    owner = np.repeat(np.arange(len(counts)), counts)
    first = np.repeat(ends[:-1] - (np.cumsum(counts) - counts), counts)
    return first + np.arange(counts.sum()), owner
