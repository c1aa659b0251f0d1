"""64-bit hashes of words, vectorised and the same on every worker."""

from __future__ import annotations

import numpy as np

ROOT = np.uint64(0x9E3779B97F4A7C15)
_STEP = np.uint64(0xD6E8FEB86659FD93)
_HALF = np.uint64(32)


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ x >> _HALF) * _STEP
    x = (x ^ x >> _HALF) * _STEP
    return x ^ x >> _HALF


def spelled(code: np.ndarray, size: np.ndarray) -> np.ndarray:
    """A mixed polynomial of each word's characters: the words, none empty,
    follow one another in ``code``."""
    start = np.cumsum(size) - size
    powers = np.cumprod(np.full(int(size.max()), ROOT))
    within = np.arange(len(code)) - np.repeat(start, size)
    return mix(np.add.reduceat((code.astype("u8") + np.uint64(1)) * powers[within], start))


def word_hashes(words: list[str]) -> np.ndarray:
    code = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), "<u4")
    return spelled(code, np.fromiter(map(len, words), "i8", len(words)))
