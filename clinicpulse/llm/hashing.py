"""Vectorised 64-bit hashes of words and shingles, equal on every machine and in every process."""

from __future__ import annotations

import numpy as np

# The six bytes that part words: space, and tab to carriage return.
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[32, *range(9, 14)]] = True
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_BYTE_VALUES = np.random.Generator(np.random.PCG64(11)).integers(1, 1 << 63, 256, dtype=np.uint64)
_STEPS = np.random.Generator(np.random.PCG64(12)).integers(1, 1 << 63, 64, dtype=np.uint64) | np.uint64(1)


class _Powers:
    """Powers of the base and of its inverse modulo 2**64, grown to the longest text seen."""

    def __init__(self) -> None:
        self.up = np.ones(1, dtype=np.uint64)
        self.down = np.ones(1, dtype=np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = 1 << max(16, (n - 1).bit_length())
            self.up = np.cumprod(np.r_[np.uint64(1), np.full(size - 1, _BASE, dtype=np.uint64)], dtype=np.uint64)
            self.down = np.cumprod(np.r_[np.uint64(1), np.full(size - 1, _INVERSE, dtype=np.uint64)], dtype=np.uint64)
        return self.up[:n], self.down[:n]


_powers = _Powers()


def mix(x: np.ndarray) -> np.ndarray:
    """The finishing steps of splitmix64."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_spans(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs without ASCII white space in a byte array."""
    inside = np.r_[False, ~_SPACE[data], False]
    turns = np.flatnonzero(inside[1:] != inside[:-1])
    return turns[::2], turns[1::2]


def word_hashes(text: bytes) -> np.ndarray:
    """One hash per word of a UTF-8 text, A-Z lower-cased; empty without words."""
    data = np.frombuffer(text.lower(), dtype=np.uint8)
    starts, ends = word_spans(data)
    if not len(starts):
        return np.empty(0, dtype=np.uint64)
    up, down = _powers.upto(len(data))
    sums = np.r_[np.uint64(0), np.cumsum(_BYTE_VALUES[data] * up, dtype=np.uint64)]
    return mix((sums[ends] - sums[starts]) * down[starts])


def shingles(words: np.ndarray, width: int) -> np.ndarray:
    """A hash for each run of ``width`` words, in order; fewer words make one shingle, none make none."""
    if not len(words):
        return words
    n = len(words) - width + 1
    if n < 1:
        return mix((words * _STEPS[: len(words)]).sum(dtype=np.uint64, keepdims=True) + np.uint64(len(words)))
    total = words[:n] * _STEPS[0]
    for i in range(1, width):
        total = total + words[i : n + i] * _STEPS[i]
    return mix(total + np.uint64(width))


def shingle_set(text: bytes | None, width: int) -> np.ndarray:
    """The sorted distinct shingles of a text."""
    return np.unique(shingles(word_hashes(text), width)) if text else np.empty(0, dtype=np.uint64)
