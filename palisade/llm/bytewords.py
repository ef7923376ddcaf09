"""Words of many texts at once, found and hashed as byte arrays."""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np

_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def table(*ranges: tuple[int, int]) -> np.ndarray:
    """Which of the 256 byte values lie in one of the ranges, ends included."""
    out = np.zeros(256, bool)
    for low, high in ranges:
        out[low : high + 1] = True
    return out


FOLD = np.arange(256, dtype=np.uint8)
FOLD[0x41:0x5B] += 32  # A-Z
NOT_SPACE = ~table((0x20, 0x20), (0x09, 0x0D))
ALPHANUMERIC = ~table((0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F))
_VALUE = np.random.default_rng(20240607).integers(1, 1 << 63, 256, dtype=np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values evenly (the finaliser of a common 64-bit hash)."""
    x = (x ^ (x >> np.uint64(30))) * _MIX[0]
    x = (x ^ (x >> np.uint64(27))) * _MIX[1]
    return x ^ (x >> np.uint64(31))


@lru_cache(maxsize=4)
def _powers(n: int, base: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        steps = np.full(n, base, np.uint64)
        steps[:1] = 1
        return np.multiply.accumulate(steps)


def powers(n: int, base: int) -> np.ndarray:
    return _powers(1 << max(16, (n - 1).bit_length()), base)[:n]


@dataclass
class Words:
    """Word i is ``data[start[i]:end[i]]`` of text ``text[i]``; ``first`` gives each text's first word."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    text: np.ndarray
    first: np.ndarray  # one more than there are texts


def words(texts: list[bytes], is_word: np.ndarray) -> Words:
    """The words of texts, A-Z lower-cased; ``hash`` is a 64-bit hash of a word's bytes and length."""
    data = FOLD[np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)]
    inside = is_word[data]
    edge = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    if inside[0]:
        edge = np.concatenate(([0], edge))
    start, end = edge[0::2], edge[1::2]
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_VALUE[data] * powers(len(data), _BASE_INVERSE), out=total[1:])
    value = (total[end] - total[start]) * powers(len(data), _BASE)[start]
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    begins = np.concatenate(([0], np.cumsum(sizes + 1)))
    first = np.searchsorted(start, begins)
    text = np.repeat(np.arange(len(texts)), np.diff(first))
    return Words(data, start, end, mix(value + (end - start).astype(np.uint64)), text, first)
