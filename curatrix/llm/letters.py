"""Texts as arrays of code points, and hashes of their runs that are alike wherever a run stands."""

from __future__ import annotations

import functools
import re

import numpy as np

_BASE, _MIX = 0x9E3779B97F4A7C15, np.uint64(0xBF58476D1CE4E5B9)


@functools.lru_cache(8)
def table_of(pattern: str) -> np.ndarray:
    """By code point, whether the pattern (of one character and more, repeated) takes it."""
    table = np.zeros(0x110000, bool)
    for found in re.finditer(pattern, "".join(map(chr, range(0x110000)))):
        table[found.start() : found.end()] = True
    return table


@functools.lru_cache(4)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The powers of the base and of its inverse, 0 to n - 1."""
    made = []
    for base in (_BASE, pow(_BASE, -1, 1 << 64)):
        factors = np.full(n, base, np.uint64)
        factors[0] = 1
        made.append(np.cumprod(factors, dtype=np.uint64))
    return made[0], made[1]


def codes_of(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def prefixes(letters: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of all beginnings, and what brings the difference of two of them back to position 0."""
    up, down = _powers(1 << int(len(letters)).bit_length())
    total = np.zeros(len(letters) + 1, np.uint64)
    np.cumsum(letters.astype(np.uint64) * up[: len(letters)], out=total[1:])
    return total, down


def mixed(h: np.ndarray) -> np.ndarray:
    """32 bits of each hash."""
    return ((h ^ (h >> np.uint64(31))) * _MIX) >> np.uint64(32)


def range_hashes(letters: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of 32 bits of the letters from starts to ends, alike wherever they stand."""
    total, down = prefixes(letters)
    return mixed((total[ends] - total[starts]) * down[starts])
