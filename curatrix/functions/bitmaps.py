"""Compressed bitmaps over integer codes: per 65 536 codes a sorted array, a run list or a plain bitmap, whichever is least."""

from __future__ import annotations

import numpy as np

CONTAINER = 1 << 16


def compress(low: np.ndarray) -> tuple[str, np.ndarray]:
    """low: sorted distinct uint16 codes of one container."""
    starts = np.flatnonzero(np.diff(low.astype(np.int32), prepend=-2) != 1)
    if len(starts) * 4 < min(len(low) * 2, CONTAINER // 8):
        ends = np.append(starts[1:], len(low)) - 1
        return "run", np.stack([low[starts], low[ends]])
    if len(low) * 2 <= CONTAINER // 8:
        return "array", low.astype(np.uint16)
    bits = np.zeros(CONTAINER, np.uint8)
    bits[low] = 1
    return "bits", np.packbits(bits)


def expand(container: tuple[str, np.ndarray]) -> np.ndarray:
    """The container's codes, sorted."""
    kind, data = container
    if kind == "array":
        return data
    if kind == "run":
        return np.concatenate([np.arange(int(a), int(b) + 1, dtype=np.uint32) for a, b in data.T]).astype(np.uint16)
    return np.flatnonzero(np.unpackbits(data)).astype(np.uint16)


def build(codes: np.ndarray) -> dict[int, tuple[str, np.ndarray]]:
    """A compressed bitmap of non-negative integer codes, in any order and with repeats."""
    codes = np.unique(np.asarray(codes, np.int64))
    high = codes // CONTAINER
    cuts = np.flatnonzero(np.diff(high)) + 1
    return {int(part[0] // CONTAINER): compress((part % CONTAINER).astype(np.uint16)) for part in np.split(codes, cuts) if len(part)}


def and_not(a: dict, b: dict) -> dict:
    """The codes of a that are not in b."""
    out = {}
    for high, mine in a.items():
        other = b.get(high)
        if other is None:
            out[high] = mine
            continue
        if mine[0] == other[0] == "bits":
            left = np.flatnonzero(np.unpackbits(mine[1] & ~other[1])).astype(np.uint16)
        else:
            left = np.setdiff1d(expand(mine), expand(other), assume_unique=True)
        if len(left):
            out[high] = compress(left)
    return out


def codes_of(bitmap: dict) -> np.ndarray:
    """All codes, sorted."""
    parts = [high * CONTAINER + expand(bitmap[high]).astype(np.int64) for high in sorted(bitmap)]
    return np.concatenate(parts) if parts else np.empty(0, np.int64)
