"""The JVM's xxhash64 of bigint columns, vectorised, so both sides of the Python boundary hash alike."""

from __future__ import annotations

import numpy as np

# The five primes of XXH64.
P1, P2, P3, P4, P5 = (np.uint64(x) for x in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))


def _rotl(x: np.ndarray, r: int) -> np.ndarray:
    return (x << np.uint64(r)) | (x >> np.uint64(64 - r))


def xxhash64_longs(*columns: np.ndarray | int) -> np.ndarray:
    """``F.xxhash64`` of bigint columns (int64 arrays or whole numbers)."""
    with np.errstate(over="ignore"):
        seed = np.uint64(42)
        for c in columns:
            x = np.asarray(c, dtype=np.int64).view(np.uint64)
            h = seed + P5 + np.uint64(8)
            h = h ^ (_rotl(x * P2, 31) * P1)
            h = _rotl(h, 27) * P1 + P4
            h = (h ^ (h >> np.uint64(33))) * P2
            h = (h ^ (h >> np.uint64(29))) * P3
            seed = h ^ (h >> np.uint64(32))
        return np.asarray(seed).view(np.int64)
