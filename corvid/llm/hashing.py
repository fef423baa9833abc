"""Vectorised 64-bit hashes of slices of byte and word sequences.

Running sums of value times base to the power of its position give the hash
of any slice in constant time, so all words, grams and windows of a block are
hashed without a Python loop.
"""

from __future__ import annotations

import numpy as np

from corvid.llm.common import mix64

BYTE_BASE = 0x9E3779B97F4A7C15


def powers(base: int, size: int) -> np.ndarray:
    """base ** i modulo 2 ** 64, for i < size; not kept, so that a worker
    holds none once a block is done."""
    steps = np.full(max(size, 1), base, np.uint64)
    steps[0] = 1
    return np.multiply.accumulate(steps, out=steps)


def prefix_sums(values: np.ndarray, base: int) -> np.ndarray:
    """Sums from which the hash of any slice follows in constant time."""
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * powers(base, len(values))[:len(values)], out=out[1:])
    return out


def slice_hashes(prefix: np.ndarray, base: int, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    inverse = powers(pow(base, -1, 1 << 64), len(prefix))
    return mix64((prefix[end] - prefix[start]) * inverse[start])


BYTE_VALUES = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(BYTE_BASE))


def word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of the byte slices start..end of ``data``."""
    if not len(start):
        return np.zeros(0, np.uint64)
    sums = prefix_sums(BYTE_VALUES[data], BYTE_BASE)
    return mix64(slice_hashes(sums, BYTE_BASE, start, end) + (end - start).astype(np.uint64))
