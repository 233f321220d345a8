"""Polynomial prefix hashes of bytes modulo 2**64, for whole blocks at once."""

from __future__ import annotations

import numpy as np

from cairnlake.llm.common import mix64

BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(BASE, -1, 1 << 64)

#: A random-looking 64-bit value for each byte, so that bytes of one block never cancel by small differences.
BYTE_VALUES = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))

_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i for i up to n at least."""
    if len(_powers[0]) <= n:
        size = max(n + 1, 1 << 16)
        for k, base in enumerate((BASE, _INVERSE)):
            out = np.full(size, base & (2**64 - 1), np.uint64)
            out[0] = 1
            _powers[k] = np.multiply.accumulate(out)
    return _powers[0], _powers[1]


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """P with P[i] the hash of the first i bytes."""
    up, _ = powers(len(data))
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(BYTE_VALUES[data] * up[: len(data)], out=out[1:])
    return out


def range_hash(prefix: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """The hash of the bytes [start, stop), equal wherever those bytes stand."""
    _, down = powers(len(prefix))
    return (prefix[stop] - prefix[start]) * down[start]
