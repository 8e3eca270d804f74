"""Rolling 64-bit hashes of byte ranges, in numpy.

A range's hash is a polynomial in an odd base modulo 2**64 over random values of its bytes, so
one prefix sum gives the hash of any range; ``mixed`` spreads it before it is compared by size.
"""

from __future__ import annotations

import numpy as np

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_VALUES = np.random.default_rng(20240131).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The base's powers 0 to n - 1 at least, and their inverses."""
    if len(_powers[0]) < n:
        size = max(n, 1 << 16)
        for k, base in enumerate((_BASE, _INVERSE)):
            each = np.full(size, base, np.uint64)
            each[0] = 1
            _powers[k] = np.cumprod(each)
    return _powers[0], _powers[1]


def mixed(x: np.ndarray, salt: int = 0) -> np.ndarray:
    x = x ^ np.uint64(salt & 0xFFFFFFFFFFFFFFFF)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


class Rolling:
    """Hashes of ranges of ``values``: bytes, or 64-bit hashes of words."""

    def __init__(self, values: np.ndarray):
        terms = _VALUES[values] if values.dtype == np.uint8 else values
        up, self._down = powers(len(values) + 1)
        self._sums = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(terms * up[: len(values)], out=self._sums[1:])

    def ranges(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return (self._sums[ends] - self._sums[starts]) * self._down[starts]

    def windows(self, length: int) -> np.ndarray:
        """Of every window of ``length`` values, by its start."""
        n = len(self._sums) - length
        if n <= 0:
            return np.zeros(0, np.uint64)
        return (self._sums[length:] - self._sums[:n]) * self._down[:n]


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """The least of x[i : i + width] for each i at which that window fits."""
    n = len(x) - width + 1
    if n <= 0:
        return x[:0]
    size = -(-len(x) // width) * width
    padded = np.full(size, np.iinfo(x.dtype).max, x.dtype)
    padded[: len(x)] = x
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1 : width - 1 + n])


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)
