"""Polynomial prefix hashes of many texts at once.

With a random number for each byte and an odd base, prefix sums give the hash of
any range in constant time, and ranges of equal bytes have equal hashes wherever
they lie.  Arithmetic is modulo 2**64; callers that need certainty compare bytes.
"""

from __future__ import annotations

import numpy as np

BASE = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers (a bijection)."""
    x = x.astype(np.uint64)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


VALUES = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> list[np.ndarray]:
    """The first ``n`` powers of the base and of its inverse."""
    if len(_powers[0]) < n:
        size = 1 << max(16, int(n - 1).bit_length())
        for k, base in enumerate((BASE, INVERSE)):
            _powers[k] = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(size - 1, base)]))
    return [p[:n] for p in _powers]


class PrefixHashes:
    """Hashes of ranges of one byte array."""

    def __init__(self, data: np.ndarray):
        up, self.down = powers(len(data) + 1)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(VALUES[data] * up[:-1], out=self.sums[1:])

    def ranges(self, start: np.ndarray, size) -> np.ndarray:
        """Hash of ``size`` bytes from each start (not yet spread)."""
        return (self.sums[start + size] - self.sums[start]) * self.down[start]

    def all_of(self, size: int) -> np.ndarray:
        """Hash of the ``size`` bytes from every place on."""
        n = max(0, len(self.sums) - size)
        return (self.sums[size:] - self.sums[:n]) * self.down[:n] if n else np.zeros(0, np.uint64)
