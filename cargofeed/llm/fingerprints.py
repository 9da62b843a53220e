"""Polynomial fingerprints of byte ranges, for numpy: modulo 2^64, and modulo a prime."""

from __future__ import annotations

import numpy as np

_RNG = np.random.default_rng(20240607)
_CODE = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_BACK = pow(_BASE, -1, 1 << 64)
_POWERS: list[np.ndarray] = []


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective finaliser: every input bit reaches every output bit."""
    x = x.astype(np.uint64)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _POWERS or len(_POWERS[0]) < n:
        size = 1 << max(16, (n - 1).bit_length())
        _POWERS[:] = [np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(size - 1, b, np.uint64)]))
                      for b in (_BASE, _BACK)]
    return _POWERS[0][:n], _POWERS[1][:n]


class Ranges:
    """Fingerprints of any ``[start, end)`` of a buffer, from prefix sums."""

    def __init__(self, buf: np.ndarray):
        n = len(buf)
        up, self.down = _powers(n + 1)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(_CODE[buf] * up[:n], out=self.sums[1:])

    def raw(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (self.sums[end] - self.sums[start]) * self.down[start]

    def get(self, start: np.ndarray, end: np.ndarray, salt: int = 0) -> np.ndarray:
        """Mixed fingerprint of content and length."""
        size = (np.asarray(end) - np.asarray(start)).astype(np.uint64)
        return mix(self.raw(start, end) ^ (size * np.uint64(0xD6E8FEB86659FD93)) ^ np.uint64(salt))


#: The largest prime below 2^32: products of two residues fit 64 bits.
_PRIME = np.uint64(4294967291)
_PRIME_CODE = _RNG.integers(1, int(_PRIME), 256, dtype=np.uint64)
_PRIME_BASE = 2654435761
_PRIME_POWERS: list[np.ndarray] = []


def _prime_powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _PRIME_POWERS or len(_PRIME_POWERS[0]) < n:
        size = 1 << max(16, (n - 1).bit_length())
        found = []
        for base in (_PRIME_BASE, pow(_PRIME_BASE, -1, int(_PRIME))):
            out = np.ones(1, np.uint64)
            while len(out) < size:
                out = np.concatenate([out, out * np.uint64(pow(base, len(out), int(_PRIME))) % _PRIME])
            found.append(out)
        _PRIME_POWERS[:] = found
    return _PRIME_POWERS[0][:n], _PRIME_POWERS[1][:n]


class PrimeRanges:
    """32-bit fingerprints of ranges in a prime field: independent of those modulo 2^64, and without their weak words."""

    def __init__(self, buf: np.ndarray):
        n = len(buf)
        up, self.down = _prime_powers(n + 1)
        self.sums = np.zeros(n + 1, np.uint64)  # sums of 2^32 residues fit
        np.cumsum(_PRIME_CODE[buf] * up[:n] % _PRIME, out=self.sums[1:])

    def get(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return ((self.sums[end] - self.sums[start]) % _PRIME * self.down[start] % _PRIME).astype(np.uint32)
