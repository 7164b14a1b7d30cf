"""Polynomial hashes of byte strings, as differences of running sums modulo 2**64."""

from __future__ import annotations

from functools import lru_cache

import numpy as np

BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)


@lru_cache(maxsize=1)
def _powers(bits: int) -> tuple[np.ndarray, np.ndarray]:
    found = []
    for base in (BASE, INVERSE):
        factors = np.full(1 << bits, base, "u8")
        factors[0] = 1
        found.append(np.multiply.accumulate(factors))
    return found[0], found[1]


def powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """At least ``size`` + 1 powers of the base and of its inverse."""
    return _powers(max(17, int(size).bit_length()))


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))
