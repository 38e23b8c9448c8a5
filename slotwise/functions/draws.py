"""Random numbers that depend on a row's key only, not on where or when the row is read."""

from __future__ import annotations

import sys

import numpy as np
from pyspark import cloudpickle

# The helpers below travel with the tasks, so that executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def uniform(key: np.ndarray, *salt: int) -> np.ndarray:
    """Numbers in (0, 1) for 64-bit keys, other ones for every salt."""
    x = key.astype(np.int64).view(np.uint64)
    with np.errstate(over="ignore"):
        for s in salt:
            x = (x ^ np.uint64(s + 1)) * np.uint64(0x9E3779B97F4A7C15)
            x ^= x >> np.uint64(29)
            x = x * np.uint64(0xBF58476D1CE4E5B9)
            x ^= x >> np.uint64(32)
    return ((x >> np.uint64(11)).astype(float) + 0.5) / float(1 << 53)
