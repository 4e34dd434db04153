"""A keyed permutation of 0 .. n-1 that needs no sort: any place, and any place's inverse, at once."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql.functions import pandas_udf

ROUNDS = 6


def _hash(x: np.ndarray, key: int) -> np.ndarray:
    x = (x.astype(np.uint64) + np.uint64(key)) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _keys(seed: int, epoch: int) -> list[int]:
    return [int(k) for k in _hash(np.arange(ROUNDS), (seed * 0x5851F42D4C957F2D + epoch * 0x14057B7EF767814F + 1) % 2**64)]


def permuted(x: np.ndarray, n: int, seed: int, epoch: int, inverse: bool = False) -> np.ndarray:
    """The Feistel network over a * b >= n numbers as (high, low) of a and b values; whatever leaves 0 .. n-1 goes through it
    again, which few do, as a * b - n < b."""
    b = max(math.isqrt(max(n - 1, 0)) + 1, 1)
    a = -(-n // b) if n else 1
    out, go = x.astype(np.int64).copy(), np.arange(len(x))
    keys = list(enumerate(_keys(seed, epoch)))
    while len(go):
        high, low = out[go] // b, out[go] % b
        for k, key in reversed(keys) if inverse else keys:
            side, other, m = (high, low, a) if k % 2 else (low, high, b)
            step = (_hash(other, key) % np.uint64(m)).astype(np.int64)
            moved = (side - step if inverse else side + step) % m
            high, low = (moved, low) if k % 2 else (high, moved)
        out[go] = high * b + low
        go = go[out[go] >= n]
    return out


def window_at(place: Column | str, n: int, seed: int, epoch: int) -> Column:
    """The window that stands at a place of an epoch."""
    return pandas_udf(lambda x: pd.Series(permuted(x.to_numpy(), n, seed, epoch)), "long")(place)


def place_of(window: Column | str, n: int, seed: int, epoch: int) -> Column:
    """The place of a window in an epoch."""
    return pandas_udf(lambda x: pd.Series(permuted(x.to_numpy(), n, seed, epoch, True)), "long")(window)
