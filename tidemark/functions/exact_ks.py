"""Exact small-sample p-value of the two-sample Kolmogorov-Smirnov distance."""

from __future__ import annotations

import math
import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import functions as F
from pyspark.sql import types as T

# tasks receive these functions by value, so executors need no copy of the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

EXACT_MAX_ROWS = 10_000


def exact_two_sided(distance: float, n: int, m: int) -> float:
    """P(D >= distance) under equal distributions.

    Every ordering of the pooled sample is a lattice path from (0,0) to (n,m), all equally likely.
    ``hit[i]`` is the chance that a random path to (i, j) has touched |i/n - j/m| >= distance; the
    point (i, j) is entered from (i-1, j) with chance i/(i+j), else from (i, j-1). Working with the
    chance of touching (not of staying inside) only ever adds positive terms, so small p keep their
    digits. One numpy pass per anti-diagonal.
    """
    step = math.gcd(n, m)
    scale = n // step * m
    reach = round(distance * scale)
    if reach <= 0:
        return 1.0
    a, b = m // step, n // step
    hit = np.zeros(n + 1)
    for d in range(1, n + m + 1):
        low, high = max(0, d - m), min(n, d)
        i = np.arange(low, high + 1)
        stay = hit[low : high + 1]
        prev = np.where(i > 0, hit[np.maximum(i - 1, 0)], 0.0)
        share = i / d
        fresh = share * prev + (1.0 - share) * stay
        fresh[np.abs(i * a - (d - i) * b) >= reach] = 1.0
        hit[low : high + 1] = fresh
    return float(min(1.0, max(0.0, hit[n])))


@F.pandas_udf(T.DoubleType())
def exact_p_value(distance: pd.Series, n: pd.Series, m: pd.Series) -> pd.Series:
    """Column form; meant for the one-row-per-feature result, NULL beyond the exact range."""

    def one(d: float, a: float, b: float) -> float | None:
        if pd.isna(d) or pd.isna(a) or pd.isna(b) or a < 1 or b < 1 or max(a, b) > EXACT_MAX_ROWS:
            return None
        return exact_two_sided(float(d), int(a), int(b))

    return pd.Series([one(*row) for row in zip(distance, n, m)], dtype="float64")
