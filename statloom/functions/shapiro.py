"""The Shapiro-Wilk statistic of one bounded sample (Royston 1995, AS R94)."""

from __future__ import annotations

import math
import sys
from collections.abc import Sequence
from statistics import NormalDist

import numpy as np
from pyspark import cloudpickle

# Workers get this module's functions with the job, so they need no install.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Royston's polynomials (1995, AS R94), lowest power first.
LAST_WEIGHT = (0.0, 0.221157, -0.147981, -2.071190, 4.434685, -2.706056)
NEXT_WEIGHT = (0.0, 0.042981, -0.293762, -1.752461, 5.682633, -3.582633)
LARGE_MEAN = (-1.5861, -0.31082, -0.083751, 0.0038915)
LARGE_LOG_STD = (-0.4803, -0.082676, 0.0030302)
SMALL_MEAN = (0.5440, -0.39978, 0.025054, -0.0006714)
SMALL_LOG_STD = (1.3822, -0.77857, 0.062767, -0.0020322)
SMALL_LIMIT = (-2.273, 0.459)
LARGE_FROM = 12


def _poly(coefficients: Sequence[float], x: float) -> float:
    return sum(c * x**k for k, c in enumerate(coefficients))


def _weights(n: int) -> np.ndarray:
    """Approximate Shapiro-Wilk weights of the ordered sample of size n."""
    if n == 3:
        return np.array([-math.sqrt(0.5), 0.0, math.sqrt(0.5)])
    quantile = NormalDist().inv_cdf
    m = np.array([quantile((i - 0.375) / (n + 0.25)) for i in range(1, n + 1)])
    size, u = float(m @ m), 1.0 / math.sqrt(n)
    # The outermost weights are fitted by polynomials, the others proportional to m.
    outer = [m[-1] / math.sqrt(size) + _poly(LAST_WEIGHT, u)]
    if n > 5:
        outer.append(m[-2] / math.sqrt(size) + _poly(NEXT_WEIGHT, u))
    k = len(outer)
    rest = size - 2.0 * float(m[n - k :] @ m[n - k :])
    a = m / math.sqrt(rest / (1.0 - 2.0 * sum(w * w for w in outer)))
    for place, w in enumerate(outer):
        a[n - 1 - place], a[place] = w, -w
    return a


def shapiro_wilk(sample: Sequence[float]) -> tuple[float, float]:
    """(W, p) of one sample of 3 to 5000 values; NaN below 3 values or without spread."""
    x = np.sort(np.asarray(sample, dtype=float))
    n = len(x)
    if n < 3 or x[0] == x[-1]:
        return math.nan, math.nan
    x = x - np.median(x)
    centred = x - x.mean()
    w = min(1.0, float(_weights(n) @ x) ** 2 / float(centred @ centred))
    if n == 3:
        p = 6.0 / math.pi * (math.asin(math.sqrt(w)) - math.asin(math.sqrt(0.75)))
        return w, min(1.0, max(0.0, p))
    if w >= 1.0:
        return w, 1.0
    y = math.log1p(-w)
    if n >= LARGE_FROM:
        log_n = math.log(n)
        mean, std = _poly(LARGE_MEAN, log_n), math.exp(_poly(LARGE_LOG_STD, log_n))
    else:
        limit = _poly(SMALL_LIMIT, n)
        if y >= limit:
            return w, 0.0
        y = -math.log(limit - y)
        mean, std = _poly(SMALL_MEAN, n), math.exp(_poly(SMALL_LOG_STD, n))
    return w, 0.5 * math.erfc((y - mean) / std / math.sqrt(2.0))
