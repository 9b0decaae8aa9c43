"""Maximum-likelihood lambdas of the power transforms.

A search round is one pass over a stored column: every task evaluates a whole grid of
lambdas on its own rows, and hands on one row of sums per lambda. The driver sees one
variance per lambda.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statloom.functions.coerce import as_double
from statloom.functions.columns import all_non_negative, all_positive
from statloom.session import store

GRID = 33
START = (-2.0, 2.0)
# A grid this fine is finished by the vertex of a parabola.
FINE_STEP = 1e-3
# An optimum is sought as far as the loss stays finite, at most this far from 0.
FARTHEST = 1e9


def value_range(df: DataFrame, value: str) -> dict:
    """Count, extremes, mean, spread and sign gates of a column, in one pass."""
    v = df.select(as_double(df, value).alias("v"))
    row = v.agg(
        F.count("v").alias("n"),
        F.min("v").alias("min"),
        F.max("v").alias("max"),
        F.avg("v").alias("mean"),
        F.stddev_samp("v").alias("std"),
        all_positive("v").alias("all_positive"),
        all_non_negative("v").alias("all_non_negative"),
    )
    return row.first().asDict()


def _grid(low: float, high: float) -> list[float]:
    step = (high - low) / (GRID - 1)
    # Rounding keeps 0 and the other grid points free of float dust.
    return [round(low + i * step, 12) for i in range(GRID)]


def _vertex(x: Sequence[float], y: Sequence[float]) -> float:
    """Lowest point of the parabola through three evenly spaced points."""
    curve = y[0] - 2.0 * y[1] + y[2]
    return x[1] if curve <= 0 else x[1] + (x[1] - x[0]) * 0.5 * (y[0] - y[2]) / curve


def _search(losses: Callable[[Sequence[float]], list[float]]) -> float:
    low, high = START
    while True:
        points = _grid(low, high)
        found = losses(points)
        best = min(range(GRID), key=lambda i: found[i])
        step = (high - low) / (GRID - 1)
        if best in (0, GRID - 1) and math.isfinite(found[best]) and max(-low, high) < FARTHEST:
            # The optimum lies outside: move on with a wider range from this edge.
            span = 2.0 * (high - low)
            edge = points[best]
            low, high = (edge - span, edge + step) if best == 0 else (edge - step, edge + span)
        elif best in (0, GRID - 1) or not math.isfinite(found[best]):
            raise ValueError("no lambda maximises the likelihood of this column")
        elif step <= FINE_STEP:
            return _vertex(points[best - 1 : best + 2], found[best - 1 : best + 2])
        else:
            low, high = points[best] - step, points[best] + step


def _power(s: np.ndarray, lam: np.ndarray) -> np.ndarray:
    """(v**lam - 1) / lam of values given by their logs ``s``."""
    return np.where(lam == 0, s, np.expm1(s * lam) / np.where(lam == 0, 1.0, lam))


def _signed_power(s: np.ndarray, lam: np.ndarray) -> np.ndarray:
    """The Yeo-Johnson transform of values given by their signed log1p ``s``."""
    return np.where(s >= 0, _power(np.maximum(s, 0.0), lam), -_power(np.maximum(-s, 0.0), 2.0 - lam))


def _grid_sums(lambdas: Sequence[float], power, centre: float):
    """Per task and lambda: rows, sums of transformed values about a common point and of their squares."""
    lam = np.array(lambdas)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, slope, sums, squares = 0, 0.0, np.zeros(len(lam)), np.zeros(len(lam))
        with np.errstate(over="ignore", invalid="ignore"):
            point = power(np.array([[centre]]), lam[None, :])
            for batch in batches:
                s = batch.column("s").to_numpy(zero_copy_only=False)
                y = power(s[:, None], lam[None, :]) - point
                n, slope = n + len(s), slope + s.sum()
                sums += y.sum(axis=0)
                squares += np.einsum("ij,ij->j", y, y)
        if n:
            yield pa.RecordBatch.from_arrays(
                [pa.array(lam), pa.array(np.full(len(lam), n)), pa.array(np.full(len(lam), slope)), pa.array(sums), pa.array(squares)],
                names=["lambda", "n", "slope", "a", "q"])

    return run


def _grid_moments(logs: DataFrame, lambdas: Sequence[float], power, centre: float) -> DataFrame:
    """Count, variance and log sum per lambda: one row per task and lambda is shuffled."""
    grid = [float(x) for x in lambdas]
    parts = logs.mapInArrow(_grid_sums(grid, power, centre), "lambda double, n long, slope double, a double, q double")
    total = parts.groupBy("lambda").agg(*(F.sum(c).alias(c) for c in ("n", "slope", "a", "q")))
    mean = F.col("a") / F.col("n")
    return total.select("lambda", "n", (F.col("q") / F.col("n") - mean * mean).alias("variance"), "slope")


def _fit(logs: DataFrame, power, slope: float) -> float:
    """Minimise ln Var(y) / 2 - lambda * slope over a stored one-column table with the mean ``slope``."""

    def losses(lambdas: Sequence[float]) -> list[float]:
        rows = _grid_moments(logs, lambdas, power, slope).select("lambda", "variance").collect()
        variance = {r["lambda"]: r["variance"] for r in rows}
        return [
            0.5 * math.log(v) - lam * slope if v and v > 0 and math.isfinite(v) else math.inf
            for lam, v in ((lam, variance.get(lam)) for lam in lambdas)
        ]

    return _search(losses)


def box_cox_fit(df: DataFrame, value: str, known: dict | None = None) -> float:
    """The Box-Cox lambda; raises unless all values are positive and not all equal.

    Works on logs centred at their mean. Dividing by the geometric mean makes the
    likelihood a function of the transformed variance alone, and avoids overflow.
    """
    known = known or value_range(df, value)
    if not known["all_positive"]:
        raise ValueError("Box-Cox needs positive values only")
    if known["min"] == known["max"]:
        raise ValueError("Box-Cox needs values that are not all equal")
    logs = store(df.select(F.log(as_double(df, value)).alias("s")).dropna(), "logs")
    centre = logs.agg(F.avg("s")).first()[0]
    centred = logs.select((F.col("s") - F.lit(centre)).alias("s"))
    return _fit(centred, _power, 0.0)


def yeo_johnson_fit(df: DataFrame, value: str, known: dict | None = None) -> float:
    """The Yeo-Johnson lambda for values of any sign; raises when all are equal."""
    known = known or value_range(df, value)
    if known["n"] == 0 or known["min"] == known["max"]:
        raise ValueError("Yeo-Johnson needs values that are not all equal")
    v = as_double(df, value)
    signed = df.select((F.signum(v) * F.log1p(F.abs(v))).alias("s")).dropna()
    signed = store(signed, "logs")
    slope = signed.agg(F.avg("s")).first()[0]

    return _fit(signed, _signed_power, slope)


def likelihood_grid(
    df: DataFrame, value: str, lambdas: Sequence[float], signed: bool = False
) -> DataFrame:
    """Log-likelihood of each given lambda, Box-Cox or (``signed``) Yeo-Johnson."""
    v = as_double(df, value)
    log_value = F.signum(v) * F.log1p(F.abs(v)) if signed else F.log(v)
    logs = df.select(log_value.alias("s")).dropna()
    centre = logs.agg(F.avg("s")).first()[0] or 0.0
    moments = _grid_moments(logs, lambdas, _signed_power if signed else _power, centre)
    likelihood = (F.col("lambda") - 1.0) * F.col("slope") - F.col("n") / 2.0 * F.log("variance")
    return moments.select("lambda", likelihood.alias("log_likelihood"))
