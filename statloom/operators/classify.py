"""Binary targets: logistic regression from sums per task, and how well scores tell the classes."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statloom.functions.coerce import as_double, quoted
from statloom.operators.ordering import value_positions
from statloom.operators.regression import RANK_TOLERANCE
from statloom.operators.validation import complete_rows
from statloom.session import dealt, store

# Newton steps end when no standardised coefficient moves by more.
SETTLED = 1e-9
# Probabilities are kept this far from 0 and 1 in the log loss.
EDGE = 1e-15


@dataclass(frozen=True)
class LogitFit:
    """Coefficients (constant first), their covariance, and how the search ended."""

    target: str
    features: tuple[str, ...]
    coefficients: tuple[float, ...]
    covariance: np.ndarray
    n: int
    log_likelihood: float
    steps: int
    converged: bool


def _newton_sums(width: int, beta: np.ndarray):
    """A task's log likelihood, gradient and information at ``beta``, one row each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 + width + width * width)
        seen = False
        for batch in batches:
            if not batch.num_rows:
                continue
            seen = True
            columns = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(width)]
            y, x = columns[0], np.column_stack([np.ones(batch.num_rows), *columns[1:]])
            z = x @ beta
            p = 0.5 * (1.0 + np.tanh(0.5 * z))
            total[0] += float(np.sum(y * z - np.logaddexp(0.0, z)))
            total[1:width + 1] += x.T @ (y - p)
            total[width + 1:] += (x.T @ (x * (p * (1.0 - p))[:, None])).ravel()
        if seen:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(len(total), dtype=np.int32)), pa.array(total)], names=["i", "v"])

    return run


def logit_fit(df: DataFrame, target: str, features: Sequence[str], max_steps: int = 50) -> LogitFit:
    """Fit P(target = 1) by maximum likelihood over the rows where target and features are present.

    Newton steps on standardised features: each step is one pass in which tasks hand on one row
    per sum; the driver solves the p x p system. A step that lowers the likelihood is halved.
    Collinear features and constants get the step of least norm. Where features separate the classes
    no maximum exists; the search then ends unconverged after ``max_steps``. Targets must be 0 or 1.
    """
    names = [target, *features]
    rows = complete_rows(df, names)
    stats = rows.agg(F.count(F.lit(1)).alias("n"), F.min(quoted(target)).alias("low"), F.max(quoted(target)).alias("high"),
                     F.sum(F.col(quoted(target)).isin(0.0, 1.0).cast("long")).alias("binary"),
                     *(f(quoted(c)).alias(f"{k}{i}") for i, c in enumerate(features)
                       for k, f in (("m", F.avg), ("s", F.stddev_pop)))).first()
    n, width = stats["n"], len(names)
    if not n:
        raise ValueError("no complete rows to fit")
    if stats["binary"] != n:
        raise ValueError(f"{target} has values other than 0 and 1")
    mean = np.array([stats[f"m{i}"] for i in range(len(features))], float)
    spread = np.array([stats[f"s{i}"] for i in range(len(features))], float)
    unit = np.where(spread > 0, spread, 1.0)
    table = store(dealt(rows.select(F.col(quoted(target)).alias("y"), *(
        ((F.col(quoted(c)) - F.lit(float(m))) / F.lit(float(u))).alias(f"x{i}")
        for i, (c, m, u) in enumerate(zip(features, mean, unit))))), "logit")

    def sums(beta: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        got = table.mapInArrow(_newton_sums(width, beta), "i int, v double").groupBy("i").agg(F.sum("v").alias("v"))
        v = np.zeros(1 + width + width * width)
        for r in got.collect():
            v[r["i"]] = r["v"]
        return float(v[0]), v[1:width + 1], v[width + 1:].reshape(width, width)

    beta = np.zeros(width)
    level, slope, bend = sums(beta)
    steps, converged = 0, False
    while steps < max_steps and not converged:
        step = np.linalg.pinv(bend, rcond=RANK_TOLERANCE, hermitian=True) @ slope
        while True:
            steps += 1
            trial = sums(beta + step)
            # Rounding of a sum over n rows is no fall.
            if trial[0] >= level - 1e-12 * abs(level) or steps >= max_steps:
                break
            step = step / 2.0
        if trial[0] < level - 1e-12 * abs(level):
            break
        beta, (level, slope, bend) = beta + step, trial
        converged = bool(np.abs(step).max() < SETTLED)
    # Back from standardised to given features.
    change = np.eye(width)
    change[1:, 1:] = np.diag(1.0 / unit)
    change[0, 1:] = -mean / unit
    inverse = np.linalg.pinv(bend, rcond=RANK_TOLERANCE, hermitian=True)
    return LogitFit(target, tuple(features), tuple(float(b) for b in change @ beta), change @ inverse @ change.T,
                    n, level, steps, converged)


def logit_table(df: DataFrame, fit: LogitFit) -> DataFrame:
    """Coefficient, standard error, z, p and odds ratio per term; ``df`` only lends its session."""
    rows = []
    for i, (term, b) in enumerate(zip(("const", *fit.features), fit.coefficients)):
        se = math.sqrt(max(0.0, float(fit.covariance[i, i])))
        z = b / se if se > 0 else None
        p = math.erfc(abs(z) / math.sqrt(2.0)) if z is not None else None
        rows.append((term, b, se, z, p, math.exp(b) if b < 700 else math.inf))
    return df.sparkSession.createDataFrame(
        rows, "term string, coef double, std_err double, z double, p double, odds_ratio double")


def probability(fit: LogitFit) -> Column:
    """P(target = 1) as an expression over any table with the features."""
    z = F.lit(fit.coefficients[0])
    for name, b in zip(fit.features, fit.coefficients[1:]):
        z = z + F.col(quoted(name)) * F.lit(b)
    return 1.0 / (1.0 + F.exp(-z))


def class_metrics(df: DataFrame, target: str, score: str, group_cols: Sequence[str] = (), cut: float = 0.5) -> DataFrame:
    """Per group n, positives, auc, log_loss, brier, accuracy, precision and recall of a probability.

    The AUC is exact: equal scores are counted first, and the rows below each score follow from
    running sums over all tasks, so no group is ordered in one task; ties count half. It is null
    where a group has one class only; precision and recall are null without any case. Rows
    without target, score or key take no part; a score equal to ``cut`` is called positive.
    """
    keys = list(group_cols)
    rows = df.select(*(F.col(quoted(k)).alias(k) for k in keys), as_double(df, target).alias("_y"),
                     as_double(df, score).alias("_s")).dropna(subset=[*map(quoted, keys), "_y", "_s"])
    rows = store(rows, "scores")
    y, p = F.col("_y"), F.least(F.greatest(F.col("_s"), F.lit(EDGE)), F.lit(1 - EDGE))
    called = F.col("_s") >= cut
    count = lambda c: F.sum(c.cast("long"))
    hit = count(called & (y == 1))
    plain = rows.groupBy(*map(quoted, keys)).agg(
        F.count(F.lit(1)).alias("n"), count(y == 1).alias("positives"),
        F.avg(-y * F.log(p) - (1 - y) * F.log(1 - p)).alias("log_loss"),
        F.avg((y - F.col("_s")) * (y - F.col("_s"))).alias("brier"),
        F.avg((called == (y == 1)).cast("double")).alias("accuracy"),
        F.try_divide(hit, count(called)).alias("precision"), F.try_divide(hit, count(y == 1)).alias("recall"))
    positions = value_positions(rows, "_s", keys).select(
        *(F.col(quoted(k)).alias(f"_k{i}") for i, k in enumerate(keys)), F.col("_v").alias("_w"),
        "_lower", (F.col("_lower") + F.col("_ties") / 2).alias("_below"))
    counted = rows.groupBy(*map(quoted, keys), "_s").agg(count(y == 1).alias("_ones"))
    # One row per group and score on both sides, so no key can be hot.
    on = F.col("_s") == F.col("_w")
    for i, k in enumerate(keys):
        on = on & (F.col(quoted(k)) == F.col(f"_k{i}"))
    # Positions run on from group to group: a group starts at its lowest.
    area = F.sum(F.col("_ones") * F.col("_below")) - F.sum("_ones") * F.min("_lower")
    beaten = counted.join(positions, on).groupBy(*map(quoted, keys)).agg(area.alias("_area"))
    if keys:
        both = plain.join(beaten, keys, "left")
    else:
        both = plain.withColumn("_area", beaten.scalar())
    pos, neg = F.col("positives"), F.col("n") - F.col("positives")
    auc = F.try_divide(F.col("_area") - pos * pos / 2, pos * neg)
    return both.select(*map(quoted, keys), "n", "positives", auc.alias("auc"), "log_loss", "brier", "accuracy",
                       "precision", "recall")
