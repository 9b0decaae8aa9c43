"""Ordinary least squares from one pass of pair moments."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from statloom.functions.coerce import as_double
from statloom.operators.associate import pair_moments
from statloom.operators.ordering import POSITION_BITS, sorted_once

# Directions with less than this share of the largest spread count as collinear.
RANK_TOLERANCE = 1e-12
# Above this many degrees of freedom a tail is the limit's with its first correction term,
# whose error is of the order of the square of their inverse.
SERIES_DF = 1e6


@dataclass(frozen=True)
class OlsFit:
    """Coefficients (constant first) and what the summary needs; all p x p or smaller."""

    target: str
    features: tuple[str, ...]
    coefficients: tuple[float, ...]
    n: int
    rank: int
    ss_residual: float
    ss_total: float
    inverse_gram: np.ndarray
    condition_number: float

    @property
    def terms(self) -> tuple[str, ...]:
        return ("const", *self.features)


def _complete(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.dropna(subset=list(columns)).select(*(as_double(df, c).alias(c) for c in columns))


def ols_fit(df: DataFrame, target: str, features: Sequence[str]) -> OlsFit:
    """Fit target ~ constant + features over the rows where all are present.

    One scan gives the covariances; the driver solves the p x p system. Collinear
    features get the solution of least norm.
    """
    names = [*features, target]
    p = len(features)
    rows = pair_moments(_complete(df, names), names, diagonal=True).collect()
    if not rows:
        raise ValueError("no complete rows to fit")
    n = rows[0]["n"]
    scatter, mean = np.zeros((p + 1, p + 1)), np.zeros(p + 1)
    for r in rows:
        scatter[r["i"], r["j"]] = scatter[r["j"], r["i"]] = r["cov"] * n
        mean[r["i"]], mean[r["j"]] = r["mean_i"], r["mean_j"]
    return fit_moments(target, features, n, mean, scatter)


def fit_moments(target: str, features: Sequence[str], n: int, mean: np.ndarray, scatter: np.ndarray) -> OlsFit:
    """The fit from n rows' means and squares about them, of the features and, last, the target."""
    p = len(features)
    sxx, sxy, syy = scatter[:p, :p], scatter[:p, p], float(scatter[p, p])
    m, y_mean = mean[:p], float(mean[p])

    # Solve on the correlation scale, dropping directions without spread.
    scale = np.sqrt(np.diag(sxx))
    unit = np.where(scale > 0, scale, 1.0)
    values, vectors = np.linalg.eigh(sxx / np.outer(unit, unit))
    live = values > RANK_TOLERANCE * max(1.0, float(values.max(initial=0.0)))
    basis = vectors[:, live] / unit[:, None]
    inner = basis @ np.diag(1.0 / values[live]) @ basis.T
    slopes = inner @ sxy
    beta = np.concatenate([[y_mean - m @ slopes], slopes])
    top = -m @ inner
    gram_inverse = np.block([[np.array([[1.0 / n + m @ inner @ m]]), top[None, :]],
                             [top[:, None], inner]])
    if not live.all():
        null = vectors[:, ~live] / unit[:, None]
        q, _ = np.linalg.qr(np.vstack([-(m @ null)[None, :], null]))
        keep = np.eye(p + 1) - q @ q.T
        beta, gram_inverse = keep @ beta, keep @ gram_inverse @ keep

    gram = np.block([[np.array([[float(n)]]), n * m[None, :]],
                     [n * m[:, None], sxx + n * np.outer(m, m)]])
    spectrum = np.linalg.eigvalsh(gram)
    smallest = float(spectrum[0])
    return OlsFit(
        target=target,
        features=tuple(features),
        coefficients=tuple(float(b) for b in beta),
        n=n,
        rank=int(live.sum()) + 1,
        ss_residual=max(0.0, syy - float(slopes @ sxy)),
        ss_total=syy,
        inverse_gram=gram_inverse,
        condition_number=math.sqrt(spectrum[-1] / smallest) if smallest > 0 else math.inf,
    )


def predict(fit: OlsFit) -> Column:
    """The fitted value as an expression over any table with the features."""
    value = F.lit(fit.coefficients[0])
    for name, b in zip(fit.features, fit.coefficients[1:]):
        value = value + F.col(name) * F.lit(b)
    return value


def ols_predict(df: DataFrame, fit: OlsFit) -> DataFrame:
    """Add prediction and absolute error to every row."""
    predicted = df.withColumn("predicted", predict(fit))
    return predicted.withColumn("abs_error", F.abs(F.col(fit.target) - F.col("predicted")))


# --- summary ---------------------------------------------------------------------


def coefficient_table(df: DataFrame, fit: OlsFit, level: float = 0.95) -> DataFrame:
    """Coefficient, standard error, t, p and confidence limits per term."""
    freedom = fit.n - fit.rank
    # The residuals themselves, as in the summary: a difference of sums cancels near R2 = 1.
    variance = residual_moments(df, fit)["ss"] / freedom
    errors = np.sqrt(np.maximum(0.0, np.diag(fit.inverse_gram)) * variance)
    reach = t_quantile(1.0 - level, freedom)
    rows = []
    for term, b, se in zip(fit.terms, fit.coefficients, map(float, errors)):
        t = b / se if se > 0 else None
        p = t_tails(t, freedom) if t is not None else None
        rows.append((term, b, se, t, p, b - reach * se, b + reach * se))
    schema = "term string, coef double, std_err double, t double, p double, ci_low double, ci_high double"
    return df.sparkSession.createDataFrame(rows, schema)


def residual_moments(df: DataFrame, fit: OlsFit) -> dict:
    """Sum of squares, skewness and kurtosis of the residuals, in one pass."""
    rows = _complete(df, [*fit.features, fit.target])
    e = rows.select((F.col(fit.target) - predict(fit)).alias("e"))
    spread = F.stddev_pop("e") > 0
    return e.agg(
        F.sum(F.col("e") * F.col("e")).alias("ss"),
        F.when(spread, F.skewness("e")).alias("skew"),
        F.when(spread, F.kurtosis("e")).alias("excess"),
    ).first().asDict()


def durbin_watson(df: DataFrame, fit: OlsFit, order_cols: Sequence[str]) -> DataFrame:
    """Squared steps between neighbouring residuals over their squares.

    Neighbours meet inside the sorted partitions; the step into a partition comes from
    the last residual before it, one small row per partition.
    """
    complete = df.dropna(subset=[*fit.features, fit.target])
    e = (F.col(fit.target) - predict(fit)).alias("e")
    marked = sorted_once(complete.select(*order_cols, e), order_cols).select("e", "_at")
    part = F.shiftright("_at", POSITION_BITS).alias("_part")
    before = F.lag("e").over(Window.partitionBy("_part").orderBy("_at"))
    steps = marked.select("e", "_at", part).withColumn("step", F.col("e") - before)
    parts = steps.groupBy("_part").agg(
        F.sum(F.coalesce(F.col("step") ** 2, F.lit(0.0))).alias("steps"), F.sum(F.col("e") ** 2).alias("squares"),
        F.min_by("e", "_at").alias("first"), F.max_by("e", "_at").alias("last"),
    )
    entry = F.col("first") - F.lag("last").over(Window.orderBy("_part"))
    joined = parts.select("squares", (F.col("steps") + F.coalesce(entry**2, F.lit(0.0))).alias("steps"))
    return joined.agg(F.try_divide(F.sum("steps"), F.sum("squares")).alias("durbin_watson"))


def ols_summary(df: DataFrame, fit: OlsFit, order_cols: Sequence[str]) -> DataFrame:
    """One row of fit statistics and residual diagnostics."""
    n, p = float(fit.n), fit.rank - 1
    freedom = n - fit.rank
    shape = residual_moments(df, fit)
    ss = shape["ss"]
    r2 = 1.0 - ss / fit.ss_total if fit.ss_total > 0 else None
    f = ((fit.ss_total - ss) / p) / (ss / freedom) if p and ss > 0 else None
    likelihood = -n / 2.0 * (math.log(2.0 * math.pi) + math.log(ss / n) + 1.0) if ss > 0 else None
    skew, excess = shape["skew"], shape["excess"]
    omnibus = jarque_bera = None
    if skew is not None:
        omnibus = skew_score(skew, n) ** 2 + kurtosis_score(excess + 3.0, n) ** 2 if n >= 8 else None
        jarque_bera = n / 6.0 * (skew**2 + excess**2 / 4.0)
    values = {
        "n": float(n),
        "df_model": float(p),
        "df_resid": float(freedom),
        "r2": r2,
        "adj_r2": None if r2 is None else 1.0 - (1.0 - r2) * (n - 1.0) / freedom,
        "f": f,
        "f_p": None if f is None else f_tail(f, p, freedom),
        "log_likelihood": likelihood,
        "aic": None if likelihood is None else -2.0 * likelihood + 2.0 * fit.rank,
        "bic": None if likelihood is None else -2.0 * likelihood + math.log(n) * fit.rank,
        "omnibus": omnibus,
        "omnibus_p": None if omnibus is None else math.exp(-omnibus / 2.0),
        "skew": skew,
        "kurtosis": None if excess is None else excess + 3.0,
        "jarque_bera": jarque_bera,
        "jarque_bera_p": None if jarque_bera is None else math.exp(-jarque_bera / 2.0),
        "condition_number": fit.condition_number,
    }
    watson = durbin_watson(df, fit, order_cols)
    return watson.select(*(F.lit(v).cast("double").alias(k) for k, v in values.items()), "durbin_watson")


# --- tails of scalar statistics --------------------------------------------------


def beta_share(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta function by its continued fraction, from the far end."""
    if x <= 0.0 or x >= 1.0:
        return min(1.0, max(0.0, x))
    if x > (a + 1.0) / (a + b + 2.0):
        return 1.0 - beta_share(b, a, 1.0 - x)
    log_front = (
        math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b)
        + a * math.log(x) + b * math.log1p(-x)
    )
    fraction = 1.0
    for m in range(100 + int(3.0 * math.sqrt(max(a, b))), 0, -1):
        even = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        odd = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        fraction = 1.0 + even / (1.0 + odd / fraction)
    first = -(a + b) * x / (a + 1.0)
    return math.exp(log_front) / (a * (1.0 + first / fraction))


def gamma_tail(a: float, x: float) -> float:
    """Upper regularised incomplete gamma function, by series or continued fraction."""
    if x <= 0.0:
        return 1.0
    front = math.exp(a * math.log(x) - x - math.lgamma(a))
    if x < a + 1.0:
        term = total = 1.0 / a
        n = a
        while term > total * 1e-17:
            n += 1.0
            term *= x / n
            total += term
        return max(0.0, 1.0 - front * total)
    fraction = 0.0
    for m in range(200 + int(4.0 * math.sqrt(a)), 0, -1):
        fraction = m * (a - m) / (x + 2 * m + 1 - a + fraction)
    return front / (x + 1.0 - a + fraction)


def t_tails(t: float, freedom: float) -> float:
    """Two-sided p-value of a t statistic."""
    if freedom > SERIES_DF:
        return f_tail(t * t, 1.0, freedom)
    return beta_share(freedom / 2.0, 0.5, freedom / (freedom + t * t))


def f_tail(f: float, d1: float, d2: float) -> float:
    """Upper p-value of an F statistic."""
    if f <= 0.0:
        return 1.0
    if d2 > SERIES_DF:
        # d1 F is a chi-square over a mean of d2 squares, whose variance is 2 / d2.
        a, x = d1 / 2.0, d1 * f
        density = math.exp((a - 1.0) * math.log(x) - x / 2.0 - a * math.log(2.0) - math.lgamma(a))
        bend = -density * ((a - 1.0) / x - 0.5)
        return min(1.0, max(0.0, gamma_tail(a, x / 2.0) + x * x * bend / d2))
    return beta_share(d2 / 2.0, d1 / 2.0, d2 / (d2 + d1 * f))


def t_quantile(two_sided: float, freedom: float) -> float:
    """The |t| that a two-sided p-value belongs to, by bisection."""
    low, high = 0.0, 1.0
    while t_tails(high, freedom) > two_sided:
        high *= 2.0
    for _ in range(80):
        mid = (low + high) / 2.0
        low, high = (mid, high) if t_tails(mid, freedom) > two_sided else (low, mid)
    return (low + high) / 2.0


def skew_score(g1: float, n: float) -> float:
    """Normal score of a sample skewness (D'Agostino 1970)."""
    y = g1 * math.sqrt((n + 1) * (n + 3) / (6.0 * (n - 2)))
    b2 = 3.0 * (n * n + 27 * n - 70) * (n + 1) * (n + 3) / ((n - 2) * (n + 5) * (n + 7) * (n + 9))
    w2 = math.sqrt(2.0 * (b2 - 1.0)) - 1.0
    return math.asinh(y / math.sqrt(2.0 / (w2 - 1.0))) / math.sqrt(0.5 * math.log(w2))


def kurtosis_score(b2: float, n: float) -> float:
    """Normal score of a sample kurtosis (Anscombe and Glynn 1983)."""
    expected = 3.0 * (n - 1) / (n + 1)
    variance = 24.0 * n * (n - 2) * (n - 3) / ((n + 1) ** 2 * (n + 3) * (n + 5))
    x = (b2 - expected) / math.sqrt(variance)
    root = (
        6.0 * (n * n - 5 * n + 2) / ((n + 7) * (n + 9))
        * math.sqrt(6.0 * (n + 3) * (n + 5) / (n * (n - 2) * (n - 3)))
    )
    a = 6.0 + 8.0 / root * (2.0 / root + math.sqrt(1.0 + 4.0 / (root * root)))
    ratio = (1.0 - 2.0 / a) / (1.0 + x * math.sqrt(2.0 / (a - 4.0)))
    return (1.0 - 2.0 / (9.0 * a) - math.cbrt(ratio)) / math.sqrt(2.0 / (9.0 * a))
