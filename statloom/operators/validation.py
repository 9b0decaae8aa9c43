"""Is a regression to be trusted: cross-validation, collinearity, spread and shape of its residuals."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statloom.functions.coerce import as_double, quoted
from statloom.operators.associate import pair_moments
from statloom.operators.ordering import value_positions
from statloom.operators.regression import OlsFit, f_tail, fit_moments, gamma_tail, ols_fit, predict

# A feature that others explain but for this share has no variance of its own.
EXACT = 1e-10
# Weights of an exact dependency below this share of its largest are rounding.
NAMED = 1e-6
# P-value of Anderson and Darling's statistic with estimated mean and variance
# (D'Agostino and Stephens 1986): upper limit of the adjusted statistic, then the polynomial of
# the exponent; the first two give the complement.
ANDERSON = [
    (0.2, (-13.436, 101.14, -223.73), True),
    (0.34, (-8.318, 42.796, -59.938), True),
    (0.6, (0.9177, -4.279, -1.38), False),
    (math.inf, (1.2937, -5.709, 0.0186), False),
]


def complete_rows(df: DataFrame, columns: Sequence[str], *more: Column) -> DataFrame:
    """The named columns as doubles where none is missing; NaN is missing."""
    rows = df.select(*more, *(as_double(df, c).alias(c) for c in dict.fromkeys(columns)))
    return rows.dropna(subset=[quoted(c) for c in columns])


# --- cross-validation --------------------------------------------------------------


def _fold_products(width: int):
    """Per fold the sums of products of all columns of a task, as one matrix product each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            fold = batch.column(0).to_numpy(zero_copy_only=False)
            x = np.column_stack([np.ones(batch.num_rows), *(
                batch.column(i).to_numpy(zero_copy_only=False) for i in range(1, batch.num_columns))])
            for f in np.unique(fold):
                part = x[fold == f]
                sums[int(f)] = sums.get(int(f), 0.0) + part.T @ part
        i, j = np.triu_indices(width)
        for f, m in sums.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(i), f, np.int32)), pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)),
                 pa.array(m[i, j])], names=["fold", "i", "j", "v"])

    return run


def fold_fits(df: DataFrame, target: str, features: Sequence[str], fold: Column) -> dict[int, OlsFit]:
    """For every fold the fit to the rows of all others, from one pass over the table.

    Each task multiplies matrices per fold, on columns about their common means; a fold's fit
    comes from the total less its own products. Only p x p matrices per fold reach the driver.
    """
    names = [*features, target]
    rows = complete_rows(df, names, fold.cast("int").alias("_fold")).filter(F.col("_fold").isNotNull())
    centre = rows.agg(*(F.avg(quoted(c)).alias(f"m{i}") for i, c in enumerate(names))).first()
    if centre[0] is None:
        raise ValueError("no complete rows to fit")
    centred = rows.select("_fold", *((F.col(quoted(c)) - F.lit(m)).alias(f"x{i}") for i, (c, m) in enumerate(zip(names, centre))))
    width = len(names) + 1
    sums = centred.mapInArrow(_fold_products(width), "fold int, i int, j int, v double")
    found: dict[int, np.ndarray] = {}
    for r in sums.groupBy("fold", "i", "j").agg(F.sum("v").alias("v")).collect():
        m = found.setdefault(r["fold"], np.zeros((width, width)))
        m[r["i"], r["j"]] = m[r["j"], r["i"]] = r["v"]
    total = sum(found.values())
    fits = {}
    for f in sorted(found):
        rest = total - found[f]
        n = round(rest[0, 0])
        if n < 1:
            raise ValueError(f"no rows outside fold {f}")
        shift = rest[0, 1:] / n
        fits[f] = fit_moments(target, features, n, np.array(centre) + shift, rest[1:, 1:] - n * np.outer(shift, shift))
    return fits


def cross_validate(df: DataFrame, target: str, features: Sequence[str], fold: Column,
                   back: Callable[[Column], Column] | None = None) -> DataFrame:
    """(fold, n, r2, rmse, mae) of every fold's rows under the fit to the others.

    ``back`` undoes a transform of the target, so that models of different targets compare on
    the same scale. Rows with a missing value or fold take no part. R2 is about the mean of the
    fold's own rows, and null where they do not vary.
    """
    fits = fold_fits(df, target, features, fold)
    rows = complete_rows(df, [*features, target], fold.cast("int").alias("_fold"))
    fitted = F.coalesce(*(F.when(F.col("_fold") == f, predict(fit)) for f, fit in fits.items()))
    change = back or (lambda c: c)
    pairs = rows.filter(F.col("_fold").isNotNull()).select(
        F.col("_fold").alias("fold"), change(F.col(quoted(target))).alias("y"), change(fitted).alias("p"))
    e = F.col("y") - F.col("p")
    return pairs.groupBy("fold").agg(
        F.count(F.lit(1)).alias("n"),
        (1 - F.try_divide(F.avg(e * e), F.var_pop("y"))).alias("r2"),
        F.sqrt(F.avg(e * e)).alias("rmse"), F.avg(F.abs(e)).alias("mae"))


# --- collinearity ------------------------------------------------------------------


def vif(df: DataFrame, features: Sequence[str], limit: float = 10.0) -> DataFrame:
    """(variable, tolerance, vif, high, depends_on) from one pass of pair moments.

    1 / (1 - R2) of every feature on all others. A feature that the others give exactly has no
    factor; ``depends_on`` names them, smallest set of the least-norm solution, or says
    constant. High is a factor above ``limit`` or none.
    """
    names, p = list(features), len(features)
    moments = pair_moments(complete_rows(df, names), names, diagonal=True).collect()
    r = np.eye(p)
    still = np.ones(p, bool)
    for m in moments:
        i, j = m["i"], m["j"]
        spread = m["std_i"] * m["std_j"]
        if i == j:
            still[i] = spread == 0
        elif spread > 0:
            r[i, j] = r[j, i] = m["cov"] / spread
    rows = []
    for k, name in enumerate(names):
        if still[k]:
            rows.append((name, None, None, True, "constant"))
            continue
        others = [i for i in range(p) if i != k and not still[i]]
        values, vectors = np.linalg.eigh(r[np.ix_(others, others)])
        live = values > EXACT * max(1.0, values.max(initial=0.0))
        weights = vectors[:, live] @ ((vectors[:, live].T @ r[others, k]) / values[live])
        own = 1.0 - float(r[others, k] @ weights)
        if own > EXACT:
            rows.append((name, own, 1.0 / own, 1.0 / own > limit, None))
        else:
            named = [names[i] for i, w in zip(others, weights) if abs(w) > NAMED * np.abs(weights).max()]
            rows.append((name, 0.0, None, True, " + ".join(sorted(named))))
    schema = "variable string, tolerance double, vif double, high boolean, depends_on string"
    return df.sparkSession.createDataFrame(rows, schema)


# --- spread of the residuals -------------------------------------------------------


def _residuals(df: DataFrame, fit: OlsFit, *more: Column) -> DataFrame:
    rows = complete_rows(df, [*fit.features, fit.target])
    return rows.select(*(F.col(quoted(c)) for c in fit.features), (F.col(quoted(fit.target)) - predict(fit)).alias("_e"), *more)


def _lagrange(rows: DataFrame, name: str, regressors: Sequence[str]) -> DataFrame:
    """LM = n R2 of the squared residuals on the regressors, with its chi-square and F tails."""
    scale = rows.agg(F.avg(F.col("_e") * F.col("_e")).alias("s")).first()["s"]
    # On the scale of the residuals' variance; it changes no R2.
    unit = scale if scale else 1.0
    second = ols_fit(rows.withColumn("_e2", F.col("_e") * F.col("_e") / F.lit(unit)), "_e2", regressors)
    r2 = 1.0 - second.ss_residual / second.ss_total if second.ss_total > 0 else None
    df, rest = second.rank - 1, second.n - second.rank
    lm = f = None
    if r2 is not None and df:
        lm = second.n * r2
        f = (r2 / df) / ((1.0 - r2) / rest) if rest > 0 and r2 < 1.0 else None
    row = (name, second.n, df, lm, None if lm is None else gamma_tail(df / 2.0, lm / 2.0),
           f, None if f is None else f_tail(f, float(df), float(rest)))
    return rows.sparkSession.createDataFrame([row], "test string, n long, df int, lm double, p double, f double, f_p double")


def breusch_pagan(df: DataFrame, fit: OlsFit) -> DataFrame:
    """Do the squared residuals follow the features? Koenker's form, robust to their shape."""
    return _lagrange(_residuals(df, fit), "Breusch-Pagan", fit.features)


def white(df: DataFrame, fit: OlsFit) -> DataFrame:
    """Do the squared residuals follow the features, their squares or products?

    Columns that repeat others, as the square of a flag, cost no degree of freedom. Features
    are taken about their means first, which spans the same space with better numbers.
    """
    rows = _residuals(df, fit)
    stats = rows.agg(*(f(quoted(c)).alias(f"{k}{i}") for i, c in enumerate(fit.features)
                       for k, f in (("m", F.avg), ("s", F.stddev_pop)))).first()
    z = [(F.col(quoted(c)) - F.lit(stats[f"m{i}"])) / F.lit(stats[f"s{i}"] or 1.0) for i, c in enumerate(fit.features)]
    made = {f"_z{i}": c for i, c in enumerate(z)}
    made |= {f"_z{i}_{j}": z[i] * z[j] for i in range(len(z)) for j in range(i, len(z))}
    return _lagrange(rows.select("_e", *(c.alias(n) for n, c in made.items())), "White", list(made))


# --- shape of the residuals --------------------------------------------------------


def log_tail(z: float) -> float:
    """Logarithm of the normal distribution's lower tail, also far out."""
    if z > -37.0:
        return math.log(0.5 * math.erfc(-z / math.sqrt(2.0)))
    return -0.5 * z * z - math.log(-z * math.sqrt(2.0 * math.pi)) - 1.0 / (z * z)


def _log_tails(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        z = batch.column("z").to_pylist()
        yield pa.RecordBatch.from_arrays(
            [pa.array([log_tail(x) for x in z], pa.float64()), pa.array([log_tail(-x) for x in z], pa.float64()),
             batch.column("up"), batch.column("down")], names=["below", "above", "up", "down"])


def anderson_p(statistic: float, n: int) -> float:
    """p-value of A2 for a sample whose mean and variance were estimated."""
    a = statistic * (1.0 + 0.75 / n + 2.25 / (n * n))
    if a > 200.0:
        return 0.0
    for limit, (c0, c1, c2), complement in ANDERSON:
        if a < limit:
            p = math.exp(c0 + c1 * a + c2 * a * a)
            return min(1.0, max(0.0, 1.0 - p if complement else p))
    return 0.0


def anderson_darling(df: DataFrame, value: str, alpha: float = 0.05) -> DataFrame:
    """(n, mean, std, a2, p, normal): is a column of any length normally distributed?

    Unlike Shapiro's test this one takes all rows. Equal values are counted, the counts sorted
    over all tasks, and a value's weight follows from the rows below it, so neither a window
    over the table nor a sample is needed. Missing values take no part; fewer than 8 rows or a
    constant column give nulls.
    """
    rows = complete_rows(df, [value]).select(F.col(quoted(value)).alias("_x"))
    n, mean, std = rows.agg(F.count("_x"), F.avg("_x"), F.stddev_samp("_x")).first()
    a2 = None
    if n >= 8 and std > 1e-13 * abs(mean):
        positions = value_positions(rows, "_x", [])
        low, ties = F.col("_lower").cast("double"), F.col("_ties").cast("double")
        # Sums of 2i - 1 over the places of a value, counted from below and from above.
        from_above = F.lit(float(n)) - low
        parts = positions.select(
            ((F.col("_v") - F.lit(mean)) / F.lit(std)).alias("z"), (ties * (2 * low + ties)).alias("up"),
            (ties * (2 * from_above - ties)).alias("down"))
        tails = parts.mapInArrow(_log_tails, "below double, above double, up double, down double")
        n2 = F.lit(float(n) * n)
        share = tails.agg(F.sum((F.col("up") * F.col("below") + F.col("down") * F.col("above")) / n2).alias("s")).first()["s"]
        a2 = -n - n * share
    p = None if a2 is None else anderson_p(a2, n)
    row = (n, mean, std, a2, p, None if p is None else p > alpha)
    return df.sparkSession.createDataFrame([row], "n long, mean double, std double, a2 double, p double, normal boolean")


def residual_normality(df: DataFrame, fit: OlsFit, alpha: float = 0.05) -> DataFrame:
    """Anderson and Darling's test of all residuals."""
    return anderson_darling(_residuals(df, fit), "_e", alpha)
