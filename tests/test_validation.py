"""Cross-validation, collinearity and residual tests against numpy and plain loops."""

import math
from statistics import NormalDist

import numpy as np
import pytest
from pyspark.sql import functions as F

from statloom.operators.regression import gamma_tail, ols_fit
from statloom.operators.validation import (
    anderson_darling, anderson_p, breusch_pagan, cross_validate, fold_fits, log_tail, residual_normality, vif, white,
)

P = 18


@pytest.fixture(scope="module")
def data():
    r = np.random.default_rng(11)
    x = r.normal(size=(400, P)) * r.uniform(0.1, 50, P) + r.uniform(-1e4, 1e4, P)
    x[:, 5] = 2 * x[:, 3] - x[:, 4] + 7  # an exact dependency
    x[:, 6] = 3.0  # a constant
    y = x[:, 0] * 2 - x[:, 1] + r.normal(size=400) * (1 + np.abs(x[:, 0] - x[:, 0].mean()))
    return x, y, np.arange(400) % 5


@pytest.fixture(scope="module")
def table(spark, data):
    x, y, fold = data
    rows = [(*map(float, a), float(b), int(f)) for a, b, f in zip(x, y, fold)]
    rows += [(None, *[1.0] * P, 0), (float("nan"), *[1.0] * P, 1), (*[1.0] * (P + 1), None)]
    schema = ", ".join([*(f"x{i} double" for i in range(P)), "y double", "fold int"])
    return spark.createDataFrame(rows, schema).repartition(7)


NAMES = [f"x{i}" for i in range(P)]


def fitted(x, y, at):
    design = np.column_stack([np.ones(len(x)), x - x.mean(axis=0)])
    beta = np.linalg.lstsq(design, y, rcond=1e-10)[0]
    return np.column_stack([np.ones(len(at)), at - x.mean(axis=0)]) @ beta


def test_every_fold_is_fitted_to_the_others(table, data):
    x, y, fold = data
    got = {r["fold"]: r for r in cross_validate(table, "y", NAMES, F.col("fold")).collect()}
    assert sorted(got) == [0, 1, 2, 3, 4]
    for f, r in got.items():
        e = y[fold == f] - fitted(x[fold != f], y[fold != f], x[fold == f])
        assert r["n"] == (fold == f).sum()
        assert r["rmse"] == pytest.approx(math.sqrt((e**2).mean()), rel=1e-6)
        assert r["mae"] == pytest.approx(np.abs(e).mean(), rel=1e-6)
        assert r["r2"] == pytest.approx(1 - (e**2).mean() / y[fold == f].var(), abs=1e-7)


def test_fold_fits_equal_fits_of_filtered_tables(table):
    fits = fold_fits(table, "y", NAMES[:3], F.col("fold"))
    for f, fit in fits.items():
        own = ols_fit(table.filter(F.col("fold") != f), "y", NAMES[:3])
        assert fit.n == own.n and fit.coefficients == pytest.approx(own.coefficients, rel=1e-7)


def test_metrics_on_the_scale_of_the_target(spark):
    rows = [(float(i), math.exp(0.1 * i), i % 2) for i in range(1, 40)]
    df = spark.createDataFrame(rows, "x double, y double, f int").withColumn("ly", F.log("y"))
    direct = cross_validate(df, "ly", ["x"], F.col("f"), back=F.exp).collect()
    assert all(r["r2"] > 0.999999 for r in direct)
    assert all(r["r2"] < 0.9 for r in cross_validate(df, "y", ["x"], F.col("f")).collect())


def test_one_fold_alone_is_an_error(spark):
    df = spark.createDataFrame([(1.0, 2.0, 0), (2.0, 3.0, 0)], "x double, y double, f int")
    with pytest.raises(ValueError, match="no rows outside fold 0"):
        fold_fits(df, "y", ["x"], F.col("f"))
    with pytest.raises(ValueError, match="no complete rows"):
        fold_fits(df.limit(0), "y", ["x"], F.col("f"))


def test_inflation_factors_and_named_dependencies(table, data):
    x = data[0]
    got = {r["variable"]: r for r in vif(table.filter("fold IS NOT NULL"), NAMES).collect()}
    free = [i for i in range(P) if i not in (3, 4, 5, 6)]
    for i in free:
        others = [j for j in range(P) if j not in (i, 5, 6)]
        e = x[:, i] - fitted(x[:, others], x[:, i], x[:, others])
        assert got[f"x{i}"]["vif"] == pytest.approx(x[:, i].var() / (e**2).mean(), rel=1e-6)
        assert not got[f"x{i}"]["high"] and got[f"x{i}"]["depends_on"] is None
    assert got["x5"]["depends_on"] == "x3 + x4" and got["x3"]["depends_on"] == "x4 + x5"
    assert got["x5"]["vif"] is None and got["x5"]["high"]
    assert got["x6"]["depends_on"] == "constant"


def plain_lm(e, z):
    e2 = e**2
    left = e2 - fitted(z, e2, z)
    return len(e) * (1 - (left**2).sum() / ((e2 - e2.mean()) ** 2).sum())


def test_spread_tests_equal_numpy(table, data):
    x, y, _ = data
    names, cols = ["x0", "x1", "x2"], [0, 1, 2]
    kept = table.filter("fold IS NOT NULL")
    fit = ols_fit(kept, "y", names)
    e = y - fitted(x[:, cols], y, x[:, cols])
    got = breusch_pagan(kept, fit).first()
    assert got["lm"] == pytest.approx(plain_lm(e, x[:, cols]), rel=1e-6) and got["df"] == 3
    assert got["p"] == pytest.approx(gamma_tail(1.5, got["lm"] / 2), rel=1e-9)
    z = x[:, cols] - x[:, cols].mean(axis=0)
    z = np.column_stack([z, *(z[:, i] * z[:, j] for i in range(3) for j in range(i, 3))])
    got = white(kept, fit).first()
    assert got["lm"] == pytest.approx(plain_lm(e, z), rel=1e-6) and got["df"] == 9 and got["p"] < 1e-3


def test_a_flag_and_its_square_count_once(spark):
    r = np.random.default_rng(3)
    flags = r.integers(0, 2, 300)
    df = spark.createDataFrame([(float(f), float(v)) for f, v in zip(flags, r.normal(size=300) * (1 + flags))], "x double, y double")
    assert white(df, ols_fit(df, "y", ["x"])).first()["df"] == 1


def plain_anderson(x):
    x = np.sort(x)
    z = (x - x.mean()) / x.std(ddof=1)
    cdf = NormalDist().cdf
    n = len(x)
    return -n - sum((2 * i + 1) * (math.log(cdf(z[i])) + math.log(cdf(-z[n - 1 - i]))) for i in range(n)) / n


@pytest.mark.parametrize("kind", ["normal", "ties", "skewed"])
def test_anderson_darling_equals_the_plain_sum(spark, kind):
    r = np.random.default_rng(6)
    x = {"normal": r.normal(5, 2, 700), "ties": np.round(r.normal(0, 2, 700)), "skewed": r.exponential(1, 700)}[kind]
    df = spark.createDataFrame([(float(v),) for v in x] + [(None,), (float("nan"),)], "x double").repartition(6)
    got = anderson_darling(df, "x").first()
    assert got["n"] == 700 and got["a2"] == pytest.approx(plain_anderson(x), rel=1e-8)
    assert got["normal"] == (kind == "normal")


def test_residuals_of_all_rows_are_tested(table, data):
    x, y, _ = data
    kept = table.filter("fold IS NOT NULL")
    got = residual_normality(kept, ols_fit(kept, "y", ["x0", "x1"])).first()
    assert got["a2"] == pytest.approx(plain_anderson(y - fitted(x[:, :2], y, x[:, :2])), rel=1e-6)


def test_small_and_constant_samples_have_no_statistic(spark):
    few = spark.createDataFrame([(float(i),) for i in range(7)], "x double")
    still = spark.createDataFrame([(1.5,)] * 20, "x double")
    assert anderson_darling(few, "x").first()["a2"] is None
    assert anderson_darling(still, "x").first()["p"] is None
    assert anderson_darling(few.limit(0), "x").first()["n"] == 0


def test_tails_and_critical_values():
    assert log_tail(-36.9) == pytest.approx(log_tail(-37.1) + 0.2 * 37, rel=1e-4)
    assert log_tail(0.0) == pytest.approx(math.log(0.5))
    # Stephens' table: 5 % at 0.752, 1 % at 1.035, for large samples.
    assert anderson_p(0.752, 10**9) == pytest.approx(0.05, abs=0.001)
    assert anderson_p(1.035, 10**9) == pytest.approx(0.01, abs=0.0005)
    steps = [anderson_p(a / 50, 10**6) for a in range(1, 400)]
    assert all(a >= b - 1e-3 for a, b in zip(steps, steps[1:])) and steps[-1] < 1e-10
