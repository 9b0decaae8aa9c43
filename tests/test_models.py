import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from statloom.functions.shapiro import shapiro_wilk
from statloom.operators.estimation import estimators, sample_size
from statloom.operators.normality import (
    add_transforms,
    best_transforms,
    compare_transforms,
    fit_transforms,
    shapiro_groups,
)
from statloom.operators.powerfit import box_cox_fit, likelihood_grid, yeo_johnson_fit
from statloom.operators.regression import (
    beta_share,
    coefficient_table,
    f_tail,
    kurtosis_score,
    ols_fit,
    ols_predict,
    ols_summary,
    skew_score,
    t_quantile,
    t_tails,
)
from statloom.operators.sampling import hash_sample, sample_hash, scatter_sample, systematic_sample


# --- lambda search ---


def brute(x, transformed, slope):
    grid = np.arange(-3.0, 4.0, 0.001)
    return grid[np.argmin([0.5 * math.log(np.var(transformed(x, g))) - g * slope for g in grid])]


def test_box_cox_fit(frame):
    x = np.exp(np.random.default_rng(7).normal(1.0, 0.4, 500)) ** 1.7
    df = frame([(float(v),) for v in x], "v double")
    centred = np.log(x) - np.log(x).mean()
    want = brute(centred, lambda u, g: u if abs(g) < 1e-9 else np.expm1(g * u) / g, 0.0)
    assert box_cox_fit(df, "v") == pytest.approx(want, abs=6e-4)


def test_box_cox_fit_widens_its_range(frame):
    x = np.random.default_rng(9).normal(12.0, 0.4, 400) ** (1 / 6)
    lam = box_cox_fit(frame([(float(v),) for v in x], "v double"), "v")
    assert lam > 3.0
    near = likelihood_grid(frame([(float(v),) for v in x], "v double"), "v", [lam - 0.1, lam, lam + 0.1])
    best = near.orderBy(F.desc("log_likelihood")).first()
    assert best["lambda"] == lam


@pytest.mark.parametrize("xs", [[1.0, 0.0, 2.0], [-1.0, 2.0, 3.0], [2.0, 2.0]])
def test_box_cox_rejects(frame, xs):
    with pytest.raises(ValueError):
        box_cox_fit(frame([(x,) for x in xs], "v double"), "v")


def test_yeo_johnson_fit(frame):
    x = np.random.default_rng(11).gamma(2.0, 3.0, 500) - 4.0
    s = np.sign(x) * np.log1p(np.abs(x))

    def yj(u, g):
        up = np.expm1(g * u) / g if abs(g) > 1e-9 else u
        down = -np.expm1(-(2 - g) * u) / (2 - g) if abs(2 - g) > 1e-9 else u
        return np.where(u >= 0, up, down)

    want = brute(s, yj, s.mean())
    assert yeo_johnson_fit(frame([(float(v),) for v in x], "v double"), "v") == pytest.approx(want, abs=6e-4)


# --- normality ---


def test_shapiro_known_samples():
    w, p = shapiro_wilk([148, 154, 158, 160, 161, 162, 166, 170, 182, 195, 236])
    assert (round(w, 5), round(p, 6)) == (0.78881, 0.006704)
    w, p = shapiro_wilk([1, 2, 4])
    assert (round(w, 5), round(p, 4)) == (0.96429, 0.6369)
    assert all(math.isnan(v) for v in shapiro_wilk([5, 5, 5, 5]) + shapiro_wilk([1, 2]))


def test_shapiro_is_affine_invariant():
    x = np.random.default_rng(0).exponential(size=300)
    assert shapiro_wilk(x)[0] == pytest.approx(shapiro_wilk(7 - 3 * x)[0], rel=1e-12)


# Published (n, W, p) triples, reproduced to their printed digits.
PUBLISHED = [
    (5000, 0.993075, 7.19e-15), (1839, 0.996586, 4.00e-04), (1839, 0.996480, 3.01e-04),
    (1839, 0.993179, 1.63e-07), (1839, 0.945137, 1.31e-25), (1839, 0.601601, 5.77e-54),
    (1839, 0.025186, 2.43e-70),
]


@pytest.mark.parametrize("n,w,p", PUBLISHED)
def test_published_p_values(n, w, p):
    from statloom.functions.shapiro import LARGE_LOG_STD, LARGE_MEAN, _poly

    log_n = math.log(n)
    z = (math.log1p(-w) - _poly(LARGE_MEAN, log_n)) / math.exp(_poly(LARGE_LOG_STD, log_n))
    assert 0.5 * math.erfc(z / math.sqrt(2)) == pytest.approx(p, rel=0.02)


def test_shapiro_false_positives():
    rng = np.random.default_rng(1)
    for n in (9, 60):
        rate = np.mean([shapiro_wilk(rng.normal(size=n))[1] < 0.05 for _ in range(600)])
        assert 0.02 < rate < 0.09


def test_shapiro_groups(spark, frame):
    rng = np.random.default_rng(2)
    rows = [(i, "normal", float(v)) for i, v in enumerate(rng.normal(size=400))]
    rows += [(400 + i, "skewed", float(v)) for i, v in enumerate(rng.exponential(size=400))]
    rows += [(900 + i, "flat", 1.0) for i in range(20)]
    df = frame(rows, "id long, g string, v double")
    got = {r["g"]: r for r in shapiro_groups(df, "v", ["g"], ["id"], 150).collect()}
    assert got["normal"]["n"] == 150 and got["skewed"]["result"] == "Nao-Normal"
    assert got["flat"]["w"] is None and got["flat"]["result"] is None
    with pytest.raises(ValueError):
        shapiro_groups(df, "v", ["g"], ["id"], 6000)


def test_transforms_share_one_sample(frame):
    x = np.exp(np.random.default_rng(3).normal(size=300))
    df = frame([(i, float(v)) for i, v in enumerate(x)], "id long, v double")
    fitted = fit_transforms(df, "v")
    got = {r["transform"]: r for r in compare_transforms(df, fitted, ["id"], n=200).collect()}
    assert set(got) == {"Original", "Box-Cox", "Yeo-Johnson", "Log", "Raiz Quadrada", "Inversa", "Z-Score"}
    assert got["Original"]["w"] == pytest.approx(got["Z-Score"]["w"], rel=1e-9)
    assert got["Box-Cox"]["lambda"] == pytest.approx(0.0, abs=0.15) and got["Log"]["lambda"] is None
    assert got["Log"]["result"] == "Normal" and got["Original"]["result"] == "Nao-Normal"
    compared = compare_transforms(df, fitted, ["id"], n=200)
    assert best_transforms(compared).first()["transform"] in {"Box-Cox", "Log", "Yeo-Johnson"}


def test_infeasible_transforms_are_left_out(frame):
    df = frame([(float(v),) for v in (-1, 0, 2, 5, 9)], "v double")
    wide = add_transforms(df, fit_transforms(df, "v"))
    assert wide.columns == ["v", "target_yeo_johnson", "target_z_score"]


# --- samples ---


def test_hash_sample_is_exact_per_group(spark):
    df = spark.range(20000).select("id", F.when(F.col("id") % 3 > 0, "hot").otherwise(
        (F.col("id") % 60).cast("string")).alias("g"))
    got = hash_sample(df, ["id"], 50, group_cols=["g"]).toPandas()
    pdf = df.withColumn("h", sample_hash(["id"])).toPandas().sort_values(["g", "h"])
    want = pdf.groupby("g").head(50)
    assert sorted(got["id"]) == sorted(want["id"])
    again = hash_sample(df.repartition(7), ["id"], 50, group_cols=["g"]).toPandas()
    assert sorted(again["id"]) == sorted(got["id"])


def test_hash_sample_of_a_small_table_is_the_table(spark):
    assert hash_sample(spark.range(10), ["id"], 50).count() == 10


def test_hash_sample_changes_with_the_seed(spark):
    a, b = ({r["id"] for r in hash_sample(spark.range(2000), ["id"], 100, s).collect()} for s in (1, 2))
    assert len(a) == len(b) == 100 and a != b


def test_systematic_and_scatter_samples(spark):
    df = spark.range(1000).select("id", (F.col("id") * 2).alias("x"), F.sqrt("id").alias("y"))
    rows = systematic_sample(df, ["id"]).orderBy("id").collect()
    assert [r["id"] for r in rows] == list(range(0, 1000, 11))
    points = scatter_sample(df, "x", "y", ["id"], 80).collect()
    assert len(points) == 80 and [p["id"] for p in points] == sorted(p["id"] for p in points)


# --- estimates ---


def test_estimators(frame):
    df = frame([(float(v), f) for v, f in zip([1, 10, 8, 6, 50, 1], [1, 0, 1, 1, 0, 0])], "v double, f int")
    row = estimators(df, "v", "f").first()
    assert (row["proportion"], round(row["mean"], 4), round(row["variance"], 4)) == (0.5, 12.6667, 347.8667)
    assert estimators(df.limit(1), "v", "f").first()["variance"] is None


def test_sample_size(spark):
    half = spark.range(2000).select((F.col("id") % 2).alias("f"))
    row = sample_size(half, "f", 0.99, 0.05).first()
    assert row["n_raw"] == pytest.approx(98.01) and row["n_adjusted"] == row["n_raw"]
    assert sample_size(half, "f", 1.96, 0.5).first()["n_raw"] == pytest.approx(3.8416)
    big = sample_size(half, "f", 1.96, 0.05).first()
    assert big["n_adjusted"] == pytest.approx(384.16 / (1 + 383.16 / 2000))
    assert big["share_pct"] == pytest.approx(big["n_adjusted"] / 20)


# --- regression ---


@pytest.fixture(scope="module")
def regression():
    rng = np.random.default_rng(6)
    n = 400
    a, b = rng.normal(10, 2, n), rng.integers(0, 2, n).astype(float)
    y = 3 + 0.5 * a - 2 * b + rng.standard_t(5, n)
    return pd.DataFrame({"id": np.arange(n), "a": a, "b": b, "a2": 2 * a, "y": y})


def test_ols_matches_numpy(spark, regression):
    df = spark.createDataFrame(regression)
    fit = ols_fit(df, "y", ["a", "b"])
    x = np.column_stack([np.ones(400), regression["a"], regression["b"]])
    y = regression["y"].to_numpy()
    beta, *_ = np.linalg.lstsq(x, y, rcond=None)
    assert fit.coefficients == pytest.approx(tuple(beta), rel=1e-9)
    e = y - x @ beta
    s2 = e @ e / 397
    se = np.sqrt(np.diag(np.linalg.inv(x.T @ x)) * s2)
    table = coefficient_table(df, fit).toPandas()
    np.testing.assert_allclose(table["std_err"], se, rtol=1e-8)
    np.testing.assert_allclose(table["t"], beta / se, rtol=1e-8)
    np.testing.assert_allclose(table["ci_high"] - table["coef"], 1.965957 * se, rtol=1e-5)
    row = ols_summary(df, fit, ["id"]).first()
    assert row["durbin_watson"] == pytest.approx((np.diff(e) ** 2).sum() / (e @ e), rel=1e-9)
    assert row["r2"] == pytest.approx(1 - e @ e / ((y - y.mean()) ** 2).sum(), rel=1e-9)
    assert row["condition_number"] == pytest.approx(np.linalg.cond(x), rel=1e-6)
    assert row["log_likelihood"] == pytest.approx(-200 * (math.log(2 * math.pi * (e @ e) / 400) + 1))
    assert abs(x.T @ e).max() < 1e-8
    predicted = ols_predict(df, fit).orderBy("id").toPandas()
    np.testing.assert_allclose(predicted["predicted"], x @ beta, rtol=1e-9)
    np.testing.assert_allclose(predicted["abs_error"], abs(e), atol=1e-9)


def test_ols_collinear_takes_the_least_norm(spark, regression):
    fit = ols_fit(spark.createDataFrame(regression), "y", ["a", "a2", "b"])
    x = np.column_stack([np.ones(400), regression["a"], regression["a2"], regression["b"]])
    assert fit.rank == 3
    assert fit.coefficients == pytest.approx(tuple(np.linalg.pinv(x) @ regression["y"]), rel=1e-7)


def test_ols_skips_incomplete_rows(frame):
    rows = [(1.0, 2.0), (2.0, 4.0), (3.0, 6.0), (None, 1.0), (4.0, None)]
    fit = ols_fit(frame(rows, "x double, y double"), "y", ["x"])
    assert fit.n == 3 and fit.coefficients == pytest.approx((0.0, 2.0), abs=1e-12)


def test_tails_against_tables():
    assert t_tails(2.228139, 10) == pytest.approx(0.05, abs=1e-6)
    assert t_quantile(0.05, 10) == pytest.approx(2.228139, abs=1e-5)
    assert f_tail(4.1028, 2, 10) == pytest.approx(0.05, abs=1e-5)
    assert t_tails(1.959964, 1e12) == pytest.approx(0.05, abs=1e-5)
    assert beta_share(2, 3, 0.4) == pytest.approx(0.5248)
    assert abs(skew_score(0.0, 50)) < 1e-12 and kurtosis_score(6.0, 50) > 2
