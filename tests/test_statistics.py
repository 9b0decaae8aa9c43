import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from statloom.operators import encode
from statloom.operators.associate import (
    collinear_pairs,
    corr_all_numeric,
    corr_with_target,
    rank_by_magnitude,
    with_selection,
)
from statloom.operators.describe import compare, describe, profile, quality, same_rows
from statloom.operators.distribution import (
    box_outliers,
    box_stats,
    histogram,
    kernel_density,
    normal_overlay,
    qq_line,
    qq_points,
)
from statloom.operators.encode import stat_encode
from statloom.operators.windows import add_lags


def values(frame, xs):
    return frame([(float(x) if x is not None else None,) for x in xs], "v double")


# --- encodings and windows ---


@pytest.mark.parametrize("limit, one_pass", [(10**6, 0), (10, 0), (10**6, 10**6)])
def test_encodings_are_the_same_every_way(spark, tmp_path, monkeypatch, limit, one_pass):
    """Medians by group, by counted values and over all tasks; tables broadcast and shuffled."""
    rng = np.random.default_rng(3)
    pdf = pd.DataFrame({"i": range(600), "a": rng.choice(["x", "y", None], 600), "b": rng.integers(0, 300, 600).astype(float),
                        "t": rng.choice([1.5, 2.0, 7.25, np.nan, *range(40)], 600), "unused": "u"})
    spark.createDataFrame(pdf).write.parquet(str(tmp_path / "rows"))
    df = spark.read.parquet(str(tmp_path / "rows"))
    df = df.withColumn("salt", (F.col("i") % 256).cast("int"))
    df.write.parquet(str(tmp_path / "salted"))
    df = spark.read.parquet(str(tmp_path / "salted"))
    monkeypatch.setattr(encode, "ONE_PASS_ROWS", one_pass)
    monkeypatch.setattr(encode, "BROADCAST_BYTES", 2_000)
    sets = {"wide": ["a"], "fine": ["b"], "both": ["a", "b"]}
    got = encode.stat_encode(df, sets, "t", limit, salt=F.col("salt"))
    narrow = got.select("i", "fine_median")
    # A join that shuffles reads the columns that are asked for, not all of the rows.
    assert "unused" not in narrow._jdf.queryExecution().executedPlan().toString()
    got = got.orderBy("i").toPandas()
    for prefix, keys in sets.items():
        want = pdf.groupby(keys)["t"].agg(["mean", "median", "std", "max", "count"]).reset_index()
        want = pdf.merge(want, on=keys, how="left")
        for s in ("mean", "median", "std", "max", "count"):
            np.testing.assert_allclose(got[f"{prefix}_{s}"].astype(float), want[s], rtol=1e-12, err_msg=f"{prefix}_{s}")


@pytest.mark.parametrize("limit", [10**6, 4])
def test_stat_encode(frame, limit):
    rows = [("a", "x", 1.0), ("a", "x", 3.0), ("a", "y", 8.0), ("b", "x", 5.0), (None, "x", 9.0),
            ("b", None, 2.0), ("b", "x", 6.0)]
    df = frame([(i, *r) for i, r in enumerate(rows)], "i int, k string, l string, t double")
    sets = {"te_k": ["k"], "te_kl": ["k", "l"]}
    got = stat_encode(df, sets, "t", row_limit=limit).orderBy("i").toPandas()
    pdf = pd.DataFrame(rows, columns=["k", "l", "t"])
    for prefix, keys in sets.items():
        g = pdf.groupby(keys)["t"].agg(["mean", "median", "std", "max", "count"]).reset_index()
        want = pdf.merge(g, on=keys, how="left")
        for s in ("mean", "median", "std", "max", "count"):
            np.testing.assert_allclose(got[f"{prefix}_{s}"].astype(float), want[s], rtol=1e-12)


@pytest.mark.parametrize("limit, ties", [(20, False), (20, True), (10**6, False)])
def test_medians_of_big_groups_sort_few_rows(spark, frame, monkeypatch, limit, ties):
    """Rows far from a group's middle values are only counted, whatever the limit; ties are counted."""
    import statloom.operators.encode as encode
    from statloom.operators import ordering

    rng = np.random.default_rng(8)
    values = rng.normal(size=4000)
    values[:4] = [np.inf, -np.inf, -0.0, 0.0]
    if ties:
        values[rng.random(4000) < 0.6] = 0.0
    pdf = pd.DataFrame({"a": rng.choice(["x", "y", None], 4000), "b": rng.integers(0, 2, 4000).astype(float), "t": values})
    sets = {"one": ["a"], "other": ["b"], "both": ["a", "b"]}
    sorted_rows, once = [], ordering.sorted_once
    monkeypatch.setattr(ordering, "sorted_once", lambda df, order: (sorted_rows.append(df.count()), once(df, order))[1])
    monkeypatch.setattr(encode, "ONE_PASS_ROWS", 0)
    monkeypatch.setattr(encode, "PARTS", 16)
    held, windows = [], encode.counted_median
    monkeypatch.setattr(encode, "counted_median", lambda df, *rest: (held.append(df.count()), windows(df, *rest))[1])
    rows = [(None if a is None else str(a), float(b), float(t)) for a, b, t in pdf.itertuples(index=False)]
    tables = encode.group_statistics(frame(rows, "a string, b double, t double"), sets, "t", limit)
    assert sum(sorted_rows) + sum(held) <= 200
    for prefix, keys in sets.items():
        got = tables[prefix][0].toPandas().set_index(keys)[f"{prefix}_median"].sort_index()
        want = pdf.groupby(keys)["t"].median().sort_index()
        assert len(got) == len(want)
        np.testing.assert_allclose(got.to_numpy(), want.to_numpy(), rtol=1e-12, atol=0)


def test_parts_of_a_range(frame):
    from statloom.operators.encode import _bounds, _part

    values = [float(v) for v in np.random.default_rng(2).normal(size=300)] + [0.0, -0.0, math.inf, -math.inf]
    df = frame([(v,) for v in values], "_target double")
    for bounds in ([0.0], [-1.0, 0.0, 0.5], _bounds(df, 50)):
        got = df.select("_target", _part(bounds).alias("p")).collect()
        assert [r.p for r in got] == [int(np.searchsorted(bounds, r._target, side="right")) for r in got]
    assert _bounds(df.filter("_target IS NULL"), 50) == []


def test_stat_encode_with_big_side_tables(frame, monkeypatch):
    import statloom.operators.encode as encode

    rows = [(i, "hot" if i % 3 else str(i % 50), float(i % 17)) for i in range(600)]
    df = frame([*rows, (600, None, 1.0)], "i int, k string, t double")
    want = stat_encode(df, {"te": ["k"]}, "t").orderBy("i").collect()
    monkeypatch.setattr(encode, "BROADCAST_BYTES", -1)
    assert stat_encode(df, {"te": ["k"]}, "t").orderBy("i").collect() == want


def test_mean_encoding_correlates_most(frame):
    rng = np.random.default_rng(1)
    rows = [(str(k), float(k % 3 + rng.normal())) for k in rng.integers(0, 9, 800)]
    encoded = stat_encode(frame(rows, "k string, t double"), {"te": ["k"]}, "t")
    corr = corr_with_target(encoded, [c for c in encoded.columns if c.startswith("te_")], "t")
    assert rank_by_magnitude(corr).first()["variable"] == "te_mean"


def test_lags_stay_inside_the_key_and_skip_gaps(frame):
    rows = [(2018, "a", 1.0), (2019, "a", 2.0), (2021, "a", 6.0), (2022, "a", 9.0),
            (2018, "b", 10.0), (2019, "b", 30.0), (2019, "b", 20.0), (2019, None, 5.0)]
    got = add_lags(frame(rows, "y int, k string, v double"), "y", "k", "v", "f").toPandas()
    at = got.set_index(["k", "y"])
    assert at.loc[("a", 2021), "f_lag1_sum"].iloc[0] == 2.0
    assert at.loc[("a", 2022), "f_roll3_sum"].iloc[0] == 3.0
    assert at.loc[("b", 2019), "f_lag1_mean"].tolist() == [10.0, 10.0]
    assert math.isnan(at.loc[("b", 2018), "f_lag1_sum"].iloc[0])
    assert len(got) == len(rows)


# --- description ---


def test_describe_matches_pandas(frame):
    rng = np.random.default_rng(5)
    x = np.exp(rng.normal(size=400))
    row = describe(values(frame, x), ["v"]).first()
    s = pd.Series(x)
    want = dict(n=400, mean=s.mean(), median=s.median(), std=s.std(), min=s.min(), max=s.max(),
                q1=s.quantile(0.25), q3=s.quantile(0.75), skew=s.skew(), kurtosis=s.kurtosis(),
                iqr=s.quantile(0.75) - s.quantile(0.25), cv=s.std() / s.mean())
    for name, v in want.items():
        assert row[name] == pytest.approx(v, rel=1e-10), name


@pytest.mark.parametrize("xs", [[3.0], [3.0, 3.0, 3.0, 3.0, 3.0], [1.0, 2.0], [1.0, 2.0, 4.0]])
def test_describe_degenerate(frame, xs):
    row = describe(values(frame, xs), ["v"]).first()
    n, flat = len(xs), len(set(xs)) == 1
    assert (row["std"] is None) == (n == 1)
    assert (row["skew"] is None) == (n < 3 or flat)
    assert (row["kurtosis"] is None) == (n < 4 or flat)


def test_compare_marks_improvement(frame):
    x = np.exp(np.random.default_rng(2).normal(size=300))
    df = frame([(float(v), float(math.log(v))) for v in x], "a double, b double")
    rows = {r["statistic"]: r for r in compare(df, "a", "b").collect()}
    assert len(rows) == 11 and rows["skew"]["closer_to_zero"] and rows["mean"]["improvement_pct"] is None
    s, t = pd.Series(x).skew(), pd.Series(np.log(x)).skew()
    assert rows["skew"]["improvement_pct"] == pytest.approx((abs(s) - abs(t)) / abs(s) * 100)


def test_published_gains(spark):
    from statloom.operators.describe import closeness_gain

    got = spark.range(1).select(
        closeness_gain(F.lit(-0.302854), F.lit(-0.055252)), closeness_gain(F.lit(0.377902), F.lit(-0.075744)),
        closeness_gain(F.lit(0.0), F.lit(1.0)),
    ).first()
    assert [round(v, 2) if v is not None else v for v in got] == [81.76, 79.96, None]


def test_profile_and_quality(frame):
    df = frame([(1.0, "a"), (None, "b"), (math.inf, "c"), (math.nan, "d")], "v double, s string")
    assert tuple(profile(df).first()) == (4, 2)
    assert tuple(quality(df, ["v"]).first()) == ("v", 4, 2, 1)
    assert same_rows(df, df.limit(3)).first()["rows_kept"] is False


# --- correlation ---


def test_corr_is_pairwise_and_guards_constants(frame):
    rows = [(1.0, 2.0, 5.0, None), (2.0, 1.0, 5.0, 3.0), (None, 7.0, 5.0, 1.0), (4.0, 9.0, 5.0, 2.0)]
    df = frame(rows, "a double, b double, c double, t double")
    got = {r["variable"]: r for r in corr_with_target(df, ["a", "b", "c"], "t").collect()}
    want = pd.DataFrame(rows, columns=list("abct")).corr()["t"]
    assert got["a"]["r"] == pytest.approx(want["a"]) and got["a"]["n"] == 2
    assert got["b"]["r"] == pytest.approx(want["b"]) and got["b"]["n"] == 3
    assert got["c"]["r"] is None
    marked = with_selection(corr_with_target(df, ["a", "b", "c"], "t"), 0.3)
    assert {r["variable"]: r["selected"] for r in marked.collect()}["c"] is False
    assert rank_by_magnitude(marked).collect()[-1]["variable"] == "c"


def test_signed_ranking_takes_all_numeric_columns(frame):
    rows = [(i, float(-i), "x", 1.0, float(i * i)) for i in range(6)]
    got = corr_all_numeric(frame(rows, "a int, b double, s string, k double, t double"), "t").collect()
    assert [r["variable"] for r in got] == ["a", "b", "k"] and got[2]["r"] is None


def test_collinear_pairs(frame):
    rng = np.random.default_rng(0)
    x, z = rng.normal(size=200), rng.normal(size=200)
    df = frame([(float(a), float(-2 * a), float(b)) for a, b in zip(x, z)], "x double, y double, z double")
    got = collinear_pairs(df, ["x", "y", "z"], 0.85).collect()
    assert [(r["var_a"], r["var_b"]) for r in got] == [("x", "y")]
    assert got[0]["abs_r"] == pytest.approx(1.0)


# --- distribution ---


def test_histogram_closes_the_last_bin(frame):
    bars = histogram(values(frame, range(11)), "v", 5).orderBy("bin").collect()
    assert [r["count"] for r in bars] == [2, 2, 2, 2, 3]
    assert sum(r["density"] * (r["upper"] - r["lower"]) for r in bars) == pytest.approx(1.0)


def test_histogram_keeps_empty_bins_and_constants(frame):
    assert [r["count"] for r in histogram(values(frame, [0, 0, 10, None]), "v", 4).orderBy("bin").collect()] == [2, 0, 0, 1]
    flat = histogram(values(frame, [3, 3]), "v", 2).orderBy("bin").collect()
    assert [(r["lower"], r["upper"], r["count"]) for r in flat] == [(2.5, 3.0, 0), (3.0, 3.5, 2)]


@pytest.mark.parametrize("limit", [10**6, 3])
def test_box(frame, limit):
    xs = [1, 2, 3, 4, 5, 6, 7, 50, -40]
    row = box_stats(values(frame, xs), "v", row_limit=limit).first().asDict()
    assert row == {"n": 9, "q1": 2.0, "median": 4.0, "q3": 6.0, "whisker_low": 1.0,
                   "whisker_high": 7.0, "n_outliers": 2}
    out = box_outliers(values(frame, xs), "v", row_limit=limit)
    assert sorted(r["v"] for r in out.collect()) == [-40.0, 50.0]


def test_kernel_density_matches_the_formula(frame):
    x = np.random.default_rng(4).normal(size=150)
    got = kernel_density(values(frame, x), "v").orderBy("point").toPandas()
    h = x.std(ddof=1) * len(x) ** -0.2
    grid = np.linspace(x.min(), x.max(), 100)
    want = np.exp(-0.5 * ((grid[:, None] - x) / h) ** 2).sum(1) / (len(x) * h * math.sqrt(2 * math.pi))
    np.testing.assert_allclose(got["x"], grid)
    np.testing.assert_allclose(got["density"], want, rtol=1e-10)


def test_normal_overlay(frame):
    x = np.array([1.0, 2.0, 4.0, 9.0])
    got = normal_overlay(values(frame, x), "v").orderBy("point").toPandas()
    s = x.std(ddof=1)
    want = np.exp(-0.5 * ((got["x"] - x.mean()) / s) ** 2) / (s * math.sqrt(2 * math.pi))
    np.testing.assert_allclose(got["density"], want)


def test_qq_of_normal_data_is_a_line(frame):
    x = np.random.default_rng(8).normal(3.0, 2.0, size=500)
    points = qq_points(values(frame, x).withColumn("i", F.monotonically_increasing_id()), "v", ["i"])
    row = qq_line(points).first()
    assert row["n"] == 500 and row["r"] > 0.99
    assert row["slope"] == pytest.approx(2.0, abs=0.2) and row["intercept"] == pytest.approx(x.mean())
    first = points.orderBy("position").first()
    assert first["observed"] == x.min()


@pytest.mark.parametrize("limit", [10**6, 4])
def test_stat_encode_skips_nan_and_takes_dotted_names(frame, limit):
    nan, inf = float("nan"), float("inf")
    rows = [("a", 1.0), ("a", nan), ("a", 4.0), ("b", None), ("b", nan), ("c", inf), (None, 2.0)] + [("d", 1.0)] * 9
    df = frame([(i, *r) for i, r in enumerate(rows)], "i int, `a.b` string, t double")
    got = {r["i"]: r for r in stat_encode(df, {"te": ["a.b"]}, "t", row_limit=limit).collect()}
    assert len(got) == len(rows)
    assert (got[0].te_mean, got[0].te_median, got[0].te_max, got[0].te_count) == (2.5, 2.5, 4.0, 2)
    assert got[3].te_mean is None and got[3].te_count == 0 and got[6].te_count is None
    assert got[5].te_median == inf and got[7].te_count == 9


def test_missing_keys_and_nan_in_estimates(frame):
    from statloom.operators.associate import corr_with_target
    from statloom.operators.estimation import estimators, sample_size
    from statloom.operators.windows import yearly_totals

    nan = float("nan")
    df = frame([("a", 1, 1.0, 1), ("a", 1, nan, 0), ("a", 1, 3.0, 1), (None, 1, 9.0, 1)],
               "k string, y int, v double, f int")
    assert [tuple(r) for r in estimators(df, "v", "f", ["k"]).collect()] == [("a", 3, pytest.approx(2 / 3), 2.0, 2.0)]
    assert sample_size(df, "f", group_cols=["k"]).count() == 1
    assert corr_with_target(df, ["f"], "v", ["k"]).count() == 1
    assert [tuple(r) for r in yearly_totals(df, "y", "k", "v").collect()] == [(1, "a", 4.0, 2.0, 2)]


def test_pair_moments_with_missing_and_infinite_values(frame):
    from statloom.operators.associate import corr_pairs

    rng = np.random.default_rng(5)
    x = rng.normal(1e6, 1.0, (400, 4))
    x[rng.random(x.shape) < 0.2] = np.nan
    pdf = pd.DataFrame(x, columns=list("abcd"))
    rows = [tuple(None if math.isnan(v) else float(v) for v in r) + (5.0, float("inf") if i == 3 else float(i))
            for i, r in enumerate(x.tolist())]
    df = frame(rows, "a double, b double, c double, d double, e double, f double")
    got = {(r.var_a, r.var_b): (r.n, r.r) for r in corr_pairs(df, list("abcdef")).collect()}
    for a, b in (("a", "b"), ("b", "d"), ("a", "d")):
        both = pdf[[a, b]].dropna()
        assert got[a, b] == (len(both), pytest.approx(both.corr().iloc[0, 1], abs=1e-9))
    assert got["a", "e"][1] is None and len(got) == 15
