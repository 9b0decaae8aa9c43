import datetime
import math
from statistics import NormalDist

import pytest
from pyspark.sql import functions as F

from helpers import column
from statloom.functions.coerce import as_double, nan_to_null, to_number, to_timestamp
from statloom.functions.columns import (
    all_non_negative,
    all_positive,
    date_parts,
    flag,
    list_field_mean,
    list_field_sum,
    list_size,
    log1p_floor0,
    optional,
    ratio,
    reorder,
    snake_name,
    unique_sorted,
    with_prefix,
)
from statloom.functions.normal import normal_density, normal_quantile
from statloom.functions.power import box_cox, inverse_box_cox, yeo_johnson

LAMBDA = 1.2623624250829306


def test_to_number_accepts_numbers_only(frame):
    texts = ["1", "1e3", " 12 ", "-.5", "12d", "12f", "abc", "", "nan", "inf", "1,5", None]
    df = frame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = column(df.select("i", to_number("t").alias("x")), "x", "i")
    assert got == [1.0, 1000.0, 12.0, -0.5, None, None, None, None, None, math.inf, None, None]


def test_nan_is_missing(frame):
    df = frame([(1.0,), (float("nan"),), (None,)], "x double")
    assert column(df.select(nan_to_null("x").alias("y")), "y") == [1.0, None, None]
    assert df.agg(F.max(as_double(df, "x"))).first()[0] == 1.0


def test_to_timestamp_is_lenient(frame):
    texts = ["2020-01-02", "2020-01-02T03:04:05", "2020-01-02 03:04:05", "02/01/2020",
             "2020-13-01", "", None]
    df = frame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = column(df.select("i", to_timestamp("t").alias("x")), "x", "i")
    stamp = datetime.datetime(2020, 1, 2, 3, 4, 5)
    assert got == [datetime.datetime(2020, 1, 2), stamp, stamp, None, None, None, None]


def test_date_parts_and_flags(frame):
    df = frame([(datetime.datetime(2024, 12, 2),), (None,)], "t timestamp_ntz")
    parts = date_parts("t")
    rows = df.select(*(c.alias(n) for n, c in parts.items()),
                     flag(parts["month"] >= 11).alias("late")).collect()
    assert tuple(rows[0]) == (12, 4, 0, 2, 2024, 1)
    assert rows[1]["month"] is None and rows[1]["late"] == 0


def test_nested_lists(frame):
    schema = "i int, xs array<struct<v: double, w: double>>"
    rows = [(0, [(1.0, 2.0), (None, 4.0)]), (1, []), (2, None), (3, [None, (3.0, None)])]
    got = frame(rows, schema).orderBy("i").select(
        list_size("xs"), list_field_sum("xs", "v"), list_field_mean("xs", "v")
    ).collect()
    assert [tuple(r) for r in got] == [(2, 1.0, 0.5), (0, 0.0, None), (0, 0.0, None), (2, 3.0, 3.0)]


def test_ratios_and_logs(frame):
    df = frame([(6.0, -2.0), (6.0, -1.0), (None, 1.0)], "a double, b double")
    got = df.select(ratio("a", "b"), ratio("a", "b", absolute=False), log1p_floor0("b"),
                    log1p_floor0("a")).collect()
    assert tuple(got[0])[:3] == (2.0, -6.0, 0.0)
    assert tuple(got[1])[:3] == (3.0, None, 0.0)
    assert tuple(got[2])[0] is None and got[2][3] is None


def test_column_helpers(frame):
    df = frame([(1, "a", 2.0)], "te_b int, x string, te_a double")
    assert with_prefix(df, "te_") == ["te_b", "te_a"]
    assert unique_sorted(["b", "a"], ["a"]) == ["a", "b"]
    assert snake_name("Raiz Quadrada") == "raiz_quadrada" and snake_name("Box-Cox") == "box_cox"
    assert reorder(df, ["x"], ["te_b"]).columns == ["x", "te_a", "te_b"]
    assert df.select(optional(df, "x").alias("x"), optional(df, "y").alias("y")).first() == ("a", None)


def test_sign_gates(frame):
    df = frame([(-1.0, 0.0, 1.0), (2.0, 3.0, None)], "a double, b double, c double")
    row = df.agg(all_non_negative("a"), all_positive("b"), all_non_negative("b"), all_positive("c"))
    assert tuple(row.first()) == (False, False, True, True)


@pytest.mark.parametrize("p", [1e-300, 1e-12, 0.01, 0.074, 0.5, 0.9, 0.926, 1 - 1e-12])
def test_normal_quantile(spark, p):
    got = spark.range(1).select(normal_quantile(F.lit(p))).first()[0]
    assert got == pytest.approx(NormalDist().inv_cdf(p), rel=1e-13, abs=1e-13)


def test_normal_density(spark):
    one = spark.range(1)
    got = one.select(normal_density(F.lit(1.5), F.lit(1.0), F.lit(2.0))).first()[0]
    assert got == pytest.approx(NormalDist(1, 2).pdf(1.5))
    assert one.select(normal_density(F.lit(1.5), F.lit(1.0), F.lit(0.0))).first()[0] is None


def test_box_cox_golden_points(frame):
    # Published points of the fitted transform.
    df = frame([(math.log1p(0.02),), (16.08099445276543,)], "x double")
    low, high = column(df.select(box_cox("x", LAMBDA).alias("y")), "y")
    assert low == pytest.approx(-0.7865594048076352, rel=1e-12)
    assert high == pytest.approx(25.608812851584517, rel=1e-12)


@pytest.mark.parametrize("lam", [-1.5, 0.0, 0.5, LAMBDA])
def test_box_cox_inverts(frame, lam):
    df = frame([(0.02,), (1.0,), (16.0,)], "x double")
    back = column(df.select(inverse_box_cox(box_cox("x", lam), lam).alias("y")), "y")
    assert back == pytest.approx([0.02, 1.0, 16.0], rel=1e-10)


def test_box_cox_limits(frame):
    df = frame([(0.0,), (-1.0,)], "x double")
    assert column(df.select(box_cox("x", 0.5).alias("y")), "y") == [None, None]
    assert df.select(inverse_box_cox(F.lit(-5.0), 0.5)).first()[0] is None


@pytest.mark.parametrize("lam", [0.0, 0.7, 2.0])
def test_yeo_johnson(frame, lam):
    df = frame([(-3.0,), (0.0,), (4.0,)], "x double")
    up = (lambda v, k: math.log(v) if k == 0 else (v**k - 1) / k)
    want = [-up(4.0, 2 - lam), 0.0, up(5.0, lam)]
    assert column(df.select(yeo_johnson("x", lam).alias("y")), "y") == pytest.approx(want)
