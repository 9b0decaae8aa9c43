"""Shapiro-Wilk tests on bounded samples, one group per Arrow batch."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from statloom.functions.coerce import as_double
from statloom.functions.columns import snake_name
from statloom.functions.power import (
    box_cox,
    inverse,
    natural_log,
    square_root,
    yeo_johnson,
    z_score,
)
from statloom.functions.shapiro import shapiro_wilk
from statloom.operators.powerfit import box_cox_fit, value_range, yeo_johnson_fit
from statloom.operators.sampling import SEED, hash_sample

SAMPLE = 5000
ALPHA = 0.05


def verdict(p: Column | str, alpha: float = ALPHA) -> Column:
    """Label of a test: is normality not rejected at this level?"""
    p = F.col(p) if isinstance(p, str) else p
    return F.when(p > alpha, "Normal").when(p.isNotNull(), "Nao-Normal")


def _test_groups(samples: DataFrame, group_cols: Sequence[str], value: str) -> DataFrame:
    """W and p per group; the caller bounds the size of every group."""
    keys = list(group_cols)
    fields = [samples.schema[k] for k in keys] + [
        T.StructField("n", T.LongType()),
        T.StructField("w", T.DoubleType()),
        T.StructField("p", T.DoubleType()),
    ]

    statistic = shapiro_wilk

    def test(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        values = group[value].to_numpy(dtype=float)
        w, p = statistic(values)
        return pd.DataFrame([[*key, len(values), w, p]], columns=[*keys, "n", "w", "p"])

    narrow = samples.select(*keys, value).dropna(subset=[value])
    tested = narrow.groupBy(*keys).applyInPandas(test, T.StructType(fields))
    return tested.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in ("w", "p")})


def shapiro_groups(
    df: DataFrame,
    value: str,
    group_cols: Sequence[str],
    key_cols: Sequence[str],
    n: int = SAMPLE,
    seed: int = SEED,
    alpha: float = ALPHA,
) -> DataFrame:
    """Shapiro-Wilk per group on a seeded sample of at most ``n`` of its rows."""
    if n > SAMPLE:
        raise ValueError(f"the test is defined for samples of at most {SAMPLE}")
    names = list(dict.fromkeys([*group_cols, *key_cols]))
    narrow = df.select(*names, as_double(df, value).alias("_v")).dropna(subset=["_v"])
    samples = hash_sample(narrow, key_cols, n, seed, group_cols)
    tested = _test_groups(samples, group_cols, "_v")
    return tested.withColumn("result", verdict("p", alpha))


# --- comparing transforms --------------------------------------------------------


@dataclass(frozen=True)
class FittedTransforms:
    """What must be known about a column to transform any of its values."""

    value: str
    mean: float
    std: float
    all_positive: bool
    all_non_negative: bool
    box_cox_lambda: float | None
    yeo_johnson_lambda: float

    def columns(self) -> dict[str, Column]:
        """The feasible transforms by display name."""
        v = F.col(self.value)
        made: dict[str, Column] = {}
        if self.all_positive:
            made["Box-Cox"] = box_cox(v, self.box_cox_lambda)
        made["Yeo-Johnson"] = yeo_johnson(v, self.yeo_johnson_lambda)
        if self.all_positive:
            made["Log"] = natural_log(v)
        if self.all_non_negative:
            made["Raiz Quadrada"] = square_root(v)
        if self.all_positive:
            made["Inversa"] = inverse(v)
        made["Z-Score"] = z_score(v, self.mean, self.std)
        return made

    def lambdas(self) -> dict[str, float | None]:
        return {"Box-Cox": self.box_cox_lambda, "Yeo-Johnson": self.yeo_johnson_lambda}


def fit_transforms(df: DataFrame, value: str) -> FittedTransforms:
    """Sign gates, moments and lambdas of a column; only scalars reach the driver."""
    known = value_range(df, value)
    return FittedTransforms(
        value=value,
        mean=known["mean"],
        std=known["std"],
        all_positive=known["all_positive"],
        all_non_negative=known["all_non_negative"],
        box_cox_lambda=box_cox_fit(df, value, known) if known["all_positive"] else None,
        yeo_johnson_lambda=yeo_johnson_fit(df, value, known),
    )


def add_transforms(df: DataFrame, fitted: FittedTransforms) -> DataFrame:
    """Append every feasible transform as target_{name}."""
    return df.withColumns(
        {f"target_{snake_name(n)}": c for n, c in fitted.columns().items()}
    )


def best_first() -> list[Column]:
    """Highest p first; p-values equal but for rounding by name, undefined ones and zeros last."""
    return [F.round(F.log("p"), 6).desc_nulls_last(), F.col("transform")]


def compare_transforms(
    df: DataFrame,
    fitted: FittedTransforms,
    key_cols: Sequence[str],
    n: int = SAMPLE,
    seed: int = SEED,
    alpha: float = ALPHA,
) -> DataFrame:
    """Test the column and each transform on one and the same sample, best p first.

    The lambdas, mean and spread come from the whole column.
    """
    narrow = df.select(*key_cols, as_double(df, fitted.value).alias(fitted.value))
    sample = hash_sample(narrow.dropna(subset=[fitted.value]), key_cols, n, seed)
    variants = {"Original": F.col(fitted.value), **fitted.columns()}
    wide = sample.select(*(c.alias(name) for name, c in variants.items()))
    long = wide.unpivot([], [f"`{v}`" for v in variants], "transform", "value")
    lam = F.lit(None).cast("double")
    for name, known in fitted.lambdas().items():
        if known is not None:
            lam = F.when(F.col("transform") == name, F.lit(known)).otherwise(lam)
    tested = _test_groups(long, ["transform"], "value")
    return tested.select(
        "transform", lam.alias("lambda"), "n", "w", "p", verdict("p", alpha).alias("result")
    ).orderBy(*best_first())


def best_transforms(comparison: DataFrame, k: int = 1) -> DataFrame:
    """The k rows of a comparison with the highest p-value."""
    return comparison.orderBy(*best_first()).limit(k)
