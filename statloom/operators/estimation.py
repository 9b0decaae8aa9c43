"""Proportion, mean and variance estimators, and sample sizes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, GroupedData
from pyspark.sql import functions as F

from statloom.functions.coerce import as_double


def _grouped(df: DataFrame, group_cols: Sequence[str]) -> GroupedData:
    """Groups of the rows that have all keys."""
    return (df.dropna(subset=list(group_cols)) if group_cols else df).groupBy(*group_cols)


def estimators(
    df: DataFrame, value: str, flag: str, group_cols: Sequence[str] = ()
) -> DataFrame:
    """Share of a 0/1 flag, and mean and unbiased variance of a value; NaN is missing."""
    return _grouped(df, group_cols).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(as_double(df, flag)).alias("proportion"),
        F.avg(as_double(df, value)).alias("mean"),
        F.var_samp(as_double(df, value)).alias("variance"),
    )


def required_sample(z: float, p: Column, e: float) -> Column:
    """Sample size for a proportion p at normal quantile z and margin e."""
    return F.lit(z * z) * p * (1.0 - p) / F.lit(e * e)


def finite_correction(n: Column, population: Column, share: float = 0.05) -> Column:
    """Correct a sample size when it exceeds the given share of the population."""
    return F.when(n / population > share, n / (1.0 + (n - 1.0) / population)).otherwise(n)


def sample_size(
    df: DataFrame,
    flag: str,
    z: float = 1.96,
    e: float = 0.5,
    group_cols: Sequence[str] = (),
) -> DataFrame:
    """How many rows to sample to estimate a flag's share, per group."""
    base = _grouped(df, group_cols).agg(
        F.count(F.lit(1)).alias("population"), F.avg(as_double(df, flag)).alias("proportion")
    )
    sized = base.withColumn("n_raw", required_sample(z, F.col("proportion"), e))
    sized = sized.withColumn("n_adjusted", finite_correction(F.col("n_raw"), F.col("population")))
    return sized.withColumn("share_pct", F.col("n_adjusted") / F.col("population") * 100)
