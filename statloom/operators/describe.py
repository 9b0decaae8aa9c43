"""Descriptive statistics, quality counts and before/after comparison."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statloom.functions.coerce import as_double, quoted
from statloom.operators.ordering import ROW_LIMIT, grouped_stats

QUARTILES = {"q1": 0.25, "median": 0.5, "q3": 0.75}


def sample_skewness(c: str) -> Column:
    """Bias-corrected skewness; null below three values or without spread."""
    n = F.count(c).cast("double")
    return F.when(
        (n > 2) & (F.stddev_pop(c) > 0), F.skewness(c) * F.sqrt(n * (n - 1)) / (n - 2)
    )


def sample_kurtosis(c: str) -> Column:
    """Bias-corrected excess kurtosis; null below four values or without spread."""
    n = F.count(c).cast("double")
    corrected = (n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * F.kurtosis(c) + 6)
    return F.when((n > 3) & (F.stddev_pop(c) > 0), corrected)


def unpivot_numbers(
    df: DataFrame, columns: Sequence[str], keep: Sequence[str] = ()
) -> DataFrame:
    """One row per (kept columns, variable, value), values as nullable doubles."""
    wide = df.select(*(quoted(k) for k in keep), *(as_double(df, c).alias(c) for c in columns))
    return wide.unpivot([quoted(k) for k in keep], [quoted(c) for c in columns], "variable", "value")


def describe(
    df: DataFrame,
    columns: Sequence[str],
    group_cols: Sequence[str] = (),
    quartiles: bool = True,
    row_limit: int = ROW_LIMIT,
) -> DataFrame:
    """Moments and quantiles, one row per group and column.

    All columns go through one aggregation, so the plan does not grow with them.
    With quartiles the row also holds q1, q3, iqr and the coefficient of variation.
    """
    aggregates = [
        F.count("value").alias("n"),
        F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
        sample_skewness("value").alias("skew"),
        sample_kurtosis("value").alias("kurtosis"),
    ]
    keys = [*group_cols, "variable"]
    probs = QUARTILES if quartiles else {"median": 0.5}
    long = unpivot_numbers(df, columns, group_cols)
    stats = grouped_stats(long, "value", aggregates, probs, keys, row_limit)
    chosen = ["n", "mean", "median", "std", "min", "max"]
    if quartiles:
        stats = stats.withColumns(
            {"iqr": F.col("q3") - F.col("q1"), "cv": F.try_divide(F.col("std"), F.col("mean"))}
        )
        return stats.select(*keys, *chosen, "q1", "q3", "iqr", "skew", "kurtosis", "cv")
    return stats.select(*keys, *chosen, "skew", "kurtosis")


def closeness_gain(before: Column, after: Column) -> Column:
    """By how many percent the magnitude shrank; null when it was 0."""
    return F.try_divide(F.abs(before) - F.abs(after), F.abs(before)) * 100


def compare(
    df: DataFrame, before: str, after: str, row_limit: int = ROW_LIMIT
) -> DataFrame:
    """The statistics of two columns side by side.

    Skewness and kurtosis also get the gain in percent and whether they came
    closer to 0; the gain is null where the value before was 0.
    """
    stats = describe(df, [before, after], row_limit=row_limit)
    names = [c for c in stats.columns if c not in ("variable", "n")]
    long = stats.unpivot(["variable"], names, "statistic", "value")
    side = long.groupBy("statistic").agg(
        F.max(F.when(F.col("variable") == before, F.col("value"))).alias("before"),
        F.max(F.when(F.col("variable") == after, F.col("value"))).alias("after"),
    )
    shape = F.col("statistic").isin("skew", "kurtosis")
    return side.withColumns(
        {
            "improvement_pct": F.when(shape, closeness_gain(F.col("before"), F.col("after"))),
            "closer_to_zero": F.when(shape, F.abs("after") < F.abs("before")),
        }
    )


def profile(df: DataFrame) -> DataFrame:
    """Row count and column count."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn(
        "n_columns", F.lit(len(df.columns)).cast("bigint")
    )


def quality(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Missing and infinite values per column, in one scan."""
    wide = df.select(*(as_double(df, c).alias(c) for c in columns))
    long = wide.unpivot([], [quoted(c) for c in columns], "variable", "value")
    return long.groupBy("variable").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col("value").isNull()).alias("n_null"),
        F.count_if(F.abs("value") == float("inf")).alias("n_infinite"),
    )


def same_rows(before: DataFrame, after: DataFrame) -> DataFrame:
    """Row counts of two tables and whether they agree."""
    a = before.agg(F.count(F.lit(1)).alias("rows_before"))
    b = after.agg(F.count(F.lit(1)).alias("rows_after")).select("rows_after").scalar()
    return a.withColumn("rows_after", b).withColumn(
        "rows_kept", F.col("rows_before") == F.col("rows_after")
    )
