"""Yearly group totals with lag and rolling features."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from statloom.functions.coerce import as_double
from statloom.operators.keyed import left_join


def yearly_totals(
    df: DataFrame, year: str, key: str, value: str, count: bool = True
) -> DataFrame:
    """Sum, mean and (if asked) count of a value per year and key; NaN is missing."""
    number = as_double(df, value)
    stats: list[Column] = [F.sum(number).alias("sum"), F.avg(number).alias("mean")]
    if count:
        stats.append(F.count(number).alias("count"))
    return df.dropna(subset=[year, key]).groupBy(year, key).agg(*stats)


def previous(column: str, key: str, year: str) -> Column:
    """The value of the key's previous existing year."""
    return F.lag(column, 1).over(Window.partitionBy(key).orderBy(year))


def rolling_mean_before(column: str, key: str, year: str, years: int = 3) -> Column:
    """Mean over up to ``years`` previous existing years of the same key."""
    span = Window.partitionBy(key).orderBy(year).rowsBetween(-years, -1)
    return F.avg(column).over(span)


def add_lags(
    df: DataFrame,
    year: str,
    key: str,
    value: str,
    prefix: str,
    features: Sequence[str] = ("lag1_sum", "roll3_sum", "lag1_mean"),
    totals_from: DataFrame | None = None,
) -> DataFrame:
    """Add lag and rolling features of the key's yearly totals.

    The windows run over one row per key and year, never over the rows themselves.
    ``totals_from`` may name a cheaper table with the same rows to total.
    """
    totals = yearly_totals(totals_from or df, year, key, value, count=False)
    made = {
        "lag1_sum": previous("sum", key, year),
        "roll3_sum": rolling_mean_before("sum", key, year, 3),
        "lag1_mean": previous("mean", key, year),
    }
    lags = totals.select(year, key, *(made[f].alias(f"{prefix}_{f}") for f in features))
    return left_join(df, lags, [year, key])
