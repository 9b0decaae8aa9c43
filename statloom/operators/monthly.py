"""Monthly group totals with calendar lags, rolling means and seasonal shares."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from statloom.functions.coerce import as_double, quoted
from statloom.operators.keyed import left_join

LAGS = (1, 12)
SPANS = (3, 12)


def month_number(date: str | Column) -> Column:
    """Months since year 0, so that neighbouring months differ by one."""
    c = F.col(quoted(date)) if isinstance(date, str) else date
    return (F.year(c) * 12 + F.month(c) - 1).cast("int")


def monthly_totals(df: DataFrame, date: str, key: str, value: str, month: str = "month") -> DataFrame:
    """Sum, mean and count of a value per key and month; NaN is missing, rows without date or key are left out."""
    rows = df.select(month_number(date).alias(month), F.col(quoted(key)).alias(key), as_double(df, value).alias("_v"))
    return rows.dropna(subset=[month, quoted(key)]).groupBy(month, quoted(key)).agg(
        F.coalesce(F.sum("_v"), F.lit(0.0)).alias("sum"), F.avg("_v").alias("mean"), F.count("_v").alias("count"))


def monthly_lags(totals: DataFrame, key: str, prefix: str, lags: Sequence[int] = LAGS, spans: Sequence[int] = SPANS,
                 month: str = "month") -> DataFrame:
    """Features of each key and month from the key's earlier months alone.

    ``{prefix}_lag{k}``: total of the month k before. ``{prefix}_mean{n}``: mean total of the n
    months before. ``{prefix}_active{n}``: how many of them have rows. ``{prefix}_gap``: months since
    the key's last one with rows. ``{prefix}_seasonal``: share of the same calendar month in all
    earlier totals. Months without rows count as 0 from the key's first month on; what lies
    before that is unknown: null, and left out of means.

    Windows run over one row per key and month, so a key of any size is as short as the calendar.
    """
    group = Window.partitionBy(quoted(key))
    over = group.orderBy(month)
    earlier = over.rowsBetween(Window.unboundedPreceding, -1)
    known = F.col(month) - F.min(month).over(group)
    made = {}
    for k in lags:
        total = F.sum("sum").over(over.rangeBetween(-k, -k))
        made[f"lag{k}"] = F.when(known >= k, F.coalesce(total, F.lit(0.0)))
    for n in spans:
        before = over.rangeBetween(-n, -1)
        made[f"mean{n}"] = F.when(known > 0, F.sum("sum").over(before) / F.least(known, F.lit(n)))
        made[f"mean{n}"] = F.when(known > 0, F.coalesce(made[f"mean{n}"], F.lit(0.0)))
        made[f"active{n}"] = F.count("sum").over(before)
    made["gap"] = F.col(month) - F.max(month).over(earlier)
    same = Window.partitionBy(quoted(key), F.col(month) % 12).orderBy(month).rowsBetween(Window.unboundedPreceding, -1)
    share = F.try_divide(F.coalesce(F.sum("sum").over(same), F.lit(0.0)), F.sum("sum").over(earlier))
    made["seasonal"] = share
    return totals.select(month, quoted(key), *(c.alias(f"{prefix}_{name}") for name, c in made.items()))


def add_monthly_lags(df: DataFrame, date: str, key: str, value: str, prefix: str, lags: Sequence[int] = LAGS,
                     spans: Sequence[int] = SPANS, totals_from: DataFrame | None = None) -> DataFrame:
    """Add ``monthly_lags`` to every row by its key and month; rows without date or key get nulls.

    ``totals_from`` may name a cheaper table with the same rows to total.
    """
    month = f"_{prefix}_month"
    made = monthly_lags(monthly_totals(totals_from or df, date, key, value, month), key, prefix, lags, spans, month)
    return left_join(df.withColumn(month, month_number(date)), made, [month, key]).drop(month)
