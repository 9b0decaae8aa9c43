"""The data behind distribution plots: histograms, boxes, densities and Q-Q points."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from statloom.functions.coerce import as_double
from statloom.functions.normal import normal_density, normal_quantile
from statloom.operators.keyed import attach
from statloom.operators.ordering import ROW_LIMIT, grouped_stats, row_ids

GRID_POINTS = 100
# The plotting positions of Filliben's order-statistic medians.
FILLIBEN_SHIFT, FILLIBEN_EXTRA = 0.3175, 0.365


def _values(df: DataFrame, value: str, group_cols: Sequence[str]) -> DataFrame:
    narrow = df.select(*group_cols, as_double(df, value).alias("_v"))
    return narrow.dropna(subset=[*group_cols, "_v"])


def _spread_stats(values: DataFrame, group_cols: Sequence[str]) -> DataFrame:
    return values.groupBy(*group_cols).agg(
        F.count("_v").alias("_n"),
        F.avg("_v").alias("_mean"),
        F.stddev_samp("_v").alias("_std"),
        F.min("_v").alias("_lo"),
        F.max("_v").alias("_hi"),
    )


# --- histogram -------------------------------------------------------------------


def histogram(
    df: DataFrame, value: str, bins: int = 50, group_cols: Sequence[str] = ()
) -> DataFrame:
    """Equal-width histogram with counts and densities; empty bins are kept.

    Bins are closed on the left, the last one on both sides. A constant column
    gets a range of width 1 around it.
    """
    values = _values(df, value, group_cols)
    flat = F.col("_lo") == F.col("_hi")
    ranges = values.groupBy(*group_cols).agg(
        F.count("_v").alias("_n"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi")
    ).withColumns(
        {
            "_lo": F.when(flat, F.col("_lo") - 0.5).otherwise(F.col("_lo")),
            "_hi": F.when(flat, F.col("_hi") + 0.5).otherwise(F.col("_hi")),
        }
    ).withColumn("_width", (F.col("_hi") - F.col("_lo")) / bins)
    placed = attach(values, ranges, group_cols).select(
        *group_cols,
        F.least(F.floor((F.col("_v") - F.col("_lo")) / F.col("_width")), F.lit(bins - 1))
        .cast("int")
        .alias("bin"),
    )
    counts = placed.groupBy(*group_cols, "bin").agg(F.count(F.lit(1)).alias("_count"))
    # ``bins`` rows per group on both sides.
    frame = ranges.withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
    count = F.coalesce("_count", F.lit(0))
    return frame.join(counts, [*group_cols, "bin"], "left").select(
        *group_cols,
        "bin",
        (F.col("_lo") + F.col("bin") * F.col("_width")).alias("lower"),
        (F.col("_lo") + (F.col("bin") + 1) * F.col("_width")).alias("upper"),
        count.alias("count"),
        (count / (F.col("_n") * F.col("_width"))).alias("density"),
    )


# --- box plot --------------------------------------------------------------------


def _fences(
    values: DataFrame, group_cols: Sequence[str], row_limit: int
) -> DataFrame:
    probs = {"q1": 0.25, "median": 0.5, "q3": 0.75}
    quartiles = grouped_stats(
        values, "_v", [F.count("_v").alias("n")], probs, group_cols, row_limit
    )
    reach = (F.col("q3") - F.col("q1")) * 1.5
    return quartiles.withColumns(
        {"_low_fence": F.col("q1") - reach, "_high_fence": F.col("q3") + reach}
    )


def box_stats(
    df: DataFrame, value: str, group_cols: Sequence[str] = (), row_limit: int = ROW_LIMIT
) -> DataFrame:
    """Quartiles, whiskers (extreme data within 1.5 IQR of the box) and outlier count."""
    values = _values(df, value, group_cols)
    fenced = attach(values, _fences(values, group_cols, row_limit), group_cols)
    v = F.col("_v")
    # The whiskers never end inside the box.
    low = F.min(F.when(v >= F.col("_low_fence"), v))
    high = F.max(F.when(v <= F.col("_high_fence"), v))
    keys = [*group_cols, "n", "q1", "median", "q3"]
    return fenced.groupBy(*keys).agg(
        F.least(low, F.col("q1")).alias("whisker_low"),
        F.greatest(high, F.col("q3")).alias("whisker_high"),
        F.count_if((v < F.col("_low_fence")) | (v > F.col("_high_fence"))).alias("n_outliers"),
    )


def box_outliers(
    df: DataFrame, value: str, group_cols: Sequence[str] = (), row_limit: int = ROW_LIMIT
) -> DataFrame:
    """The rows beyond the whiskers, with all their columns."""
    values = _values(df, value, group_cols)
    fences = _fences(values, group_cols, row_limit).select(
        *group_cols, "_low_fence", "_high_fence"
    )
    v = as_double(df, value)
    outside = attach(df, fences, group_cols).filter(
        (v < F.col("_low_fence")) | (v > F.col("_high_fence"))
    )
    return outside.select(*df.columns)


# --- densities -------------------------------------------------------------------


def _grid(stats: DataFrame, points: int) -> DataFrame:
    """``points`` evenly spaced positions from minimum to maximum, per stats row."""
    step = (F.col("_hi") - F.col("_lo")) / (points - 1)
    return stats.withColumn("point", F.explode(F.sequence(F.lit(0), F.lit(points - 1)))).withColumn(
        "x", F.col("_lo") + F.col("point") * step
    )


def normal_overlay(
    df: DataFrame, value: str, group_cols: Sequence[str] = (), points: int = GRID_POINTS
) -> DataFrame:
    """Density of the fitted normal distribution on a minimum-to-maximum grid."""
    stats = _spread_stats(_values(df, value, group_cols), group_cols)
    return _grid(stats, points).select(
        *group_cols,
        "point",
        "x",
        normal_density(F.col("x"), F.col("_mean"), F.col("_std")).alias("density"),
    )


# Rows whose kernels are evaluated together, and groups a task sums before it hands them on.
KERNEL_ROWS, KERNEL_GROUPS = 10_000, 10_000


def _kernel_sums(group_cols: Sequence[str], points: int):
    """Per task, group and grid point the sum of the kernels of the task's rows."""
    keys = list(group_cols)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[tuple, np.ndarray] = {}

        def hand_on() -> pd.DataFrame:
            rows = [[*key, point, float(x)] for key, row in sums.items() for point, x in enumerate(row)]
            return pd.DataFrame(rows, columns=[*keys, "point", "_sum"])

        for batch in batches:
            parts = batch.groupby(keys, sort=False) if keys else [((), batch)]
            for key, part in parts:
                low, high, h = (float(part[c].iloc[0]) for c in ("_lo", "_hi", "_h"))
                if not h > 0:
                    continue
                grid = low + np.arange(points) * ((high - low) / (points - 1))
                into = sums.setdefault(key, np.zeros(points))
                values = part["_v"].to_numpy(float)
                for at in range(0, len(values), KERNEL_ROWS):
                    z = (grid - values[at:at + KERNEL_ROWS, None]) / h
                    into += np.exp(z * z * -0.5).sum(axis=0)
            if len(sums) >= KERNEL_GROUPS:
                yield hand_on()
                sums = {}
        if sums:
            yield hand_on()

    return run


def kernel_density(
    df: DataFrame, value: str, group_cols: Sequence[str] = (), points: int = GRID_POINTS
) -> DataFrame:
    """Gaussian kernel density with Scott's bandwidth on a minimum-to-maximum grid.

    Every row adds to each grid point inside its own task; partial sums leave
    ``points`` rows per task and group, so the shuffle does not grow with the rows.
    Without spread there is no density.
    """
    values = _values(df, value, group_cols)
    stats = _spread_stats(values, group_cols).withColumn(
        "_h", F.col("_std") * F.pow(F.col("_n").cast("double"), F.lit(-0.2))
    )
    keys = list(group_cols)
    pieces = attach(values, stats, keys).select(*keys, "_v", "_lo", "_hi", "_h")
    fields = [pieces.schema[k] for k in keys] + [
        T.StructField("point", T.IntegerType()), T.StructField("_sum", T.DoubleType())]
    sums = pieces.mapInPandas(_kernel_sums(keys, points), T.StructType(fields))
    sums = sums.groupBy(*keys, "point").agg(F.sum("_sum").alias("_sum"))
    scale = F.col("_n") * F.col("_h") * math.sqrt(2.0 * math.pi)
    return _grid(stats.filter("_n > 0"), points).join(sums, [*keys, "point"], "left").select(
        *keys,
        "point",
        "x",
        F.try_divide(F.col("_sum"), scale).alias("density"),
    )


def violin_marks(
    df: DataFrame, value: str, group_cols: Sequence[str] = (), row_limit: int = ROW_LIMIT
) -> DataFrame:
    """The mean and the median that a violin plot marks on its curve."""
    values = _values(df, value, group_cols)
    return grouped_stats(
        values, "_v", [F.count("_v").alias("n"), F.avg("_v").alias("mean")], {"median": 0.5}, group_cols, row_limit
    )


# --- Q-Q -------------------------------------------------------------------------


def median_position(i: Column, n: Column) -> Column:
    """Median of the i-th of n uniform order statistics, i from 1 (Filliben)."""
    last = F.pow(F.lit(0.5), 1.0 / n)
    inner = (i - FILLIBEN_SHIFT) / (n + FILLIBEN_EXTRA)
    return F.when(i == n, last).when(i == 1, 1.0 - last).otherwise(inner)


def qq_points(df: DataFrame, value: str, tie_break: Sequence[str]) -> DataFrame:
    """Ordered values against the normal quantiles of their positions.

    The order is a range-partitioned sort; equal values are interchangeable, but the
    ``tie_break`` columns let a heavily repeated value spread over tasks.
    """
    if not tie_break:
        raise ValueError("a tie break is needed, or one task gets all rows of a repeated value")
    narrow = df.select(as_double(df, value).alias("observed"), *tie_break)
    ordered = row_ids(narrow.dropna(subset=["observed"]), ["observed", *tie_break])
    n = F.lit(float(ordered.count()))
    i = F.col("row_id") + F.lit(1)
    placed = ordered.select(
        i.alias("position"), median_position(i.cast("double"), n).alias("_p"), "observed"
    )
    return placed.select("position", normal_quantile(F.col("_p")).alias("theoretical"), "observed")


def qq_line(points: DataFrame) -> DataFrame:
    """Least-squares line through the Q-Q points and their correlation."""
    x, y = F.col("theoretical"), F.col("observed")
    spread = F.stddev_pop(x) * F.stddev_pop(y)
    return points.agg(
        F.count(F.lit(1)).alias("n"),
        F.regr_slope(y, x).alias("slope"),
        F.regr_intercept(y, x).alias("intercept"),
        F.try_divide(F.covar_pop(x, y), spread).alias("r"),
    )


def adherence(w: Column | str, threshold: float = 0.99) -> Column:
    """Label for how well the Q-Q points follow the line, from the W statistic."""
    w = F.col(w) if isinstance(w, str) else w
    return F.when(w > threshold, "good").when(w.isNotNull(), "fair")
