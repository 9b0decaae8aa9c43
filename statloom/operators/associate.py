"""Pearson correlation of many columns, in long tables that do not widen the plan."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from statloom.functions.coerce import as_double, quoted


# Spread below this share of the mean is rounding, as among means of equal values.
STILL = 1e-13
# Correlations that agree to so many digits are ranked as equal.
TIE_DIGITS = 10


def guarded_corr(x: str, y: str) -> Column:
    """Aggregate: Pearson r over complete pairs, null where a column is constant."""
    both = F.col(x).isNotNull() & F.col(y).isNotNull()
    px, py = F.when(both, F.col(x)), F.when(both, F.col(y))
    moves = [F.stddev_pop(p) > F.abs(F.avg(p)) * STILL for p in (px, py)]
    return F.when(moves[0] & moves[1],
                  F.try_divide(F.covar_pop(px, py), F.stddev_pop(px) * F.stddev_pop(py)))


def corr_with_target(
    df: DataFrame, columns: Sequence[str], target: str, group_cols: Sequence[str] = ()
) -> DataFrame:
    """r of each column with the target: (groups, variable, n, r), one row per column.

    Without groups one pass gives every task's moments of each column with the target, which
    are merged. Within groups rows are unpivoted inside each task and reduced before the shuffle.
    """
    if not group_cols:
        return _corr_with_target(df, [c for c in columns if c != target], target)
    wide = df.select(
        *group_cols,
        as_double(df, target).alias("_target"),
        *(as_double(df, c).alias(c) for c in columns if c != target),
    )
    if group_cols:
        wide = wide.dropna(subset=list(group_cols))
    names = [quoted(c) for c in columns if c != target]
    long = wide.unpivot([*group_cols, "_target"], names, "variable", "value")
    complete = F.col("value").isNotNull() & F.col("_target").isNotNull()
    return long.groupBy(*group_cols, "variable").agg(
        F.count_if(complete).alias("n"), guarded_corr("value", "_target").alias("r")
    )


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def rank_by_magnitude(corr: DataFrame) -> DataFrame:
    """Strongest first whatever the sign, undefined last, ties by name.

    Correlations that differ by rounding alone, as of two encodings that are functions of
    each other, are ties.
    """
    return corr.orderBy(F.round(F.abs("r"), TIE_DIGITS).desc_nulls_last(), "variable")


def rank_signed(corr: DataFrame) -> DataFrame:
    """Largest r first, undefined last, ties (up to rounding) by name."""
    return corr.orderBy(F.round("r", TIE_DIGITS).desc_nulls_last(), "variable")


def corr_all_numeric(df: DataFrame, target: str) -> DataFrame:
    """Signed ranking of every numeric column against the target."""
    return rank_signed(corr_with_target(df, numeric_columns(df), target))


def with_selection(corr: DataFrame, threshold: float = 0.3) -> DataFrame:
    """Mark the variables with |r| above the threshold; an undefined r is not selected."""
    chosen = F.coalesce(F.abs("r") > threshold, F.lit(False))
    return corr.withColumn("selected", chosen)


def _against_last(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each column with the last one, over their complete rows: n, means, squares and products about them.

    Sums are taken about the means of the task's first batch, so none of them cancels.
    """
    centre, sums = None, None
    for batch in batches:
        x = np.column_stack([c.to_numpy(zero_copy_only=False).astype(float) for c in batch.columns])
        there, endless = ~np.isnan(x), np.isinf(x)
        value = np.where(there & ~endless, x, 0.0)
        if centre is None:
            centre = value.sum(axis=0) / np.maximum(1, (there & ~endless).sum(axis=0))
            sums = np.zeros((7, x.shape[1] - 1))
        value = np.where(there & ~endless, value - centre, 0.0)
        mask, value, hit = there[:, :-1].astype(float), value[:, :-1], value[:, -1]
        seen = there[:, -1].astype(float)
        sums += [seen @ mask, seen @ value, hit @ mask, seen @ (value * value), (hit * hit) @ mask, hit @ value,
                 seen @ endless[:, :-1] + endless[:, -1].astype(float) @ mask]
    if centre is not None:
        n, sx, sy, sxx, syy, sxy, bad = sums
        i = np.flatnonzero(n)
        n, sx, sy, sxx, syy, sxy, bad = (a[i] for a in (n, sx, sy, sxx, syy, sxy, bad))
        # An infinite value makes the moments of its pair NaN.
        wrong = np.where(bad > 0, np.nan, 0.0)
        yield pa.RecordBatch.from_arrays(
            [pa.array(i.astype(np.int32)), pa.array(n.astype(np.int64)), pa.array(centre[:-1][i] + sx / n + wrong),
             pa.array(centre[-1] + sy / n + wrong), pa.array(sxx - sx * sx / n + wrong), pa.array(syy - sy * sy / n + wrong),
             pa.array(sxy - sx * sy / n + wrong)], names=["i", "n", "mx", "my", "vx", "vy", "c"])


def _corr_with_target(df: DataFrame, names: Sequence[str], target: str) -> DataFrame:
    wide = df.select(*(as_double(df, c).alias(f"_c{k}") for k, c in enumerate([*names, target])))
    parts = wide.mapInArrow(_against_last, "i int, n long, mx double, my double, vx double, vy double, c double")
    column = Window.partitionBy("i")  # one row per task and column
    rows = F.sum("n").over(column)
    parts = parts.select("*", *((F.sum(F.col("n") * F.col(m)).over(column) / rows).alias(f"a{m}") for m in ("mx", "my")))
    dx, dy = F.col("mx") - F.col("amx"), F.col("my") - F.col("amy")
    total = parts.groupBy("i").agg(
        F.sum("n").alias("n"), F.first("amx").alias("amx"), F.first("amy").alias("amy"),
        F.sum(F.col("vx") + F.col("n") * dx * dx).alias("vx"), F.sum(F.col("vy") + F.col("n") * dy * dy).alias("vy"),
        F.sum(F.col("c") + F.col("n") * dx * dy).alias("c"))
    moves = [F.sqrt(F.greatest(F.col(v), F.lit(0.0)) / F.col("n")) > F.abs(F.col(m)) * STILL for v, m in (("vx", "amx"), ("vy", "amy"))]
    r = F.when(moves[0] & moves[1], F.try_divide(F.col("c"), F.sqrt(F.col("vx")) * F.sqrt(F.col("vy"))))
    every = df.sparkSession.createDataFrame(list(enumerate(names)), "i int, variable string")
    # A column without any complete pair has no moments.
    return every.join(total.select("i", "n", r.alias("r")), "i", "left").select(
        "variable", F.coalesce("n", F.lit(0)).alias("n"), "r")


def _gram(width: int):
    """Sums over the rows where both columns of a pair are present, as matrix products.

    One row per task and pair leaves: counts, sums of either column, of squares and of
    products. An infinite value turns the sums of its pairs to NaN and no others.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((6, width, width))
        for batch in batches:
            x = np.column_stack([c.to_numpy(zero_copy_only=False).astype(float) for c in batch.columns])
            there = ~np.isnan(x)
            endless = np.isinf(x)
            value = np.where(there & ~endless, x, 0.0)
            mask = there.astype(float)
            sums[0] += mask.T @ mask
            sums[1] += value.T @ mask
            sums[2] += (value * value).T @ mask
            sums[3] += value.T @ value
            if endless.any():
                hit = endless.astype(float).T @ mask
                sums[4] += hit + hit.T
        i, j = np.triu_indices(width)
        bad = np.where(sums[4][i, j] > 0, np.nan, 0.0)
        yield pa.RecordBatch.from_arrays(
            [pa.array(v) for v in (
                i.astype(np.int32), j.astype(np.int32), sums[0][i, j].astype(np.int64), sums[1][i, j] + bad,
                sums[1][j, i] + bad, sums[2][i, j] + bad, sums[2][j, i] + bad, sums[3][i, j] + bad)],
            names=["i", "j", "n", "sx", "sy", "sxx", "syy", "sxy"])

    return run


def pair_moments(df: DataFrame, columns: Sequence[str], diagonal: bool = False) -> DataFrame:
    """Moments of every unordered pair of columns over their complete rows.

    Gives (i, j, n, mean_i, mean_j, cov, std_i, std_j), i < j by position in ``columns``.
    Columns are centred at their means first, then one scan multiplies matrices inside each
    task; the shuffle holds one row per pair and task.
    """
    names = list(columns)
    wide = df.select(*(as_double(df, c).alias(f"_c{k}") for k, c in enumerate(names)))
    finite = [F.when(F.abs(f"_c{k}") < float("inf"), F.col(f"_c{k}")) for k in range(len(names))]
    means = wide.agg(*(F.avg(c).alias(f"_c{k}") for k, c in enumerate(finite))).first()
    centre = [m if m is not None and math.isfinite(m) else 0.0 for m in means]
    centred = wide.select(*((F.col(f"_c{k}") - F.lit(m)).alias(f"_c{k}") for k, m in enumerate(centre)))
    parts = centred.mapInArrow(
        _gram(len(names)), "i int, j int, n long, sx double, sy double, sxx double, syy double, sxy double")
    sums = parts.groupBy("i", "j").agg(*(F.sum(c).alias(c) for c in ("n", "sx", "sy", "sxx", "syy", "sxy")))
    sums = sums.filter("n > 0" if diagonal else "n > 0 AND i < j")
    shift = F.array(*map(F.lit, centre))
    mean_x, mean_y = F.col("sx") / F.col("n"), F.col("sy") / F.col("n")
    spread = lambda ss, m: F.sqrt(F.greatest(F.lit(0.0), ss / F.col("n") - m * m))
    # A constant column differs from its mean by rounding alone, which is no spread.
    still = lambda ss, m, c: F.when(
        F.abs(ss / F.col("n") - m * m) <= F.lit(STILL**2) * c * c, 0.0).otherwise(spread(ss, m))
    return sums.select(
        "i", "j", "n",
        (F.get(shift, F.col("i")) + mean_x).alias("mean_i"),
        (F.get(shift, F.col("j")) + mean_y).alias("mean_j"),
        (F.col("sxy") / F.col("n") - mean_x * mean_y).alias("cov"),
        still(F.col("sxx"), mean_x, F.get(shift, F.col("i"))).alias("std_i"),
        still(F.col("syy"), mean_y, F.get(shift, F.col("j"))).alias("std_j"),
    )


def corr_pairs(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """r of every unordered pair of columns: (var_a, var_b, n, r)."""
    names = F.array(*(F.lit(c) for c in columns))
    return pair_moments(df, columns).select(
        F.get(names, F.col("i")).alias("var_a"),
        F.get(names, F.col("j")).alias("var_b"),
        "n",
        F.try_divide(F.col("cov"), F.col("std_i") * F.col("std_j")).alias("r"),
    )


def collinear_pairs(
    df: DataFrame, columns: Sequence[str], threshold: float = 0.85
) -> DataFrame:
    """Pairs with |r| above the threshold, strongest first: (var_a, var_b, abs_r)."""
    strong = corr_pairs(df, columns).filter(F.abs("r") > threshold)
    return strong.select("var_a", "var_b", F.abs("r").alias("abs_r")).orderBy(
        F.round("abs_r", TIE_DIGITS).desc(), "var_a", "var_b"
    )
