"""Order without one-task windows: row numbers, quantiles and ranks of big groups.

A global order is a range-partitioned sort. Positions follow from each partition's
own order plus the totals of the partitions before it, so no task sees more than
its range, whatever the size of a group. Quantiles and ranks first count equal
values, so a heavily repeated value is one row before anything is shuffled by it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from statloom.functions.coerce import nan_to_null, quoted
from statloom.operators.keyed import any_null, left_join
from statloom.session import store

# The most rows of one group that a single task may sort or hold.
ROW_LIMIT = 2_000_000
# monotonically_increasing_id keeps the position within a partition in this many bits.
POSITION_BITS = 33


# --- row numbers -----------------------------------------------------------------


def _before(marked: DataFrame, amount: Column, name: str) -> DataFrame:
    """Add the sum of ``amount`` over all rows before each row of a stored sort.

    ``marked`` carries the sort's partition and position in ``_at``.
    """
    part = F.shiftright("_at", POSITION_BITS)
    # One row per partition of the sort.
    sums = marked.groupBy(part.alias("_part")).agg(F.sum(amount).alias("_sum"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select("_part", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_start"))
    inside = Window.partitionBy("_part").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    placed = marked.withColumn("_part", part).withColumn("_own", F.coalesce(F.sum(amount).over(inside), F.lit(0)))
    joined = placed.join(F.broadcast(starts), "_part")
    return joined.withColumn(name, F.col("_start") + F.col("_own")).drop("_part", "_start", "_own", "_at")


def sorted_once(df: DataFrame, order_cols: Sequence[str | Column]) -> DataFrame:
    """The sorted table, written once, with each row's partition and position in ``_at``.

    The sort runs before the write, so the numbers stay put when tasks rerun.
    """
    return store(df.orderBy(*order_cols).withColumn("_at", F.monotonically_increasing_id()), "sorted")


def row_ids(df: DataFrame, order_cols: Sequence[str | Column], name: str = "row_id") -> DataFrame:
    """Number all rows 0, 1, 2, ... in the given order, which must be total."""
    marked = sorted_once(df, order_cols)
    part = F.shiftright("_at", POSITION_BITS)
    position = F.col("_at").bitwiseAND((1 << POSITION_BITS) - 1)
    # One row per partition of the sort.
    sizes = marked.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_size"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        "_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start")
    )
    return (
        marked.withColumn("_part", part)
        .join(F.broadcast(starts), "_part")
        .withColumn(name, F.col("_start") + position)
        .drop("_part", "_start", "_at")
    )


# --- size checks -----------------------------------------------------------------


def fits_one_task(df: DataFrame, group_cols: Sequence[str], row_limit: int = ROW_LIMIT) -> bool:
    """Is every group small enough for one task? Costs one or two counting passes."""
    if df.count() <= row_limit:
        return True
    if not group_cols:
        return False
    counts = df.groupBy(*group_cols).agg(F.count(F.lit(1)).alias("_rows"))
    return (counts.agg(F.max("_rows")).first()[0] or 0) <= row_limit


# --- counted values --------------------------------------------------------------


def _present(df: DataFrame, value: str) -> Column:
    """The value, where NaN is missing like null."""
    c = F.col(quoted(value))
    return nan_to_null(c) if isinstance(df.schema[value].dataType, (T.FloatType, T.DoubleType)) else c


def value_positions(df: DataFrame, value: str, group_cols: Sequence[str], ties: str | None = None) -> DataFrame:
    """Per group and distinct value ``_v``: its rows ``_ties`` and the group's rows ``_lower`` below it.

    Any orderable type; the caller has removed missing values and keys. ``_lower`` counts
    over all groups in order: only its differences inside a group mean something. ``ties``
    names the column that says how many rows a row of ``df`` stands for.
    """
    rows = F.count(F.lit(1)) if ties is None else F.sum(ties)
    counts = df.groupBy(*group_cols, F.col(quoted(value)).alias("_v")).agg(rows.alias("_ties"))
    return _before(sorted_once(counts, [*group_cols, "_v"]), F.col("_ties"), "_lower")


def _group_starts(positions: DataFrame, group_cols: Sequence[str]) -> DataFrame:
    return positions.groupBy(*group_cols).agg(
        F.min("_lower").alias("_start"), F.sum("_ties").alias("_total"))


# --- quantiles -------------------------------------------------------------------


def percentile_columns(value: str, probs: Mapping[str, float]) -> list[Column]:
    """Exact interpolated quantiles as aggregates; only for groups that fit one task."""
    return [F.percentile(value, p).alias(name) for name, p in probs.items()]


def counted_quantiles(
    df: DataFrame, value: str, probs: Mapping[str, float], group_cols: Sequence[str] = (), ties: str | None = None
) -> DataFrame:
    """Exact interpolated quantiles of groups of any size, one row per group.

    Equal values are counted, the counts sorted by group and value over all tasks, and
    the values that hold a wanted order statistic are picked by their positions. ``ties``
    names the column that says how many rows a row of ``df`` stands for.
    """
    keys = list(group_cols) or ["_all"]
    narrow = df.withColumn("_all", F.lit(0)).select(*keys, _present(df, value).alias("_v"), *([ties] if ties else []))
    positions = value_positions(narrow.dropna(subset=["_v"]), "_v", keys, ties)
    starts = _group_starts(positions, keys)
    # The two order statistics around each quantile, with their weights.
    wanted = F.array(
        *(F.struct(F.lit(n).alias("name"), F.lit(float(p)).alias("p")) for n, p in probs.items())
    )
    at = F.col("want.p") * (F.col("_total") - 1)
    share = at - F.floor(at)
    ends = F.array(
        F.struct(F.floor(at).alias("k"), (1.0 - share).alias("weight")),
        F.struct((F.floor(at) + 1).alias("k"), share.alias("weight")),
    )
    targets = (
        starts.withColumn("want", F.explode(wanted))
        .withColumn("end", F.explode(ends))
        .filter(F.col("end.weight") > 0)
        .select(*keys, F.col("want.name").alias("_name"), F.col("end.weight").alias("_weight"),
                (F.col("_start") + F.col("end.k")).alias("_k"))
    )
    return _picked(positions, targets, keys, list(probs)).select(*group_cols, *probs)


def _picked(positions: DataFrame, targets: DataFrame, keys: Sequence[str], names: Sequence[str]) -> DataFrame:
    """Per group and name the weighted sum of the values at places ``_k`` of the sort.

    ``targets`` has keys, _name, _weight, _k.
    """
    targets = targets.groupBy(*keys).agg(
        F.collect_list(F.struct("_name", "_weight", "_k")).alias("_targets"))
    placed = left_join(positions, targets, keys)
    inside = lambda t: (t["_k"] >= F.col("_lower")) & (t["_k"] < F.col("_lower") + F.col("_ties"))
    found = placed.select(*keys, "_v", F.explode(F.filter("_targets", inside)).alias("t"))
    part = F.col("t._weight") * F.col("_v")
    return found.groupBy(*keys).agg(
        *(F.sum(F.when(F.col("t._name") == n, part)).alias(n) for n in names)
    )


def counted_halves(df: DataFrame, value: str, places: Sequence[str], group_cols: Sequence[str]) -> DataFrame:
    """Half the sum of a group's values at the given places, for groups of any size.

    ``places`` names columns, the same in all rows of a group, with a place in its order counted
    from 0, or null. Equal values are counted and sorted over all tasks.
    """
    keys = [*group_cols, *places]
    positions = value_positions(df, value, keys)
    ends = F.array(*(F.col(p) for p in places))
    targets = _group_starts(positions, keys).withColumn("_place", F.explode(ends)).dropna(subset=["_place"]).select(
        *keys, F.lit("half").alias("_name"), F.lit(0.5).alias("_weight"), (F.col("_start") + F.col("_place")).alias("_k"))
    # A place may be null, which no join matches, so a struct is the key.
    group = F.struct(*keys).alias("_group")
    found = _picked(positions.select(group, "_v", "_lower", "_ties"),
                    targets.select(group, "_name", "_weight", "_k"), ["_group"], ["half"])
    return found.select(*(F.col(f"_group.{c}") for c in group_cols), "half")


def grouped_stats(
    df: DataFrame,
    value: str,
    aggregates: Sequence[Column],
    probs: Mapping[str, float],
    group_cols: Sequence[str] = (),
    row_limit: int = ROW_LIMIT,
) -> DataFrame:
    """Aggregates and exact quantiles of one column, one row per group without missing keys.

    Both ways to the quantiles skip null and NaN and give the same numbers.
    """
    df = df.dropna(subset=list(group_cols)) if group_cols else df
    if isinstance(df.schema[value].dataType, (T.FloatType, T.DoubleType)):
        df = df.withColumn(value, nan_to_null(F.col(quoted(value))))
    grouped = df.groupBy(*group_cols)
    if not probs or fits_one_task(df, group_cols, row_limit):
        return grouped.agg(*aggregates, *percentile_columns(value, probs))
    quantiles = counted_quantiles(df, value, probs, group_cols)
    base = grouped.agg(*aggregates)
    if group_cols:
        # One row per group on both sides, so no key can be hot.
        return base.join(quantiles, list(group_cols), "left")
    row = quantiles.select(F.struct(*probs)).scalar()
    return base.select("*", *(row[n].alias(n) for n in probs))


def counted_median(counts: DataFrame, value: str, ties: str, group_cols: Sequence[str]) -> DataFrame:
    """The exact median per group of values that stand for ``ties`` rows each; a group's values fit one task."""
    group = Window.partitionBy(*group_cols)
    upto = group.orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    placed = counts.select(*group_cols, value, ties, F.sum(ties).over(upto).alias("_upto"), F.sum(ties).over(group).alias("_total"))
    # The middle places, counted from 0: one or two.
    covers = [(F.col("_upto") > p) & (F.col("_upto") - F.col(ties) <= p)
              for p in (F.floor((F.col("_total") - 1) / 2), F.floor(F.col("_total") / 2))]
    half = [F.when(c, F.col(value) / 2) for c in covers]
    return placed.filter(covers[0] | covers[1]).groupBy(*group_cols).agg(
        (F.sum(half[0]) + F.sum(half[1])).alias("median"))


# --- ranks -----------------------------------------------------------------------


def percent_rank_average(
    df: DataFrame,
    value: str,
    group_cols: Sequence[str],
    name: str = "rank_pct",
    row_limit: int = ROW_LIMIT,
) -> DataFrame:
    """Rank within the group over the group's size, ties sharing their mean rank.

    Any orderable type. A missing value (null or NaN) or key has no rank and counts for
    none. Groups that fit one task are ranked by a window, others by counted values.
    """
    keys = list(group_cols)
    clean = _present(df, value)
    present = clean.isNotNull() & ~any_null(keys)
    ranked = df.filter(present)
    if fits_one_task(ranked, keys, row_limit):
        group = Window.partitionBy(*keys)
        ties = F.count(F.lit(1)).over(Window.partitionBy(*keys, quoted(value)))
        mean_rank = F.rank().over(group.orderBy(quoted(value))) + (ties - 1) / 2
        in_group = ranked.withColumn(name, mean_rank / F.count(F.lit(1)).over(group))
        return in_group.unionByName(df.filter(~present).withColumn(name, F.lit(None).cast("double")))
    positions = store(value_positions(ranked, value, keys), "positions")
    values = left_join(positions, _group_starts(positions, keys), keys)
    below = F.col("_lower") - F.col("_start")
    ranks = values.select(
        *keys, F.col("_v").alias("_value"), ((below + (F.col("_ties") + 1) / 2) / F.col("_total")).alias(name)
    )
    joined = left_join(df.withColumn("_value", clean), ranks, [*keys, "_value"])
    return joined.drop("_value")
