"""Reproducible exact-size samples and systematic samples."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from statloom.operators.keyed import left_join
from statloom.operators.ordering import row_ids
from statloom.session import materialise

SEED = 42
# Leading hex digits of the hash that decide the cut.
DIGITS = 12


def sample_hash(key_cols: Sequence[str], seed: int = SEED) -> Column:
    """The md5 that orders rows for sampling: of the key values and the seed, joined by |."""
    return F.md5(F.concat_ws("|", *(F.col(k).cast("string") for k in key_cols), F.lit(str(seed))))


def _cut(share: Column) -> Column:
    """Hex digits below which about ``share`` of all hashes fall."""
    return F.lower(F.lpad(F.hex((share * float(16**DIGITS)).cast("bigint")), DIGITS, "0"))


def hash_sample(
    df: DataFrame,
    key_cols: Sequence[str],
    n: int,
    seed: int = SEED,
    group_cols: Sequence[str] = (),
) -> DataFrame:
    """The ``n`` rows (per group) with the smallest hash: exact, seeded, repeatable.

    ``key_cols`` must identify a row. Hashes are uniform, so a cut slightly above
    n / size keeps about n rows of a group whatever its size, without a shuffle;
    only those are ranked. Should a cut ever keep too few, it is widened.
    """
    groups = list(group_cols) or ["_all"]
    rows = df if group_cols else df.withColumn("_all", F.lit(0))
    rows = rows.dropna(subset=groups)
    sizes = materialise(rows.groupBy(*groups).agg(F.count(F.lit(1)).cast("double").alias("_size")))
    count = sizes.count()
    hashed = rows.withColumn("_hash", sample_hash(key_cols, seed))
    slack = 1.0
    while True:
        room = n + slack * (6.0 * n**0.5 + 20.0)
        share = room / F.col("_size")
        cuts = sizes.select(*groups, "_size", F.when(share < 1.0, _cut(share)).alias("_cut"))
        kept = left_join(hashed, cuts, groups, side_rows=count).filter(
            F.col("_cut").isNull() | (F.substring("_hash", 1, DIGITS) < F.col("_cut"))
        )
        kept = materialise(kept)
        found = kept.groupBy(*groups).agg(F.count(F.lit(1)).alias("_found"))
        short = sizes.join(found, groups, "left").filter(
            F.coalesce("_found", F.lit(0)) < F.least(F.col("_size"), F.lit(float(n)))
        )
        if short.isEmpty():
            break
        slack *= 4.0
    order = Window.partitionBy(*groups).orderBy("_hash", *key_cols)
    ranked = kept.withColumn("_rank", F.row_number().over(order)).filter(F.col("_rank") <= n)
    return ranked.select(*df.columns)


def systematic_sample(df: DataFrame, order_cols: Sequence[str], step: int = 11) -> DataFrame:
    """Every ``step``-th row in the given total order, with its ``row_id``."""
    return row_ids(df, order_cols).filter(F.col("row_id") % step == 0)


def scatter_sample(
    df: DataFrame,
    x: str,
    y: str,
    order_cols: Sequence[str],
    n: int = 2000,
    seed: int = SEED,
) -> DataFrame:
    """Up to ``n`` sampled (x, y) points in row order; ``order_cols`` identify a row."""
    names = list(dict.fromkeys([*order_cols, x, y]))
    drawn = hash_sample(df.select(*names), order_cols, n, seed)
    return drawn.orderBy(*order_cols).select(
        *order_cols, F.col(x).alias("x"), F.col(y).alias("y")
    )
