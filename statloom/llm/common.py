"""Helpers shared by the training-data operators: reading, storing, skew-safe joins, ranks."""

from __future__ import annotations

import os
from collections.abc import Callable, Sequence
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from statloom.session import scratch_path, store

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

# ASCII white space, as every contract of these operators uses it.
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"
SPACE_CHARS = " \t\n\x0b\x0c\r"
# A group with more than 1/HOT_GROUPS of all rows is hot, so at most HOT_GROUPS are.
HOT_GROUPS = 1_000
# Keys to drop are broadcast up to this many rows of a few numbers each (about 32 MB).
BROADCAST_ROWS = 500_000
# Rows that one task orders at a time.
BUCKET_ROWS = 50_000

__all__ = ["BROADCAST_ROWS", "BUCKET_ROWS", "ORACLES", "QUERIES", "SPACE", "SPACE_CHARS", "WORD",
           "ascii_lower", "attach_groups", "drop_table", "free_names", "keep_rows", "one_each", "query", "read", "running", "same",
           "store", "text_hash", "without", "write_table"]


def query(name: str, sql: str | None = None):
    """Register a query and, where SQL can express it, its equivalent."""

    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


def share_package(spark: SparkSession) -> None:
    """Let Python workers look for this package where the driver found it.

    For sessions that were started elsewhere; on a cluster the package is installed or shipped.
    """
    root = str(Path(__file__).resolve().parents[2])
    environment = spark.sparkContext.environment
    known = environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in known:
        environment["PYTHONPATH"] = os.pathsep.join(filter(None, [*known, root]))


def read(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """A table of the folder ``sf``."""
    share_package(spark)
    return spark.read.parquet(f"{sf}/{name}.parquet")


def write_table(df: DataFrame, label: str) -> tuple[DataFrame, str]:
    """``store`` for a table of a loop: the stored table and its path, to be dropped when it is replaced."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def drop_table(spark: SparkSession, path: str) -> None:
    """Delete a table that ``write_table`` wrote, once no later result reads it."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(folder, True)


def text_hash(text: Column) -> list[Column]:
    """128 bits of a text as two longs; the second hash starts from another seed."""
    return [F.xxhash64(text), F.xxhash64(F.lit(1), text)]


def ascii_lower(text: Column) -> Column:
    """Lower-case A to Z and no other letter."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    slow = F.translate(text, upper, upper.lower())
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(slow)


def free_names(df: DataFrame, *names: str) -> list[str]:
    """The names, each led by as many underscores as it takes to be no column of ``df``."""
    taken = {c.lower() for c in df.columns}
    found = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        found.append(name)
    return found


def same(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    """Equality of the named columns, where null equals null."""
    condition = F.lit(True)
    for k in keys:
        condition = condition & left[k].eqNullSafe(right[k])
    return condition


def attach_groups(rows: DataFrame, groups: DataFrame, keys: Sequence[str], size: str,
                  total: int) -> DataFrame:
    """Left join of rows onto one row per group, safe for groups of any size.

    Groups above total / HOT_GROUPS rows, at most HOT_GROUPS of them, are broadcast.
    The rows they take leave the shuffle: their keys become random and match nothing.
    """
    added = [c for c in groups.columns if c not in keys]
    limit = max(1, total // HOT_GROUPS)
    renamed = groups.select(*(F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)),
                            F.struct(*added).alias("_g"), F.col(size).alias("_n"))
    hot = F.broadcast(renamed.filter(F.col("_n") > limit).drop("_n"))
    on = F.lit(True)
    for i, k in enumerate(keys):
        on = on & (F.col(k) == F.col(f"_k{i}"))
    first = rows.join(hot, on, "left").drop(*(f"_k{i}" for i in range(len(keys))))
    first = first.withColumnRenamed("_g", "_hot")
    # A hash of the row, so that a repeated task sends each row where it went before.
    salt = F.pmod(F.xxhash64(*rows.columns), F.lit(1 << 31))
    spread = first.withColumn("_salt", F.when(F.col("_hot").isNotNull(), salt).otherwise(-1))
    rest = renamed.filter(F.col("_n") <= limit).drop("_n").withColumn("_kept", F.lit(-1))
    on = F.col("_salt") == F.col("_kept")
    for i, k in enumerate(keys):
        on = on & (F.col(k) == F.col(f"_k{i}"))
    both = spread.join(rest, on, "left")
    return both.select(*rows.columns, *(F.coalesce(F.col("_hot")[c], F.col("_g")[c]).alias(c)
                                        for c in added))


def without(rows: DataFrame, keys: DataFrame) -> DataFrame:
    """Rows whose key is not among ``keys``: broadcast up to BROADCAST_ROWS keys, shuffled beyond."""
    names = keys.columns
    small = keys.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    right = F.broadcast(keys) if small else keys
    return rows.join(right, same(rows, right, names), "left_anti")


def running(rows: DataFrame, group: Sequence[str], order: Sequence[Column], value: Column,
            bucket: str, name: str) -> DataFrame:
    """Sum of ``value`` over the rows before each row of its group, in bucket and row order.

    ``bucket`` splits a group into ordered parts; only one part is ordered in a task, and
    the sums of whole parts, one row each, are added up first.
    """
    sums = rows.groupBy(*group, bucket).agg(F.sum(value).alias("_sum"), F.count("*").alias("_rows"))
    over = Window.partitionBy(*group).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(*group, bucket, F.coalesce(F.sum("_sum").over(over), F.lit(0)).alias("_start"))
    inside = (Window.partitionBy(*group, bucket).orderBy(*order)
              .rowsBetween(Window.unboundedPreceding, -1))
    part = rows.withColumn("_inside", F.coalesce(F.sum(value).over(inside), F.lit(0)))
    joined = part.join(starts, [*group, bucket])
    return joined.withColumn(name, F.col("_start") + F.col("_inside")).drop("_start", "_inside")


def one_each(rows: DataFrame, keys: Sequence[str], twins: DataFrame) -> DataFrame:
    """Rows, but of those whose key is in ``twins`` (keys held by several rows) one each."""
    if twins.isEmpty():
        return rows
    ones = rows.join(twins, same(rows, twins, keys), "left_semi").dropDuplicates(list(keys))
    return without(rows, twins).unionByName(ones)


def keep_rows(docs: DataFrame, decided: DataFrame, id_col: str = "doc_id",
              text_col: str = "text") -> DataFrame:
    """Rows of ``docs`` that ``decided`` (id_col, t0, t1, kept: one row per row) keeps.

    Rows are told by their id and 128 bits of their text. Where rows are alike in both, one
    stays, as an operator that keeps one row of a class decides.
    """
    t0, t1, kept, n = free_names(docs, "_t0", "_t1", "_kept", "_n")
    keys = [id_col, t0, t1]
    by_key = decided.select(id_col, F.col("t0").alias(t0), F.col("t1").alias(t1), "kept")
    by_key = store(by_key.groupBy(*keys).agg(F.max("kept").alias(kept), F.count("*").alias(n)), "kept")
    hashes = text_hash(F.coalesce(F.col(text_col), F.lit("")))
    rows = docs.withColumns({t0: hashes[0], t1: hashes[1]})
    rows = without(rows, by_key.filter(~F.col(kept)).select(*keys))
    twins = by_key.filter(F.col(kept) & (F.col(n) > 1)).select(*keys)
    return one_each(rows, keys, twins).select(*docs.columns)
