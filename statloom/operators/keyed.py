"""Joins onto tables with unique keys, safe under skewed and null keys.

A missing key never matches, and rows with a missing key belong to no group.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from statloom.functions.coerce import quoted
from statloom.session import materialise

# A side of at most this many bytes, measured before the join, is broadcast.
BROADCAST_BYTES = 64 << 20
# What a value takes in memory beside the bytes of a text.
CELL_BYTES = 16
# A key is hot when it holds more than 1/HOT_KEYS of the rows, so at most
# HOT_KEYS keys are hot and a table of them is always small.
HOT_KEYS = 1_000
# Over how many tasks the rows of a hot or missing key are spread.
SALTS = 256


def any_null(names: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(quoted(n)).isNull() for n in names], F.lit(False))


def key_hash(keys: Sequence[str]) -> Column:
    return F.xxhash64(*(F.col(quoted(k)) for k in keys))


def hot_hashes(df: DataFrame, keys: Sequence[str], share: int = HOT_KEYS) -> list[int]:
    """Hashes of all keys that hold more than 1/share of the rows, and perhaps of some others.

    A frequent-items sketch: one narrow pass, nothing but bounded counters shuffled.
    """
    hashes = df.dropna(subset=list(keys)).select(key_hash(keys).alias("_h"))
    return list(hashes.freqItems(["_h"], 1.0 / share).first()[0] or [])


def _holds(kind: T.DataType, wanted: type) -> bool:
    """Does a type contain another one anywhere inside?"""
    if isinstance(kind, wanted):
        return True
    if isinstance(kind, T.ArrayType):
        return _holds(kind.elementType, wanted)
    if isinstance(kind, T.MapType):
        return _holds(kind.keyType, wanted) or _holds(kind.valueType, wanted)
    return isinstance(kind, T.StructType) and any(_holds(f.dataType, wanted) for f in kind.fields)


def text_bytes(df: DataFrame, names: Sequence[str] | None = None) -> Column:
    """Bytes of a row's texts and nested values, to be summed; fixed-width values count as cells."""
    total = F.lit(0).cast("long")
    for f in df.schema.fields:
        if names is not None and f.name not in names:
            continue
        c = F.col(quoted(f.name))
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            total = total + F.coalesce(F.octet_length(c).cast("long"), F.lit(0))
        elif isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            total = total + F.coalesce(F.octet_length(F.to_json(F.struct(c.alias("c")))).cast("long"), F.lit(0))
    return total


def measured_bytes(side: DataFrame, rows: int, texts: int) -> int:
    """About what a table takes when it is broadcast."""
    return rows * len(side.columns) * CELL_BYTES + texts


def row_salt(df: DataFrame) -> Column:
    """A repeatable number below SALTS from all of the row's values that can be hashed."""
    plain = [F.col(quoted(f.name)) for f in df.schema.fields if not _holds(f.dataType, T.MapType)]
    return F.pmod(F.xxhash64(*plain, F.lit(1)), F.lit(SALTS)).cast("int")


def common_type(spark: SparkSession, left: T.DataType, right: T.DataType) -> T.DataType:
    """The type in which keys of both types are compared, whatever way the join takes."""
    if left == right:
        return left
    if not (isinstance(left, T.NumericType) and isinstance(right, T.NumericType)):
        raise TypeError(f"keys of type {left.simpleString()} and {right.simpleString()} do not compare")
    both = F.coalesce(F.lit(None).cast(left), F.lit(None).cast(right)).alias("c")
    return spark.range(0).select(both).schema["c"].dataType


def left_join(
    df: DataFrame,
    side: DataFrame,
    keys: Sequence[str],
    side_rows: int | None = None,
    broadcast_bytes: int = BROADCAST_BYTES,
    hot: Sequence[int] | None = None,
    side_bytes: int | None = None,
    stored: bool = False,
    salt: Column | None = None,
) -> DataFrame:
    """Left join onto a side whose keys are unique; the row count never changes.

    The side is computed once and measured. A small one is broadcast, so ``df``
    is not shuffled. A big one is shuffled on the keys and a salt: rows with a hot
    or missing key spread over SALTS tasks, and the few hot side rows are repeated
    for each salt. ``hot`` gives the hashes of the hot keys if they are known, ``stored``
    says that the side is read from files and needs no copy. ``salt`` names a stored
    ``row_salt`` of the rows; made here it keeps all columns of ``df`` in the plan.

    Keys of different numeric types are compared in their common type on both ways;
    other types must be equal, else a TypeError says so.
    """
    keys = list(keys)
    kinds = {k: common_type(df.sparkSession, df.schema[k].dataType, side.schema[k].dataType) for k in keys}
    if side_rows is None or side_bytes is None:
        if side_rows is None and not stored:
            side = materialise(side)
        side_rows, texts = side.agg(F.count(F.lit(1)), F.sum(text_bytes(side))).first()
        side_bytes = measured_bytes(side, side_rows, texts or 0)
    added = [c for c in side.columns if c not in keys]
    columns = [quoted(c) for c in [*df.columns, *added]]
    # The side's keys get names of their own, so a key of ``df`` keeps its type and values.
    marks = [f"_key{i}" for i in range(len(keys))]
    wide = [F.col(quoted(k)).cast(kinds[k]) for k in keys]
    right = side.select(*(c.alias(m) for c, m in zip(wide, marks)), *(F.col(quoted(c)) for c in added))
    on = F.lit(True)
    for c, m in zip(wide, marks):
        on = on & (c == F.col(m))
    if side_bytes <= broadcast_bytes:
        return df.join(F.broadcast(right), on, "left").select(*columns)

    wide_hash = F.xxhash64(*wide)
    if hot is None:
        hot = hot_hashes(df.select(*(c.alias(k) for c, k in zip(wide, keys))), keys)
    salted = df.withColumn(
        "_salt",
        F.when(wide_hash.isin(list(hot)) | any_null(keys), row_salt(df) if salt is None else salt).otherwise(F.lit(0)),
    )
    every = F.sequence(F.lit(0), F.lit(SALTS - 1))
    side_hash = F.xxhash64(*(F.col(m) for m in marks))
    repeated = right.withColumn(
        "_turn", F.explode(F.when(side_hash.isin(list(hot)), every).otherwise(F.array(F.lit(0))))
    )
    return salted.join(repeated, on & (F.col("_salt") == F.col("_turn")), "left").select(*columns)


def attach(df: DataFrame, stats: DataFrame, group_cols: Sequence[str] = ()) -> DataFrame:
    """Add a group's statistics to each of its rows.

    Without groups ``stats`` is one row, read once as a scalar subquery: no join.
    """
    if group_cols:
        return left_join(df, stats, group_cols)
    row = stats.select(F.struct(*stats.columns)).scalar()
    return df.withColumns({c: row[c] for c in stats.columns})
