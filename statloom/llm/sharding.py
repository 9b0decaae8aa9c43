"""Shards of equal bytes by histogram sort: count exactly, refine probes, exchange once."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from statloom.llm.common import query, read, running, store

N_SHARDS = 40
ROW_BYTES = 16
# Hexadecimal digits by which each round refines a probe: 4096 candidates per splitter.
DIGITS = 3
# The key is two md5 sums and one 64-bit hash, in hexadecimal.
KEY_DIGITS = 80
# Above every hexadecimal key.
LAST = "~"


def _after(prefix: str) -> str:
    """The smallest prefix of the same length above every key that starts with this one."""
    up = int(prefix, 16) + 1
    return LAST if up >= 16 ** len(prefix) else f"{up:0{len(prefix)}x}"


def find_splitters(table: DataFrame, n_shards: int, tolerance: float) -> list[str]:
    """Keys that cut ``table`` (key, size) into shards of equal size.

    Each round counts the exact bytes per prefix of the key, only inside the cells that
    hold an unsettled splitter: at most (n_shards - 1) * 4096 counts reach the driver. A
    splitter settles when a boundary is within ``tolerance`` of a shard's share of its
    target, or when a cell cannot be cut further.
    """
    total = table.agg(F.sum("size")).first()[0] or 0
    targets = {j: total * j / n_shards for j in range(1, n_shards)}
    inside, below, found = dict.fromkeys(targets, ""), dict.fromkeys(targets, 0), {}
    length = 0
    while targets and total:
        step = min(length + DIGITS, KEY_DIGITS)
        rows = table
        if length:
            rows = rows.filter(F.substring("key", 1, length).isin(sorted(set(inside.values()))))
        cells = rows.groupBy(F.substring("key", 1, step).alias("cell")).agg(
            F.sum("size").alias("size"), F.count("*").alias("n"))
        counts = sorted((r["cell"], r["size"], r["n"]) for r in cells.collect())
        for j, target in list(targets.items()):
            at = below[j]
            for cell, size, n in (c for c in counts if c[0].startswith(inside[j])):
                if at + size >= target:
                    break
                at += size
            near = min(target - at, at + size - target)
            if n == 1 or step == KEY_DIGITS or near <= tolerance * total / n_shards:
                found[j] = cell if target - at <= at + size - target else _after(cell)
                del targets[j]
            else:
                inside[j], below[j] = cell, at
        length = step
    # Many tiny shards may settle on one boundary; order is what assign() relies on.
    return sorted(found[j] for j in sorted(found))


def _place(key: Column, splitters: Sequence[str], first: int = 0) -> Column:
    """How many splitters are at or below the key, as a balanced tree of comparisons."""
    if not splitters:
        return F.lit(first)
    mid = len(splitters) // 2
    return F.when(key < splitters[mid], _place(key, splitters[:mid], first)).otherwise(
        _place(key, splitters[mid + 1:], first + mid + 1))


def shard_by_bytes(docs: DataFrame, n_shards: int = N_SHARDS, id_col: str = "doc_id",
                   text_col: str = "text", carry: Sequence[str] | None = None,
                   tolerance: float = 0.0) -> DataFrame:
    """Put every row into one of ``n_shards`` shards of nearly equal bytes.

    The size of a row is the UTF-8 bytes of its text (null: none) plus 16. Rows are ordered
    by md5 of the text, then of the id, then a hash of the row's number, so equal texts are
    neighbours, and a group of copies of any size is cut where a cut falls inside it. Returns
    id_col, size, text_crc32, shard, slot (gapless from 0 within the shard) and the columns
    in ``carry`` (all of ``docs`` by default; the names above win over equal names there).

    With ``tolerance`` 0 each cut is the row boundary nearest to its target. Null texts count
    as empty (crc 0), null ids as an empty id; an empty table gives no rows.
    """
    names = ("size", "text_crc32", "shard", "slot", id_col)
    extra = [c for c in (docs.columns if carry is None else carry) if c not in names]
    text = F.coalesce(F.col(text_col), F.lit(""))
    row = F.lpad(F.lower(F.hex(F.xxhash64(F.monotonically_increasing_id()))), 16, "0")
    key = F.concat(F.md5(text.cast("binary")),
                   F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")), row)
    table = store(docs.select(
        F.col(id_col).alias("id"), F.octet_length(text).cast("long").__add__(ROW_BYTES).alias("size"),
        F.crc32(text.cast("binary")).alias("crc"), key.alias("key"),
        F.struct(*extra).alias("carried") if extra else F.lit(None).cast("int").alias("carried"),
    ), "shard-keys")
    splitters = find_splitters(table, n_shards, tolerance)
    # Inside a shard, 256 x 256 parts by text and id are ordered on their own.
    part = F.concat(F.substring("key", 1, 2), F.substring("key", 33, 2))
    placed = table.withColumns({"shard": _place(F.col("key"), splitters), "part": part})
    placed = running(placed, ["shard"], [F.col("key")], F.lit(1), "part", "slot")
    return placed.select(
        F.col("id").alias(id_col), "size", F.col("crc").alias("text_crc32"), "shard",
        F.col("slot").cast("long").alias("slot"), *(F.col("carried")[c].alias(c) for c in extra))


def write_shards(sharded: DataFrame, path: str) -> None:
    """One folder per shard, rows of a file in slot order."""
    sharded.sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)


SQL = r"""
WITH crc AS (
  SELECT [list_reduce([i] || range(8), lambda c, k: CASE WHEN c % 2 = 1
            THEN xor(c // 2, 3988292384) ELSE c // 2 END) FOR i IN range(256)] AS t),
keyed AS (
  SELECT doc_id, CAST(strlen(coalesce(text, '')) + 16 AS BIGINT) AS size,
         md5(coalesce(text, '')) AS a, md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS b,
         xor(list_reduce([CAST(4294967295 AS BIGINT)] || [CAST(('0x' || x) AS BIGINT) FOR x IN
               regexp_extract_all(hex(encode(coalesce(text, ''))), '..')],
             lambda c, x: xor(c // 256, t[xor(c % 256, x) + 1])), 4294967295) AS text_crc32
  FROM documents, crc),
summed AS (
  SELECT *, sum(size) OVER () AS total,
         sum(size) OVER (ORDER BY a, b ROWS UNBOUNDED PRECEDING) - size AS below
  FROM keyed),
placed AS (
  SELECT *, CAST(least(39, 20 * (2 * below + size) // total) AS INTEGER) AS shard FROM summed)
SELECT doc_id, size, CAST(text_crc32 AS BIGINT) AS text_crc32, 'bytes' AS law, shard,
       row_number() OVER (PARTITION BY shard ORDER BY left(a, 2), left(b, 2), a, b) - 1 AS slot,
       CAST(NULL AS INTEGER) AS grown_shard
FROM placed"""


@query("op5_sharding", SQL)
def op5_sharding(spark: SparkSession, sf: str) -> DataFrame:
    """All documents in 40 shards of nearly equal bytes."""
    sharded = shard_by_bytes(read(spark, sf, "documents"), carry=())
    return sharded.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
                          "slot", F.lit(None).cast("int").alias("grown_shard"))
