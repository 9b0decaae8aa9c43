"""Best-fit packing of documents into bins, under conflicts of source and duplicate cluster."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from statloom.llm.common import SPACE, WORD, ascii_lower, query, read, store

# Words of a bin, and how many documents of one source a bin may hold.
CAPACITY = 4_096
SOURCE_LIMIT = 16
# Documents packed together by one call; a hash of the row deals them out.
GROUP_ROWS = 4_096


def best_fit(sizes: Sequence[int], sources: Sequence[int], clusters: Sequence[int], capacity: int,
             source_limit: int) -> list[int]:
    """The bin of each item, the items taken in the order given.

    Bins are kept by residual. A search starts at the smallest residual that holds the item
    and goes on to the next larger one until a bin is compatible, the oldest first: no item
    of the same cluster and fewer than ``source_limit`` of the same source. A bin carries
    a bitmap of its clusters and, for each count up to the limit, one of its sources.
    A cluster below zero conflicts with nothing.
    """
    by_residual: dict[int, list[int]] = {}
    present = 0  # bit r is set while some bin has residual r
    cluster_bits: list[int] = []
    source_bits: list[list[int]] = []
    placed = []
    for size, source, cluster in zip(sizes, sources, clusters, strict=True):
        source_bit = 1 << source
        cluster_bit = 1 << cluster if cluster >= 0 else 0
        ahead, chosen, residual = present >> size, -1, size
        while ahead:
            step = (ahead & -ahead).bit_length() - 1
            residual += step
            ahead >>= step
            for b in by_residual[residual]:
                if not cluster_bits[b] & cluster_bit and not source_bits[b][-1] & source_bit:
                    chosen = b
                    break
            if chosen >= 0:
                break
            ahead >>= 1
            residual += 1
        if chosen >= 0:
            row = by_residual[residual]
            row.remove(chosen)
            if not row:
                present ^= 1 << residual
        else:
            chosen, residual = len(cluster_bits), capacity
            cluster_bits.append(0)
            source_bits.append([0] * source_limit)
        left = residual - size
        by_residual.setdefault(left, []).append(chosen)
        present |= 1 << left
        cluster_bits[chosen] |= cluster_bit
        carry = source_bit
        for k, bits in enumerate(source_bits[chosen]):
            source_bits[chosen][k], carry = bits | carry, bits & carry
            if not carry:
                break
        placed.append(chosen)
    return placed


COLUMNS = ("id", "source", "group", "piece", "first_word", "n_words", "bin", "offset", "bin_words")


def pack_group(rows: pd.DataFrame, capacity: int, source_limit: int) -> pd.DataFrame:
    """Full pieces of long rows fill bins of their own; what is left is packed, largest first."""
    rows = rows.sort_values(["size", "cluster", "rid"], ascending=[False, True, True])
    size = rows["size"].to_numpy()
    full, rest = size // capacity, size % capacity
    source_codes = pd.factorize(rows["source"], use_na_sentinel=False)[0]
    repeated = rows["cluster"].duplicated(keep=False)
    codes = pd.factorize(rows["cluster"].where(repeated))[0]
    order = sorted((i for i in range(len(rows)) if rest[i]), key=lambda i: -rest[i])
    bins = best_fit([int(rest[i]) for i in order], [int(source_codes[i]) for i in order],
                    [int(codes[i]) for i in order], capacity, source_limit)
    fill: dict[int, int] = {}
    ids, source = rows["id"].tolist(), rows["source"].tolist()
    group = int(rows["group"].iloc[0])
    out = []
    for i, b in zip(order, bins, strict=True):
        at = fill.get(b, 0)
        fill[b] = at + int(rest[i])
        out.append([ids[i], source[i], group, int(full[i]), int(full[i]) * capacity, int(rest[i]), b, at, 0])
    for row in out:
        row[-1] = fill[row[-3]]
    new = len(fill)
    for i in range(len(rows)):
        for piece in range(int(full[i])):
            out.append([ids[i], source[i], group, piece, piece * capacity, capacity, new, 0, capacity])
            new += 1
        if not size[i]:
            out.append([ids[i], source[i], group, 0, 0, 0, None, None, None])
    frame = pd.DataFrame(out, columns=list(COLUMNS))
    return frame.astype({c: "Int64" for c in ("bin", "offset", "bin_words")} | {"id": "Int64"})


def _packer(capacity: int, source_limit: int) -> Callable[[pd.DataFrame], pd.DataFrame]:
    return lambda rows: pack_group(rows, capacity, source_limit)


def pack(docs: DataFrame, capacity: int = CAPACITY, source_limit: int = SOURCE_LIMIT,
         id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
         group_rows: int = GROUP_ROWS) -> DataFrame:
    """Pack the words of all rows into bins of ``capacity`` words; one row per piece.

    A row longer than a bin is cut into full bins and a rest. Two rests share a bin only if
    their texts differ after collapsing white space and lower-casing A-Z, and a bin holds
    at most ``source_limit`` rests of one source. Rows are dealt by a hash into groups of
    about ``group_rows``, each packed on its own, so that no task grows with the table.

    Returns id_col, source_col, piece (from 0), first_word, n_words, bin_id, bin_offset (words
    before it in the bin) and bin_words (words of the bin). Rows without words (null, empty
    or blank text) return one piece of no words and no bin. A null source is a source of its
    own; null and repeated ids are packed as rows of their own; an empty table gives no rows.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    flat = ascii_lower(F.btrim(F.regexp_replace(text, SPACE + "+", " ")))
    table = store(docs.select(
        F.col(id_col).cast("long").alias("id"), F.col(source_col).cast("string").alias("source"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"),
        F.xxhash64(flat).alias("cluster"), F.monotonically_increasing_id().alias("rid"),
    ), "pack-sizes")
    groups = max(1, -(-table.count() // group_rows))
    dealt = table.withColumn("group", F.pmod(F.xxhash64("rid"), F.lit(groups)))
    packed = dealt.groupBy("group").applyInPandas(
        _packer(capacity, source_limit),
        "id long, source string, group long, piece int, first_word long, n_words long, "
        "bin long, offset long, bin_words long")
    bin_id = F.col("group") * F.lit(1 << 24) + F.col("bin")
    return packed.select(
        F.col("id").alias(id_col), F.col("source").alias(source_col), "piece", "first_word", "n_words",
        bin_id.alias("bin_id"), F.col("offset").alias("bin_offset"), "bin_words")


@query("op8_best_fit_packing")
def op8_best_fit_packing(spark: SparkSession, sf: str) -> DataFrame:
    """Every document's pieces in bins of 4096 words."""
    return pack(read(spark, sf, "documents"))
