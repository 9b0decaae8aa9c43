"""Exact duplicates by an exchange of Golomb-coded fingerprints and a comparison of bytes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from statloom.llm.common import (
    BROADCAST_ROWS, SPACE, attach_groups, query, read, store, text_hash,
)

# Fingerprints one owner receives, about.
OWNER_HASHES = 400_000


def normalised(text: Column) -> Column:
    """Each run of ASCII white space as one space; null as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACE + "+", " ")


def golomb_encode(values: np.ndarray) -> tuple[int, bytes]:
    """Sorted distinct unsigned numbers as Golomb-Rice coded gaps: (bits of the remainder, code).

    A gap is its quotient in unary (ones, then a zero) and ``k`` bits of remainder.
    """
    if len(values) == 0:
        return 0, b""
    gaps = np.diff(values.astype(np.uint64), prepend=np.uint64(0))
    mean = float(values[-1]) / len(values)
    k = max(0, min(62, int(np.log2(max(mean, 1.0)))))
    quotients = (gaps >> np.uint64(k)).astype(np.int64)
    ends = np.cumsum(quotients + 1 + k)
    bits = np.ones(int(ends[-1]), dtype=np.uint8)
    starts = ends - k - 1
    bits[starts] = 0
    for i in range(k):
        bits[starts + 1 + i] = (gaps >> np.uint64(k - 1 - i)) & np.uint64(1)
    return k, np.packbits(bits).tobytes()


def golomb_decode(k: int, code: bytes, n: int) -> np.ndarray:
    """The inverse of golomb_encode for ``n`` numbers."""
    bits = np.unpackbits(np.frombuffer(code, dtype=np.uint8))
    zeros = np.flatnonzero(bits == 0)
    # The next zero at or behind each place, to walk from code word to code word.
    place, starts = 0, np.empty(n, dtype=np.int64)
    quotients = np.empty(n, dtype=np.int64)
    walk = 0
    zero_list = zeros.tolist()
    for i in range(n):
        while zero_list[walk] < place:
            walk += 1
        end = zero_list[walk]
        quotients[i], starts[i] = end - place, end + 1
        place = end + 1 + k
    gaps = quotients.astype(np.uint64) << np.uint64(k)
    for i in range(k):
        gaps |= bits[starts + i].astype(np.uint64) << np.uint64(k - 1 - i)
    return np.cumsum(gaps, dtype=np.uint64)


def _messages(owners: int):
    """Per sender and owner: the sender's sorted distinct hashes, coded, and which repeat there."""

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: dict[int, list[np.ndarray]] = {}
        for batch in batches:
            for sender, rows in batch.groupby("sender", sort=False):
                seen.setdefault(sender, []).append(rows["hash"].to_numpy().astype(np.int64))
        width = np.uint64(2**64 // owners + 1)
        for sender, parts in seen.items():
            hashes, counts = np.unique(np.concatenate(parts).view(np.uint64), return_counts=True)
            owner = (hashes // width).astype(np.int64)
            cuts = np.flatnonzero(np.diff(owner)) + 1
            for h, c in zip(np.split(hashes, cuts), np.split(counts, cuts), strict=True):
                o = int(h[0] // width)
                k, code = golomb_encode(h - np.uint64(o) * width)
                yield pd.DataFrame({"sender": [sender], "owner": [o], "n": [len(h)],
                                    "k": [k], "code": [code],
                                    "repeats": [np.packbits(c > 1).tobytes()]})

    return encode


def _judge(messages: pd.DataFrame) -> pd.DataFrame:
    """At an owner: for each sender a bitmap of its hashes that some other row has too."""
    hashes = [golomb_decode(k, code, n) for k, code, n in
              zip(messages["k"], messages["code"], messages["n"], strict=True)]
    repeats = [np.unpackbits(np.frombuffer(r, np.uint8), count=n).astype(bool)
               for r, n in zip(messages["repeats"], messages["n"], strict=True)]
    values, inverse, counts = np.unique(np.concatenate(hashes), return_inverse=True, return_counts=True)
    double = counts > 1
    double |= np.bincount(inverse, np.concatenate(repeats), len(values)) > 0
    marks = np.split(double[inverse], np.cumsum([len(h) for h in hashes])[:-1])
    return pd.DataFrame({"sender": messages["sender"], "owner": messages["owner"], "marks": [np.packbits(m).tobytes() for m in marks]})


def _apply(owners: int):
    """At a sender: its hashes in the order sent, against the bitmaps that came back."""

    def suspects(rows: pd.DataFrame, bitmaps: pd.DataFrame) -> pd.DataFrame:
        hashes = np.unique(rows["hash"].to_numpy().astype(np.int64).view(np.uint64))
        owner = (hashes // np.uint64(2**64 // owners + 1)).astype(np.int64)
        found = []
        for o, marks in zip(bitmaps["owner"], bitmaps["marks"], strict=True):
            sent = hashes[owner == o]
            found.append(sent[np.unpackbits(np.frombuffer(marks, np.uint8), count=len(sent)).astype(bool)])
        out = np.concatenate(found) if found else hashes[:0]
        return pd.DataFrame({"hash": out.view(np.int64)})

    return suspects


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                owner_hashes: int = OWNER_HASHES) -> DataFrame:
    """Groups of rows whose texts are equal after replacing runs of white space by one space.

    Every sender (a split of the stored hashes) sends each owner of a hash range its sorted
    distinct hashes, Golomb-coded; the owner returns a bitmap of those it knows from other
    rows; only texts with such a hash are shuffled and compared byte by byte. Returns per
    row: id_col, t0 and t1 (128 bits of the text), text_sha256, keep_id, group_size, kept. The rows are those of
    ``docs``; of the equal texts the row with the smallest id is kept.

    Null texts count as empty. A null id is larger than every other (keep_id is null if all
    are). Of rows with equal text and id one is kept. An empty table gives no rows.
    """
    text = normalised(F.col(text_col))
    own = text_hash(F.coalesce(F.col(text_col), F.lit("")))
    source = docs.select(F.col(id_col).alias("id"), text.alias("text"),
                         *(h.alias(f"t{i}") for i, h in enumerate(own)))
    source = source.withColumn("hash", F.xxhash64("text"))
    table = source.select("id", "hash", F.sha2("text", 256).alias("sha"), "t0", "t1",
                          F.monotonically_increasing_id().alias("rid"))
    rows = store(table, "dedup-hashes")
    total = rows.count()
    owners = max(2, total // owner_hashes)

    # A sender is one split of the stored table, known by its file and offset.
    place = F.xxhash64(F.input_file_name(), F.input_file_block_start())
    sent = rows.select("hash", place.alias("sender"))
    messages = sent.mapInPandas(
        _messages(owners),
        "sender long, owner long, n long, k int, code binary, repeats binary")
    bitmaps = messages.groupBy("owner").applyInPandas(
        _judge, "sender long, owner long, marks binary")
    suspects = sent.groupBy("sender").cogroup(bitmaps.groupBy("sender")).applyInPandas(
        _apply(owners), "hash long")
    suspects = store(suspects.distinct(), "dedup-suspects")

    # Bytes decide: one row per distinct text of a suspect hash.
    few = suspects.count() <= BROADCAST_ROWS
    texts = source.join(F.broadcast(suspects) if few else suspects, "hash", "left_semi")
    equal = texts.groupBy("hash", "text").agg(F.count("*").alias("group_size"))
    equal = equal.select("hash", F.sha2("text", 256).alias("sha"), "group_size")
    first = F.min(F.struct(F.col("id").isNull(), F.col("id"), F.col("rid")))
    keepers = rows.join(F.broadcast(suspects) if few else suspects, "hash", "left_semi")
    keepers = keepers.groupBy("hash", "sha").agg(first.alias("first"))
    groups = store(equal.join(keepers, ["hash", "sha"]).filter("group_size > 1"), "dedup-groups")
    joined = attach_groups(rows, groups, ["hash", "sha"], "group_size", total)
    return joined.select(
        F.col("id").alias(id_col), "t0", "t1", F.col("sha").alias("text_sha256"),
        F.when(F.col("first").isNull(), F.col("id")).otherwise(F.col("first.id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        F.coalesce(F.col("first.rid") == F.col("rid"), F.lit(True)).alias("kept"))


SQL = r"""
WITH t AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS text
  FROM documents),
g AS (SELECT *, min(doc_id) OVER (PARTITION BY text) AS keep_id,
             count(*) OVER (PARTITION BY text) AS group_size FROM t)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(text) AS text_sha256 FROM g"""


@query("op1_exact_dedup", SQL)
def op1_exact_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """Every document with the copy that stays and the size of its group."""
    found = exact_dedup(read(spark, sf, "documents"))
    return found.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")
