"""Near duplicates by SimHash: pigeonhole blocks, joined and verified by Hamming distance."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from statloom.llm.common import attach_groups, query, read, store, text_hash
from statloom.llm.graph import components

SHINGLE = 3
SEED = 42
# Shingle hashes turned into bits at a time.
CHUNK = 100_000


def shingle_hashes(text: str | None, width: int = SHINGLE) -> np.ndarray:
    """XXH64 of every shingle of ``width`` words; of the whole sequence if there are fewer."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    digest = xxhash.xxh64_intdigest
    if len(words) <= width:
        return np.array([digest(b" ".join(words), SEED)], np.uint64)
    shingles = map(b" ".join, zip(*(words[i:] for i in range(width)), strict=False))
    return np.fromiter((digest(s, SEED) for s in shingles), np.uint64, len(words) - width + 1)


def bit_counts(hashes: np.ndarray) -> np.ndarray:
    """How many of the hashes have each of the 64 bits, lowest first."""
    total = np.zeros(64, np.int64)
    for at in range(0, len(hashes), CHUNK):
        part = hashes[at:at + CHUNK].astype("<u8").view(np.uint8).reshape(-1, 8)
        total += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return total


POWERS = np.uint64(1) << np.arange(64, dtype=np.uint64)


def fingerprint(text: str | None, width: int = SHINGLE) -> int:
    """A bit is 1 if it is set in over half of the shingle hashes; no words give zero."""
    hashes = shingle_hashes(text, width)
    return int(POWERS[bit_counts(hashes) * 2 > len(hashes)].sum(dtype=np.uint64))


# Six blocks; a pair that differs in three bits or fewer has at least three blocks in common.
BLOCKS, MAX_BITS = 6, 3
# A bucket of at most this many fingerprints is compared directly.
BUCKET = 2_048
# With this few free bits a bucket is compared directly whatever its size: at most 2^8.
FEW_BITS = 8


def child_masks(mask: int) -> list[int]:
    """The bits that two fingerprints, equal under ``mask``, share in one of 20 ways.

    The free bits are cut into six blocks; each way fixes three of them.
    """
    free = [b for b in range(64) if not mask >> b & 1]
    blocks = [sum(1 << int(b) for b in part) for part in np.array_split(free, BLOCKS)]
    return [mask | sum(chosen) for chosen in combinations(blocks, BLOCKS - MAX_BITS)]


def _signed(number: int) -> int:
    return number - (1 << 64) if number >> 63 else number


def spanning_links(prints: np.ndarray) -> list[tuple[int, int]]:
    """Links that join every component of the graph of pairs within MAX_BITS, and no more."""
    left, found = prints[1:], []
    stack = [prints[0]]
    while len(left):
        if not stack:
            stack, left = [left[0]], left[1:]
            continue
        at = stack.pop()
        near = np.bitwise_count(left ^ at) <= MAX_BITS
        found += [(int(at), int(x)) for x in left[near]]
        stack += list(left[near])
        left = left[~near]
    return found


def _link(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Buckets in order: their links (mask 0), or for large ones rows of 20 smaller buckets each."""
    held_mask = held_key = None
    held: list[np.ndarray] = []
    size = 0

    def emit(masks, a, b) -> pd.DataFrame:
        return pd.DataFrame({"mask": np.asarray(masks, np.int64), "a": np.asarray(a, np.int64),
                             "b": np.asarray(b, np.int64)})

    def deeper(mask: int, prints: np.ndarray) -> pd.DataFrame:
        masks = np.array([_signed(m) for m in child_masks(mask % 2**64)], np.int64)
        return emit(np.repeat(masks, len(prints)), np.tile(prints, len(masks)), np.tile(prints, len(masks)))

    def close() -> Iterator[pd.DataFrame]:
        if size > 1 and held:
            links = spanning_links(np.concatenate(held))
            if links:
                yield emit(np.zeros(len(links)), *zip(*links, strict=True))

    for batch in batches:
        mask, key, prints = (batch[c].to_numpy(np.int64) for c in ("mask", "key", "fp"))
        if not len(mask):
            continue
        new = np.flatnonzero((np.diff(mask) != 0) | (np.diff(key) != 0)) + 1
        bounds = [0, *new.tolist(), len(mask)]
        for lo, hi in zip(bounds, bounds[1:], strict=False):
            if hi - lo == 1 and lo > 0 and hi < len(mask):
                # Alone in its bucket, and not at the edge of the batch.
                yield from close()
                held_mask, held_key, held, size = mask[lo], key[lo], [], 1
                continue
            if mask[lo] != held_mask or key[lo] != held_key:
                yield from close()
                held_mask, held_key, held, size = mask[lo], key[lo], [], 0
            before, size = size, size + hi - lo
            free = 64 - (int(held_mask) % 2**64).bit_count()
            if size <= BUCKET or free <= FEW_BITS:
                held.append(prints[lo:hi])
            else:
                if before <= BUCKET and held:
                    yield deeper(int(held_mask), np.concatenate(held))
                    held = []
                for at in range(lo, hi, BUCKET):
                    yield deeper(int(held_mask), prints[at:min(hi, at + BUCKET)])
    yield from close()


def links(prints: DataFrame) -> DataFrame:
    """Links (a, b) that join the components of distinct fingerprints (fp) within MAX_BITS.

    Every fingerprint goes to 20 buckets by three of six blocks. A bucket emits a spanning
    forest, never all its pairs. A bucket above BUCKET is cut again by the bits its members
    may differ in; after two more cuts at most eight bits are free, so no bucket is
    compared in more than 2^16 steps, however dense the fingerprints are.
    """
    masks = F.array(*(F.lit(_signed(m)) for m in child_masks(0)))
    rows = prints.select(F.explode(masks).alias("mask"), "fp")
    found = None
    while True:
        keyed = rows.withColumn("key", F.col("fp").bitwiseAND(F.col("mask")))
        ordered = keyed.repartition("mask", "key").sortWithinPartitions("mask", "key")
        made = store(ordered.mapInPandas(_link, "mask long, a long, b long"), "near-links")
        level = made.filter("mask = 0").select("a", "b")
        found = level if found is None else found.union(level)
        rows = made.filter("mask != 0").select("mask", F.col("a").alias("fp")).distinct()
        if rows.isEmpty():
            return found


def _fingerprints(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for part in texts:
        yield pd.Series([_signed(fingerprint(t)) for t in part], dtype="int64")


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Classes of near-duplicate rows: linked fingerprints differ in at most MAX_BITS bits.

    Words are runs of anything but ASCII white space, A-Z lower-cased; shingles have three
    words, repeats included. Returns per row: id_col, t0 and t1 (128 bits of the text), fp,
    component_id (smallest id reachable), group_size and kept (one row of each class: the
    one with the smallest id).

    Null and empty texts have fingerprint zero and are linked like any other. Null ids are
    larger than every other; component_id is null where all are. Of rows with equal ids one
    is kept. An empty table gives no rows.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    hashed = F.pandas_udf(_fingerprints, "long")
    rows = store(docs.select(
        F.col(id_col).alias("id"), *(h.alias(f"t{i}") for i, h in enumerate(text_hash(text))),
        hashed(F.col(text_col)).alias("fp"), F.monotonically_increasing_id().alias("rid"),
    ), "fingerprints")
    total = rows.count()
    first = F.min(F.struct(F.col("id").isNull().alias("no_id"), F.col("id"), F.col("rid")))
    nodes = store(rows.groupBy("fp").agg(first.alias("first"), F.count("*").alias("n")), "distinct-prints")
    found = components(links(nodes.select("fp")))
    rooted = nodes.join(found.withColumnRenamed("node", "fp"), "fp", "left").withColumn(
        "root", F.coalesce("root", "fp"))
    rooted = store(rooted, "rooted-prints")
    classes = rooted.groupBy("root").agg(
        F.min("first").alias("first"), F.sum("n").alias("group_size"), F.count("*").alias("prints"))
    distinct = nodes.count()
    classed = attach_groups(rooted.select("fp", "n", "root"), classes, ["root"], "prints", distinct)
    classed = classed.select("fp", "n", "first", "group_size")
    joined = attach_groups(rows, store(classed, "classed-prints"), ["fp"], "n", total)
    return joined.select(
        F.col("id").alias(id_col), "t0", "t1", "fp", F.col("first.id").alias("component_id"),
        F.col("group_size").cast("long").alias("group_size"),
        (F.col("first.rid") == F.col("rid")).alias("kept"))


@query("op6_simhash_near_dedup")
def op6_simhash_near_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """Fingerprint and near-duplicate class of every document."""
    found = near_dedup(read(spark, sf, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
