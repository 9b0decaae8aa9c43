"""Connected components of large graphs by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statloom.llm.common import store


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node with an edge: the root is the smallest node of its component.

    ``edges`` has two columns of one type; direction, repeats and loops don't matter. Each
    round replaces a node's larger neighbours' links by links to its smallest neighbour,
    then the same for smaller ones; the number of rounds grows with the logarithm of the
    longest path. Rounds are stored, so a lost executor costs one round at most.
    """
    a, b = edges.columns
    now = edges.filter(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b"))
    now = store(now.distinct(), "links")
    mark = _checksum(now)
    while True:
        both = now.union(now.select(F.col("b"), F.col("a")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(low, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").filter("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        now = store(small.union(low).distinct(), "links")
        before, mark = mark, _checksum(now)
        if mark == before:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
                now.select("b", "b").distinct())


def _checksum(links: DataFrame) -> tuple:
    # Hashes are shortened so that their sum cannot overflow.
    short = F.shiftright(F.xxhash64("a", "b"), 24)
    return tuple(links.agg(F.count("*"), F.sum(short)).first())
