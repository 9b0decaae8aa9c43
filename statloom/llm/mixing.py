"""Mixing sources to target weights on a low-discrepancy schedule of equal-token blocks."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from statloom.llm.common import (
    SPACE, WORD, free_names, one_each, query, read, running, same, store, text_hash,
)

# Weights of the sources in code point order, repeating.
WEIGHTS = (5, 2, 1)
# The mix holds SHARE_UP / SHARE_DOWN of all words, and a source at most REPEATS times.
SHARE_UP, SHARE_DOWN = 3, 2
REPEATS = 2
# Words of a block: one slot of the schedule takes one block.
BLOCK_WORDS = 1_024
# Odd integer next to 2^32 / golden ratio: multiples of it modulo 2^32 spread evenly.
GOLDEN = 2_654_435_769
CIRCLE = 1 << 32
# Cells of the circle by which slots find their source.
CELLS = 4_096
# Slots ranked by one task.
CHUNK = 65_536


class Mix(NamedTuple):
    """rows: one per document; sources: one per source; schedule: one per slot;
    pieces: the runs of words of each slot, to be read in schedule order."""

    rows: DataFrame
    sources: DataFrame
    schedule: DataFrame
    pieces: DataFrame


def targets(sizes: DataFrame) -> DataFrame:
    """Water-filling over (source, source_size): weighted shares, none above REPEATS x its size.

    Sources fill in the order of cap per weight. One is capped if the level that its own
    and all later weights would reach is at least its cap.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)),
                          (F.row_number().over(order) - 1) % len(WEIGHTS) + 1)
    table = sizes.select("source", "source_size", weight.cast("long").alias("weight"))
    everything = Window.partitionBy()
    fill = Window.orderBy(F.col("source_size") / F.col("weight"), F.col("source").asc_nulls_last())
    later = fill.rowsBetween(0, Window.unboundedFollowing)
    earlier = fill.rowsBetween(Window.unboundedPreceding, -1)
    table = table.select(
        "*", (F.sum("source_size").over(everything) * SHARE_UP).alias("budget"),
        F.sum("weight").over(later).alias("open"),
        (F.coalesce(F.sum("source_size").over(earlier), F.lit(0)) * (REPEATS * SHARE_DOWN)).alias("used"),
    )
    capped = (REPEATS * SHARE_DOWN * F.col("source_size") * F.col("open")
              <= (F.col("budget") - F.col("used")) * F.col("weight"))
    # Once a source is uncapped all later ones are; they share what the capped ones leave.
    table = table.withColumn("capped", capped)
    left = F.first(F.when(~F.col("capped"), F.struct("budget", "used", "open")), True).over(everything)
    table = table.withColumn("left", left)
    share = ((F.col("left.budget") - F.col("left.used")) / F.lit(float(SHARE_DOWN))
             * F.col("weight") / F.col("left.open"))
    target = F.when(F.col("capped"), (F.col("source_size") * REPEATS).cast("double")).otherwise(share)
    return table.select("source", "source_size", target.alias("target"))


def _slots(sources: DataFrame, block: int) -> DataFrame:
    """Of each source the number of slots that reach its target, and its arc of the circle."""
    words, size = F.floor("target").cast("long"), F.col("source_size")
    blocks = F.ceil(size / block).cast("long")
    rest = words % F.greatest(size, F.lit(1))
    epochs = F.when(size > 0, F.floor((words - rest) / F.greatest(size, F.lit(1)))).otherwise(0)
    slots = epochs * blocks + F.ceil(rest / block)
    table = sources.select("source", "source_size", "target", words.alias("words"),
                           blocks.alias("blocks"), slots.cast("long").alias("slots"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    upto = F.sum("slots").over(order.rowsBetween(Window.unboundedPreceding, 0))
    whole = F.greatest(F.sum("slots").over(Window.partitionBy()), F.lit(1))
    edge = lambda c: F.floor(c / whole * CIRCLE).cast("long")
    return table.select("*", F.row_number().over(order).alias("src"),
                        edge(upto - F.col("slots")).alias("low"), edge(upto).alias("high"))


def _schedule(table: DataFrame, total: int) -> DataFrame:
    """Slots 0, 1, ... with their source and rank in it; each source gets exactly its slots.

    Golden-ratio points pick the sources; a source the points leave short by a few slots
    gets them behind the others.
    """
    spark = table.sparkSession
    width = CIRCLE // CELLS
    arcs = table.filter("high > low").select("src", "low", "high", F.explode(F.sequence(
        F.floor(F.col("low") / width), F.floor((F.col("high") - 1) / width))).alias("cell"))
    point = (F.col("id") % (1 << 31)) * GOLDEN % CIRCLE
    points = spark.range(total).select(F.col("id").alias("at"), point.alias("point"))
    points = points.withColumn("cell", F.floor(F.col("point") / width))
    picked = points.join(arcs, "cell").filter("low <= point AND point < high")
    picked = picked.select("at", "src", F.floor(F.col("at") / CHUNK).alias("chunk"))
    ranked = running(picked, ["src"], [F.col("at")], F.lit(1), "chunk", "rank")
    slots = table.select("src", "slots")
    ranked = ranked.join(slots, "src").filter(F.col("rank") < F.col("slots")).select("at", "src", "rank")
    given = ranked.groupBy("src").agg(F.count("*").alias("given"))
    short = slots.join(given, "src", "left").select(
        "src", F.explode(F.sequence(F.coalesce("given", F.lit(0)), F.col("slots") - 1)).alias("rank"),
        (F.col("slots") > F.coalesce("given", F.lit(0))).alias("some")).filter("some")
    closing = short.select((F.lit(total) + F.col("rank")).alias("at"), "src", "rank")
    return ranked.union(closing)


def mix_sources(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                source_col: str = "source", block: int = BLOCK_WORDS) -> Mix:
    """Mix all rows so that sources reach their targets, in blocks of equal words.

    Every source shuffles its rows by md5 of the id and lays their words end to end, cut
    into blocks of ``block`` words. Slot r of a source takes block r modulo its blocks, so
    a source with a target above its size starts over; the last slot is cut at the target.
    Words taken from a source are its target rounded down; no row is taken more than
    REPEATS times. A null text has no words; a null source is a source of its own, the
    last; rows with equal ids are rows of their own; an empty table gives an empty mix.
    """
    hashes = text_hash(F.coalesce(F.col(text_col), F.lit("")))
    table = store(docs.select(
        F.col(id_col).alias("id"), *(h.alias(f"t{i}") for i, h in enumerate(hashes)), F.col(source_col).alias("source"),
        F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        F.coalesce(F.md5(F.col(id_col).cast("string").cast("binary")), F.lit("")).alias("order"),
    ), "mix-sizes")
    sizes = table.groupBy("source").agg(F.sum("size").alias("source_size"))
    sources = store(_slots(targets(sizes), block), "mix-sources")
    total = sources.agg(F.sum("slots")).first()[0] or 0
    schedule = store(_schedule(sources, total), "mix-schedule")

    named = table.join(sources, same(table, sources, ["source"])).select(
        table["id"], "t0", "t1", table["source"], "size", "order", "src", "source_size", "target", "words", "blocks")
    named = named.withColumn("part", F.substring("order", 1, 3))
    order = [F.col("order"), F.col("id"), F.col("size")]
    laid = store(running(named, ["src"], order, F.col("size"), "part", "start"), "mix-rows")

    last = F.floor((F.col("start") + F.col("size") - 1) / block)
    cut = laid.filter("size > 0").withColumn(
        "block", F.explode(F.sequence(F.floor(F.col("start") / block), last)))
    cut = cut.select("src", "block", "id", "start", "size",
                     F.greatest(F.col("start"), F.col("block") * block).alias("from"),
                     F.least(F.col("start") + F.col("size"), (F.col("block") + 1) * block).alias("to"))
    slots = schedule.join(sources.select("src", "blocks", "source_size", "words"), "src").select(
        "at", "src", "rank", (F.col("rank") % F.col("blocks")).alias("block"),
        # Where this turn of the source ends: the target cuts the last one.
        (F.col("words") - F.floor(F.col("rank") / F.col("blocks")) * F.col("source_size")).alias("end"))
    pieces = cut.join(slots, ["src", "block"])
    pieces = pieces.withColumn("to", F.least("to", "end")).filter(F.col("to") > F.col("from"))
    taken = pieces.groupBy("src", "start").agg(F.sum(F.col("to") - F.col("from")).alias("taken"))
    # A row with words is told by the place of its first word.
    has = F.col("size") > 0
    keyed = laid.withColumn("_at", F.when(has, F.col("start")).otherwise(-1 - F.col("start")))
    rows = keyed.join(taken.withColumnRenamed("start", "_at"), ["src", "_at"], "left").select(
        F.col("id").alias(id_col), "t0", "t1", F.col("source").alias(source_col), "size", "source_size", "target",
        F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))
    pieces = pieces.select(
        "at", "src", "rank", F.col("id").alias(id_col),
        (F.col("from") - F.col("start")).alias("first_word"), (F.col("to") - F.col("from")).alias("n_words"))
    return Mix(rows, sources, schedule, pieces)


def take(docs: DataFrame, mix: Mix, id_col: str = "doc_id", text_col: str = "text",
         count_col: str = "n_chars") -> DataFrame:
    """The mixed documents in the columns of ``docs``: each as often as the mix takes it whole.

    The one document of a source that its target cuts ends after the words taken, and its
    ``count_col``, if there is one, is set anew. Rows are told by id, source and text.
    """
    t0, t1, turns, n, kept_words = free_names(docs, "_t0", "_t1", "_turns", "_n", "_words")
    keys = [id_col, t0, t1]
    hashes = text_hash(F.coalesce(F.col(text_col), F.lit("")))
    rows = docs.withColumns({t0: hashes[0], t1: hashes[1]})
    whole = F.when(F.col("size") > 0, F.floor(F.col("taken") / F.col("size"))).otherwise(0)
    taken = mix.rows.filter("taken > 0").select(
        F.col(id_col), F.col("t0").alias(t0), F.col("t1").alias(t1),
        whole.alias("whole"), (F.col("taken") - whole * F.col("size")).alias("cut"))
    # Rows alike in id and text are taken together.
    cuts = F.filter(F.collect_list("cut"), lambda c: c > 0)
    taken = store(taken.groupBy(*keys).agg(
        F.concat(F.array_repeat(F.lit(0).cast("long"), F.sum("whole").cast("int")), cuts).alias(turns),
        F.count("*").alias(n)), "taken")
    rows = one_each(rows, keys, taken.filter(F.col(n) > 1).select(*keys))
    mixed = rows.join(taken, same(rows, taken, keys)).select(
        *(rows[c] for c in docs.columns), F.explode(turns).alias(kept_words))
    words = F.regexp_extract_all(F.col(text_col), F.lit(f"{SPACE}*{WORD}"), F.lit(0))
    cut = F.when(F.col(kept_words) > 0, F.array_join(F.slice(words, F.lit(1), F.col(kept_words).cast("int")), ""))
    mixed = mixed.withColumn(text_col, F.coalesce(cut, F.col(text_col)))
    if count_col in docs.columns:
        kind = docs.schema[count_col].dataType
        counted = F.when(F.col(kept_words) > 0, F.length(text_col).cast(kind)).otherwise(F.col(count_col))
        mixed = mixed.withColumn(count_col, counted)
    return mixed.select(*docs.columns)


SQL = r"""
WITH sized AS (
  SELECT doc_id, source, md5(CAST(doc_id AS VARCHAR)) AS o,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size
  FROM documents),
by_source AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         [5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS w
  FROM sized GROUP BY source),
filled AS (
  SELECT *, sum(source_size) OVER () * 3 AS budget,
    sum(w) OVER (ORDER BY source_size / w, source NULLS LAST
                 ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open,
    (sum(source_size) OVER (ORDER BY source_size / w, source NULLS LAST
                            ROWS UNBOUNDED PRECEDING) - source_size) * 4 AS used
  FROM by_source),
flagged AS (SELECT *, 4 * source_size * open <= (budget - used) * w AS capped FROM filled),
rest AS (
  SELECT budget, used, open FROM flagged WHERE NOT capped
  ORDER BY source_size / w, source NULLS LAST LIMIT 1),
targets AS (
  SELECT source, source_size, CASE WHEN capped THEN 2.0::DOUBLE * source_size
    ELSE (SELECT CAST(budget - used AS DOUBLE) / 2.0::DOUBLE * w / open FROM rest) END AS target
  FROM flagged),
laid AS (
  SELECT s.doc_id, s.size, t.source_size, t.target, CAST(floor(t.target) AS BIGINT) AS words,
         sum(size) OVER (PARTITION BY s.source ORDER BY o, doc_id ROWS UNBOUNDED PRECEDING) - size AS start
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       CAST(CASE WHEN size = 0 THEN 0 ELSE words // source_size * size
            + greatest(0, least(size, words % source_size - start)) END AS BIGINT) AS taken
FROM laid"""


@query("op2_mixing", SQL)
def op2_mixing(spark: SparkSession, sf: str) -> DataFrame:
    """Words of every document that the mix takes, repeats counted."""
    rows = mix_sources(read(spark, sf, "documents")).rows
    return rows.select("doc_id", "size", "source_size", "target", "taken")
