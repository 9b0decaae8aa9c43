"""Removal of lines that many documents share: hash, count documents, drop, reassemble."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from statloom.llm.common import (
    SPACE_CHARS, ascii_lower, attach_groups, query, read, same, store, text_hash,
)

MIN_CHARS = 40
MIN_DOCS = 5


def _lines(text: F.Column) -> F.Column:
    return F.split(text, "\n", -1)


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """Drop lines that at least ``min_docs`` documents share, except in the largest id.

    A line's key is the line without ASCII white space at both ends and with A-Z
    lower-cased; only keys of at least ``min_chars`` code points count. Returns one row
    per input row: id_col, text (what stays, lines joined by \\n), n_lines, n_dropped.

    A null or empty text is one empty line. Rows with a null id count together as one
    document that is smaller than every other. Rows with equal ids count as one document;
    each row is returned. Further columns are not read. An empty table gives no rows.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    base = docs.select(F.col(id_col).alias("id"), text.alias("text"))
    base = base.select("id", "text", *(h.alias(f"t{i}") for i, h in enumerate(text_hash(F.col("text")))))
    lines = base.select("id", "t0", "t1", F.posexplode(_lines(F.col("text"))).alias("pos", "line"))
    keys = lines.select("id", "t0", "t1", "pos", F.btrim("line", F.lit(SPACE_CHARS)).alias("line"))
    keys = keys.filter(F.length("line") >= min_chars)
    hashes = [h.alias(f"h{i}") for i, h in enumerate(text_hash(ascii_lower(F.col("line"))))]
    found = store(keys.select("id", "t0", "t1", "pos", *hashes), "lines")

    # One row per line and document first, so a line in every document is counted in parts.
    held = found.select("h0", "h1", "id").distinct()
    shared = held.groupBy("h0", "h1").agg(F.count("*").alias("n"), F.max("id").alias("keeper"))
    shared = store(shared.filter(F.col("n") >= min_docs), "shared-lines")
    marked = attach_groups(found, shared, ["h0", "h1"], "n", found.count())
    gone = marked.filter(F.col("n").isNotNull() & ~F.col("id").eqNullSafe(F.col("keeper")))
    cuts = gone.groupBy("id", "t0", "t1").agg(F.sort_array(F.collect_set("pos")).alias("cuts"))

    joined = base.join(cuts, same(base, cuts, ["id", "t0", "t1"]), "left")
    joined = joined.select(base["id"], "text", "cuts").withColumn("lines", _lines(F.col("text")))
    # What stays are the runs of lines between neighbouring cuts.
    ends = F.concat(F.array(F.lit(-1)), F.col("cuts"), F.array(F.size("lines")))
    runs = F.transform(F.sequence(F.lit(1), F.size("cuts") + 1),
                       lambda j: F.slice("lines", F.get("ends", j - 1) + 2,
                                         F.get("ends", j) - F.get("ends", j - 1) - 1))
    kept = F.when(F.col("cuts").isNull(), F.col("text")).otherwise(F.array_join(F.flatten(runs), "\n"))
    return joined.withColumn("ends", ends).select(
        F.col("id").alias(id_col), kept.alias("text"), F.size("lines").cast("long").alias("n_lines"),
        F.coalesce(F.size("cuts"), F.lit(0)).cast("long").alias("n_dropped"))


SQL = r"""
WITH lines AS (
  SELECT doc_id, unnest(l) AS line, unnest(range(len(l))) AS pos
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents)),
keyed AS (
  SELECT doc_id, pos, line,
         translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM lines),
shared AS (
  SELECT k, max(doc_id) AS keeper FROM keyed WHERE length(k) >= 40
  GROUP BY k HAVING count(DISTINCT doc_id) >= 5),
marked AS (
  SELECT doc_id, pos, line, keeper IS NOT NULL AND keeper <> doc_id AS gone
  FROM keyed LEFT JOIN shared USING (k))
SELECT doc_id, count(*) AS n_lines, CAST(count(*) FILTER (WHERE gone) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id"""


@query("op9_line_dedup", SQL)
def op9_line_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """Lines of at least 40 code points in at least 5 documents stay only in the largest id."""
    kept = line_dedup(read(spark, sf, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))
