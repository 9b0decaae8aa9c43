"""Queries over boosted trees and forests."""

from __future__ import annotations

from pyspark.sql import functions as F

from statloom.operators.trees import boost, first_splits, forest, importance, out_of_bag, predict_trees
from statloom.registry.base import query, table
from statloom.registry.sqltools import significant, significant_sql

KEY = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
FEATURES = ["l_quantity", "l_discount", "l_tax", "l_partkey"]
TARGET = "l_extendedprice"
BINS, MIN_LEAF, ROUNDS, RATE = 16, 20, 3, 0.5

CUTS_SQL = f"""lines AS MATERIALIZED (SELECT row_number() OVER () AS rid, {", ".join(KEY)}, l_quantity, l_discount, l_tax,
      l_extendedprice AS y FROM lineitem),
    cuts AS MATERIALIZED ({" UNION ".join(
        f"SELECT '{c}' AS f, {i} AS place, unnest(quantile_cont(CAST({c} AS DOUBLE), [k / {BINS}.0::DOUBLE FOR k IN range(1, {BINS})])) AS t FROM lines"
        for i, c in enumerate(FEATURES))})"""


def _sides_sql(rows: str, value: str) -> str:
    """Per place to split: rows and sum on the left."""
    return " UNION ALL ".join(
        f"SELECT f, place, t, count(*) AS nl, sum({value}) AS gl FROM {rows}, cuts WHERE f = '{c}' AND CAST({c} AS DOUBLE) <= t GROUP BY ALL"
        for c in FEATURES)


GAIN = "gl * gl / nl + (g - gl) * (g - gl) / (n - nl) - g * g / n"


@query(
    "tree_first_splits",
    f"""WITH {CUTS_SQL}, w AS (SELECT count(*) AS n, avg(y) AS m, var_pop(y) * count(*) AS v FROM lines),
        d AS (SELECT lines.* EXCLUDE (y), y - m AS e FROM lines, w),
        s AS ({_sides_sql('d', 'e')}), g AS (SELECT s.*, n, v, 0.0::DOUBLE AS g FROM s, w WHERE nl >= {MIN_LEAF} AND n - nl >= {MIN_LEAF})
        SELECT f AS variable, {significant_sql('t')} AS threshold, nl AS n_left, round(({GAIN}) / v, 6) AS share FROM g""",
)
def tree_first_splits(spark, sf):
    found = first_splits(table(spark, sf, "lineitem"), TARGET, FEATURES, KEY, BINS, MIN_LEAF)
    cut = significant(found.select("variable", "threshold", "n_left", F.col("share").cast("string").alias("share")))
    return cut.withColumn("share", F.round(F.col("share").cast("double"), 6))


def _boost_sql() -> str:
    ctes = [CUTS_SQL, f"w AS (SELECT count(*) AS n, {significant_sql('avg(y)', 5)} AS base FROM lines)",
            "r0 AS MATERIALIZED (SELECT lines.*, y - base AS e FROM lines, w)"]
    for k in range(ROUNDS):
        ctes.append(f"""s{k} AS ({_sides_sql(f'r{k}', 'e')}),
          b{k} AS MATERIALIZED (SELECT s.*, n, g FROM s{k} s, (SELECT count(*) AS n, sum(e) AS g FROM r{k})
            WHERE nl >= {MIN_LEAF} AND n - nl >= {MIN_LEAF} ORDER BY {GAIN} DESC, place, t LIMIT 1),
          r{k + 1} AS MATERIALIZED (SELECT r.* EXCLUDE (e), e - {RATE} * CASE WHEN CASE f {" ".join(
              f"WHEN '{c}' THEN CAST({c} AS DOUBLE)" for c in FEATURES)} END <= t THEN gl / nl ELSE (g - gl) / (n - nl) END AS e
            FROM r{k} r, b{k})""")
    return f"""WITH {", ".join(ctes)} SELECT {", ".join(KEY)}, {significant_sql(f'(y - e)', 4)} AS predicted FROM r{ROUNDS}"""


@query("boosted_trees", _boost_sql())
def boosted_trees(spark, sf):
    """Three rounds of boosted stumps; deeper trees are tested against exhaustive ones."""
    lines = table(spark, sf, "lineitem")
    model = boost(lines, TARGET, FEATURES, KEY, rounds=ROUNDS, depth=1, rate=RATE, bins=BINS, min_leaf=MIN_LEAF, ridge=0.0)
    return significant(predict_trees(lines, model).select(*KEY, "predicted"), 4)


@query("forest_out_of_bag")
def forest_out_of_bag(spark, sf):
    """Error of a random forest on the rows that its trees never drew."""
    lines = table(spark, sf, "lineitem")
    return significant(out_of_bag(lines, forest(lines, TARGET, FEATURES, KEY, trees=10, depth=5, share=0.5), KEY))


@query("boost_importance")
def boost_importance(spark, sf):
    """What the splits of ten trees of depth 3 took off the squared error, by feature."""
    lines = table(spark, sf, "lineitem")
    return significant(importance(lines, boost(lines, TARGET, FEATURES, KEY, rounds=10, depth=3, bins=BINS)))
