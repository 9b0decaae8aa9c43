"""Queries over encodings that do not leak the target."""

from __future__ import annotations

from pyspark.sql import functions as F

from statloom.operators.fairencode import FOLDS, SEED, fold_of, shrinkage, smooth_encode, stat_encode_asof, stat_encode_oof
from statloom.registry.base import FACT_SQL, fact, query
from statloom.registry.sqltools import significant, significant_sql

KEY_SETS = {"te_seg": ["c_mktsegment"], "te_segPri": ["c_mktsegment", "o_orderpriority"], "te_cust": ["o_custkey"]}
# The rows from this year on are the test set.
CUT = 2000


def _facts(spark, sf):
    return fact(spark, sf).select("o_orderkey", "c_mktsegment", "o_orderpriority", "o_custkey", "year", "log_target")


def _joined_sql(extra: str, other: str, apart: str, statistics: dict[str, str]) -> str:
    """Per key set: statistics over the rows of a group that stand ``apart`` from a row's fold or time."""
    ctes, columns, joins = [], [], []
    for prefix, keys in KEY_SETS.items():
        ks, on = ", ".join(keys), " AND ".join(f"a.{k} = b.{k}" for k in keys)
        made = ", ".join(f"{sql} AS {s}" for s, sql in statistics.items())
        ctes.append(f"""{prefix} AS (SELECT {", ".join(f"b.{k}" for k in keys)}, b.{other}, {made} FROM rows a
            JOIN (SELECT DISTINCT {ks}, {other} FROM rows) b ON {on} AND {apart} GROUP BY ALL)""")
        columns += [f"coalesce({prefix}.count, 0) AS {prefix}_count" if s == "count"
                    else f"{significant_sql(f'{prefix}.{s}')} AS {prefix}_{s}" for s in statistics]
        joins.append(f"LEFT JOIN {prefix} USING ({ks}, {other})")
    return f"""WITH {FACT_SQL}, rows AS MATERIALIZED (SELECT o_orderkey, c_mktsegment, o_orderpriority, o_custkey,
        log_target AS y, {extra} FROM fact), {", ".join(ctes)}
        SELECT o_orderkey, {", ".join(columns)} FROM rows {" ".join(joins)}"""


FOLD_SQL = f"('0x' || substr(md5(CAST(o_orderkey AS VARCHAR) || ':{SEED}'), 1, 8))::BIGINT % {FOLDS} AS fold"
FIVE = {"mean": "avg(y)", "median": "median(y)", "std": "stddev_samp(y)", "max": "max(y)", "count": "count(y)"}


@query("stat_encode_oof", _joined_sql(FOLD_SQL, "fold", "a.fold <> b.fold", FIVE))
def stat_encode_oof_query(spark, sf):
    encoded = stat_encode_oof(_facts(spark, sf), KEY_SETS, "log_target", fold_of(F.col("o_orderkey")))
    return significant(encoded.select("o_orderkey", *(c for c in encoded.columns if c.startswith("te_"))))


@query(
    "stat_encode_asof",
    _joined_sql(f"least(year, {CUT}) AS moment", "moment", "a.moment < b.moment", {s: FIVE[s] for s in ("mean", "std", "max", "count")}),
)
def stat_encode_asof_query(spark, sf):
    """Rows of the test years only see rows before the cut; earlier rows only years before their own."""
    encoded = stat_encode_asof(_facts(spark, sf), KEY_SETS, "log_target", "year", CUT)
    return significant(encoded.select("o_orderkey", *(c for c in encoded.columns if c.startswith("te_"))))


@query(
    "shrinkage",
    f"""WITH {FACT_SQL}, g AS (SELECT o_custkey, count(*) AS n, avg(log_target) AS m,
          var_pop(log_target) * count(*) AS v FROM fact GROUP BY o_custkey),
        w AS (SELECT sum(n) AS n, count(*) AS g, sum(n * m) / sum(n) AS mean, sum(v) / (sum(n) - count(*)) AS inside,
          sum(n * n) AS nn FROM g),
        b AS (SELECT greatest(0, (sum(g.n * pow(g.m - w.mean, 2)) / (w.g - 1) - w.inside) / ((w.n - w.nn / w.n) / (w.g - 1)))
          AS between_ FROM g, w GROUP BY w.g, w.inside, w.n, w.nn),
        s AS (SELECT o_custkey, g.n, g.m, w.mean, CASE WHEN between_ > 0 THEN g.n / (g.n + w.inside / between_) ELSE 0 END AS k
          FROM g, w, b)
        SELECT o_custkey, n, {significant_sql('m')} AS mean, {significant_sql('k')} AS weight,
          {significant_sql('(mean + k * (m - mean))')} AS smoothed FROM s""",
)
def shrinkage_query(spark, sf):
    """Mean per customer, drawn to the mean of all by empirical Bayes."""
    return significant(shrinkage(fact(spark, sf), ["o_custkey"], "log_target"))


LEVELS = [["c_mktsegment"], ["c_mktsegment", "c_nationkey"], ["c_mktsegment", "c_nationkey", "o_custkey"]]


def _smooth_sql() -> str:
    ctes = [f"train AS (SELECT * FROM fact WHERE year < {CUT})", "t AS (SELECT avg(log_target) AS prior FROM train)"]
    joins = []
    for i, keys in enumerate(LEVELS):
        ks = ", ".join(keys)
        prior = f"JOIN v{i - 1} USING ({', '.join(LEVELS[i - 1])})" if i else "CROSS JOIN t"
        ctes.append(f"""g{i} AS (SELECT {ks}, count(*) AS n, avg(log_target) AS m, var_pop(log_target) * count(*) AS v
            FROM train GROUP BY {ks}),
          p{i} AS (SELECT {", ".join(keys)}, n, m, v, {f'v{i - 1}.s{i - 1}' if i else 'prior'} AS prior FROM g{i} {prior}),
          c{i} AS (SELECT sum(v) / nullif(sum(n) - count(*), 0) AS inside, sum(n * pow(m - prior, 2)) AS spread,
            count(*) AS g, sum(n) AS n FROM p{i}),
          b{i} AS (SELECT coalesce(inside, 0) AS inside, greatest(0, (spread - g * coalesce(inside, 0)) / n) AS between_ FROM c{i}),
          v{i} AS MATERIALIZED (SELECT {ks}, prior + CASE WHEN between_ > 0 THEN n / (n + inside / between_) ELSE 0 END * (m - prior)
            AS s{i} FROM p{i}, b{i})""")
        joins.append(f"LEFT JOIN v{i} USING ({ks})")
    best = ", ".join(f"s{i}" for i in reversed(range(len(LEVELS))))
    return f"""WITH {FACT_SQL}, {", ".join(ctes)}
        SELECT o_orderkey, round(coalesce({best}, prior), 8) AS te_smooth FROM fact {" ".join(joins)} CROSS JOIN t"""


@query("smooth_encode", _smooth_sql())
def smooth_encode_query(spark, sf):
    """Customers learned before the cut, drawn to their nation in the segment, to the segment, to all."""
    train = F.col("year") < CUT
    encoded = smooth_encode(fact(spark, sf), LEVELS, "log_target", "te", train)
    return encoded.select("o_orderkey", F.round("te_smooth", 8).alias("te_smooth"))
