"""Queries over cross-validation, collinearity and the assumptions of a regression."""

from __future__ import annotations

from pyspark.sql import functions as F

from statloom.operators.fairencode import FOLDS, fold_of
from statloom.operators.regression import ols_fit
from statloom.operators.validation import breusch_pagan, cross_validate, residual_normality, vif, white
from statloom.registry.base import query, table
from statloom.registry.fair import FOLD_SQL
from statloom.registry.sqltools import significant, significant_sql, upper_tail_sql

TARGET, FEATURE = "o_totalprice", "months"


def _orders(spark, sf):
    """Orders with their age in months: one predictor, so that SQL has closed forms."""
    return table(spark, sf, "orders").select(
        "o_orderkey", TARGET, (F.year("o_orderdate") * 12 + F.month("o_orderdate")).cast("double").alias(FEATURE))


ORDERS_SQL = """rows AS (SELECT o_orderkey, o_totalprice AS y,
    CAST(year(o_orderdate) * 12 + month(o_orderdate) AS DOUBLE) AS x FROM orders)"""


@query(
    "cross_validation",
    f"""WITH {ORDERS_SQL}, folded AS MATERIALIZED (SELECT *, {FOLD_SQL} FROM rows),
        fits AS (SELECT f.fold, regr_slope(y, x) AS b, regr_intercept(y, x) AS a
          FROM folded r JOIN (SELECT DISTINCT fold FROM folded) f ON r.fold <> f.fold GROUP BY f.fold),
        e AS (SELECT fold, y, y - a - b * x AS e FROM folded JOIN fits USING (fold))
        SELECT CAST(fold AS INTEGER) AS fold, count(*) AS n, round(1 - avg(e * e) / var_pop(y), 8) AS r2,
          {significant_sql('sqrt(avg(e * e))')} AS rmse, {significant_sql('avg(abs(e))')} AS mae FROM e GROUP BY fold""",
)
def cross_validation_query(spark, sf):
    found = cross_validate(_orders(spark, sf), TARGET, [FEATURE], fold_of(F.col("o_orderkey"), FOLDS))
    kept = found.select("fold", "n", F.round("r2", 8).alias("r2"))
    return kept.join(significant(found.select("fold", "rmse", "mae")), "fold")


@query(
    "vif",
    f"""WITH m AS (SELECT corr(l_quantity, l_extendedprice) AS a, corr(l_quantity, x) AS b, corr(l_extendedprice, x) AS c
          FROM (SELECT l_quantity, l_extendedprice, l_quantity * l_discount + l_tax AS x FROM lineitem)),
        d AS (SELECT *, 1 + 2 * a * b * c - a * a - b * b - c * c AS det FROM m),
        v AS (SELECT unnest([{{'n': 'l_quantity', 'v': (1 - c * c) / det}}, {{'n': 'l_extendedprice', 'v': (1 - b * b) / det}},
            {{'n': 'given', 'v': (1 - a * a) / det}}]) AS s FROM d)
        SELECT s.n AS variable, {significant_sql('(1 / s.v)')} AS tolerance, {significant_sql('s.v')} AS vif,
          s.v > 1.2 AS high, CAST(NULL AS VARCHAR) AS depends_on FROM v
        UNION ALL SELECT 'fixed', NULL, NULL, true, 'constant'
        UNION ALL SELECT 'both', 0, NULL, true, 'twice'
        UNION ALL SELECT 'twice', 0, NULL, true, 'both'""",
)
def vif_query(spark, sf):
    """Three features of the line items, a constant, and two columns that say the same."""
    lines = table(spark, sf, "lineitem").withColumns({
        "given": F.col("l_quantity") * F.col("l_discount") + F.col("l_tax"), "fixed": F.lit(4.0)})
    alone = vif(lines, ["l_quantity", "l_extendedprice", "given", "fixed"], 1.2)
    lines = lines.select(F.col("l_discount").alias("both"), (F.col("l_discount") * 2 + 1).alias("twice"))
    return significant(alone.union(vif(lines, ["both", "twice"])))


RESIDUAL_SQL = f"""{ORDERS_SQL}, fit AS (SELECT regr_slope(y, x) AS b, regr_intercept(y, x) AS a FROM rows),
    res AS MATERIALIZED (SELECT x - (SELECT avg(x) FROM rows) AS x, y - a - b * x AS e FROM rows, fit)"""


@query(
    "breusch_pagan",
    f"""WITH {RESIDUAL_SQL}, r AS (SELECT count(*) AS n, pow(corr(e * e, x), 2) AS r2 FROM res),
        t AS (SELECT n, n * r2 AS lm, r2 / ((1 - r2) / (n - 2)) AS f FROM r)
        SELECT 'Breusch-Pagan' AS test, n, 1 AS df, {significant_sql('lm', 4)} AS lm,
          round(2 * {upper_tail_sql('sqrt(lm)')}, 6) AS p, {significant_sql('f', 4)} AS f FROM t""",
)
def breusch_pagan_query(spark, sf):
    orders = _orders(spark, sf)
    found = breusch_pagan(orders, ols_fit(orders, TARGET, [FEATURE])).drop("f_p")
    return significant(found.drop("p"), 4).join(found.select("test", F.round("p", 6).alias("p")), "test")


@query(
    "white_test",
    f"""WITH {RESIDUAL_SQL}, c AS (SELECT count(*) AS n, corr(e * e, x) AS r1, corr(e * e, x * x) AS r2, corr(x, x * x) AS r12 FROM res),
        r AS (SELECT n, (r1 * r1 + r2 * r2 - 2 * r1 * r2 * r12) / (1 - r12 * r12) AS r2 FROM c),
        t AS (SELECT n, n * r2 AS lm, (r2 / 2) / ((1 - r2) / (n - 3)) AS f FROM r)
        SELECT 'White' AS test, n, 2 AS df, {significant_sql('lm', 4)} AS lm, round(exp(-lm / 2), 6) AS p,
          {significant_sql('f', 4)} AS f FROM t""",
)
def white_query(spark, sf):
    orders = _orders(spark, sf)
    found = white(orders, ols_fit(orders, TARGET, [FEATURE])).drop("f_p")
    return significant(found.drop("p"), 4).join(found.select("test", F.round("p", 6).alias("p")), "test")


@query(
    "residual_normality",
    f"""WITH {RESIDUAL_SQL}, s AS (SELECT count(*) AS n, avg(e) AS m, stddev_samp(e) AS d FROM res),
        z AS (SELECT (e - m) / d AS z, n, row_number() OVER (ORDER BY e) AS i FROM res, s),
        a AS (SELECT any_value(n) AS n, -any_value(n) - sum((2 * i - 1) * ln({upper_tail_sql('-z')})
            + (2 * n + 1 - 2 * i) * ln({upper_tail_sql('z')})) / any_value(n) AS a2 FROM z)
        SELECT a.n, {significant_sql('d')} AS std, {significant_sql('a2', 4)} AS a2, 0.0::DOUBLE AS p, false AS normal FROM a, s""",
)
def residual_normality_query(spark, sf):
    """All residuals; the given prices are far from normal."""
    orders = _orders(spark, sf)
    found = residual_normality(orders, ols_fit(orders, TARGET, [FEATURE])).drop("mean")
    return significant(found.drop("a2", "p")).join(significant(found.select("n", "a2"), 4), "n").join(
        found.select("n", F.round("p", 8).alias("p")), "n")
