"""Queries over monthly lags and binary targets."""

from __future__ import annotations

from pyspark.sql import functions as F

from statloom.operators.classify import class_metrics, logit_fit, logit_table
from statloom.operators.monthly import add_monthly_lags
from statloom.plans.risk import study_risk
from statloom.registry.base import query, rounded, table
from statloom.registry.sqltools import significant, significant_sql

LAG_NAMES = ["lag1", "lag12", "mean3", "active3", "mean12", "active12", "gap", "seasonal"]


@query(
    "monthly_lags",
    f"""WITH t AS (SELECT o_custkey, CAST(year(o_orderdate) * 12 + month(o_orderdate) - 1 AS INTEGER) AS month,
            sum(o_totalprice) AS s FROM orders GROUP BY ALL),
        w AS (SELECT o_custkey, month, month - min(month) OVER (PARTITION BY o_custkey) AS known,
            sum(s) OVER (k RANGE BETWEEN 1 PRECEDING AND 1 PRECEDING) AS l1,
            sum(s) OVER (k RANGE BETWEEN 12 PRECEDING AND 12 PRECEDING) AS l12,
            sum(s) OVER (k RANGE BETWEEN 3 PRECEDING AND 1 PRECEDING) AS s3,
            sum(s) OVER (k RANGE BETWEEN 12 PRECEDING AND 1 PRECEDING) AS s12,
            count(s) OVER (k RANGE BETWEEN 3 PRECEDING AND 1 PRECEDING) AS c_active3,
            count(s) OVER (k RANGE BETWEEN 12 PRECEDING AND 1 PRECEDING) AS c_active12,
            month - lag(month) OVER k AS c_gap,
            sum(s) OVER (PARTITION BY o_custkey, month % 12 ORDER BY month ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS same,
            sum(s) OVER (k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before
          FROM t WINDOW k AS (PARTITION BY o_custkey ORDER BY month)),
        f AS (SELECT *, CASE WHEN known >= 1 THEN coalesce(l1, 0) END AS c_lag1,
            CASE WHEN known >= 12 THEN coalesce(l12, 0) END AS c_lag12,
            CASE WHEN known > 0 THEN coalesce(s3, 0) / least(known, 3) END AS c_mean3,
            CASE WHEN known > 0 THEN coalesce(s12, 0) / least(known, 12) END AS c_mean12,
            coalesce(same, 0) / before AS c_seasonal FROM w)
        SELECT o_orderkey, {", ".join(
            f'c_{c} AS customer_{c}' if c.startswith(("active", "gap")) else f"round(c_{c}, 6) AS customer_{c}"
            for c in LAG_NAMES)}
        FROM orders o LEFT JOIN f ON o.o_custkey = f.o_custkey AND year(o_orderdate) * 12 + month(o_orderdate) - 1 = f.month""",
)
def monthly_lags_query(spark, sf):
    """Every order with what its customer did in the months before."""
    made = add_monthly_lags(table(spark, sf, "orders"), "o_orderdate", "o_custkey", "o_totalprice", "customer")
    # Cents over at most 12 months have fewer than six decimals or no last one, so none is halfway.
    return rounded(made.select("o_orderkey", *(f"customer_{c}" for c in LAG_NAMES)), 6)


# One binary predictor, so that the fit has a closed form: a b / c d are the rows by predictor and class.
CELLS_SQL = """o AS (SELECT *, CAST(o_orderstatus = 'F' AS INTEGER) AS y,
      CAST(o_orderpriority IN ('1-URGENT', '2-HIGH') AS INTEGER) AS urgent FROM orders)"""
COUNTS_SQL = """n AS (SELECT 1.0 * sum((1 - urgent) * y) AS a, 1.0 * sum((1 - urgent) * (1 - y)) AS b,
      1.0 * sum(urgent * y) AS c, 1.0 * sum(urgent * (1 - y)) AS d FROM o{where})"""


def _classes(spark, sf):
    return table(spark, sf, "orders").withColumns({
        "y": (F.col("o_orderstatus") == "F").cast("int"),
        "urgent": F.col("o_orderpriority").isin("1-URGENT", "2-HIGH").cast("int"), "year": F.year("o_orderdate")})


@query(
    "logit_fit",
    f"""WITH {CELLS_SQL}, {COUNTS_SQL.format(where='')},
        t AS (SELECT 'const' AS term, ln(a / b) AS coef, sqrt(1 / a + 1 / b) AS se FROM n
          UNION ALL SELECT 'urgent', ln(c / d) - ln(a / b), sqrt(1 / a + 1 / b + 1 / c + 1 / d) FROM n)
        SELECT term, {significant_sql('coef')} AS coef, {significant_sql('se')} AS std_err,
          {significant_sql('(coef / se)')} AS z, {significant_sql('exp(coef)')} AS odds_ratio FROM t""",
)
def logit_fit_query(spark, sf):
    orders = _classes(spark, sf)
    return significant(logit_table(orders, logit_fit(orders, "y", ["urgent"])).drop("p"))


METRICS_SQL = """agg AS (SELECT {g}, count(*) AS n, CAST(sum(y) AS BIGINT) AS positives,
        avg(-y * ln(p) - (1 - y) * ln(1 - p)) AS log_loss, avg(pow(y - p, 2)) AS brier,
        avg(CAST((p >= 0.5) = (y = 1) AS INTEGER)) AS accuracy,
        1.0 * sum(CAST(p >= 0.5 AND y = 1 AS INTEGER)) / nullif(sum(CAST(p >= 0.5 AS INTEGER)), 0) AS precision,
        1.0 * sum(CAST(p >= 0.5 AND y = 1 AS INTEGER)) / nullif(sum(y), 0) AS recall
      FROM s GROUP BY 1),
    ranks AS (SELECT {g}, y, rank() OVER (PARTITION BY {g} ORDER BY p)
        + (count(*) OVER (PARTITION BY {g}, p) - 1) / 2.0 AS r FROM s),
    area AS (SELECT {g}, sum(y * r) AS r FROM ranks GROUP BY 1)
    SELECT {g}, n, positives, {auc} AS auc, {log_loss} AS log_loss, {brier} AS brier, {accuracy} AS accuracy,
      {precision} AS "precision", {recall} AS recall FROM agg JOIN area USING ({g})"""


def _metrics_sql(group: str) -> str:
    auc = "((r - positives * (positives + 1) / 2.0) / (positives * (n - positives)))"
    names = ("log_loss", "brier", "accuracy", "precision", "recall")
    return METRICS_SQL.format(g=group, auc=significant_sql(auc), **{c: significant_sql(c) for c in names})


@query(
    "class_metrics",
    f"""WITH {CELLS_SQL}, s AS (SELECT o_orderpriority, y, o_totalprice / (o_totalprice + 150000) AS p FROM o
          WHERE o_totalprice > 0), {_metrics_sql('o_orderpriority')}""",
)
def class_metrics_query(spark, sf):
    """How well an order's price tells whether it is finished, per priority."""
    orders = _classes(spark, sf).filter("o_totalprice > 0").withColumn(
        "p", F.col("o_totalprice") / (F.col("o_totalprice") + 150000))
    return significant(class_metrics(orders, "y", "p", ["o_orderpriority"]))


@query(
    "outstanding_risk",
    f"""WITH {CELLS_SQL}, {COUNTS_SQL.format(where=' WHERE year(o_orderdate) <= 1999')},
        s AS (SELECT CASE WHEN year(o_orderdate) <= 1999 THEN 'train' ELSE 'test' END AS part, y,
          CASE WHEN urgent = 1 THEN c / (c + d) ELSE a / (a + b) END AS p FROM o, n), {_metrics_sql('part')}""",
)
def outstanding_risk(spark, sf):
    """A model of the years up to 1999, judged on those and on the later ones."""
    return significant(study_risk(_classes(spark, sf), ["urgent"], 1999, "year", "y").metrics)
