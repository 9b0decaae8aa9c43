"""Queries over transforms, normality tests, samples, estimates and regression."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from statloom.functions.columns import flag
from statloom.functions.normal import CENTRE, SHOULDER, TAIL
from statloom.functions.power import (
    box_cox,
    inverse,
    inverse_box_cox,
    natural_log,
    square_root,
    yeo_johnson,
    z_score,
)
from statloom.operators.estimation import estimators, sample_size
from statloom.operators.keyed import attach
from statloom.operators.normality import (
    add_transforms,
    best_transforms,
    compare_transforms,
    fit_transforms,
    shapiro_groups,
)
from statloom.operators.powerfit import (
    box_cox_fit,
    likelihood_grid,
    value_range,
    yeo_johnson_fit,
)
from statloom.operators.regression import (
    coefficient_table,
    durbin_watson,
    ols_fit,
    ols_predict,
    ols_summary,
)
from statloom.operators.sampling import hash_sample, scatter_sample, systematic_sample
from statloom.registry.base import FACT_SQL, fact, query, rounded, table
from statloom.registry.sqltools import (
    BOX_COX,
    SHAPIRO_Z,
    YEO_JOHNSON,
    fit_ctes,
    significant,
    significant_sql,
    upper_tail_sql,
    verdict_sql,
)
from statloom.registry.statistics import _ratio_sql

# --- transforms with known parameters --------------------------------------------


@query(
    "zscore",
    """SELECT o_orderkey, round((o_totalprice - m) / s, 6) AS z FROM orders,
       (SELECT avg(o_totalprice) AS m, stddev_samp(o_totalprice) AS s FROM orders)""",
)
def zscore(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    stats = orders.agg(
        F.avg("o_totalprice").alias("m"), F.stddev_samp("o_totalprice").alias("s")
    )
    z = z_score("o_totalprice", F.col("m"), F.col("s"))
    return attach(orders, stats).select("o_orderkey", F.round(z, 6).alias("z"))


@query(
    "zscore_grouped",
    """SELECT o_orderkey, round((o_totalprice - m) / s, 6) AS z FROM orders JOIN
       (SELECT o_orderstatus, avg(o_totalprice) AS m, stddev_samp(o_totalprice) AS s
        FROM orders GROUP BY 1) USING (o_orderstatus)""",
)
def zscore_grouped(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    stats = orders.groupBy("o_orderstatus").agg(
        F.avg("o_totalprice").alias("m"), F.stddev_samp("o_totalprice").alias("s")
    )
    z = z_score("o_totalprice", F.col("m"), F.col("s"))
    return attach(orders, stats, ["o_orderstatus"]).select("o_orderkey", F.round(z, 6).alias("z"))


@query(
    "log_sqrt_inv",
    """SELECT c_custkey, CASE WHEN c_acctbal > 0 THEN round(ln(c_acctbal), 6) END AS log,
              CASE WHEN c_acctbal >= 0 THEN round(sqrt(c_acctbal), 6) END AS root,
              CASE WHEN c_acctbal <> 0 THEN round(1 / c_acctbal, 8) END AS inverse FROM customer""",
)
def log_sqrt_inv(spark, sf):
    return table(spark, sf, "customer").select(
        "c_custkey",
        F.round(natural_log("c_acctbal"), 6).alias("log"),
        F.round(square_root("c_acctbal"), 6).alias("root"),
        F.round(inverse("c_acctbal"), 8).alias("inverse"),
    )


@query(
    "sign_gates",
    """SELECT count(*) AS n, min(c_acctbal) AS min, max(c_acctbal) AS max,
              bool_and(c_acctbal > 0) AS all_positive, bool_and(c_acctbal >= 0) AS all_non_negative
       FROM customer""",
)
def sign_gates(spark, sf):
    known = value_range(table(spark, sf, "customer"), "c_acctbal")
    names = ("n", "min", "max", "all_positive", "all_non_negative")
    schema = "n bigint, min double, max double, all_positive boolean, all_non_negative boolean"
    return spark.createDataFrame([tuple(known[k] for k in names)], schema)


# Fixed value: a published lambda, to test applying one.
LAMBDA = 1.2623624250829306


@query(
    "boxcox_apply",
    f"""SELECT o_orderkey, round((pow(x, {LAMBDA}) - 1) / {LAMBDA}, 6) AS y, round(ln(x), 6) AS y0
        FROM (SELECT o_orderkey, ln(1 + o_totalprice) AS x FROM orders)""",
)
def boxcox_apply(spark, sf):
    x = F.log1p("o_totalprice")
    return table(spark, sf, "orders").select(
        "o_orderkey",
        F.round(box_cox(x, LAMBDA), 6).alias("y"),
        F.round(box_cox(x, 0.0), 6).alias("y0"),
    )


@query(
    "boxcox_inverse",
    f"""SELECT o_orderkey, CASE WHEN y * {LAMBDA} + 1 > 0
              THEN round(pow(y * {LAMBDA} + 1, 1 / {LAMBDA}), 6) END AS x
        FROM (SELECT o_orderkey, o_totalprice / 10000 - 5 AS y FROM orders)""",
)
def boxcox_inverse(spark, sf):
    y = F.col("o_totalprice") / 10000 - 5
    return table(spark, sf, "orders").select(
        "o_orderkey", F.round(inverse_box_cox(y, LAMBDA), 6).alias("x")
    )


@query(
    "yeojohnson_apply",
    """SELECT c_custkey, round(CASE WHEN c_acctbal >= 0 THEN (pow(c_acctbal + 1, 0.9) - 1) / 0.9
              ELSE -(pow(1 - c_acctbal, 1.1) - 1) / 1.1 END, 5) AS y FROM customer""",
)
def yeojohnson_apply(spark, sf):
    return table(spark, sf, "customer").select(
        "c_custkey", F.round(yeo_johnson("c_acctbal", 0.9), 5).alias("y")
    )


# --- lambda search ---------------------------------------------------------------

GRID = [i / 4 for i in range(-4, 9)]


@query(
    "boxcox_likelihood",
    f"""WITH g AS (SELECT i / 4.0 AS lam FROM range(-4, 9) t(i)),
        y AS (SELECT CAST(lam AS DOUBLE) AS lam, ln(o_totalprice) AS l,
                CASE WHEN lam = 0 THEN ln(o_totalprice) ELSE (pow(o_totalprice, lam) - 1) / lam END AS y
              FROM orders, g)
        SELECT lam AS "lambda", round((lam - 1) * sum(l) - count(*) / 2.0 * ln(var_pop(y)), 3)
               AS log_likelihood FROM y GROUP BY lam""",
)
def boxcox_likelihood(spark, sf):
    return rounded(likelihood_grid(table(spark, sf, "orders"), "o_totalprice", GRID), 3)


@query(
    "yeojohnson_likelihood",
    """WITH g AS (SELECT CAST(i / 4.0 AS DOUBLE) AS lam FROM range(-4, 9) t(i)),
        y AS (SELECT lam, sign(c_acctbal) * ln(1 + abs(c_acctbal)) AS l,
                CASE WHEN c_acctbal >= 0 THEN CASE WHEN lam = 0 THEN ln(1 + c_acctbal)
                       ELSE (pow(1 + c_acctbal, lam) - 1) / lam END
                     ELSE CASE WHEN lam = 2 THEN -ln(1 - c_acctbal)
                       ELSE -(pow(1 - c_acctbal, 2 - lam) - 1) / (2 - lam) END END AS y
              FROM customer, g)
        SELECT lam AS "lambda", round((lam - 1) * sum(l) - count(*) / 2.0 * ln(var_pop(y)), 3)
               AS log_likelihood FROM y GROUP BY lam""",
)
def yeojohnson_likelihood(spark, sf):
    grid = likelihood_grid(table(spark, sf, "customer"), "c_acctbal", GRID, signed=True)
    return rounded(grid, 3)


def _search_sql(source: str, power: str, slope: str) -> str:
    """Three zooming grids and a parabola in SQL; ``s`` is the log value, ``lam`` the lambda."""
    loss = f"0.5 * ln(var_pop({power})) - lam * {slope}"
    levels = [f"x AS ({source})"]
    for k, (step, centre) in enumerate(
        [(1 / 8, "0"), (1 / 128, "(SELECT b FROM b0)"), (1 / 2048, "(SELECT b FROM b1)")]
    ):
        levels.append(
            f"""g{k} AS (SELECT {centre} + i * {step}::DOUBLE AS lam FROM range(-16, 17) t(i)),
            l{k} AS (SELECT lam, {loss} AS loss FROM x, g{k} GROUP BY lam),
            b{k} AS (SELECT arg_min(lam, loss) AS b FROM l{k})"""
        )
    last = f"{1 / 2048}::DOUBLE"
    return f"""WITH {', '.join(levels)},
        w AS (SELECT lam, loss AS c, lag(loss) OVER (ORDER BY lam) AS a,
                lead(loss) OVER (ORDER BY lam) AS e FROM l2)
        SELECT round(lam + {last} * 0.5 * (a - e) / (a - 2 * c + e), 4) AS "lambda"
        FROM w WHERE lam = (SELECT b FROM b2)"""


@query(
    "boxcox_fit",
    _search_sql(
        "SELECT ln(o_totalprice) - (SELECT avg(ln(o_totalprice)) FROM orders) AS s FROM orders",
        "CASE WHEN lam = 0 THEN s ELSE (exp(s * lam) - 1) / lam END",
        "0",
    ),
)
def boxcox_fit(spark, sf):
    lam = box_cox_fit(table(spark, sf, "orders"), "o_totalprice")
    return spark.range(1).select(F.round(F.lit(lam), 4).alias("lambda"))


@query(
    "yeojohnson_fit",
    _search_sql(
        "SELECT sign(c_acctbal) * ln(1 + abs(c_acctbal)) AS s FROM customer",
        """CASE WHEN s >= 0 THEN CASE WHEN lam = 0 THEN s ELSE (exp(s * lam) - 1) / lam END
           ELSE CASE WHEN lam = 2 THEN s ELSE -(exp(-s * (2 - lam)) - 1) / (2 - lam) END END""",
        "(SELECT avg(s) FROM x)",
    ),
)
def yeojohnson_fit(spark, sf):
    lam = yeo_johnson_fit(table(spark, sf, "customer"), "c_acctbal")
    return spark.range(1).select(F.round(F.lit(lam), 4).alias("lambda"))


# --- normality -------------------------------------------------------------------


def _shapiro_sql(table: str, group: str, value: str, key: str, n: int) -> str:
    """W of the seeded sample of each group, in SQL."""
    last = "0.221157*u - 0.147981*u*u - 2.071190*pow(u,3) + 4.434685*pow(u,4) - 2.706056*pow(u,5)"
    nxt = "0.042981*u - 0.293762*u*u - 1.752461*pow(u,3) + 5.682633*pow(u,4) - 3.582633*pow(u,5)"
    return f"""s AS (SELECT {group} AS g, {value} AS v, row_number() OVER (PARTITION BY {group}
              ORDER BY md5({key} || '|42'), {key}) AS h FROM {table}),
        r AS (SELECT g, v, row_number() OVER (PARTITION BY g ORDER BY v) AS i,
                CAST(count(*) OVER (PARTITION BY g) AS DOUBLE) AS n FROM s WHERE h <= {n}),
        p AS (SELECT *, (i - 0.375) / (n + 0.25) AS p FROM r),
        z AS (SELECT *, p - 0.5 AS q, 0.180625 - (p - 0.5) * (p - 0.5) AS c,
                sqrt(-ln(least(p, 1 - p))) - 1.6 AS a, sqrt(-ln(least(p, 1 - p))) - 5 AS b FROM p),
        m AS (SELECT g, v, i, n, 1 / sqrt(n) AS u, CASE WHEN abs(q) <= 0.425
                THEN q * {_ratio_sql('c', CENTRE)}
                WHEN a <= 3.4 THEN sign(q) * {_ratio_sql('a', SHOULDER)}
                ELSE sign(q) * {_ratio_sql('b', TAIL)} END AS m FROM z),
        t AS (SELECT g, n, u, sum(m * m) AS mm, max(m) AS m1, max(m) FILTER (i < n) AS m2,
                n * var_pop(v) AS ss FROM m GROUP BY g, n, u),
        k AS (SELECT *, m1 / sqrt(mm) + {last} AS a1, m2 / sqrt(mm) + {nxt} AS a2 FROM t),
        f AS (SELECT *, (mm - 2*m1*m1 - 2*m2*m2) / (1 - 2*a1*a1 - 2*a2*a2) AS phi FROM k),
        w AS (SELECT m.g, m.n, pow(sum(v * CASE WHEN i = m.n THEN a1 WHEN i = m.n - 1 THEN a2
                WHEN i = 1 THEN -a1 WHEN i = 2 THEN -a2 ELSE m / sqrt(phi) END), 2) / any_value(ss) AS w
              FROM m JOIN f USING (g) GROUP BY m.g, m.n)"""


@query(
    "shapiro_w",
    f"""WITH {FACT_SQL}, {_shapiro_sql('fact', 'c_mktsegment', 'o_totalprice', 'o_orderkey', 2000)}
        SELECT g AS c_mktsegment, CAST(n AS BIGINT) AS n, round(w, 8) AS w FROM w""",
)
def shapiro_w(spark, sf):
    tested = shapiro_groups(fact(spark, sf), "o_totalprice", ["c_mktsegment"], ["o_orderkey"], 2000)
    return tested.select("c_mktsegment", "n", F.round("w", 8).alias("w"))


@query(
    "shapiro_groups",
    f"""WITH {FACT_SQL}, {_shapiro_sql('fact', 'c_mktsegment', 'log_target', 'o_orderkey', 5000)},
        score AS (SELECT *, {SHAPIRO_Z} AS z FROM w), tail AS (SELECT *, {upper_tail_sql('z')} AS p FROM score)
        SELECT g AS c_mktsegment, CAST(n AS BIGINT) AS n, round(w, 8) AS w, round(p, 8) AS p,
          {verdict_sql('p')} AS result FROM tail""",
)
def shapiro_groups_query(spark, sf):
    tested = shapiro_groups(fact(spark, sf), "log_target", ["c_mktsegment"], ["o_orderkey"])
    return rounded(tested, 8)


def _logged(spark, sf):
    return table(spark, sf, "orders").select(
        "o_orderkey", "o_totalprice", F.log1p("o_totalprice").alias("log_target")
    )


# Digits of a fitted lambda that two searches share.
LAMBDA_DIGITS = 3


def shared_lambdas(fitted):
    """The fit with its lambdas rounded to what both searches agree on."""
    return replace(fitted, **{
        name: None if lam is None else round(lam, LAMBDA_DIGITS)
        for name in ("box_cox_lambda", "yeo_johnson_lambda") for lam in (getattr(fitted, name),)})


def fits_sql(value: str, reach: int = 48, digits: int = 12) -> str:
    """CTEs of both lambdas of a positive column: ``bc`` and ``yj``, over ``src`` (key, x)."""
    return ", ".join([
        f"src AS MATERIALIZED (SELECT o_orderkey, {value} AS x FROM orders)",
        fit_ctes("bc", "SELECT ln(x) - (SELECT avg(ln(x)) FROM src) AS s FROM src", BOX_COX, "0", reach, digits),
        fit_ctes("yj", "SELECT ln(1 + x) AS s FROM src", YEO_JOHNSON, "(SELECT avg(s) FROM {x})", reach, digits),
    ])


def transforms_sql() -> dict[str, str]:
    """Every transform of a positive ``x`` by its display name."""
    return {
        "Original": "x",
        "Box-Cox": "(pow(x, (SELECT lam FROM bc)) - 1) / (SELECT lam FROM bc)",
        "Yeo-Johnson": "(pow(x + 1, (SELECT lam FROM yj)) - 1) / (SELECT lam FROM yj)",
        "Log": "ln(x)", "Raiz Quadrada": "sqrt(x)", "Inversa": "1 / x",
        "Z-Score": "(x - (SELECT avg(x) FROM src)) / (SELECT stddev_samp(x) FROM src)",
    }


def compared_sql(value: str) -> str:
    """CTEs up to ``tests``: the Shapiro-Wilk test of every transform on one sample."""
    rows = " UNION ALL ".join(
        f"SELECT o_orderkey, '{name}' AS transform, {sql} AS v FROM src" for name, sql in transforms_sql().items())
    return f"""{fits_sql(value)}, variants AS MATERIALIZED ({rows}),
        {_shapiro_sql('variants', 'transform', 'v', 'o_orderkey', 5000)},
        score AS (SELECT *, {SHAPIRO_Z} AS z FROM w), tail AS (SELECT *, {upper_tail_sql('z')} AS p FROM score),
        tests AS (SELECT g AS transform, CASE g WHEN 'Box-Cox' THEN (SELECT lam FROM bc)
            WHEN 'Yeo-Johnson' THEN (SELECT lam FROM yj) END AS lam, CAST(n AS BIGINT) AS n, w, p,
            {verdict_sql('p')} AS result FROM tail)"""


COMPARED = """SELECT transform, round(lam, 3) AS "lambda", n, round(w, 6) AS w, round(p, 6) AS p, result FROM tests"""


def compared_rounded(tests):
    """Lambdas and statistics to the digits that two searches share."""
    digits = {"lambda": 3, "w": 6, "p": 6}
    return tests.withColumns({c: F.round(c, d) for c, d in digits.items()})


@query("compare_transforms", f"WITH {compared_sql('ln(1 + o_totalprice)')} {COMPARED}")
def compare_transforms_query(spark, sf):
    orders = _logged(spark, sf)
    return compared_rounded(compare_transforms(orders, fit_transforms(orders, "log_target"), ["o_orderkey"]))


@query(
    "best_transforms",
    f"WITH {compared_sql('ln(1 + o_totalprice)')} {COMPARED} ORDER BY round(ln(nullif(tests.p, 0)), 6) DESC NULLS LAST, transform LIMIT 3",
)
def best_transforms_query(spark, sf):
    orders = _logged(spark, sf)
    compared = compare_transforms(orders, fit_transforms(orders, "log_target"), ["o_orderkey"])
    return compared_rounded(best_transforms(compared, 3))


def snake(name: str) -> str:
    return "target_" + name.lower().replace("-", "_").replace(" ", "_")


ADDED_SQL = ", ".join(
    f"{significant_sql(f'({sql})', 5)} AS {snake(name)}"
    for name, sql in transforms_sql().items() if name != "Original"
)


@query("add_transforms", f"WITH {fits_sql('o_totalprice', 8, LAMBDA_DIGITS)} SELECT o_orderkey, {ADDED_SQL} FROM src")
def add_transforms_query(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    wide = add_transforms(orders, shared_lambdas(fit_transforms(orders, "o_totalprice")))
    return significant(wide.drop("o_totalprice"), 5)


# --- samples ---------------------------------------------------------------------


@query(
    "hash_sample",
    """SELECT * FROM orders ORDER BY md5(o_orderkey || '|42'), o_orderkey LIMIT 5000""",
)
def hash_sample_query(spark, sf):
    return hash_sample(table(spark, sf, "orders"), ["o_orderkey"], 5000)


@query(
    "hash_sample_grouped",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipmode, l_extendedprice
       FROM (SELECT *, l_returnflag || l_linestatus AS l_shipmode, row_number() OVER (
          PARTITION BY l_returnflag || l_linestatus
          ORDER BY md5(l_orderkey || '|' || l_linenumber || '|' || l_partkey || '|' || l_suppkey || '|7'),
                   l_orderkey, l_linenumber, l_partkey, l_suppkey) AS r FROM lineitem) WHERE r <= 300""",
)
def hash_sample_grouped(spark, sf):
    key = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    lines = table(spark, sf, "lineitem").select(
        *key, F.concat("l_returnflag", "l_linestatus").alias("l_shipmode"), "l_extendedprice"
    )
    return hash_sample(lines, key, 300, seed=7, group_cols=["l_shipmode"])


@query(
    "systematic_sample",
    """SELECT o_orderkey, o_totalprice, row_id FROM (SELECT o_orderkey, o_totalprice,
         row_number() OVER (ORDER BY o_orderkey) - 1 AS row_id FROM orders) WHERE row_id % 11 = 0""",
)
def systematic_sample_query(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return systematic_sample(orders, ["o_orderkey"])


@query(
    "scatter_sample",
    """SELECT o_orderkey, o_totalprice AS x, round(ln(1 + o_totalprice), 6) AS y
       FROM orders ORDER BY md5(o_orderkey || '|42'), o_orderkey LIMIT 2000""",
)
def scatter_sample_query(spark, sf):
    points = scatter_sample(_logged(spark, sf), "o_totalprice", "log_target", ["o_orderkey"])
    return points.withColumn("y", F.round("y", 6))


# --- estimates -------------------------------------------------------------------

FLAG_SQL = "CAST(o_totalprice >= 100000 AS INTEGER)"


def _flagged(spark, sf):
    return fact(spark, sf).withColumn("large", flag(F.col("o_totalprice") >= 100000))


@query(
    "estimators",
    f"""WITH {FACT_SQL} SELECT c_mktsegment, count(*) AS n, round(avg({FLAG_SQL}), 6) AS proportion,
        round(avg(o_totalprice), 4) AS mean, round(var_samp(o_totalprice), 0) AS variance
        FROM fact GROUP BY 1""",
)
def estimators_query(spark, sf):
    found = estimators(_flagged(spark, sf), "o_totalprice", "large", ["c_mktsegment"])
    return found.withColumns(
        {
            "proportion": F.round("proportion", 6),
            "mean": F.round("mean", 4),
            "variance": F.round("variance", 0),
        }
    )


@query(
    "sample_size_by_group",
    f"""WITH {FACT_SQL}, b AS (SELECT c_mktsegment, count(*) AS population,
          avg({FLAG_SQL}) AS p FROM fact GROUP BY 1),
        s AS (SELECT *, 1.96 * 1.96 * p * (1 - p) / (0.02 * 0.02) AS n0 FROM b),
        a AS (SELECT *, CASE WHEN n0 / population > 0.05
                THEN n0 / (1 + (n0 - 1) / population) ELSE n0 END AS n1 FROM s)
        SELECT c_mktsegment, population, round(p, 6) AS proportion, round(n0, 4) AS n_raw,
          round(n1, 4) AS n_adjusted, round(n1 / population * 100, 4) AS share_pct FROM a""",
)
def sample_size_by_group(spark, sf):
    sized = sample_size(_flagged(spark, sf), "large", 1.96, 0.02, ["c_mktsegment"])
    digits = {"proportion": 6, "n_raw": 4, "n_adjusted": 4, "share_pct": 4}
    return sized.withColumns({c: F.round(c, d) for c, d in digits.items()})


# --- regression ------------------------------------------------------------------

ROWS_SQL = "SELECT l_quantity AS a, l_discount AS b, l_extendedprice AS y, * FROM lineitem"
SOLVE_SQL = f"""d AS ({ROWS_SQL}),
    c AS (SELECT count(*) AS n, avg(a) AS ma, avg(b) AS mb, avg(y) AS my, var_pop(a) AS saa,
            var_pop(b) AS sbb, covar_pop(a, b) AS sab, covar_pop(a, y) AS say,
            covar_pop(b, y) AS sby, var_pop(y) AS syy FROM d),
    k AS (SELECT *, (say * sbb - sby * sab) / (saa * sbb - sab * sab) AS ba,
            (sby * saa - say * sab) / (saa * sbb - sab * sab) AS bb FROM c),
    f AS (SELECT *, my - ba * ma - bb * mb AS b0, n * (syy - ba * say - bb * sby) AS sse FROM k)"""
PREDICTORS = ["l_quantity", "l_discount"]
LINE_KEY = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]


@query(
    "ols_simple",
    """SELECT round(regr_intercept(l_extendedprice, l_quantity), 4) AS intercept,
              round(regr_slope(l_extendedprice, l_quantity), 6) AS slope,
              round(regr_r2(l_extendedprice, l_quantity), 10) AS r2 FROM lineitem""",
)
def ols_simple(spark, sf):
    fit = ols_fit(table(spark, sf, "lineitem"), "l_extendedprice", ["l_quantity"])
    r2 = 1.0 - fit.ss_residual / fit.ss_total
    return spark.range(1).select(
        F.round(F.lit(fit.coefficients[0]), 4).alias("intercept"),
        F.round(F.lit(fit.coefficients[1]), 6).alias("slope"),
        F.round(F.lit(r2), 10).alias("r2"),
    )


@query(
    "ols_fit",
    f"""WITH {SOLVE_SQL}, e AS (SELECT *, sse / (n - 3) AS s2, saa * sbb - sab * sab AS det FROM f),
        t AS (SELECT 'const' AS term, b0 AS coef, sqrt(s2 / n * (1 + (ma*ma*sbb - 2*ma*mb*sab + mb*mb*saa) / det)) AS se FROM e
              UNION ALL SELECT 'l_quantity', ba, sqrt(s2 / n * sbb / det) FROM e
              UNION ALL SELECT 'l_discount', bb, sqrt(s2 / n * saa / det) FROM e)
        SELECT term, round(coef, 4) AS coef, round(se, 4) AS std_err, round(coef / se, 4) AS t FROM t""",
)
def ols_fit_query(spark, sf):
    lines = table(spark, sf, "lineitem")
    fitted = coefficient_table(lines, ols_fit(lines, "l_extendedprice", PREDICTORS))
    return rounded(fitted.select("term", "coef", "std_err", "t"))


# Two-sided p-value and 97.5 % quantile of Student's t, by their expansions in 1 / freedom.
T_TAIL_SQL = f"""least(1, 2 * ({upper_tail_sql('abs(t)')}
    + exp(-0.5 * t * t) / sqrt(2 * pi()) * abs(t) * (t * t + 1) / (4 * v)))"""
Z975 = 1.959963984540054
T_REACH_SQL = (f"({Z975} + (pow({Z975}, 3) + {Z975}) / (4 * v)"
               f" + (5 * pow({Z975}, 5) + 16 * pow({Z975}, 3) + 3 * {Z975}) / (96 * v * v))")


@query(
    "ols_coefficients",
    f"""WITH {SOLVE_SQL}, e AS (SELECT *, sse / (n - 3) AS s2, saa * sbb - sab * sab AS det FROM f),
        c1 AS (SELECT 'const' AS term, b0 AS coef, n - 3.0 AS v,
                 sqrt(s2 / n * (1 + (ma*ma*sbb - 2*ma*mb*sab + mb*mb*saa) / det)) AS se FROM e
              UNION ALL SELECT 'l_quantity', ba, n - 3.0, sqrt(s2 / n * sbb / det) FROM e
              UNION ALL SELECT 'l_discount', bb, n - 3.0, sqrt(s2 / n * saa / det) FROM e),
        t AS (SELECT *, coef / se AS t FROM c1)
        SELECT term, round(coef, 4) AS coef, round(se, 4) AS std_err, round(t, 4) AS t, round({T_TAIL_SQL}, 6) AS p,
          round(coef - {T_REACH_SQL} * se, 3) AS ci_low, round(coef + {T_REACH_SQL} * se, 3) AS ci_high FROM t""",
)
def ols_coefficients(spark, sf):
    lines = table(spark, sf, "lineitem")
    fitted = coefficient_table(lines, ols_fit(lines, "l_extendedprice", PREDICTORS))
    digits = {"coef": 4, "std_err": 4, "t": 4, "p": 6, "ci_low": 3, "ci_high": 3}
    return fitted.withColumns({c: F.round(c, d) for c, d in digits.items()})


RESIDUAL_SQL = """r AS (SELECT y - (b0 + ba * a + bb * b) AS e,
      row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS i
      FROM d, f),
    w AS (SELECT e, e - lag(e) OVER (ORDER BY i) AS step FROM r)"""


# Scores of skewness (D'Agostino) and kurtosis (Anscombe and Glynn), as in the library.
SCORES_SQL = """y AS (SELECT *, g1 * sqrt((n + 1.0) * (n + 3) / (6.0 * (n - 2))) AS y,
      3.0 * (n * n + 27.0 * n - 70) * (n + 1) * (n + 3) / ((n - 2.0) * (n + 5) * (n + 7) * (n + 9)) AS b2,
      (g2 - 3.0 * (n - 1) / (n + 1)) / sqrt(24.0 * n * (n - 2) * (n - 3)
        / (pow(n + 1.0, 2) * (n + 3) * (n + 5))) AS x,
      6.0 * (n * n - 5.0 * n + 2) / ((n + 7.0) * (n + 9))
        * sqrt(6.0 * (n + 3) * (n + 5) / (n * (n - 2.0) * (n - 3))) AS root FROM v),
    kk AS (SELECT *, sqrt(2 * (b2 - 1)) - 1 AS w2, 6 + 8 / root * (2 / root + sqrt(1 + 4 / (root * root))) AS a FROM y),
    u AS (SELECT *, y / sqrt(2 / (w2 - 1)) AS q, (1 - 2 / a) / (1 + x * sqrt(2 / (a - 4))) AS ratio FROM kk),
    o AS (SELECT *, pow(ln(q + sqrt(q * q + 1)) / sqrt(0.5 * ln(w2)), 2)
        + pow((1 - 2 / (9 * a) - cbrt(ratio)) / sqrt(2 / (9 * a)), 2) AS omnibus,
        n / 6.0 * (g1 * g1 + pow(g2 - 3, 2) / 4) AS jb,
        ((sst - sse) / 2) / (sse / (n - 3)) AS f FROM u),
    h AS (SELECT *, n * 1.0 AS m11, n * ma AS m12, n * mb AS m13, n * (saa + ma * ma) AS m22,
        n * (sab + ma * mb) AS m23, n * (sbb + mb * mb) AS m33 FROM o),
    i1 AS (SELECT *, (m11 + m22 + m33) / 3 AS c3 FROM h),
    i2 AS (SELECT *, sqrt((pow(m11 - c3, 2) + pow(m22 - c3, 2) + pow(m33 - c3, 2)
        + 2 * (m12 * m12 + m13 * m13 + m23 * m23)) / 6) AS pp FROM i1),
    i3 AS (SELECT *, acos(greatest(-1, least(1, ((m11 - c3) * ((m22 - c3) * (m33 - c3) - m23 * m23)
        - m12 * (m12 * (m33 - c3) - m23 * m13) + m13 * (m12 * m23 - (m22 - c3) * m13)) / pow(pp, 3) / 2))) / 3 AS phi
        FROM i2),
    i4 AS (SELECT *, c3 + 2 * pp * cos(phi) AS top, m11 * (m22 * m33 - m23 * m23) - m12 * (m12 * m33 - m23 * m13)
        + m13 * (m12 * m23 - m22 * m13) AS det3, c3 + 2 * pp * cos(phi - 2 * pi() / 3) AS mid FROM i3)"""
SUMMARY_DIGITS = {
    "df_model": 0, "df_resid": 0, "r2": 9, "adj_r2": 9, "f": 4, "f_p": 8, "log_likelihood": 2, "aic": 2, "bic": 2,
    "omnibus": 2, "omnibus_p": 8, "skew": 6, "kurtosis": 6, "jarque_bera": 2, "jarque_bera_p": 8,
    "condition_number": 2, "durbin_watson": 6,
}
SUMMARY_SQL = f"""WITH {SOLVE_SQL}, {{residuals}},
        m AS (SELECT avg(pow(e, 3)) / pow(avg(e * e), 1.5) AS g1,
                avg(pow(e, 4)) / pow(avg(e * e), 2) AS g2,
                sum(step * step) / sum(e * e) AS dw FROM w),
        v AS (SELECT f.*, m.*, n * syy AS sst, -n / 2.0 * (ln(2 * pi()) + ln(sse / n) + 1) AS ll FROM f, m),
        {SCORES_SQL}
        SELECT CAST(n AS DOUBLE) AS n, 2.0::DOUBLE AS df_model, CAST(n - 3 AS DOUBLE) AS df_resid,
          round(1 - sse / sst, 9) AS r2, round(1 - sse / sst * (n - 1) / (n - 3), 9) AS adj_r2, round(f, 4) AS f,
          -- With two predictors the tail of F has a closed form.
          round(pow(1 + 2 * f / (n - 3), -(n - 3) / 2.0), 8) AS f_p, round(ll, 2) AS log_likelihood,
          round(-2 * ll + 6, 2) AS aic, round(-2 * ll + 3 * ln(n), 2) AS bic,
          round(omnibus, 2) AS omnibus, round(exp(-omnibus / 2), 8) AS omnibus_p,
          round(g1, 6) AS skew, round(g2, 6) AS kurtosis, round(jb, 2) AS jarque_bera,
          round(exp(-jb / 2), 8) AS jarque_bera_p,
          -- The smallest eigenvalue from the determinant, which does not cancel.
          round(sqrt(top / (det3 / top / mid)), 2) AS condition_number, round(dw, 6) AS durbin_watson FROM i4"""


def _summary(spark, sf):
    lines = table(spark, sf, "lineitem")
    row = ols_summary(lines, ols_fit(lines, "l_extendedprice", PREDICTORS), LINE_KEY)
    return row.select("n", *(F.round(c, d).alias(c) for c, d in SUMMARY_DIGITS.items()))


@query("ols_summary", SUMMARY_SQL.format(residuals=RESIDUAL_SQL))
def ols_summary_query(spark, sf):
    return _summary(spark, sf)


@query("ols_diagnostics", SUMMARY_SQL.format(residuals=RESIDUAL_SQL).replace("SELECT CAST(n AS DOUBLE) AS n,", "SELECT", 1))
def ols_diagnostics(spark, sf):
    return _summary(spark, sf).drop("n")


@query(
    "durbin_watson",
    f"""WITH {SOLVE_SQL}, {RESIDUAL_SQL}
        SELECT round(sum(step * step) / sum(e * e), 6) AS durbin_watson FROM w""",
)
def durbin_watson_query(spark, sf):
    lines = table(spark, sf, "lineitem")
    found = durbin_watson(lines, ols_fit(lines, "l_extendedprice", PREDICTORS), LINE_KEY)
    return found.select(F.round("durbin_watson", 6).alias("durbin_watson"))


@query(
    "ols_predict",
    f"""WITH {SOLVE_SQL}
        SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice,
          round(b0 + ba * a + bb * b, 4) AS predicted,
          round(abs(y - (b0 + ba * a + bb * b)), 4) AS abs_error FROM d, f""",
)
def ols_predict_query(spark, sf):
    lines = table(spark, sf, "lineitem")
    predicted = ols_predict(lines, ols_fit(lines, "l_extendedprice", PREDICTORS))
    return predicted.select(
        *LINE_KEY, F.round("predicted", 4).alias("predicted"), F.round("abs_error", 4).alias("abs_error")
    )
