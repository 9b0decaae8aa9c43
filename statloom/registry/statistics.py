"""Queries over encodings, windows, correlations, descriptions and distributions."""

from __future__ import annotations

from pyspark.sql import functions as F

from statloom.operators.associate import (
    collinear_pairs,
    corr_all_numeric,
    corr_pairs,
    corr_with_target,
    rank_by_magnitude,
    with_selection,
)
from statloom.operators.describe import compare, describe, same_rows
from statloom.operators.distribution import (
    box_outliers,
    box_stats,
    histogram,
    kernel_density,
    normal_overlay,
    qq_line,
    qq_points,
)
from statloom.operators.encode import stat_encode
from statloom.operators.ordering import counted_quantiles, percent_rank_average, row_ids
from statloom.operators.windows import add_lags, yearly_totals
from statloom.functions.normal import CENTRE, SHOULDER, TAIL
from statloom.registry.base import FACT_SQL, fact, joined, query, rounded, table

# --- encodings -------------------------------------------------------------------


def encode_sql(key_sets: dict[str, list[str]], target: str, table: str) -> tuple[str, str, str]:
    """CTEs, columns and joins that encode a table in SQL."""
    ctes, columns, joins = [], [], []
    for prefix, keys in key_sets.items():
        ks = ", ".join(f'"{k}"' for k in keys)
        ctes.append(
            f"""{prefix} AS (SELECT {ks}, avg({target}) AS "mean", median({target}) AS "median",
            stddev_samp({target}) AS "std", max({target}) AS "max", count({target}) AS "count"
            FROM {table} WHERE {' AND '.join(f'"{k}" IS NOT NULL' for k in keys)} GROUP BY {ks})"""
        )
        columns += [
            f'round({prefix}."{s}", 4) AS "{prefix}_{s}"' for s in ("mean", "median", "std", "max")
        ] + [f'{prefix}."count" AS "{prefix}_count"']
        on = " AND ".join(f'{table}."{k}" = {prefix}."{k}"' for k in keys)
        joins.append(f"LEFT JOIN {prefix} ON {on}")
    return ", ".join(ctes), ", ".join(columns), " ".join(joins)


ENCODINGS = {
    "stat_encode_1d": {"te_seg": ["c_mktsegment"], "te_pri": ["o_orderpriority"]},
    "stat_encode_2d": {"te_segPri": ["c_mktsegment", "o_orderpriority"]},
    "stat_encode_3d": {"te_segPriSta": ["c_mktsegment", "o_orderpriority", "o_orderstatus"]},
    "stat_encode_fine": {"te_cust": ["o_custkey"], "te_nation": ["c_nationkey"]},
}


def _register_encoding(name: str, sets: dict[str, list[str]], row_limit: int | None = None):
    ctes, columns, joins = encode_sql(sets, "log_target", "fact")
    sql = f"WITH {FACT_SQL}, {ctes} SELECT o_orderkey, {columns} FROM fact {joins}"

    @query(name, sql)
    def run(spark, sf):
        facts = fact(spark, sf).select(
            "o_orderkey", "log_target", *dict.fromkeys(k for keys in sets.values() for k in keys)
        )
        limit = {} if row_limit is None else {"row_limit": row_limit}
        encoded = stat_encode(facts, sets, "log_target", **limit)
        return rounded(
            encoded.select("o_orderkey", *(c for c in encoded.columns if c.startswith("te_")))
        )


for _name, _sets in ENCODINGS.items():
    _register_encoding(_name, _sets)
# The path for groups too big for a task, forced by a small limit.
_register_encoding(
    "stat_encode_sliced",
    {"te_seg": ["c_mktsegment"], "te_segPri": ["c_mktsegment", "o_orderpriority"]},
    row_limit=1000,
)


# --- windows ---------------------------------------------------------------------

YEARLY_SQL = """yearly AS (
  SELECT year, c_mktsegment, sum(o_totalprice) AS s, avg(o_totalprice) AS m,
         count(o_totalprice) AS n FROM fact GROUP BY ALL)"""


@query(
    "yearly_totals",
    f"""WITH {FACT_SQL}, {YEARLY_SQL}
        SELECT year, c_mktsegment, round(s, 2) AS sum, round(m, 4) AS mean, n AS count FROM yearly""",
)
def yearly_totals_query(spark, sf):
    totals = yearly_totals(fact(spark, sf), "year", "c_mktsegment", "o_totalprice")
    return totals.withColumns({"sum": F.round("sum", 2), "mean": F.round("mean", 4)})


@query(
    "lag_year",
    f"""WITH {FACT_SQL}, {YEARLY_SQL},
        lags AS (SELECT year, c_mktsegment,
                   lag(s) OVER (PARTITION BY c_mktsegment ORDER BY year) AS l1,
                   lag(m) OVER (PARTITION BY c_mktsegment ORDER BY year) AS m1 FROM yearly)
        SELECT o_orderkey, round(l1, 2) AS seg_lag1_sum, round(m1, 4) AS seg_lag1_mean
        FROM fact LEFT JOIN lags USING (year, c_mktsegment)""",
)
def lag_year(spark, sf):
    facts = fact(spark, sf).select("o_orderkey", "year", "c_mktsegment", "o_totalprice")
    wide = add_lags(
        facts, "year", "c_mktsegment", "o_totalprice", "seg", ("lag1_sum", "lag1_mean")
    )
    return wide.select(
        "o_orderkey",
        F.round("seg_lag1_sum", 2).alias("seg_lag1_sum"),
        F.round("seg_lag1_mean", 4).alias("seg_lag1_mean"),
    )


@query(
    "roll3_year",
    f"""WITH {FACT_SQL}, {YEARLY_SQL},
        rolls AS (SELECT year, c_mktsegment, avg(s) OVER (PARTITION BY c_mktsegment ORDER BY year
                   ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING) AS r FROM yearly)
        SELECT o_orderkey, round(r, 3) AS seg_roll3_sum
        FROM fact LEFT JOIN rolls USING (year, c_mktsegment)""",
)
def roll3_year(spark, sf):
    facts = fact(spark, sf).select("o_orderkey", "year", "c_mktsegment", "o_totalprice")
    wide = add_lags(facts, "year", "c_mktsegment", "o_totalprice", "seg", ("roll3_sum",))
    return wide.select("o_orderkey", F.round("seg_roll3_sum", 3).alias("seg_roll3_sum"))


RANK_SQL = f"""WITH {FACT_SQL}
    SELECT o_orderkey, round((rank() OVER (PARTITION BY year, c_mktsegment ORDER BY o_totalprice)
         + (count(*) OVER (PARTITION BY year, c_mktsegment, o_totalprice) - 1) / 2.0)
         / count(*) OVER (PARTITION BY year, c_mktsegment), 8) AS rank_pct FROM fact"""


def _rank(spark, sf, **limit):
    facts = fact(spark, sf).select("o_orderkey", "year", "c_mktsegment", "o_totalprice")
    ranked = percent_rank_average(facts, "o_totalprice", ["year", "c_mktsegment"], **limit)
    return ranked.select("o_orderkey", F.round("rank_pct", 8).alias("rank_pct"))


@query("rank_pct", RANK_SQL)
def rank_pct(spark, sf):
    return _rank(spark, sf)


@query("rank_pct_sliced", RANK_SQL)
def rank_pct_sliced(spark, sf):
    return _rank(spark, sf, row_limit=100)


@query(
    "row_position",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice,
              row_number() OVER (ORDER BY l_extendedprice, l_orderkey, l_linenumber, l_partkey,
                                 l_suppkey) - 1 AS row_id FROM lineitem""",
)
def row_position(spark, sf):
    order = ["l_extendedprice", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    return row_ids(table(spark, sf, "lineitem").select(*order), order)


# --- correlation -----------------------------------------------------------------

CORR_SETS = {
    "te_seg": ["c_mktsegment"],
    "te_cust": ["o_custkey"],
    "te_sta": ["o_orderstatus"],
    "te_natPri": ["c_nationkey", "o_orderpriority"],
}
STATS = ("mean", "median", "std", "max", "count")


def _encoded_sql() -> str:
    ctes, _, joins = encode_sql(CORR_SETS, "log_target", "fact")
    columns = ", ".join(f'{p}."{s}" AS "{p}_{s}"' for p in CORR_SETS for s in STATS)
    return f"""{FACT_SQL}, {ctes},
        encoded AS (SELECT fact.*, {columns}, 0.1::DOUBLE AS constant FROM fact {joins})"""


def _corr_sql(columns: list[str], target: str) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS variable, count(*) FILTER ("{c}" IS NOT NULL AND "{target}" IS NOT NULL) AS n,
        CASE WHEN isnan(corr("{c}", "{target}")) THEN NULL ELSE corr("{c}", "{target}") END AS r
        FROM encoded"""
        for c in columns
    )


def _encoded(spark, sf):
    facts = fact(spark, sf).select(
        "o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus", "o_orderpriority",
        "c_mktsegment", "c_nationkey", "year", "log_target",
    )
    return stat_encode(facts, CORR_SETS, "log_target").withColumn("constant", F.lit(0.1))


CORR_COLUMNS = [f"{p}_{s}" for p in CORR_SETS for s in STATS] + ["year", "constant"]


@query(
    "corr_target",
    f"WITH {_encoded_sql()} SELECT variable, n, round(r, 6) AS r FROM ({_corr_sql(CORR_COLUMNS, 'log_target')})",
)
def corr_target(spark, sf):
    corr = corr_with_target(_encoded(spark, sf), CORR_COLUMNS, "log_target")
    return rank_by_magnitude(corr.withColumn("r", F.round("r", 6)))


@query(
    "corr_selected",
    f"""WITH {_encoded_sql()} SELECT variable, n, round(r, 6) AS r,
        coalesce(abs(r) > 0.1, false) AS selected FROM ({_corr_sql(CORR_COLUMNS, 'log_target')})""",
)
def corr_selected(spark, sf):
    corr = corr_with_target(_encoded(spark, sf), CORR_COLUMNS, "log_target")
    return rank_by_magnitude(with_selection(corr, 0.1).withColumn("r", F.round("r", 6)))


NUMERIC = [
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_discount", "l_tax",
]


@query(
    "corr_signed_all",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS variable, count(*) AS n,
        round(corr({c}, l_extendedprice), 4) AS r FROM lineitem"""
        for c in NUMERIC
    ),
)
def corr_signed_all(spark, sf):
    corr = corr_all_numeric(table(spark, sf, "lineitem"), "l_extendedprice")
    return corr.withColumn("r", F.round("r", 4))


PAIRED = [f"{p}_{s}" for p in ("te_cust", "te_natPri") for s in STATS]


def _pairs_sql() -> str:
    return " UNION ALL ".join(
        f"""SELECT '{a}' AS var_a, '{b}' AS var_b, corr("{a}", "{b}") AS r,
        count(*) FILTER ("{a}" IS NOT NULL AND "{b}" IS NOT NULL) AS n FROM encoded"""
        for i, a in enumerate(PAIRED)
        for b in PAIRED[i + 1 :]
    )


@query(
    "corr_pairs",
    f"WITH {_encoded_sql()} SELECT var_a, var_b, n, round(r, 6) AS r FROM ({_pairs_sql()})",
)
def corr_pairs_query(spark, sf):
    return corr_pairs(_encoded(spark, sf), PAIRED).withColumn("r", F.round("r", 6))


@query(
    "collinear_pairs",
    f"""WITH {_encoded_sql()} SELECT var_a, var_b, round(abs(r), 6) AS abs_r
        FROM ({_pairs_sql()}) WHERE abs(r) > 0.7""",
)
def collinear_pairs_query(spark, sf):
    pairs = collinear_pairs(_encoded(spark, sf), PAIRED, 0.7)
    return pairs.withColumn("abs_r", F.round("abs_r", 6))


# --- description -----------------------------------------------------------------


def describe_sql(column: str, table: str, group: str = "", extra: bool = True) -> str:
    quart = (
        f""", quantile_cont({column}, 0.25) AS q1, quantile_cont({column}, 0.75) AS q3,
        quantile_cont({column}, 0.75) - quantile_cont({column}, 0.25) AS iqr,
        stddev_samp({column}) / avg({column}) AS cv"""
        if extra
        else ""
    )
    lead = f"{group}, " if group else ""
    tail = f" GROUP BY {group}" if group else ""
    return f"""SELECT {lead}'{column}' AS variable, count({column}) AS n, avg({column}) AS mean,
        median({column}) AS median, stddev_samp({column}) AS std, min({column}) AS min,
        max({column}) AS max, skewness({column}) AS skew, kurtosis({column}) AS kurtosis{quart}
        FROM {table}{tail}"""


def _round_sql(inner: str, keep: list[str], columns: list[str]) -> str:
    cols = ", ".join(keep + [f"round({c}, 4) AS {c}" for c in columns])
    return f"SELECT {cols} FROM ({inner})"


SEVEN = ["mean", "median", "std", "min", "max", "skew", "kurtosis"]
ELEVEN = [*SEVEN, "q1", "q3", "iqr", "cv"]


@query(
    "describe_7",
    _round_sql(describe_sql("o_totalprice", "orders", extra=False), ["variable", "n"], SEVEN),
)
def describe_7(spark, sf):
    return rounded(describe(table(spark, sf, "orders"), ["o_totalprice"], quartiles=False))


@query(
    "describe_11",
    _round_sql(
        describe_sql("o_totalprice", "orders", "o_orderstatus"),
        ["o_orderstatus", "variable", "n"],
        ELEVEN,
    ),
)
def describe_11(spark, sf):
    return rounded(describe(table(spark, sf, "orders"), ["o_totalprice"], ["o_orderstatus"]))


@query(
    "describe_texts",
    _round_sql(
        describe_sql(
            "n_chars", "(SELECT lang, CAST(n_chars AS DOUBLE) AS n_chars FROM documents)", "lang"
        ),
        ["lang", "variable", "n"],
        ELEVEN,
    ),
)
def describe_texts(spark, sf):
    return rounded(describe(table(spark, sf, "documents"), ["n_chars"], ["lang"]))


@query(
    "quantiles_sliced",
    """SELECT l_returnflag, round(quantile_cont(l_extendedprice, 0.1), 4) AS d1,
              round(quantile_cont(l_extendedprice, 0.5), 4) AS median,
              round(quantile_cont(l_extendedprice, 0.9), 4) AS d9 FROM lineitem GROUP BY ALL""",
)
def quantiles_sliced(spark, sf):
    probs = {"d1": 0.1, "median": 0.5, "d9": 0.9}
    lines = table(spark, sf, "lineitem")
    return rounded(counted_quantiles(lines, "l_extendedprice", probs, ["l_returnflag"]))


def _improvement_sql() -> str:
    before = describe_sql("o_totalprice", "orders")
    after = describe_sql("root", "(SELECT sqrt(o_totalprice) AS root FROM orders)")
    rows = " UNION ALL ".join(
        f"""SELECT '{s}' AS statistic, a.{s} AS before, b.{s} AS after FROM a, b"""
        for s in ELEVEN
    )
    shape = "statistic IN ('skew', 'kurtosis')"
    return f"""WITH a AS ({before}), b AS ({after}), t AS ({rows})
        SELECT statistic, round(before, 4) AS before, round(after, 4) AS after,
          CASE WHEN {shape} THEN round((abs(before) - abs(after)) / abs(before) * 100, 4) END AS improvement_pct,
          CASE WHEN {shape} THEN abs(after) < abs(before) END AS closer_to_zero FROM t"""


@query("improvement", _improvement_sql())
def improvement(spark, sf):
    orders = table(spark, sf, "orders").withColumn("root", F.sqrt("o_totalprice"))
    return rounded(compare(orders, "o_totalprice", "root"))


@query(
    "same_rows",
    """SELECT (SELECT count(*) FROM orders) AS rows_before, (SELECT count(*) FROM orders) AS rows_after,
       true AS rows_kept""",
)
def same_rows_query(spark, sf):
    return same_rows(table(spark, sf, "orders"), fact(spark, sf))


# --- distribution ----------------------------------------------------------------


def _histogram_sql(bins: int, columns: str) -> str:
    return f"""WITH r AS (SELECT min(o_totalprice) AS lo, max(o_totalprice) AS hi, count(*) AS n,
           (max(o_totalprice) - min(o_totalprice)) / {bins} AS w FROM orders),
        c AS (SELECT least(floor((o_totalprice - lo) / w), {bins} - 1) AS bin, count(*) AS k
              FROM orders, r GROUP BY 1)
        SELECT {columns} FROM (SELECT CAST(b.bin AS INTEGER) AS bin, lo + b.bin * w AS lower,
            lo + (b.bin + 1) * w AS upper, coalesce(k, 0) AS count, coalesce(k, 0) / (n * w) AS density
          FROM r, range({bins}) b(bin) LEFT JOIN c ON c.bin = b.bin)"""


@query(
    "histogram",
    _histogram_sql(50, "bin, round(lower, 4) AS lower, round(upper, 4) AS upper, count"),
)
def histogram_query(spark, sf):
    bars = histogram(table(spark, sf, "orders"), "o_totalprice", 50)
    return rounded(bars.drop("density"))


@query(
    "histogram_density",
    _histogram_sql(60, "bin, count, round(density * 1000000, 6) AS density_ppm"),
)
def histogram_density(spark, sf):
    bars = histogram(table(spark, sf, "orders"), "o_totalprice", 60)
    return bars.select("bin", "count", F.round(F.col("density") * 1e6, 6).alias("density_ppm"))


BOX_SQL = """q AS (SELECT l_returnflag, count(*) AS n, quantile_cont(v, 0.25) AS q1,
       quantile_cont(v, 0.5) AS median, quantile_cont(v, 0.75) AS q3 FROM lines GROUP BY ALL),
    f AS (SELECT *, q1 - (q3 - q1) * 1.5 AS lo, q3 + (q3 - q1) * 1.5 AS hi FROM q)"""
LINES_SQL = """lines AS (SELECT *, l_extendedprice * l_extendedprice * l_quantity / 1e9 AS v
    FROM lineitem)"""


def _lines(spark, sf):
    price = F.col("l_extendedprice")
    return table(spark, sf, "lineitem").withColumn(
        "v", price * price * F.col("l_quantity") / 1e9
    )


@query(
    "box_stats",
    f"""WITH {LINES_SQL}, {BOX_SQL}
        SELECT l_returnflag, n, round(q1, 4) AS q1, round(median, 4) AS median, round(q3, 4) AS q3,
          round(min(v) FILTER (v >= lo), 4) AS whisker_low,
          round(max(v) FILTER (v <= hi), 4) AS whisker_high,
          count(*) FILTER (v < lo OR v > hi) AS n_outliers
        FROM lines JOIN f USING (l_returnflag) GROUP BY ALL""",
)
def box_stats_query(spark, sf):
    return rounded(box_stats(_lines(spark, sf), "v", ["l_returnflag"]))


@query(
    "box_outliers",
    f"""WITH {LINES_SQL}, {BOX_SQL}
        SELECT l_orderkey, l_linenumber, l_returnflag, round(v, 4) AS v
        FROM lines JOIN f USING (l_returnflag) WHERE v < lo OR v > hi""",
)
def box_outliers_query(spark, sf):
    lines = _lines(spark, sf).select("l_orderkey", "l_linenumber", "l_returnflag", "v")
    return rounded(box_outliers(lines, "v", ["l_returnflag"]))


GRID_SQL = """s AS (SELECT count(*) AS n, avg(o_totalprice) AS m, stddev_samp(o_totalprice) AS sd,
       min(o_totalprice) AS lo, max(o_totalprice) AS hi FROM orders),
    g AS (SELECT CAST(i AS INTEGER) AS point, lo + i * (hi - lo) / 99 AS x, s.* FROM s, range(100) t(i))"""


@query(
    "kde_grid",
    f"""WITH {GRID_SQL}
        SELECT point, round(x, 4) AS x, round(1000000 * sum(exp(-0.5 * pow((x - o_totalprice)
          / (sd * pow(n, -0.2)), 2))) / (n * sd * pow(n, -0.2) * sqrt(2 * pi())), 6) AS density_ppm
        FROM g, orders GROUP BY point, x, n, sd""",
)
def kde_grid(spark, sf):
    grid = kernel_density(table(spark, sf, "orders"), "o_totalprice")
    return grid.select(
        "point", F.round("x", 4).alias("x"), F.round(F.col("density") * 1e6, 6).alias("density_ppm")
    )


@query(
    "normal_overlay",
    f"""WITH {GRID_SQL}
        SELECT point, round(x, 4) AS x,
          round(1000000 * exp(-0.5 * pow((x - m) / sd, 2)) / (sd * sqrt(2 * pi())), 6) AS density_ppm
        FROM g""",
)
def normal_overlay_query(spark, sf):
    grid = normal_overlay(table(spark, sf, "orders"), "o_totalprice")
    return grid.select(
        "point", F.round("x", 4).alias("x"), F.round(F.col("density") * 1e6, 6).alias("density_ppm")
    )


# --- Q-Q -------------------------------------------------------------------------


def _poly_sql(x: str, coefficients) -> str:
    text = repr(coefficients[-1])
    for c in reversed(coefficients[:-1]):
        text = f"({text} * {x} + {c!r})"
    return text


def _ratio_sql(x: str, piece) -> str:
    return f"{_poly_sql(x, piece[0])} / {_poly_sql(x, piece[1])}"


def qq_sql(value: str, key: str, source: str) -> str:
    """CTEs that end in ``points``: position, observed, theoretical."""
    return f"""o AS (SELECT {value} AS observed, row_number() OVER (ORDER BY {value}, {key}) AS i,
      CAST(count(*) OVER () AS DOUBLE) AS n FROM {source}),
    p AS (SELECT i, observed, CASE WHEN i = n THEN pow(0.5, 1 / n)
            WHEN i = 1 THEN 1 - pow(0.5, 1 / n) ELSE (i - 0.3175) / (n + 0.365) END AS p FROM o),
    z AS (SELECT i, observed, p - 0.5 AS q, 0.180625 - (p - 0.5) * (p - 0.5) AS c,
            sqrt(-ln(least(p, 1 - p))) - 1.6 AS a, sqrt(-ln(least(p, 1 - p))) - 5 AS b FROM p),
    points AS (SELECT i AS position, observed, CASE WHEN abs(q) <= 0.425
        THEN q * {_ratio_sql('c', CENTRE)}
        WHEN a <= 3.4 THEN sign(q) * {_ratio_sql('a', SHOULDER)}
        ELSE sign(q) * {_ratio_sql('b', TAIL)} END AS theoretical FROM z)"""


QQ_SQL = qq_sql("value", "event_id", "events")


@query(
    "qq_points",
    f"""WITH {QQ_SQL} SELECT position, round(theoretical, 8) AS theoretical, observed FROM points""",
)
def qq_points_query(spark, sf):
    points = qq_points(table(spark, sf, "events"), "value", ["event_id"])
    return points.withColumn("theoretical", F.round("theoretical", 8))


@query(
    "qq_line",
    f"""WITH {QQ_SQL} SELECT count(*) AS n, round(regr_slope(observed, theoretical), 5) AS slope,
        round(regr_intercept(observed, theoretical), 5) AS intercept,
        round(corr(observed, theoretical), 6) AS r FROM points""",
)
def qq_line_query(spark, sf):
    line = qq_line(qq_points(table(spark, sf, "events"), "value", ["event_id"]))
    return line.withColumns(
        {"slope": F.round("slope", 5), "intercept": F.round("intercept", 5), "r": F.round("r", 6)}
    )
