"""Queries over sources, projections, row functions, side tables and joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from statloom.functions.coerce import quoted, to_number, to_timestamp
from statloom.functions.columns import (
    date_parts,
    flag,
    list_field_mean,
    list_field_sum,
    list_size,
    log1p_floor0,
    optional,
    ratio,
    reorder,
    snake_name,
    with_prefix,
)
from statloom.operators.describe import describe, profile, quality
from statloom.operators.keyed import left_join
from statloom.registry.base import FACT_SQL, fact, joined, query, rounded, table
from statloom.session import scratch_path
from statloom.sources.readers import read_csv, read_json_family
from statloom.sources.writers import write_csv, write_json


@query(
    "json_scan_flatten",
    """SELECT o_orderkey, o_orderstatus AS "order.status", o_totalprice AS "order.price",
              CASE WHEN o_orderstatus = 'F' THEN o_orderpriority END AS priority
       FROM orders""",
)
def json_scan_flatten(spark, sf):
    # Two JSON families share a prefix; one lacks a column, which becomes null.
    orders = table(spark, sf, "orders")
    base = scratch_path(spark, "json")
    nested = orders.select(
        "o_orderkey",
        F.struct(
            F.col("o_orderstatus").alias("status"), F.col("o_totalprice").alias("price")
        ).alias("order"),
        F.col("o_orderpriority").alias("priority"),
    )
    closed = F.col("order.status") == "F"
    write_json(nested.filter(closed), f"{base}/orders closed.json")
    write_json(nested.filter(~closed).drop("priority"), f"{base}/orders open.json")
    return read_json_family(spark, base, "orders", lines=True).select(
        "o_orderkey", quoted("order.status"), quoted("order.price"), "priority"
    )


@query("json_array_scan", "SELECT c_custkey, c_name, c_nationkey, c_acctbal FROM customer")
def json_array_scan(spark, sf):
    """Files that are one JSON array each, the form in which such exports come."""
    customers = table(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey", "c_acctbal")
    base = scratch_path(spark, "json-array")
    # A file of this form is one task's, so every part is kept at a bounded size.
    files = max(8, -(-customers.count() // 100_000))
    parts = customers.groupBy(F.pmod(F.xxhash64("c_custkey"), F.lit(files)).alias("part")).agg(
        F.to_json(F.collect_list(F.struct(*customers.columns))).alias("value"))
    parts.write.partitionBy("part").text(f"{base}/customers all.json")
    return read_json_family(spark, base, "customers", customers.schema).select(*customers.columns)


@query(
    "json_props",
    """SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events""",
)
def json_props(spark, sf):
    events = table(spark, sf, "events")
    return events.select("event_id", F.from_json("props", "k bigint")["k"].alias("k"))


@query("csv_roundtrip", "SELECT p_partkey, p_name, p_size, p_retailprice FROM part")
def csv_roundtrip(spark, sf):
    part = table(spark, sf, "part").select("p_partkey", "p_name", "p_size", "p_retailprice")
    path = scratch_path(spark, "csv")
    write_csv(part, path)
    return read_csv(spark, path, part.schema)


@query(
    "metadata_row",
    """SELECT count(*) AS registros, round(avg(o_totalprice), 4) AS media,
              round(median(o_totalprice), 4) AS mediana,
              round(stddev_samp(o_totalprice), 4) AS desvio_padrao,
              min(o_totalprice) AS minimo, max(o_totalprice) AS maximo,
              round(skewness(o_totalprice), 6) AS assimetria,
              round(kurtosis(o_totalprice), 6) AS curtose FROM orders""",
)
def metadata_row(spark, sf):
    orders = table(spark, sf, "orders")
    stats = describe(orders, ["o_totalprice"], quartiles=False)
    nested = stats.select(
        F.struct(
            F.col("n").alias("registros"),
            F.round("mean", 4).alias("media"),
            F.round("median", 4).alias("mediana"),
            F.round("std", 4).alias("desvio_padrao"),
            F.col("min").alias("minimo"),
            F.col("max").alias("maximo"),
            F.round("skew", 6).alias("assimetria"),
            F.round("kurtosis", 6).alias("curtose"),
        ).alias("estatisticas")
    )
    path = scratch_path(spark, "metadata")
    write_json(nested, path)
    return spark.read.schema(nested.schema).json(path).select("estatisticas.*")


@query(
    "profile",
    "SELECT count(*) AS n_rows, CAST(6 AS BIGINT) AS n_columns FROM orders",
)
def profile_query(spark, sf):
    return profile(table(spark, sf, "orders"))


@query(
    "quality_counts",
    """SELECT 'o_totalprice' AS variable, count(*) AS n_rows,
              count(*) FILTER (o_totalprice IS NULL) AS n_null,
              count(*) FILTER (isinf(o_totalprice)) AS n_infinite FROM orders
       UNION ALL
       SELECT 'gap', count(*), count(*) FILTER (o_orderstatus = 'P'),
              count(*) FILTER (o_orderstatus = 'O') FROM orders""",
)
def quality_counts(spark, sf):
    gap = (
        F.when(F.col("o_orderstatus") == "O", F.lit(float("inf")))
        .when(F.col("o_orderstatus") == "F", F.col("o_totalprice"))
    )
    orders = table(spark, sf, "orders").withColumn("gap", gap)
    return quality(orders, ["o_totalprice", "gap"])


@query(
    "coerce_numeric",
    """SELECT o_orderkey, CASE o_orderstatus
         WHEN 'F' THEN TRY_CAST(o_totalprice AS DOUBLE)
         WHEN 'O' THEN NULL ELSE 12.5 END AS amount,
       CASE o_orderstatus WHEN 'F' THEN o_totalprice WHEN 'O' THEN 0.0 ELSE 12.5 END AS filled
       FROM orders""",
)
def coerce_numeric(spark, sf):
    text = (
        F.when(F.col("o_orderstatus") == "F", F.col("o_totalprice").cast("string"))
        .when(F.col("o_orderstatus") == "O", F.concat("o_orderkey", F.lit("d")))
        .otherwise(F.lit(" 1.25e1 "))
    )
    amount = to_number(text)
    return table(spark, sf, "orders").select(
        "o_orderkey", amount.alias("amount"), F.coalesce(amount, F.lit(0.0)).alias("filled")
    )


@query(
    "coerce_timestamp",
    """SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN NULL
              ELSE CAST(o_orderdate AS TIMESTAMP) END AS at FROM orders""",
)
def coerce_timestamp(spark, sf):
    text = F.when(
        F.col("o_orderstatus") == "F", F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss")
    ).when(F.col("o_orderstatus") == "O", F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"))
    text = text.otherwise(F.date_format("o_orderdate", "dd/MM/yyyy"))
    return table(spark, sf, "orders").select("o_orderkey", to_timestamp(text).alias("at"))


@query(
    "date_parts_flags",
    """SELECT o_orderkey, CAST(month(o_orderdate) AS INTEGER) AS mes,
              CAST(quarter(o_orderdate) AS INTEGER) AS trimestre,
              CAST(isodow(o_orderdate) - 1 AS INTEGER) AS dia_semana,
              CAST(day(o_orderdate) AS INTEGER) AS dia_mes,
              CAST(year(o_orderdate) AS INTEGER) AS ano,
              CAST(month(o_orderdate) >= 11 AS INTEGER) AS fim_ano,
              CAST(month(o_orderdate) <= 2 AS INTEGER) AS inicio_ano FROM orders""",
)
def date_parts_flags(spark, sf):
    p = date_parts("o_orderdate")
    return table(spark, sf, "orders").select(
        "o_orderkey",
        p["month"].alias("mes"),
        p["quarter"].alias("trimestre"),
        p["weekday"].alias("dia_semana"),
        p["day"].alias("dia_mes"),
        p["year"].alias("ano"),
        flag(p["month"] >= 11).alias("fim_ano"),
        flag(p["month"] <= 2).alias("inicio_ano"),
    )


@query(
    "ratios_logs",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice,
              round(l_discount / (abs(l_extendedprice) + 1), 9) AS tx_anulacao,
              round((l_discount + l_tax) / (abs(l_extendedprice) + 1), 9) AS tx_restos,
              round(l_quantity / (l_linenumber + 1), 6) AS ocupacao,
              round(ln(1 + greatest(l_quantity - 25, 0)), 6) AS log_saldo,
              abs(l_quantity - 25) AS distance FROM lineitem""",
)
def ratios_logs(spark, sf):
    gap = F.col("l_quantity") - 25
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice",
        F.round(ratio("l_discount", "l_extendedprice"), 9).alias("tx_anulacao"),
        F.round(ratio(F.col("l_discount") + F.col("l_tax"), "l_extendedprice"), 9).alias("tx_restos"),
        F.round(ratio("l_quantity", "l_linenumber", absolute=False), 6).alias("ocupacao"),
        F.round(log1p_floor0(gap), 6).alias("log_saldo"),
        F.abs(gap).alias("distance"),
    )


@query(
    "nested_len_sum_mean",
    """SELECT vec_id, CAST(len(embedding) AS INTEGER) AS n,
              round(list_sum(CAST(embedding AS DOUBLE[])), 4) AS total,
              round(list_sum(CAST(embedding AS DOUBLE[])) / len(embedding), 6) AS mean,
              CASE WHEN label < 5 THEN CAST(len(embedding) AS INTEGER) ELSE 0 END AS n_some
       FROM embeddings""",
)
def nested_len_sum_mean(spark, sf):
    listed = table(spark, sf, "embeddings").withColumn(
        "levels", F.transform("embedding", lambda x: F.struct(x.alias("valor")))
    )
    some = F.when(F.col("label") < 5, F.col("levels"))
    return listed.select(
        "vec_id",
        list_size("levels").alias("n"),
        F.round(list_field_sum("levels", "valor"), 4).alias("total"),
        F.round(list_field_mean("levels", "valor"), 6).alias("mean"),
        list_size(some).alias("n_some"),
    )


@query(
    "optional_column",
    """SELECT c_custkey, c_mktsegment, CAST(NULL AS VARCHAR) AS c_missing FROM customer""",
)
def optional_column(spark, sf):
    customer = table(spark, sf, "customer")
    return customer.select(
        "c_custkey",
        optional(customer, "c_mktsegment").alias("c_mktsegment"),
        optional(customer, "c_missing").alias("c_missing"),
    )


@query(
    "prefix_projection",
    """SELECT c_acctbal, c_acctbal AS target_raiz_quadrada, c_custkey, c_mktsegment, c_name,
              c_nationkey, 1.25::DOUBLE AS lambda_boxcox FROM customer""",
)
def prefix_projection(spark, sf):
    customer = table(spark, sf, "customer")
    name = f"target_{snake_name('Raiz Quadrada')}"
    wide = customer.withColumns({"lambda_boxcox": F.lit(1.25), name: F.col("c_acctbal")})
    kept = wide.select(*sorted(with_prefix(wide, "c_")), "lambda_boxcox", name)
    return reorder(kept, ["c_acctbal", name], ["lambda_boxcox"])


@query(
    "thresholds",
    """SELECT CAST(sum(CASE WHEN o_totalprice >= 1000 THEN 1 ELSE 0 END) AS BIGINT) AS above_1000,
              CAST(sum(CASE WHEN o_totalprice >= 100000 THEN 1 ELSE 0 END) AS BIGINT) AS above_100000,
              round(avg(CASE WHEN o_totalprice >= 300000 THEN 1 ELSE 0 END), 6) AS share_300000
       FROM orders""",
)
def thresholds(spark, sf):
    over = {n: flag(F.col("o_totalprice") >= n) for n in (1000, 100000, 300000)}
    return table(spark, sf, "orders").agg(
        F.sum(over[1000]).alias("above_1000"),
        F.sum(over[100000]).alias("above_100000"),
        F.round(F.avg(over[300000]), 6).alias("share_300000"),
    )


# --- side tables and joins -------------------------------------------------------

PROGRAM_SQL = """programs AS (
  SELECT year(l_shipdate) AS year, p_brand AS brand, l_returnflag AS flag_key,
         sum(l_extendedprice) AS budget, sum(l_extendedprice * (1 - l_discount)) AS paid,
         sum(l_quantity) AS quantity, avg(l_discount) AS pct_a, avg(l_tax) AS pct_b,
         count(DISTINCT l_partkey) AS n_actions
  FROM lineitem LEFT JOIN part ON l_partkey = p_partkey GROUP BY ALL)"""
POSITION_SQL = """positions AS (
  SELECT year(l_shipdate) AS year, s_nationkey AS nation, count(DISTINCT l_suppkey) AS n_jobs,
         sum(l_quantity) AS created, sum(l_quantity - l_linenumber) AS filled,
         avg(l_extendedprice) AS salary,
         sum(l_quantity - l_linenumber) / (sum(l_quantity) + 1) AS occupancy
  FROM lineitem LEFT JOIN supplier ON l_suppkey = s_suppkey GROUP BY ALL)"""
ADVANCE_SQL = """advances AS (
  SELECT year(o_orderdate) AS year, c_mktsegment AS department,
         count(CASE WHEN o_orderstatus <> 'P' THEN o_orderkey END) AS n_advances,
         sum(o_totalprice) AS advanced
  FROM orders LEFT JOIN customer ON o_custkey = c_custkey GROUP BY ALL)"""


def _programs(spark, sf):
    lines, part = (table(spark, sf, t) for t in ("lineitem", "part"))
    wide = joined(lines, part, "l_partkey", "p_partkey", "p_brand")
    return wide.groupBy(
        F.year("l_shipdate").alias("year"),
        F.col("p_brand").alias("brand"),
        F.col("l_returnflag").alias("flag_key"),
    ).agg(
        F.sum("l_extendedprice").alias("budget"),
        F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("paid"),
        F.sum("l_quantity").alias("quantity"),
        F.avg("l_discount").alias("pct_a"),
        F.avg("l_tax").alias("pct_b"),
        F.countDistinct("l_partkey").alias("n_actions"),
    )


def _positions(spark, sf):
    lines, supplier = (table(spark, sf, t) for t in ("lineitem", "supplier"))
    wide = joined(lines, supplier, "l_suppkey", "s_suppkey", "s_nationkey")
    totals = wide.groupBy(
        F.year("l_shipdate").alias("year"), F.col("s_nationkey").alias("nation")
    ).agg(
        F.countDistinct("l_suppkey").alias("n_jobs"),
        F.sum("l_quantity").alias("created"),
        F.sum(F.col("l_quantity") - F.col("l_linenumber")).alias("filled"),
        F.avg("l_extendedprice").alias("salary"),
    )
    return totals.withColumn("occupancy", ratio("filled", "created", absolute=False))


def _advances(spark, sf):
    return fact(spark, sf).groupBy("year", F.col("c_mktsegment").alias("department")).agg(
        F.count(F.when(F.col("o_orderstatus") != "P", F.col("o_orderkey"))).alias("n_advances"),
        F.sum("o_totalprice").alias("advanced"),
    )


@query(
    "agg_program",
    f"""WITH {PROGRAM_SQL}
        SELECT CAST(year AS INTEGER) AS year, brand, flag_key, round(budget, 2) AS budget,
               round(paid, 4) AS paid, round(quantity, 2) AS quantity, round(pct_a, 10) AS pct_a,
               round(pct_b, 10) AS pct_b, n_actions FROM programs""",
)
def agg_program(spark, sf):
    p = _programs(spark, sf)
    return p.select(
        "year", "brand", "flag_key",
        *(F.round(c, 2).alias(c) for c in ("budget", "quantity")),
        F.round("paid", 4).alias("paid"),
        *(F.round(c, 10).alias(c) for c in ("pct_a", "pct_b")),
        "n_actions",
    )


@query(
    "agg_positions",
    f"""WITH {POSITION_SQL}
        SELECT CAST(year AS INTEGER) AS year, nation, n_jobs, created, filled,
               round(salary, 6) AS salary, round(occupancy, 6) AS occupancy FROM positions""",
)
def agg_positions(spark, sf):
    return _positions(spark, sf).withColumns(
        {"salary": F.round("salary", 6), "occupancy": F.round("occupancy", 6)}
    )


@query(
    "agg_advances",
    f"""WITH {ADVANCE_SQL}
        SELECT CAST(year AS INTEGER) AS year, department, n_advances,
               round(advanced, 2) AS advanced FROM advances""",
)
def agg_advances(spark, sf):
    return _advances(spark, sf).withColumn("advanced", F.round("advanced", 2))


ENRICH_SQL = f"""WITH {FACT_SQL}, {PROGRAM_SQL}, {POSITION_SQL}, {ADVANCE_SQL},
        lines AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice,
                         year(l_shipdate) AS year, p_brand AS brand, l_returnflag AS flag_key
                  FROM lineitem LEFT JOIN part ON l_partkey = p_partkey)
        SELECT o_orderkey, f.year, c_mktsegment, c_nationkey,
               round(coalesce(budget, 0), 2) AS budget, coalesce(n_actions, 0) AS n_actions,
               coalesce(n_jobs, 0) AS n_jobs, round(coalesce(occupancy, 0), 6) AS occupancy,
               coalesce(n_advances, 0) AS n_advances, round(coalesce(advanced, 0), 2) AS advanced
        FROM fact f
        LEFT JOIN programs p ON f.year = p.year AND p.brand = 'Brand#' || f.c_nationkey
             AND p.flag_key = CASE o_orderstatus WHEN 'F' THEN 'R' WHEN 'O' THEN 'N' ELSE 'X' END
        LEFT JOIN positions q ON f.year = q.year AND f.c_nationkey = q.nation
        LEFT JOIN advances a ON f.year = a.year AND f.c_mktsegment = a.department"""


def _enrich(spark, sf, **options):
    facts = fact(spark, sf).select(
        "o_orderkey",
        "year",
        "c_mktsegment",
        "c_nationkey",
        F.concat(F.lit("Brand#"), "c_nationkey").alias("brand"),
        F.when(F.col("o_orderstatus") == "F", "R")
        .when(F.col("o_orderstatus") == "O", "N")
        .otherwise("X")
        .alias("flag_key"),
        F.col("c_nationkey").alias("nation"),
        F.col("c_mktsegment").alias("department"),
    )
    wide = left_join(facts, _programs(spark, sf), ["year", "brand", "flag_key"], **options)
    wide = left_join(wide, _positions(spark, sf), ["year", "nation"], **options)
    wide = left_join(wide, _advances(spark, sf), ["year", "department"], **options)
    names = ["budget", "n_actions", "n_jobs", "occupancy", "n_advances", "advanced"]
    filled = wide.fillna(0, subset=names).withColumns(
        {
            "budget": F.round("budget", 2),
            "occupancy": F.round("occupancy", 6),
            "advanced": F.round("advanced", 2),
        }
    )
    return filled.select("o_orderkey", "year", "c_mktsegment", "c_nationkey", *names)


@query("enrich_left_joins", ENRICH_SQL)
def enrich_left_joins(spark, sf):
    return _enrich(spark, sf)


@query("enrich_left_joins_shuffled", ENRICH_SQL)
def enrich_left_joins_shuffled(spark, sf):
    """The way for side tables that are too big to broadcast."""
    return _enrich(spark, sf, broadcast_bytes=-1)
