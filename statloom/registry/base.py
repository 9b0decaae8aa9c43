"""Registration of the checked queries, and the role tables they share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from statloom.operators.keyed import left_join
from statloom.sources.readers import read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query and, where SQL can express it, its equivalent."""

    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """One table of the test data."""
    return read_table(spark, sf, name)


def rounded(df: DataFrame, digits: int = 4) -> DataFrame:
    """Round every floating column, so that equal results hash equally."""
    return df.select(
        *(
            F.round(F.col(f"`{f.name}`").cast("double"), digits).alias(f.name)
            if isinstance(f.dataType, (T.DoubleType, T.FloatType))
            else F.col(f"`{f.name}`")
            for f in df.schema.fields
        )
    )


def joined(facts: DataFrame, side: DataFrame, fact_key: str, side_key: str, *columns: str):
    """Left join of a fact onto a dimension of the test data, safe for hot keys."""
    right = side.select(F.col(side_key).alias(fact_key), *columns)
    return left_join(facts, right, [fact_key], stored=True)


def fact(spark: SparkSession, sf: str) -> DataFrame:
    """Orders with their customer's segment and nation: the fact table of most queries."""
    orders, customer = (table(spark, sf, t) for t in ("orders", "customer"))
    wide = joined(orders, customer, "o_custkey", "c_custkey", "c_mktsegment", "c_nationkey")
    return wide.filter(F.col("o_totalprice") > 0).withColumns(
        {"year": F.year("o_orderdate"), "log_target": F.log1p("o_totalprice")}
    )


FACT_SQL = """fact AS (
  SELECT o.*, c.c_mktsegment, c.c_nationkey, CAST(year(o_orderdate) AS INTEGER) AS year,
         ln(1 + o_totalprice) AS log_target
  FROM orders o LEFT JOIN customer c ON o_custkey = c_custkey
  WHERE o_totalprice > 0)"""
