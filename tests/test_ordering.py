"""Order operators against brute force, on skewed groups, heavy ties and missing keys."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from statloom.operators.keyed import attach, hot_hashes, key_hash, left_join
from statloom.operators.ordering import (
    counted_median,
    counted_quantiles,
    grouped_stats,
    percent_rank_average,
    row_ids,
)


@pytest.fixture(scope="module")
def skewed():
    """A third of the rows in one group, a third of the values equal, some missing."""
    rng = np.random.default_rng(3)
    n = 3000
    key = np.where(rng.random(n) < 0.34, "hot", rng.integers(0, 40, n).astype(str)).astype(object)
    value = np.where(rng.random(n) < 0.34, 7.0, np.round(rng.normal(5, 20, n), 2)).astype(object)
    key[rng.random(n) < 0.05] = None
    value[rng.random(n) < 0.05] = None
    return pd.DataFrame({"id": np.arange(n), "key": key, "value": value})


@pytest.fixture(scope="module")
def table(spark, skewed):
    rows = [(int(i), k, None if v is None else float(v)) for i, k, v in skewed.itertuples(index=False)]
    return spark.createDataFrame(rows, "id long, key string, value double").repartition(6)


def test_row_ids_number_the_whole_order(table):
    got = row_ids(table, ["value", "id"]).orderBy("row_id").toPandas()
    assert got["row_id"].tolist() == list(range(3000))
    value = got["value"].to_numpy()
    present = value[~np.isnan(value)]
    assert (np.diff(present) >= 0).all() and np.isnan(value[: 3000 - len(present)]).all()


def test_counted_quantiles_are_exact(table, skewed):
    probs = {"low": 0.0, "d1": 0.1, "q1": 0.25, "median": 0.5, "d9": 0.9, "top": 1.0}
    got = counted_quantiles(table, "value", probs, ["key"]).toPandas().set_index("key")
    want = skewed.assign(value=skewed["value"].astype(float)).dropna().groupby("key")["value"]
    assert set(got.index) == set(want.groups)
    for name, p in probs.items():
        assert got[name].sort_index().to_numpy() == pytest.approx(want.quantile(p).sort_index().to_numpy())
    whole = counted_quantiles(table, "value", probs).first()
    assert tuple(whole) == pytest.approx(
        tuple(skewed["value"].astype(float).quantile(p) for p in probs.values())
    )


def test_both_paths_agree(table):
    aggregates = [F.count("value").alias("n"), F.avg("value").alias("mean")]
    small, big = (
        grouped_stats(table, "value", aggregates, {"m": 0.5}, ["key"], limit)
        for limit in (10**6, 50)
    )
    assert small.exceptAll(big.select(small.columns)).count() == 0
    assert small.count() == big.count() == 41


def test_quantiles_of_a_constant(frame):
    df = frame([(4.0,)] * 50, "v double")
    assert tuple(counted_quantiles(df, "v", {"a": 0.3, "b": 0.9}).first()) == (4.0, 4.0)


@pytest.mark.parametrize("limit", [10**6, 60])
def test_percent_rank_shares_ties(table, skewed, limit):
    got = percent_rank_average(table, "value", ["key"], row_limit=limit).toPandas()
    assert len(got) == 3000
    pct = got.set_index("id").sort_index()["rank_pct"].to_numpy()
    frame = skewed.assign(value=skewed["value"].astype(float))
    want = frame.groupby("key")["value"].rank(pct=True).to_numpy()
    np.testing.assert_allclose(pct, want, rtol=1e-12)


def test_rank_of_known_ties(frame):
    df = frame([("g", v) for v in (10.0, 20.0, 20.0, 30.0)], "k string, v double")
    got = percent_rank_average(df, "v", ["k"]).orderBy("v").collect()
    assert [r["rank_pct"] for r in got] == [0.25, 0.625, 0.625, 1.0]


@pytest.mark.parametrize("limit", [10**6, 0])
def test_left_join_keeps_rows(table, skewed, limit):
    side = table.groupBy("key").agg(F.count("*").alias("n")).filter(F.coalesce("key", F.lit("")) != "3")
    joined = left_join(table, side.dropna(subset=["key"]), ["key"], broadcast_bytes=limit).toPandas()
    assert len(joined) == 3000 and list(joined.columns) == ["id", "key", "value", "n"]
    sizes = skewed.groupby("key")["id"].count()
    want = skewed["key"].map(sizes).where(skewed["key"] != "3").to_numpy(dtype=float)
    np.testing.assert_array_equal(joined.sort_values("id")["n"].to_numpy(dtype=float), want)


def test_hot_keys_are_found(table):
    hot = table.filter("key = 'hot'").select(key_hash(["key"])).first()[0]
    found = hot_hashes(table, ["key"], 5)
    assert hot in found and len(found) <= 6


def test_attach_without_groups_needs_no_join(table):
    stats = table.agg(F.avg("value").alias("m"))
    plan = attach(table, stats)._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan


def test_hot_rows_spread_over_tasks(spark, table):
    side = table.dropna(subset=["key"]).groupBy("key").agg(F.count("*").alias("n"))
    with_limit = left_join(table, side, ["key"], broadcast_bytes=0)
    plan = with_limit._jdf.queryExecution().optimizedPlan().toString()
    assert "_salt" in plan and with_limit.count() == 3000


BOTH_WAYS = pytest.mark.parametrize("limit", [10**9, 0])


@BOTH_WAYS
@pytest.mark.parametrize(("left", "right"), [("int", "double"), ("double", "bigint"), ("string", "string")])
def test_join_keys_meet_in_their_common_type(spark, limit, left, right):
    facts = spark.createDataFrame([("1",), ("2",), (None,), ("1",)], "k string").select(F.col("k").cast(left))
    side = spark.createDataFrame([("1", 10), ("1.5", 20), ("3", 30)], "k string, w int")
    side = side.filter("k <> '1.5'") if right == "bigint" else side
    side = side.select(F.col("k").cast(right), "w")
    got = left_join(facts, side, ["k"], broadcast_bytes=limit)
    assert got.schema["k"].dataType.simpleString() == left
    assert sorted((str(r.k), r.w) for r in got.collect()) == sorted(
        (str(r.k), 10 if r.k is not None and str(r.k) in ("1", "1.0") else None) for r in facts.collect())
    with pytest.raises(TypeError):
        left_join(facts.select(F.col("k").cast("string")), side.select(F.col("k").cast("double"), "w"), ["k"],
                  broadcast_bytes=limit)


@pytest.mark.parametrize("kind", ["string", "timestamp", "date", "double", "int"])
def test_ranks_of_any_type_agree(spark, kind):
    days = [None, *(f"2024-01-{d:02d}" for d in (1, 1, 5, 7, 7, 7, 9))]
    number = [None, 1, 1, 5, 7, 7, 7, 9]
    rows = [(i, "a" if i % 4 else "b", str(v)) if v is not None else (i, "a", None)
            for i, v in enumerate((number if kind in ("double", "int") else days) * 6)]
    table = spark.createDataFrame(rows, "i int, g string, v string").withColumn("v", F.col("v").cast(kind))
    if kind == "double":
        more = spark.createDataFrame([(100, "a"), (101, "a"), (102, None)], "i int, g string")
        table = table.unionByName(more.withColumn("v", F.expr("CASE i WHEN 100 THEN double('nan') ELSE double('inf') END")))
    small, big = (percent_rank_average(table, "v", ["g"], row_limit=n) for n in (10**6, 3))
    small, big = ({r.i: r.rank_pct for r in x.collect()} for x in (small, big))
    assert small == pytest.approx(big) and len(small) == table.count()
    if kind == "double":
        assert small[100] is None and small[101] == 1.0 and small[102] is None


def test_quantiles_skip_nan_both_ways(spark):
    table = spark.createDataFrame([(1, 1.0), (1, 2.0), (1, float("nan")), (1, None), (1, float("inf"))],
                                  "g int, v double")
    small, big = (grouped_stats(table, "v", [F.count("v").alias("n")], {"m": 0.5}, ["g"], n).first()
                  for n in (100, 1))
    assert small == big == (1, 3, 2.0)


def test_counted_median_weighs_ties(frame):
    rows = [("a", 1.0, 1), ("a", 2.0, 1), ("a", 9.0, 2), ("b", 5.0, 3), ("b", 7.0, 1), ("c", 4.0, 1)]
    got = counted_median(frame(rows, "k string, v double, n long"), "v", "n", ["k"]).collect()
    want = {"a": np.median([1, 2, 9, 9]), "b": np.median([5, 5, 5, 7]), "c": 4.0}
    assert dict(map(tuple, got)) == want
