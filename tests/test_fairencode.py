"""Encodings without leaks, against plain loops over small awkward tables."""

import hashlib
import math
import random
import statistics

import pytest
from pyspark.sql import functions as F

from statloom.operators.fairencode import fold_of, shrinkage, smooth_encode, stat_encode_asof, stat_encode_oof


def close(a, b):
    if a is None or b is None:
        return a is b
    return math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-9)


def rows_of(n=160, seed=4):
    r = random.Random(seed)
    rows = []
    for i in range(n):
        a = r.choice(["x", "x", "x", "y", "z", None])
        b = r.choice([1, 2, 3, None])
        y = r.choice([None, float("nan"), r.gauss(1e6, 2.0), 1e6, 1e6 + 1])
        rows.append((i, a, b, y, r.choice([2019, 2020, 2021, 2023, None])))
    rows += [(n, "alone", 9, 5.0, 2020), (n + 1, "same", 7, 3.0, 2019), (n + 2, "same", 7, 3.0, 2020),
             (n + 3, "same", 7, 3.0, 2021), (n + 4, "none", 8, None, 2020)]
    return rows


@pytest.fixture(scope="module")
def table(spark):
    return spark.createDataFrame(rows_of(), "id long, `a.b` string, b int, y double, year int").repartition(5)


SETS = {"one": ["a.b"], "two": ["a.b", "b"], "back": ["b", "a.b"]}
PLACES = {"one": (1,), "two": (1, 2), "back": (2, 1)}


def present(y):
    return y is not None and not math.isnan(y)


def plain_stats(values):
    values = [v for v in values if present(v)]
    n = len(values)
    return {"mean": statistics.fmean(values) if n else None, "median": statistics.median(values) if n else None,
            "std": statistics.stdev(values) if n > 1 else None, "max": max(values) if n else None, "count": n}


def test_folds_are_stable_and_even(spark):
    got = spark.range(20_000).select("id", fold_of(F.col("id"), 4, 1).alias("f")).collect()
    for r in got[:200]:
        assert r["f"] == int(hashlib.md5(f"{r['id']}:1".encode()).hexdigest()[:8], 16) % 4
    counts = [sum(r["f"] == f for r in got) for f in range(4)]
    assert min(counts) > 4_700


@pytest.mark.parametrize("row_limit", [10**6, 90, 0])
def test_out_of_fold_statistics_equal_plain_ones(table, row_limit):
    fold = lambda i: int(hashlib.md5(f"{i}:42".encode()).hexdigest()[:8], 16) % 5
    encoded = {r["id"]: r for r in stat_encode_oof(
        table, SETS, "y", fold_of(F.col("id")), row_limit=row_limit).collect()}
    rows = rows_of()
    assert len(encoded) == len(rows)
    for row in rows:
        for prefix, places in PLACES.items():
            key = tuple(row[p] for p in places)
            if None in key:
                expected = dict.fromkeys(("mean", "median", "std", "max", "count"))
            else:
                others = [o[3] for o in rows if tuple(o[p] for p in places) == key and fold(o[0]) != fold(row[0])]
                expected = plain_stats(others)
            for s, v in expected.items():
                assert close(encoded[row[0]][f"{prefix}_{s}"], v), (row, prefix, s)


def test_out_of_fold_medians_copy_no_row_per_fold(spark, monkeypatch):
    from statloom.operators import fairencode

    written, plain = {}, fairencode.store

    def counted(df, label="table", **options):
        stored = plain(df, label, **options)
        written[label] = stored.count()
        return stored

    monkeypatch.setattr(fairencode, "store", counted)
    rows = [(i, "ab"[i % 2], float(i * i % 997)) for i in range(400)]
    df = spark.createDataFrame(rows, "id long, k string, y double")
    got = {r["id"]: r["te_median"] for r in stat_encode_oof(df, {"te": ["k"]}, "y", F.col("id") % 7, row_limit=0).collect()}
    assert got == {i: statistics.median(y for j, g, y in rows if g == k and j % 7 != i % 7) for i, k, _ in rows}
    assert max(written.values()) == 400 and "fold-places" in written


def test_out_of_fold_hides_the_own_target(spark):
    rows = [(i, "k", 0.0) for i in range(50)]
    spike = [*rows[:7], (7, "k", 1e9), *rows[8:]]
    for data in (rows, spike):
        df = spark.createDataFrame(data, "id long, k string, y double")
        got = stat_encode_oof(df, {"te": ["k"]}, "y", fold_of(F.col("id"), 50)).filter("id = 7").first()
        assert (got["te_mean"], got["te_max"], got["te_median"]) == (0.0, 0.0, 0.0)


def test_rows_without_a_fold_have_no_statistics(spark):
    df = spark.createDataFrame([(1, "k", 1.0, None), (2, "k", 2.0, 0), (3, "k", 3.0, 1)], "id long, k string, y double, f int")
    got = {r["id"]: (r["te_mean"], r["te_count"]) for r in stat_encode_oof(df, {"te": ["k"]}, "y", F.col("f")).collect()}
    assert got == {1: (None, None), 2: (3.0, 1), 3: (2.0, 1)}
    none = stat_encode_oof(df.limit(0), {"te": ["k"]}, "y", F.col("f"))
    assert none.count() == 0 and none.columns[-5:] == [f"te_{s}" for s in ("mean", "median", "std", "max", "count")]


def test_past_statistics_equal_plain_ones(table):
    rows = rows_of()
    for cut in (None, 2021):
        at = lambda t: t if cut is None or t is None else min(t, cut)
        encoded = {r["id"]: r for r in stat_encode_asof(table, SETS, "y", "year", cut).collect()}
        assert len(encoded) == len(rows)
        for row in rows:
            for prefix, places in PLACES.items():
                key = tuple(row[p] for p in places)
                expected = dict.fromkeys(("mean", "std", "max", "count"))
                if None not in key and row[4] is not None:
                    before = [o[3] for o in rows if tuple(o[p] for p in places) == key and o[4] is not None
                              and at(o[4]) < at(row[4])]
                    expected = {s: v for s, v in plain_stats(before).items() if s != "median"}
                for s, v in expected.items():
                    assert close(encoded[row[0]][f"{prefix}_{s}"], v), (cut, row, prefix, s)


def plain_components(groups):
    """Pooled variance inside groups, variance between them by the method of moments."""
    n, g = sum(map(len, groups)), len(groups)
    grand = statistics.fmean(v for values in groups for v in values)
    inside = sum((v - statistics.fmean(values)) ** 2 for values in groups for v in values) / (n - g)
    spread = sum(len(v) * (statistics.fmean(v) - grand) ** 2 for v in groups) / (g - 1)
    return grand, inside, max(0.0, (spread - inside) / ((n - sum(len(v) ** 2 for v in groups) / n) / (g - 1)))


def groups_of(rows, places):
    found = {}
    for r in rows:
        key = tuple(r[p] for p in places)
        if None not in key and present(r[3]):
            found.setdefault(key, []).append(r[3])
    return found


def test_shrinkage_equals_plain_estimates(table):
    groups = groups_of(rows_of(), (2,))
    grand, inside, between = plain_components(list(groups.values()))
    got = {r["b"]: r for r in shrinkage(table, ["b"], "y").collect()}
    assert got.keys() == {k for k, in groups}
    for (k,), values in groups.items():
        weight = len(values) / (len(values) + inside / between) if between else 0.0
        mean = statistics.fmean(values)
        assert got[k]["n"] == len(values) and close(got[k]["weight"], weight)
        assert math.isclose(got[k]["smoothed"], grand + weight * (mean - grand), rel_tol=1e-9)


def test_smoothing_falls_back_level_by_level(spark):
    r = random.Random(8)
    centre = {"p": 10.0, "q": 20.0}
    rows = [(i, k, j, centre[k] + j + r.gauss(0, 1), True) for i, (k, j) in enumerate(
        (k, j) for k in "pq" for j in range(4) for _ in range(r.randint(1, 12)))]
    rows += [(900, "p", 99, None, False), (901, "new", 0, None, False), (902, None, 0, None, False), (903, "q", 1, 5e9, False)]
    df = spark.createDataFrame(rows, "id long, k string, j int, y double, train boolean")
    got = {r["id"]: r["te_smooth"] for r in smooth_encode(df, [["k"], ["k", "j"]], "y", "te", F.col("train")).collect()}
    known = [x for x in rows if x[4]]
    total = statistics.fmean(x[3] for x in known)

    def level(places, prior):
        groups = groups_of(known, places)
        n, g = sum(map(len, groups.values())), len(groups)
        inside = sum((v - statistics.fmean(vs)) ** 2 for vs in groups.values() for v in vs) / (n - g)
        between = max(0.0, (sum(len(vs) * (statistics.fmean(vs) - prior(k)) ** 2 for k, vs in groups.items()) - g * inside) / n)
        weight = lambda vs: len(vs) / (len(vs) + inside / between) if between else 0.0
        return {k: prior(k) + weight(vs) * (statistics.fmean(vs) - prior(k)) for k, vs in groups.items()}

    coarse = level((1,), lambda k: total)
    fine = level((1, 2), lambda k: coarse[k[:1]])
    for row in rows:
        expected = fine.get((row[1], row[2]), coarse.get((row[1],), total))
        assert math.isclose(got[row[0]], expected, rel_tol=1e-9), row
    assert got[901] == got[902] and math.isclose(got[902], total)


def test_smoothing_needs_nested_levels(spark):
    df = spark.createDataFrame([(1, 1, 1.0)], "a int, b int, y double")
    with pytest.raises(ValueError, match="does not hold"):
        smooth_encode(df, [["a"], ["b"]], "y", "te")
