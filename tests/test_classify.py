"""Monthly lags, logistic regression and class metrics against plain loops and numpy."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from statloom.operators.classify import class_metrics, logit_fit, logit_table, probability
from statloom.operators.monthly import add_monthly_lags
from statloom.plans.risk import add_outstanding, study_risk


def plain_lags(rows):
    """(key, month) -> features from a loop over earlier months; rows are (key, month, value)."""
    made = {}
    for key in {k for k, m, _ in rows if k is not None and m is not None}:
        total = {}
        for k, m, v in rows:
            if k == key and m is not None:
                total[m] = total.get(m, 0.0) + (v or 0.0)
        for m in total:
            past, known = {x: v for x, v in total.items() if x < m}, m - min(total)
            span = lambda n: sum(v for x, v in past.items() if x >= m - n)  # noqa: B023, E731
            everything = sum(past.values())
            made[key, m] = (
                past.get(m - 1, 0.0) if known >= 1 else None, past.get(m - 12, 0.0) if known >= 12 else None,
                span(3) / min(known, 3) if known else None, sum(x >= m - 3 for x in past),
                span(12) / min(known, 12) if known else None, sum(x >= m - 12 for x in past),
                m - max(past) if past else None,
                sum(v for x, v in past.items() if (m - x) % 12 == 0) / everything if everything else None)
    return made


def test_monthly_lags(spark):
    r = np.random.default_rng(2)
    rows = [(f"k{i % 4}", 2020 * 12 + int(r.integers(0, 40)), float(r.integers(0, 90))) for i in range(150)]
    rows += [(None, 2020 * 12, 1.0), ("k1", None, 1.0), ("k2", 2020 * 12 + 5, None), ("one", 2021 * 12, 0.0)]
    dated = [(i, k, None if m is None else f"{m // 12}-{m % 12 + 1:02d}-17", v) for i, (k, m, v) in enumerate(rows)]
    table = spark.createDataFrame(dated, "i int, `k.x` string, d string, v double").withColumn("d", F.to_date("d"))
    got = add_monthly_lags(table.repartition(5), "d", "k.x", "v", "p").orderBy("i").collect()
    expected = plain_lags(rows)
    assert got[0].__fields__[:4] == ["i", "k.x", "d", "v"] and len(got) == len(rows)
    for r, (k, m, _) in zip(got, rows, strict=True):
        for a, b in zip(list(r)[4:], expected.get((k, m), (None,) * 8), strict=True):
            assert (a is None) == (b is None) if b is None or a is None else a == pytest.approx(b), (k, m, r)
    assert add_monthly_lags(table.limit(0), "d", "k.x", "v", "p").collect() == []


def plain_logit(x, y, steps=30):
    x = np.column_stack([np.ones(len(x)), x])
    beta = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-x @ beta))
        beta += np.linalg.solve(x.T @ (x * (p * (1 - p))[:, None]), x.T @ (y - p))
    return beta, np.sqrt(np.diag(np.linalg.inv(x.T @ (x * (p * (1 - p))[:, None]))))


@pytest.fixture(scope="module")
def sample(spark):
    r = np.random.default_rng(4)
    x = r.normal(size=(600, 3)) * [1, 50, 0.01] + [0, 1000, 3]
    y = (r.random(600) < 1 / (1 + np.exp(-(0.5 + x[:, 0] - (x[:, 1] - 1000) / 40)))).astype(int)
    rows = [(*map(float, a), 2 * float(a[0]) + 1, 5.0, int(b), 2000 + i % 6) for i, (a, b) in enumerate(zip(x, y))]
    rows += [(None, 1.0, 1.0, 1.0, 5.0, 1, 2001), (float("nan"), 1.0, 1.0, 1.0, 5.0, 1, 2001), (1.0, 1.0, 1.0, 1.0, 5.0, None, 2001)]
    return x, y, spark.createDataFrame(rows, "a double, b double, c double, twin double, fixed double, y int, year int").repartition(6)


def test_logit_against_numpy(sample):
    x, y, table = sample
    beta, se = plain_logit(x, y)
    fit = logit_fit(table, "y", ["a", "b", "c"])
    assert fit.converged and fit.n == 600
    assert fit.coefficients == pytest.approx(beta, rel=1e-6)
    rows = logit_table(table, fit).collect()
    assert [r.std_err for r in rows] == pytest.approx(se, rel=1e-5)
    assert rows[0].term == "const" and rows[1].odds_ratio == pytest.approx(np.exp(beta[1]))
    # A twin and a constant add nothing to what is predicted.
    more = logit_fit(table, "y", ["a", "b", "c", "twin", "fixed"])
    assert more.log_likelihood == pytest.approx(fit.log_likelihood)
    close = table.dropna().select(F.max(F.abs(probability(fit) - probability(more)))).first()[0]
    assert close < 1e-6


def test_logit_without_a_maximum(spark):
    table = spark.createDataFrame([(float(i), int(i > 9)) for i in range(20)], "x double, y int")
    fit = logit_fit(table, "y", ["x"], max_steps=15)
    assert not fit.converged and fit.coefficients[1] > 1
    with pytest.raises(ValueError, match="other than"):
        logit_fit(table.withColumn("y", F.col("y") * 2), "y", ["x"])
    with pytest.raises(ValueError, match="no complete rows"):
        logit_fit(table.limit(0), "y", ["x"])


def test_class_metrics(spark):
    r = np.random.default_rng(6)
    rows = [(f"g{i % 3}", int(r.random() < 0.4), float(r.integers(0, 11)) / 10) for i in range(300)]
    rows += [("ones", 1, 0.2), ("ones", 1, 0.9), ("g0", None, 0.5), ("g0", 1, None), (None, 1, 0.5), ("g1", 0, float("nan"))]
    table = spark.createDataFrame(rows, "g string, y int, s double").repartition(4)
    got = {m.g: m for m in class_metrics(table, "y", "s", ["g"]).collect()}
    assert set(got) == {"g0", "g1", "g2", "ones"}
    for g, m in got.items():
        pairs = [(y, s) for k, y, s in rows if k == g and y is not None and s is not None and s == s]
        pos, neg = [s for y, s in pairs if y], [s for y, s in pairs if not y]
        wins = sum((a > b) + (a == b) / 2 for a in pos for b in neg)
        assert (m.n, m.positives) == (len(pairs), len(pos))
        assert m.auc is None if not neg else m.auc == pytest.approx(wins / len(pos) / len(neg))
        p = [min(max(s, 1e-15), 1 - 1e-15) for _, s in pairs]
        assert m.log_loss == pytest.approx(-np.mean([np.log(q if y else 1 - q) for (y, _), q in zip(pairs, p)]))
        assert m.accuracy == pytest.approx(np.mean([(s >= 0.5) == (y == 1) for y, s in pairs]))
        assert m.recall == pytest.approx(sum(s >= 0.5 for s in pos) / len(pos))
    whole = class_metrics(table.filter("g = 'g0'"), "y", "s").first()
    assert whole.auc == pytest.approx(got["g0"].auc)
    assert class_metrics(table.limit(0), "y", "s", ["g"]).collect() == []


def test_risk_of_later_years(spark, sample):
    _, _, table = sample
    study = study_risk(table, ["a", "b"], 2003, "year", "y")
    parts = {m.part: m for m in study.metrics.collect()}
    assert set(parts) == {"train", "test"} and parts["train"].n == 400 and parts["test"].n == 200
    assert study.fit.n == 400 and all(m.auc > 0.7 for m in parts.values())
    assert study.scores.count() == 603
    odd = spark.createDataFrame([(0.0,), (2.5,), (None,), (float("nan"),), (-1.0,)], "saldoAPagar double")
    assert [r.em_aberto for r in add_outstanding(odd).collect()] == [0, 1, 0, 0, 0]
