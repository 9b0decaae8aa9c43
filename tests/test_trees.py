"""Boosting and forests against plain exhaustive trees on small tables."""

import math
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from statloom.operators.trees import (
    Tree, _columns, UNIT_BITS, walk, walked_values, boost, bootstrap, forest, importance, out_of_bag, predict_trees, quantile_cuts,
)

FEATURES = ["a", "b", "c d", "still"]


def rows_of(n=400):
    r = random.Random(2)
    rows = []
    for i in range(n):
        a, b, c = r.uniform(0, 10), r.choice([None, 0.0, 1.0, 2.0]), float(r.randint(0, 100))
        y = 3.0 * (a > 4) + (5.0 if b is None else b) + 0.02 * c + r.gauss(0, 0.3)
        rows.append((i, a, b, c, 1.0, y))
    return [*rows, (n, 1.0, 1.0, 1.0, 1.0, None), (n + 1, float("nan"), None, None, None, 2.0)]


SCHEMA = "id long, a double, b double, `c d` double, still double, y double"


@pytest.fixture(scope="module")
def table(spark):
    return spark.createDataFrame(rows_of(), SCHEMA).repartition(6)


def present(v):
    return v is not None and not math.isnan(v)


def bins_of(cuts, rows):
    return [[0 if not present(v) else 1 + sum(c < v for c in cuts[f]) for f, v in enumerate(r[1:5])] for r in rows]


def plain_tree(x, g, depth, min_leaf, ridge):
    """Nested (feature, bin, left, right) or a leaf's value, by trying every split."""
    n, total = len(g), sum(g)
    score = lambda s, m: s * s / (m + ridge)
    best = None
    for f in range(len(FEATURES) if depth else 0):
        for b in sorted({r[f] for r in x}):
            left = [v for r, v in zip(x, g) if r[f] <= b]
            if len(left) < min_leaf or n - len(left) < min_leaf:
                continue
            gain = score(sum(left), len(left)) + score(total - sum(left), n - len(left)) - score(total, n)
            if gain > 0 and (best is None or gain > best[0]):
                best = (gain, f, b)
    if best is None:
        return total / (n + ridge)
    _, f, b = best
    sides = [[(r, v) for r, v in zip(x, g) if (r[f] <= b) == left] for left in (True, False)]
    return (f, b, *(plain_tree([r for r, _ in s], [v for _, v in s], depth - 1, min_leaf, ridge) for s in sides))


def plain_value(tree, row):
    while isinstance(tree, tuple):
        tree = tree[2] if row[tree[0]] <= tree[1] else tree[3]
    return tree


def shape(tree, node=0):
    if tree.feature[node] < 0:
        return None
    return tree.feature[node], tree.bin[node], shape(tree, tree.left[node]), shape(tree, tree.right[node])


def plain_shape(tree):
    return (tree[0], tree[1], plain_shape(tree[2]), plain_shape(tree[3])) if isinstance(tree, tuple) else None


def test_cuts_are_exact_quantiles(table):
    cuts = quantile_cuts(table, FEATURES, 8)
    for f in range(4):
        values = [r[1 + f] for r in rows_of() if present(r[1 + f])]
        expected = sorted(set(np.quantile(values, [k / 8 for k in range(1, 8)])))
        assert list(cuts[f]) == pytest.approx(expected)


def test_boosted_trees_equal_exhaustive_ones(table):
    model = boost(table, "y", FEATURES, ["id"], rounds=3, depth=3, rate=0.5, bins=16, min_leaf=10)
    rows = [r for r in rows_of() if r[5] is not None]
    x, y = bins_of(model.cuts, rows), [r[5] for r in rows]
    unit = max(abs(v - model.base) for v in y) / 2**UNIT_BITS
    fitted = [model.base] * len(y)
    for tree in model.trees:
        plain = plain_tree(x, [round((v - p) / unit) for v, p in zip(y, fitted)], 3, 10, 1.0)
        assert shape(tree) == plain_shape(plain)
        fitted = [p + 0.5 * unit * plain_value(plain, r) for p, r in zip(fitted, x)]
    got = {r["id"]: r["predicted"] for r in predict_trees(table, model).collect()}
    assert [got[r[0]] for r in rows] == pytest.approx(fitted, rel=1e-9)
    assert all(0 <= f != 3 for t in model.trees for f in t.feature if f >= 0)  # a constant is never split


def test_boosting_learns_and_ranks_features(table):
    model = boost(table, "y", FEATURES, ["id"], rounds=25, depth=3, rate=0.3)
    e = predict_trees(table, model).select(F.avg((F.col("y") - F.col("predicted")) ** 2)).first()[0]
    spread = table.select(F.var_pop("y")).first()[0]
    assert e < 0.1 * spread
    told = {r["variable"]: r for r in importance(table, model).collect()}
    assert told["b"]["gain"] > told["c d"]["gain"] > told["still"]["gain"] == 0.0
    assert sum(r["share"] for r in told.values()) == pytest.approx(1.0)


def test_models_do_not_depend_on_partitions(table):
    other = table.orderBy(F.rand(3)).repartition(11)
    for make in (lambda d: boost(d, "y", FEATURES, ["id"], rounds=2),
                 lambda d: forest(d, "y", FEATURES, ["id"], trees=3, depth=3)):
        assert make(table) == make(other)


def test_bootstrap_weights_are_poisson():
    seed = np.random.default_rng(1).integers(-(2**63), 2**63 - 1, 40_000)
    first, second = bootstrap(seed, 0, 42), bootstrap(seed, 1, 42)
    assert first.mean() == pytest.approx(1.0, abs=0.02) and first.var() == pytest.approx(1.0, abs=0.04)
    assert (first == 0).mean() == pytest.approx(math.exp(-1), abs=0.01)
    assert abs(np.corrcoef(first, second)[0, 1]) < 0.02
    assert (bootstrap(seed, 0, 42) == first).all()


def test_out_of_bag_error_is_honest(table):
    model = forest(table, "y", FEATURES, ["id"], trees=12, depth=5, share=0.7)
    found = out_of_bag(table, model, ["id"]).first()
    inside = predict_trees(table, model).select(F.sqrt(F.avg((F.col("y") - F.col("predicted")) ** 2))).first()[0]
    spread = math.sqrt(table.select(F.var_pop("y")).first()[0])
    assert inside < found["rmse"] < 0.6 * spread and found["n"] > 395
    # Of pure noise nothing can be told beforehand.
    noise = table.withColumn("y", F.xxhash64("id") % 1000 / 100.0)
    blind = out_of_bag(noise, forest(noise, "y", FEATURES, ["id"], trees=12, depth=5), ["id"]).first()
    assert blind["r2"] < 0.1


def test_trees_of_awkward_tables(spark):
    none = spark.createDataFrame([], SCHEMA)
    with pytest.raises(ValueError, match="no rows with a target"):
        boost(none, "y", FEATURES, ["id"])
    same = spark.createDataFrame([(i, 1.0, None, 2.0, 3.0, 7.0) for i in range(60)], SCHEMA)
    model = boost(same, "y", FEATURES, ["id"], rounds=2)
    assert [t.feature for t in model.trees] == [[-1], [-1]]
    assert {r["predicted"] for r in predict_trees(same, model).collect()} == {7.0}
    with pytest.raises(ValueError, match="one byte"):
        quantile_cuts(same, FEATURES, 300)


def test_whole_columns_find_the_leaves_that_single_rows_find():
    x = np.random.default_rng(5).integers(0, 6, (200, 3)).astype(np.uint8)
    tree = Tree()
    left, right = tree.split(0, 1, 2, 1.0, [(1.0, 1), (2.0, 1)])
    tree.split(right, 0, 0, 1.0, [(3.0, 1), (4.0, 1)])
    tree.split(left, 2, 4, 1.0, [(5.0, 1), (6.0, 1)])

    def leaf(row, node=0):
        if tree.feature[node] < 0:
            return node
        return leaf(row, (tree.left if row[tree.feature[node]] <= tree.bin[node] else tree.right)[node])

    batch = pa.RecordBatch.from_arrays(
        [pa.array(range(200)), pa.array([0.0] * 200), pa.array([r.tobytes() for r in x], pa.binary())], names=["seed", "y", "bins"])
    cut = batch.slice(50, 100)  # a part of a buffer
    read = _columns(cut, 3)[2]
    assert (read == x[50:150]).all()
    want = [leaf(r) for r in x[50:150]]
    assert walk(tree, read).tolist() == want
    assert walked_values(tree, read).tolist() == [tree.value[n] for n in want]
    assert walk(Tree(), read).tolist() == [0] * 100
    assert len(_columns(batch.slice(0, 0), 3)[2]) == 0
