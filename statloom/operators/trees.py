"""Regression trees on binned columns: boosting and forests, grown level by level over all rows.

Columns are cut at exact quantiles once and stored as one byte each. A level of growth is one
pass: every task sums rows and targets per open node, feature and bin, so no row leaves its
task; running sums over bins and the best split of a node are found by Spark, and the driver
gets one row per node. Targets are whole multiples of a small unit, so sums are exact and a
model does not depend on how rows are dealt.
"""

from __future__ import annotations

import math
import random
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from statloom.functions.coerce import as_double, quoted
from statloom.operators.ordering import grouped_stats
from statloom.session import dealt, store

BINS = 32
# Targets are counted in units of their reach over 2 to this power.
UNIT_BITS = 20
GOLDEN = np.uint64(0x9E3779B97F4A7C15)  # fixed values: the steps of the splitmix64 generator
MIX = ((np.uint64(30), np.uint64(0xBF58476D1CE4E5B9)), (np.uint64(27), np.uint64(0x94D049BB133111EB)))


@dataclass
class Tree:
    """Nodes by number, 0 the root; a leaf has feature -1. A row with a bin up to ``bin`` goes left."""

    feature: list[int] = field(default_factory=lambda: [-1])
    bin: list[int] = field(default_factory=lambda: [0])
    left: list[int] = field(default_factory=lambda: [-1])
    right: list[int] = field(default_factory=lambda: [-1])
    value: list[float] = field(default_factory=lambda: [0.0])
    rows: list[int] = field(default_factory=lambda: [0])
    gain: list[float] = field(default_factory=lambda: [0.0])

    def split(self, node: int, feature: int, bin_: int, gain: float, sides: Sequence[tuple[float, int]]) -> list[int]:
        """Make a leaf an inner node; returns its two leaves."""
        made = []
        for value, rows in sides:
            made.append(len(self.feature))
            for column, v in zip((self.feature, self.bin, self.left, self.right, self.value, self.rows, self.gain),
                                 (-1, 0, -1, -1, value, rows, 0.0)):
                column.append(v)
        self.feature[node], self.bin[node], self.gain[node] = feature, bin_, gain
        self.left[node], self.right[node] = made
        return made


@dataclass(frozen=True)
class Ensemble:
    """base + rate x the sum of all trees; cuts are the upper bounds of each feature's bins."""

    target: str
    features: tuple[str, ...]
    cuts: tuple[tuple[float, ...], ...]
    trees: tuple[Tree, ...]
    base: float
    rate: float
    seed: int = 0


# --- bins --------------------------------------------------------------------------


def quantile_cuts(df: DataFrame, features: Sequence[str], bins: int = BINS) -> list[tuple[float, ...]]:
    """Distinct exact quantiles of every feature at 1/bins, 2/bins, ...; missing values left out."""
    if not 2 <= bins <= 255:
        raise ValueError("a bin's number takes one byte: 2 to 255 bins")
    names = [f"_f{i}" for i in range(len(features))]
    wide = df.select(*(as_double(df, c).alias(n) for n, c in zip(names, features)))
    long = wide.unpivot([], names, "variable", "value").filter(F.col("value").isNotNull())
    probs = {f"q{k}": k / bins for k in range(1, bins)}
    found = {r["variable"]: r for r in grouped_stats(long, "value", [F.count(F.lit(1)).alias("n")], probs, ["variable"]).collect()}
    return [tuple(sorted({found[n][q] for q in probs})) if n in found else () for n in names]


def _to_bins(cuts: Sequence[Sequence[float]]):
    edges = [np.array(c) for c in cuts]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.zeros((batch.num_rows, len(edges)), np.uint8)
            for i, e in enumerate(edges):
                v = batch.column(2 + i).to_numpy(zero_copy_only=False).astype(float)
                x[:, i] = np.where(np.isnan(v), 0, np.searchsorted(e, v, side="left") + 1)
            ends = np.arange(batch.num_rows + 1, dtype=np.int32) * len(edges)
            packed = pa.Array.from_buffers(pa.binary(), batch.num_rows, [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(x.tobytes())])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), packed], names=["seed", "y", "bins"])

    return run


def binned(df: DataFrame, target: str, features: Sequence[str], key: Sequence[str], cuts) -> DataFrame:
    """(seed, y, bins), stored: a hash of the row's key, the target, a byte per feature, 0 if missing.

    Rows without a target take no part.
    """
    rows = df.select(F.xxhash64(*(F.col(quoted(k)) for k in key)).alias("seed"), as_double(df, target).alias("y"),
                     *(as_double(df, c).alias(f"_f{i}") for i, c in enumerate(features))).filter(F.col("y").isNotNull())
    return store(dealt(rows).mapInArrow(_to_bins(cuts), "seed long, y double, bins binary"), "bins")


# --- what a task does --------------------------------------------------------------


def _routed(tree: Tree, x: np.ndarray, ends: Sequence, node: int = 0):
    """What ``ends`` holds for the leaf of every row; whole columns are compared, no row is looked up."""
    f = tree.feature[node]
    if f < 0:
        return ends[node]
    left, right = (_routed(tree, x, ends, n) for n in (tree.left[node], tree.right[node]))
    return np.where(x[:, f] <= tree.bin[node], left, right)


def walk(tree: Tree, x: np.ndarray) -> np.ndarray:
    """The leaf of every row."""
    return np.broadcast_to(_routed(tree, x, np.arange(len(tree.feature), dtype=np.int32)), len(x))


def walked_values(tree: Tree, x: np.ndarray) -> np.ndarray:
    """The value of every row's leaf."""
    return np.broadcast_to(_routed(tree, x, np.array(tree.value)), len(x))


def bootstrap(seed: np.ndarray, tree: int, salt: int) -> np.ndarray:
    """How often a tree draws each row: Poisson with mean 1, from a hash of the row, tree and salt."""
    limits = np.cumsum([math.exp(-1.0) / math.factorial(k) for k in range(12)])
    with np.errstate(over="ignore"):
        z = seed.astype(np.int64).view(np.uint64) + GOLDEN * np.uint64((salt << 20) + tree + 1)
        for shift, factor in MIX:
            z = (z ^ (z >> shift)) * factor
        z ^= z >> np.uint64(31)
    return np.searchsorted(limits, z.astype(float) / 2.0**64, side="right")


def _columns(batch: pa.RecordBatch, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    seed, y = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("seed", "y"))
    bins = batch.column("bins")  # all of one length, so they lie in one buffer without gaps
    _, ends, data = bins.buffers()
    start = np.frombuffer(ends, np.int32)[bins.offset] if len(bins) else 0
    x = np.frombuffer(data, np.uint8, batch.num_rows * width, start) if width and len(bins) else np.zeros(0, np.uint8)
    return seed, y, np.asfortranarray(x.reshape(batch.num_rows, width))


def _histograms(ready: Sequence[Tree], growing: dict[int, Tree], open_: dict[tuple[int, int], list[int]],
                base: float, rate: float, unit: float, width: int, salt: int | None):
    """Rows and targets per open node, wanted feature and bin; of boosting the targets are residuals."""

    # Per tree and feature the nodes that want it, which are summed together.
    nodes: dict[tuple[int, int], list[int]] = {}
    for (owner, node), features in open_.items():
        for f in features:
            nodes.setdefault((owner, f), []).append(node)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = {key: np.zeros((2, 256 * len(at)), np.int64) for key, at in nodes.items()}
        for batch in batches:
            seed, y, x = _columns(batch, width)
            rest = y - base
            for t in ready:
                rest = rest - rate * walked_values(t, x)
            g = np.rint(rest / unit)
            for number, tree in growing.items():
                times = None if salt is None else bootstrap(seed, number, salt)
                drawn = slice(None) if times is None else np.flatnonzero(times)
                leaf, w = walk(tree, x)[drawn], None if times is None else times[drawn].astype(float)
                wg = g if w is None else w * g[drawn]
                for (owner, f), wanted in nodes.items():
                    if owner != number:
                        continue
                    # Nodes that do not want the feature share a last place, which is left out.
                    place = np.full(len(tree.feature), len(wanted))
                    place[wanted] = np.arange(len(wanted))
                    cell, cells = place[leaf] * 256 + x[drawn, f], 256 * len(wanted)
                    counts = [np.bincount(cell, v, cells)[:cells].astype(np.int64) for v in (w, wg)]
                    sums[owner, f] += np.stack(counts)
        keys = np.array([(owner, node, f) for (owner, f), wanted in nodes.items() for node in wanted]).reshape(-1, 3)
        table = np.hstack(list(sums.values())) if sums else np.zeros((2, 0), np.int64)
        seen = table[0] > 0
        if seen.any():
            keys, bins = np.repeat(keys, 256, axis=0)[seen], np.tile(np.arange(256), len(keys))[seen]
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(keys[:, i].astype(np.int32)) for i in range(3)), pa.array(bins.astype(np.int32)),
                 *(pa.array(c[seen]) for c in table)], names=["tree", "node", "feature", "bin", "n", "g"])

    return run


# --- splits ------------------------------------------------------------------------


def split_gains(histogram: DataFrame, min_leaf: int, ridge: float) -> DataFrame:
    """Of every place to split: rows and targets on the left, in all, and the gain (null: too few rows)."""
    group = Window.partitionBy("tree", "node", "feature")
    upto = group.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    sides = histogram.select(
        "tree", "node", "feature", "bin", F.sum("n").over(upto).alias("nl"), F.sum("g").over(upto).alias("gl"),
        F.sum("n").over(group).alias("n"), F.sum("g").over(group).alias("g"))
    score = lambda g, n: g.cast("double") * g.cast("double") / (n + F.lit(ridge))
    n, g, nl, gl = (F.col(c) for c in ("n", "g", "nl", "gl"))
    allowed = (nl >= min_leaf) & (n - nl >= min_leaf)
    return sides.withColumn("gain", F.when(allowed, score(gl, nl) + score(g - gl, n - nl) - score(g, n)))


def _best(histogram: DataFrame, min_leaf: int, ridge: float) -> list:
    """The best split per node: most gain, then the first feature, then the lowest bin."""
    gains = split_gains(histogram, min_leaf, ridge)
    order = F.struct(F.coalesce("gain", F.lit(-1.0)), -F.col("feature"), -F.col("bin"))
    return gains.groupBy("tree", "node").agg(
        F.max("n").alias("n"), F.max("g").alias("g"),
        F.max_by(F.struct("feature", "bin", "nl", "gl", "gain"), order).alias("s")).collect()


def _grow(rows: DataFrame, ready: Sequence[Tree], growing: dict[int, Tree], depth: int, wanted, base: float, rate: float,
          unit: float, width: int, salt: int | None, min_leaf: int, ridge: float) -> None:
    """Grow trees side by side, one pass per level."""
    open_ = {(t, 0): wanted(t, 0) for t in growing}
    for _ in range(depth):
        if not open_:
            return
        kernel = _histograms(ready, growing, open_, base, rate, unit, width, salt)
        found = rows.mapInArrow(kernel, "tree int, node int, feature int, bin int, n long, g long")
        sums = found.groupBy("tree", "node", "feature", "bin").agg(F.sum("n").alias("n"), F.sum("g").alias("g"))
        open_ = {}
        for r in sorted(_best(sums, min_leaf, ridge), key=lambda r: (r["tree"], r["node"])):
            tree, node, s = growing[r["tree"]], r["node"], r["s"]
            if node == 0:
                tree.value[0], tree.rows[0] = r["g"] * unit / (r["n"] + ridge), r["n"]
            if s["gain"] is None or s["gain"] <= 0.0:
                continue
            sides = [(g * unit / (n + ridge), n) for g, n in ((s["gl"], s["nl"]), (r["g"] - s["gl"], r["n"] - s["nl"]))]
            for leaf in tree.split(node, s["feature"], s["bin"], s["gain"] * unit * unit, sides):
                open_[r["tree"], leaf] = wanted(r["tree"], leaf)


def _scale(rows: DataFrame) -> tuple[float, float]:
    """A constant near the mean target, and the unit that targets are counted in."""
    low, high, mean = rows.agg(F.min("y"), F.max("y"), F.avg("y")).first()
    if mean is None:
        raise ValueError("no rows with a target")
    # Rounded, as the last digits of a mean depend on the order of its sums.
    base = float(f"{mean:.6g}")
    reach = max(abs(high - base), abs(low - base))
    return base, (reach or 1.0) / 2**UNIT_BITS


def boost(df: DataFrame, target: str, features: Sequence[str], key: Sequence[str], rounds: int = 20, depth: int = 3,
          rate: float = 0.1, bins: int = BINS, min_leaf: int = 20, ridge: float = 1.0) -> Ensemble:
    """Gradient boosting for squared error: every tree fits what the ones before leave.

    A missing feature value goes left at every split. Rows without a target take no part; a
    constant feature is never split. ``key`` names the columns that tell rows apart.
    """
    cuts = quantile_cuts(df, features, bins)
    rows = binned(df, target, features, key, cuts)
    base, unit = _scale(rows)
    trees: list[Tree] = []
    every = list(range(len(features)))
    for _ in range(rounds):
        tree = Tree()
        _grow(rows, trees, {0: tree}, depth, lambda t, n: every, base, rate, unit, len(features), None, min_leaf, ridge)
        trees.append(tree)
    return Ensemble(target, tuple(features), tuple(cuts), tuple(trees), base, rate)


def forest(df: DataFrame, target: str, features: Sequence[str], key: Sequence[str], trees: int = 20, depth: int = 6,
           share: float = 1 / 3, bins: int = BINS, min_leaf: int = 5, seed: int = 42, together: int = 10) -> Ensemble:
    """A random forest: trees on Poisson bootstraps, each node choosing among a share of the features.

    A row's weight in a tree is a hash of its key, so the same rows give the same forest on
    every cluster; rows with equal keys are drawn together. ``together`` trees grow in one pass.
    """
    cuts = quantile_cuts(df, features, bins)
    rows = binned(df, target, features, key, cuts)
    base, unit = _scale(rows)
    many = max(1, math.ceil(share * len(features)))
    wanted = lambda t, n: sorted(random.Random(f"{seed}:{t}:{n}").sample(range(len(features)), many))
    grown: list[Tree] = []
    for first in range(0, trees, together):
        group = {t: Tree() for t in range(first, min(trees, first + together))}
        _grow(rows, [], group, depth, wanted, base, 1.0, unit, len(features), seed, min_leaf, 0.0)
        grown += group.values()
    return Ensemble(target, tuple(features), tuple(cuts), tuple(grown), base, 1.0 / trees, seed)


def first_splits(df: DataFrame, target: str, features: Sequence[str], key: Sequence[str], bins: int = BINS,
                 min_leaf: int = 20) -> DataFrame:
    """(variable, threshold, n_left, share) of every place to split all rows once.

    ``share`` is the part of the target's variation that the split takes off. Rows with a
    missing value are on the left of all thresholds; a null threshold splits them off alone.
    """
    cuts = quantile_cuts(df, features, bins)
    rows = binned(df, target, features, key, cuts)
    base, unit = _scale(rows)
    every = list(range(len(features)))
    kernel = _histograms([], {0: Tree()}, {(0, 0): every}, base, 1.0, unit, len(features), None)
    found = rows.mapInArrow(kernel, "tree int, node int, feature int, bin int, n long, g long")
    sums = found.groupBy("tree", "node", "feature", "bin").agg(F.sum("n").alias("n"), F.sum("g").alias("g"))
    whole = rows.agg((F.var_pop("y") * F.count("y")).alias("v")).first()["v"]
    edges = F.array(*(F.array(*map(F.lit, c)) if c else F.array().cast("array<double>") for c in cuts))
    return split_gains(sums, min_leaf, 0.0).filter(F.col("gain").isNotNull()).select(
        F.get(F.array(*map(F.lit, features)), F.col("feature")).alias("variable"),
        F.get(F.get(edges, F.col("feature")), F.col("bin") - 1).alias("threshold"),
        F.col("nl").alias("n_left"), F.try_divide(F.col("gain") * F.lit(unit * unit), F.lit(whole)).alias("share"))


# --- use ---------------------------------------------------------------------------


def _tree_column(model: Ensemble, tree: Tree, node: int, columns: Sequence[Column]) -> Column:
    f = tree.feature[node]
    if f < 0:
        return F.lit(tree.value[node])
    left, right = (_tree_column(model, tree, n, columns) for n in (tree.left[node], tree.right[node]))
    missing = columns[f].isNull()
    if tree.bin[node] == 0:
        return F.when(missing, left).otherwise(right)
    if tree.bin[node] > len(model.cuts[f]):
        return left
    return F.when(missing | (columns[f] <= model.cuts[f][tree.bin[node] - 1]), left).otherwise(right)


def predict_trees(df: DataFrame, model: Ensemble, name: str = "predicted") -> DataFrame:
    """Add the model's value to every row, as one expression of its features."""
    columns = [as_double(df, c) for c in model.features]
    total = F.lit(0.0)
    for tree in model.trees:
        total = total + _tree_column(model, tree, 0, columns)
    return df.withColumn(name, F.lit(model.base) + F.lit(model.rate) * total)


def importance(df: DataFrame, model: Ensemble) -> DataFrame:
    """(variable, splits, gain, share) of every feature: what its splits took off the squared error."""
    gains, splits = [0.0] * len(model.features), [0] * len(model.features)
    for tree in model.trees:
        for f, g in zip(tree.feature, tree.gain):
            if f >= 0:
                gains[f] += g
                splits[f] += 1
    whole = sum(gains)
    rows = [(c, s, g, g / whole if whole else None) for c, s, g in zip(model.features, splits, gains)]
    return df.sparkSession.createDataFrame(rows, "variable string, splits int, gain double, share double")


def _out_of_bag(trees: Sequence[Tree], base: float, width: int, salt: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seed, y, x = _columns(batch, width)
            total, votes = np.zeros(len(y)), np.zeros(len(y))
            for number, tree in enumerate(trees):
                out = bootstrap(seed, number, salt) == 0
                total[out] += walked_values(tree, x[out])
                votes += out
            told = votes > 0
            p = base + total[told] / votes[told]
            yield pa.RecordBatch.from_arrays([pa.array(y[told]), pa.array(p)], names=["y", "p"])

    return run


def out_of_bag(df: DataFrame, model: Ensemble, key: Sequence[str]) -> DataFrame:
    """(n, r2, rmse, mae) of a forest, every row predicted by the trees that never drew it."""
    rows = binned(df, model.target, model.features, key, model.cuts)
    pairs = rows.mapInArrow(_out_of_bag(model.trees, model.base, len(model.features), model.seed), "y double, p double")
    e = F.col("y") - F.col("p")
    return pairs.agg(
        F.count(F.lit(1)).alias("n"), (1 - F.try_divide(F.avg(e * e), F.var_pop("y"))).alias("r2"),
        F.sqrt(F.avg(e * e)).alias("rmse"), F.avg(F.abs(e)).alias("mae"))
