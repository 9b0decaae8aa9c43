"""Encodings that do not leak the target: out of fold, smoothed, and as of a point in time."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from statloom.functions.coerce import as_double, quoted
from statloom.functions.columns import unique_sorted
from statloom.operators.encode import COUNTED_ROWS, ONE_PASS_ROWS, STATISTICS, hot_groups
from statloom.operators.keyed import BROADCAST_BYTES, any_null, left_join, measured_bytes, text_bytes
from statloom.operators.ordering import POSITION_BITS, ROW_LIMIT, sorted_once
from statloom.session import dealt, store

FOLDS = 5
SEED = 42


# --- folds -------------------------------------------------------------------------


def fold_of(key: Column, folds: int = FOLDS, seed: int = SEED) -> Column:
    """The fold of a row, 0 to folds - 1, by the md5 of its key: the same on every run and cluster."""
    text = F.concat(key.cast("string"), F.lit(f":{seed}"))
    digest = F.substring(F.md5(text.cast("binary")), 1, 8)
    return (F.conv(digest, 16, 10).cast("long") % folds).cast("int")


# --- partial states ----------------------------------------------------------------
# Rows, mean and squares about that mean: such states are merged, never subtracted, so no
# digits are lost where groups lie far apart.


def _state(value: str) -> list[Column]:
    n = F.count(value)
    return [n.alias("n"), F.avg(value).alias("m"), (F.var_pop(value) * n).alias("v"), F.max(value).alias("most")]


def _std(n: Column, squares: Column) -> Column:
    """Sample deviation from the squares about the mean."""
    return F.when(n > 1, F.sqrt(F.greatest(squares, F.lit(0.0)) / (n - 1)))


def _narrow(df: DataFrame, key_sets: Mapping[str, Sequence[str]], target: str, more: dict[str, Column]) -> tuple:
    """Keys, target and further columns, written once, and the plain names of the keys."""
    names = unique_sorted(*key_sets.values())
    inner = {n: f"_k{i}" for i, n in enumerate(names)}
    keys = df.select(*(F.col(quoted(n)).alias(inner[n]) for n in names), as_double(df, target).alias("_y"),
                     *(c.alias(n) for n, c in more.items()))
    return store(dealt(keys), "keys"), inner


def _grouped(narrow: DataFrame, inner: Mapping[str, str], key_sets: Mapping[str, Sequence[str]],
             always: Sequence[str], *aggregates: Column) -> tuple[DataFrame, dict[str, int]]:
    """One grouping-sets pass over all key sets, each with the columns ``always``; tagged by ``_set``."""
    columns = [*inner.values(), *always]
    sets = {p: [*(inner[k] for k in sorted(ks)), *always] for p, ks in key_sets.items()}
    ids = {p: sum(1 << i for i, c in enumerate(reversed(columns)) if c not in cs) for p, cs in sets.items()}
    distinct = {ids[p]: cs for p, cs in sets.items()}
    long = narrow.groupingSets([[F.col(c) for c in cs] for cs in distinct.values()], *(F.col(c) for c in columns)).agg(
        F.grouping_id().alias("_set"), *aggregates)
    return long, ids


def _named(table: DataFrame, inner: Mapping[str, str], keys: Sequence[str], prefix: str,
           values: Mapping[str, Column], *more: Column) -> DataFrame:
    return table.select(*(F.col(inner[k]).alias(k) for k in keys), *more,
                        *(c.alias(f"{prefix}_{s}") for s, c in values.items()))


# --- out of fold -------------------------------------------------------------------


def _picked(placed: DataFrame, keys: Sequence[str], folds: Sequence[int]) -> DataFrame:
    """Per group an array of the medians without each fold: (keys, medians).

    For the i-th fold a row of ``placed`` stands for ``_c{i}`` rows of the other folds, has ``_l{i}``
    of them before it in its group, and the group has ``_z{i}``. A median needs the one or two
    values that cover its places; only those rows are shuffled.
    """
    weights = []
    for i in range(len(folds)):
        low, ties, size = (F.col(f"_{x}{i}") for x in "lcz")
        covers = [(p >= low) & (p < low + ties) for p in (F.floor((size - 1) / 2), F.floor(size / 2))]
        weights.append((covers[0].cast("double") + covers[1].cast("double")) / 2)
    hit = placed.select(*keys, "_y", *(w.alias(f"_w{i}") for i, w in enumerate(weights)))
    used = [F.col(f"_w{i}") > 0 for i in range(len(folds))]
    return hit.filter(reduce(lambda x, y: x | y, used)).groupBy(*keys).agg(
        F.array(*(F.sum(F.when(u, F.col(f"_w{i}") * F.col("_y"))) for i, u in enumerate(used))).alias("medians"))


def _medians_inside(rows: DataFrame, keys: Sequence[str], folds: Sequence[int]) -> DataFrame:
    """(keys, medians) of groups that each fit one task: their values are sorted there, once for all folds."""
    held = rows.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("_y", "_fold"))).alias("all"))
    others = F.transform(F.array(*(F.lit(f) for f in folds)), lambda f: F.filter("all", lambda t: t["_fold"] != f))

    def middle(values: Column) -> Column:
        low, high = (F.get(values, F.floor(n / 2).cast("int"))["_y"] for n in (F.size(values) - 1, F.size(values)))
        return F.when(F.size(values) > 0, low / 2 + high / 2)

    return held.select(*keys, F.transform(others, middle).alias("medians"))


def _medians_across(counts: DataFrame, keys: Sequence[str], folds: Sequence[int]) -> DataFrame:
    """(keys, medians) of groups of any size.

    ``counts`` holds a row per group and value with the rows ``_c{i}`` of all folds but the
    i-th. It is sorted once by group and value over all tasks; every value carries the rows before it.
    """
    marked = sorted_once(counts, [*keys, "_y"])
    part = F.shiftright("_at", POSITION_BITS)
    cells = [f"_c{i}" for i in range(len(folds))]
    sums = marked.groupBy(part.alias("_part")).agg(*(F.sum(c).alias(c) for c in cells))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # a row per sorted partition
    starts = sums.select("_part", *(F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"_s{c}") for c in cells))
    inside = Window.partitionBy("_part").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    placed = marked.withColumn("_part", part)
    placed = placed.select("*", *(F.coalesce(F.sum(c).over(inside), F.lit(0)).alias(f"_o{c}") for c in cells))
    placed = placed.join(F.broadcast(starts), "_part")
    # Counted over all groups so far; a group's own count starts at its least.
    placed = store(placed.select(*keys, "_y", *cells, *(
        (F.col(f"_s{c}") + F.col(f"_o{c}")).alias(f"_b{i}") for i, c in enumerate(cells))), "fold-places")
    begin = placed.groupBy(*keys).agg(*(F.min(f"_b{i}").alias(f"_f{i}") for i in range(len(folds))),
                                      *(F.sum(c).alias(f"_z{i}") for i, c in enumerate(cells)))
    met = left_join(placed, begin, keys)
    return _picked(met.withColumns({f"_l{i}": F.col(f"_b{i}") - F.col(f"_f{i}") for i in range(len(folds))}), keys, folds)


def _medians_without(kept: DataFrame, long: DataFrame, inner: Mapping[str, str], key_sets: Mapping[str, Sequence[str]],
                     ids: Mapping[str, int], folds: Sequence[int], row_limit: int) -> DataFrame:
    """Medians without each fold, in the order of ``folds``, of the groups of all key sets:
    (_set, keys, medians), stored by set.

    Sets of small groups are sorted group by group. Of other sets equal values are counted
    first and sorted over all tasks, those of all sets in one go.
    """
    columns = list(inner.values())
    sets = {ids[p]: [inner[k] for k in sorted(ks)] for p, ks in key_sets.items()}
    groups = long.groupBy("_set", *columns).agg(F.sum("rows").alias("n")).groupBy("_set").agg(
        F.count(F.lit(1)).alias("groups"), F.max("n").alias("largest"), F.sum("n").alias("n"))
    small = {r["_set"] for r in groups.collect()
             if r["largest"] <= row_limit and r["n"] <= max(ONE_PASS_ROWS, COUNTED_ROWS * r["groups"])}
    kinds = {f.name: f.dataType for f in kept.schema.fields}

    def tagged(table: DataFrame, i: int, *names: str) -> DataFrame:
        keys = (F.col(c) if c in sets[i] else F.lit(None).cast(kinds[c]).alias(c) for c in columns)
        return table.select(F.lit(i).cast("long").alias("_set"), *keys, *names)

    present = lambda i: kept.dropna(subset=[*sets[i], "_y"])
    found = [tagged(_medians_inside(present(i), sets[i], folds), i, "medians") for i in sets if i in small]
    coarse = [i for i in sets if i not in small]
    if coarse:
        cells = [F.count(F.when(F.col("_fold") != f, 1)).alias(f"_c{k}") for k, f in enumerate(folds)]
        counted = (tagged(present(i).groupBy(*sets[i], "_y").agg(*cells), i, "_y", *(f"_c{k}" for k in range(len(folds))))
                   for i in coarse)
        # A struct compares as a whole, with the columns that a set has not.
        together = reduce(DataFrame.unionByName, counted).withColumn("_group", F.struct("_set", *columns))
        across = _medians_across(together.drop("_set", *columns), ["_group"], folds)
        found.append(across.select("_group.*", "medians"))
    return store(reduce(DataFrame.unionByName, found), "fold-medians", partition_by=["_set"])


def stat_encode_oof(
    df: DataFrame,
    key_sets: Mapping[str, Sequence[str]],
    target: str,
    fold: Column,
    statistics: Sequence[str] = STATISTICS,
    row_limit: int = ROW_LIMIT,
) -> DataFrame:
    """Add {prefix}_{mean, median, std, max, count} of the row's group over the other folds.

    ``fold`` gives a row's fold (see ``fold_of``). One grouping-sets pass keeps a state per
    group and fold: rows, mean, squares about it, maximum. A row's statistics merge the states
    of all folds but its own. Medians come from values sorted group by group, or over all tasks
    where groups are big (``row_limit``). So no row sees its own target or that
    of its fold.

    A row with a missing key or fold gets nulls, as does one whose group has no row outside its
    fold (its count is 0). A missing target or NaN counts for nobody.
    """
    fold_name = "_fold"
    narrow, inner = _narrow(df, key_sets, target, {fold_name: fold.cast("int")})
    kept = narrow.filter(F.col(fold_name).isNotNull())
    long, ids = _grouped(kept, inner, key_sets, [fold_name], F.count(F.lit(1)).alias("rows"), *_state("_y"))
    long = store(long, "fold-groups", partition_by=["_set"])
    # The folds that occur; their number is a parameter.
    folds = sorted(r[fold_name] for r in long.select(fold_name).distinct().collect())
    medians = None
    if folds and "median" in statistics:
        medians = _medians_without(kept, long, inner, key_sets, ids, folds, row_limit)
    rows = df.withColumn(fold_name, fold.cast("int"))
    for prefix, keys in key_sets.items():
        cols = [inner[k] for k in keys]
        parts = long.filter((F.col("_set") == ids[prefix]) & ~any_null(cols))
        # A group has at most as many states as there are folds; it meets every fold.
        group = parts.groupBy(*cols).agg(F.array_sort(F.collect_list(F.struct(fold_name, "n", "m", "v", "most"))).alias("all"))
        if medians is None:
            group = group.withColumn("medians", F.lit(None).cast("array<double>"))
        else:
            # One row per group on both sides, so no key can be hot.
            group = group.join(medians.filter(F.col("_set") == ids[prefix]).select(*cols, "medians"), cols, "left")
        every = F.posexplode(F.array(*(F.lit(f) for f in folds)) if folds else F.array().cast("array<int>"))
        table = group.select("*", every.alias("_place", fold_name))
        table = table.withColumn("others", F.filter("all", lambda t: (t[fold_name] != F.col(fold_name)) & (t["n"] > 0)))
        zero = F.lit(0.0)
        table = table.withColumn("count", F.aggregate("others", F.lit(0).cast("long"), lambda a, t: a + t["n"]))
        table = table.withColumn("mean", F.when(F.col("count") > 0, F.aggregate(
            "others", zero, lambda a, t: a + t["m"] * (t["n"] / F.col("count")))))
        squares = F.aggregate("others", zero, lambda a, t: a + t["v"] + t["n"] * (t["m"] - F.col("mean")) * (t["m"] - F.col("mean")))
        table = table.select(*cols, fold_name, "mean", "count", _std(F.col("count"), squares).alias("std"),
                             F.array_max(F.transform("others", lambda t: t["most"])).alias("max"),
                             F.get("medians", F.col("_place")).alias("median"))
        side = store(_named(table, inner, keys, prefix, {x: F.col(x) for x in statistics}, F.col(fold_name)), "fold-side")
        side_rows, texts = side.agg(F.count(F.lit(1)), F.sum(text_bytes(side))).first()
        size, both = measured_bytes(side, side_rows, texts or 0), [*keys, fold_name]
        hot = None
        if size > BROADCAST_BYTES:
            sizes = parts.select(*(F.col(inner[k]).alias(k) for k in keys), fold_name, F.col("rows").alias("_rows"))
            hot = hot_groups(sizes, both, "_rows")
        rows = left_join(rows, side, both, side_rows, hot=hot, side_bytes=size, stored=True)
    return rows.drop(fold_name)


# --- smoothed ----------------------------------------------------------------------


def shrinkage(df: DataFrame, keys: Sequence[str], target: str) -> DataFrame:
    """Mean per group drawn towards the mean of all rows: (keys, n, mean, weight, smoothed).

    Empirical Bayes: with W the variance inside groups (pooled) and B that between groups (by
    the method of moments for groups of unequal size, at least 0), a group of n rows counts
    with the weight n / (n + W / B). Without any variance between groups all get the prior;
    without any inside them, each its own mean.
    """
    return _shrunk(_group_states(df, keys, target), keys)


def _group_states(df: DataFrame, keys: Sequence[str], target: str) -> DataFrame:
    narrow = df.dropna(subset=list(map(quoted, keys))).select(*(F.col(quoted(k)) for k in keys), as_double(df, target).alias("_y"))
    return store(narrow.filter(F.col("_y").isNotNull()).groupBy(*map(quoted, keys)).agg(*_state("_y")), "states")


def _components(states: DataFrame) -> dict:
    """Rows, groups and the two variances, from one row per group."""
    first = states.agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("m")).alias("s")).first()
    n = first["n"] or 0
    mean = first["s"] / n if n else None
    gap = F.col("m") - F.lit(mean)
    r = states.agg(F.count(F.lit(1)).alias("g"), F.sum(F.col("n") * F.col("n")).alias("nn"), F.sum("v").alias("inside"),
                   F.sum(F.col("n") * gap * gap).alias("between")).first()
    g = r["g"]
    inside = r["inside"] / (n - g) if n > g else 0.0
    between = 0.0
    if g > 1:
        between = max(0.0, (r["between"] / (g - 1) - inside) / ((n - r["nn"] / n) / (g - 1)))
    return {"n": n, "groups": g, "mean": mean, "within": inside, "between": between}


def _weight(n: Column, found: dict) -> Column:
    if found["between"] <= 0.0:
        return F.lit(0.0)
    return n / (n + F.lit(found["within"] / found["between"]))


def _shrunk(states: DataFrame, keys: Sequence[str]) -> DataFrame:
    found = _components(states)
    weight, prior = _weight(F.col("n"), found), F.lit(found["mean"])
    return states.select(*map(quoted, keys), "n", F.col("m").alias("mean"), weight.alias("weight"),
                         (prior + weight * (F.col("m") - prior)).alias("smoothed"))


def smooth_encode(df: DataFrame, levels: Sequence[Sequence[str]], target: str, prefix: str,
                  train: Column | None = None) -> DataFrame:
    """Add {prefix}_smooth: the mean of the row's group, drawn towards coarser groups.

    ``levels`` goes from the coarsest to the finest key set, as [["a"], ["a", "b"]]. Every
    level shrinks a group's mean towards what the level before gives for it: the levels before
    it must be part of its keys, or the coarser group is not determined. Between groups counts
    the variance about that prior. Each level has its own weights by empirical Bayes.

    ``train`` marks the rows to learn from. A row whose finest group was never seen gets the
    coarser one's value, in the end the mean of all; a missing key counts as unseen.
    """
    for coarse, fine in zip(levels, levels[1:]):
        if not set(coarse) < set(fine):
            raise ValueError(f"{list(fine)} does not hold all of {list(coarse)}")
    source = df if train is None else df.filter(train)
    value = as_double(source, target)
    total = source.agg(F.avg(value).alias("m")).first()["m"]
    rows, name = df, f"{prefix}_smooth"
    if name in df.columns:
        raise ValueError(f"the table has a column {name}")
    tables: list[tuple[Sequence[str], DataFrame]] = []
    before = None
    for keys in levels:
        states = _group_states(source, keys, target)
        if before is None:
            with_prior = states.withColumn("_prior", F.lit(total))
        else:
            coarse, table = before
            with_prior = left_join(states, table.select(*map(quoted, coarse), F.col("_value").alias("_prior")), list(coarse))
        with_prior = store(with_prior, "priors")
        # Moments of the groups about their priors.
        gap = F.col("m") - F.col("_prior")
        r = with_prior.agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("g"), F.sum("v").alias("inside"),
                           F.sum(F.col("n") * gap * gap).alias("between")).first()
        n, g = r["n"] or 0, r["g"]
        inside = r["inside"] / (n - g) if n > g else 0.0
        between = max(0.0, (r["between"] - g * inside) / n) if n else 0.0
        weight = _weight(F.col("n"), {"within": inside, "between": between})
        table = with_prior.select(*map(quoted, keys), (F.col("_prior") + weight * gap).alias("_value"))
        before = (keys, table)
        tables.append((keys, table))
    found = []
    for i, (keys, table) in enumerate(tables):
        found.append(f"_smooth{i}")
        rows = left_join(rows, table.withColumnRenamed("_value", found[-1]), list(keys))
    best = F.coalesce(*(F.col(c) for c in reversed(found)), F.lit(total))
    return rows.withColumn(name, best).drop(*found)


# --- as of a point in time ---------------------------------------------------------


def stat_encode_asof(
    df: DataFrame,
    key_sets: Mapping[str, Sequence[str]],
    target: str,
    time_col: str,
    cut: int | float | None = None,
) -> DataFrame:
    """Add {prefix}_{mean, std, max, count} of the row's group over strictly earlier times only.

    A state per group and time is kept by one grouping-sets pass; the states of a group are
    added up in the order of time, and every row meets the sum before its own time. With ``cut``
    the rows from the cut on (a test set) only use rows before the cut, so that no test row
    enters any statistic; rows before it use what lies before them. A group without an earlier
    row has count 0 and nulls; a row with a missing key or time gets nulls.
    """
    at = "_time"
    seen = F.col(quoted(time_col))
    if cut is not None:
        # All of the test set stands at the cut.
        seen = F.when(seen.isNotNull(), F.least(seen, F.lit(cut).cast(df.schema[time_col].dataType)))
    narrow, inner = _narrow(df, key_sets, target, {at: seen})
    kept = narrow.filter(F.col(at).isNotNull())
    long, ids = _grouped(kept, inner, key_sets, [at], *_state("_y"))
    long = store(long, "time-groups", partition_by=["_set"])
    rows = df.withColumn(at, seen)
    for prefix, keys in key_sets.items():
        cols = [inner[k] for k in keys]
        parts = long.filter((F.col("_set") == ids[prefix]) & ~any_null(cols))
        # One row per group and time, so a group's task holds its times, not its rows.
        group = Window.partitionBy(*cols)
        earlier = group.orderBy(at).rowsBetween(Window.unboundedPreceding, -1)
        # Running sums about the group's own mean.
        centre = F.sum(F.col("n") * F.col("m")).over(group) / F.sum("n").over(group)
        parts = parts.withColumn("c", F.when(F.sum("n").over(group) > 0, centre)).withColumn("d", F.col("m") - F.col("c"))
        added = lambda c: F.coalesce(F.sum(c).over(earlier), F.lit(0))
        past = parts.select(*cols, at, "c", added(F.col("n")).alias("n"), added(F.col("n") * F.col("d")).alias("s"),
                            added(F.col("v") + F.col("n") * F.col("d") * F.col("d")).alias("q"),
                            F.max("most").over(earlier).alias("most"))
        n = F.col("n")
        mean = F.when(n > 0, F.col("c") + F.col("s") / n)
        values = {"mean": mean, "std": _std(n, F.col("q") - F.col("s") * F.col("s") / n), "max": F.col("most"), "count": n}
        rows = left_join(rows, _named(past, inner, keys, prefix, values, F.col(at)), [*keys, at])
    return rows.drop(at)
