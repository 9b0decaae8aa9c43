"""Group-statistic encodings: a target's statistics per key set, joined back to the rows."""

from __future__ import annotations

import math
from collections.abc import Callable, Collection, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from statloom.functions.coerce import as_double, quoted
from statloom.functions.columns import unique_sorted
from statloom.operators.keyed import (
    BROADCAST_BYTES,
    HOT_KEYS,
    any_null,
    key_hash,
    left_join,
    measured_bytes,
    text_bytes,
)
from statloom.operators.ordering import ROW_LIMIT, counted_halves, counted_median, percentile_columns
from statloom.session import dealt, release, store

STATISTICS = ("mean", "median", "std", "max", "count")
# Up to so many rows the medians of all key sets are aggregated along.
ONE_PASS_ROWS = 200_000
# Groups of up to so many rows on average are always sorted group by group.
COUNTED_ROWS = 100
# Into how many parts the target's range is cut to find the middle values of big groups, and at most.
PARTS, MOST_PARTS = 64, 1_000
# Up to so many places of middle values are broadcast.
PLACES = 200_000


def _moments(target: str) -> list[Column]:
    return [
        F.avg(target).alias("mean"),
        F.stddev_samp(target).alias("std"),
        F.max(target).alias("max"),
        F.count(target).alias("count"),
    ]


def _bounds(narrow: DataFrame, parts: int) -> list[float]:
    """Values that cut the target into about even parts. Any values would give the same medians."""
    shares = [i / parts for i in range(1, parts)]
    found = narrow.agg(F.percentile_approx("_target", shares, 10 * parts).alias("b")).first()["b"] or []
    return sorted({b + 0.0 for b in found if math.isfinite(b)})


def _part(bounds: Sequence[float]) -> Column:
    """How many of the sorted bounds are not above the target, by a wide step and a narrow one."""
    step = math.isqrt(len(bounds)) + 1
    blocks = [list(bounds[i:i + step]) for i in range(0, len(bounds), step)]
    upto = lambda values: F.size(F.filter(values, lambda b: b <= F.col("_target")))
    below = upto(F.lit([block[-1] for block in blocks]))
    inside = F.coalesce(upto(F.get(F.lit(blocks), below)), F.lit(0))
    return F.least(below * step + inside, F.lit(len(bounds))).cast("int")


def _places(narrow: DataFrame, sets: Mapping[int, Sequence[str]], coarse: Sequence[int], bounds: Sequence[float]) -> DataFrame:
    """Where the middle values of the groups lie: (_set, keys, _cell, n, _from, _to, _lo, _hi), stored by set.

    Rows are counted per group and part of the target's range. ``_lo`` and ``_hi`` are the places of
    the lower and upper middle value among the n rows of the part, null if it lies in another one.
    """
    used = unique_sorted(*(sets[i] for i in coarse))
    marks = [*used, "_cell"]
    tags = {sum(1 << k for k, c in enumerate(reversed(marks)) if c not in (*sets[i], "_cell")): i for i in coarse}
    cells = narrow.withColumn("_cell", _part(bounds) if bounds else F.lit(0)).groupingSets(
        [[F.col(c) for c in (*sets[i], "_cell")] for i in tags.values()], *(F.col(c) for c in marks)).agg(
        F.grouping_id().alias("_tag"), F.count(F.lit(1)).alias("n"))
    group = Window.partitionBy("_tag", *used)
    upto = group.orderBy("_cell").rowsBetween(Window.unboundedPreceding, 0)
    placed = cells.withColumns({"_upto": F.sum("n").over(upto), "_total": F.sum("n").over(group)})
    # The middle places, counted from 0: one or two.
    middle = {"_lo": F.floor((F.col("_total") - 1) / 2), "_hi": F.floor(F.col("_total") / 2)}
    before = F.col("_upto") - F.col("n")
    ends = F.lit([*bounds, float("inf")])
    which = F.create_map(*(F.lit(x).cast("long") for pair in tags.items() for x in pair))
    return store(placed.withColumns({
        m: F.when((p >= before) & (p < F.col("_upto")), p - before) for m, p in middle.items()
    }).filter("_lo IS NOT NULL OR _hi IS NOT NULL").select(
        which[F.col("_tag").cast("long")].alias("_set"), *used, "_cell", "n",
        F.get(ends, F.col("_cell") - 1).alias("_from"),
        F.when(F.col("_cell") < len(bounds), F.get(ends, F.col("_cell"))).alias("_to"), "_lo", "_hi",
    ), "places", partition_by=["_set"])


def _medians(narrow: DataFrame, long: DataFrame, sets: Mapping[int, Sequence[str]], columns: Sequence[str],
             total: int, row_limit: int) -> DataFrame:
    """Exact medians of the groups of all key sets: (_set, columns, median), stored by set.

    Sets of small groups are sorted group by group. Of other sets rows are first counted by parts
    of the target's range, then only the rows of the parts with a group's middle values are
    shuffled and sorted; where such a part has more than ``row_limit`` rows, those of all sets are
    sorted over all tasks in one go.
    """
    groups = long.groupBy("_set").agg(F.count(F.lit(1)).alias("n"), F.max("_rows").alias("largest")).collect()
    parts = min(max(PARTS, -(-total // row_limit)), MOST_PARTS)
    # Counts of parts are few only where groups hold several rows in each.
    small = {r["_set"] for r in groups
             if r["largest"] <= row_limit and total <= max(COUNTED_ROWS, 16 * parts) * r["n"]}
    kinds = {f.name: f.dataType for f in narrow.schema.fields}

    def tagged(table: DataFrame, i: int, *names: str) -> DataFrame:
        keys = (F.col(c) if c in sets[i] else F.lit(None).cast(kinds[c]).alias(c) for c in columns)
        return table.select(F.lit(i).cast("long").alias("_set"), *keys, *names)

    present = lambda i: narrow.select(*sets[i], "_target").dropna()
    found = [tagged(counted_median(present(i).withColumn("_ties", F.lit(1)), "_target", "_ties", sets[i]), i, "median")
             for i in sets if i in small]
    coarse = [i for i in sets if i not in small]
    if coarse:
        places = _places(narrow.filter("_target IS NOT NULL"), sets, coarse, _bounds(narrow, parts))
        sizes = {r["_set"]: r for r in places.groupBy("_set").agg(F.count(F.lit(1)).alias("rows"), F.max("n").alias("n")).collect()}
        inside = ((F.col("_from").isNull() | (F.col("_target") >= F.col("_from")))
                  & (F.col("_to").isNull() | (F.col("_target") < F.col("_to"))))

        def middle(i: int) -> DataFrame:
            """The rows of a set's groups in the parts with their middle values."""
            side = places.filter(F.col("_set") == i).select(*sets[i], "_cell", "_from", "_to", "_lo", "_hi").dropna(subset=sets[i])
            side = F.broadcast(side) if sizes[i]["rows"] <= PLACES else side
            return present(i).join(side, sets[i]).filter(inside).drop("_from", "_to")

        def halves(i: int) -> DataFrame:
            order = Window.partitionBy(*sets[i], "_cell").orderBy("_target")
            at = middle(i).withColumn("_at", F.row_number().over(order) - 1)
            share = sum((F.when(F.col("_at") == F.col(p), F.col("_target") / 2).otherwise(0.0) for p in ("_lo", "_hi")), F.lit(0.0))
            return at.filter("_at = _lo OR _at = _hi").select(*sets[i], share.alias("half"))

        some = [i for i in coarse if i in sizes]
        big = [i for i in some if sizes[i]["n"] > row_limit]
        found += [tagged(halves(i).groupBy(*sets[i]).agg(F.sum("half").alias("median")), i, "median") for i in some if i not in big]
        if big:
            # A struct compares as a whole, with the columns that a set has not.
            together = reduce(DataFrame.unionByName, (
                tagged(middle(i), i, "_cell", "_target", "_lo", "_hi") for i in big)).select(
                F.struct("_set", *columns).alias("_group"), "_cell", "_target", "_lo", "_hi")
            across = counted_halves(together, "_target", ["_lo", "_hi"], ["_group", "_cell"])
            found.append(across.groupBy("_group").agg(F.sum("half").alias("median")).select("_group.*", "median"))
    if not found:
        found = [tagged(present(i).limit(0), i, "_target").withColumnRenamed("_target", "median") for i in list(sets)[:1]]
    return store(reduce(DataFrame.unionByName, found), "medians", partition_by=["_set"])


def group_statistics(
    df: DataFrame,
    key_sets: Mapping[str, Sequence[str]],
    target: str,
    row_limit: int = ROW_LIMIT,
    medians_of: Collection[str] | None = None,
    even: bool = False,
) -> dict[str, tuple[DataFrame, int, int]]:
    """Mean, median, std, max and count of the target per group of every key set.

    One scan serves all key sets: each row meets its groups through grouping sets, and
    partial aggregation shrinks them before the shuffle. Medians of a small table are
    aggregated along, those of a bigger one come from sorted values (``_medians``). NaN counts
    as missing. Returns per prefix the table of its groups (keys, then prefix_statistic), its
    rows and its bytes. ``medians_of`` names the prefixes whose median is needed, if not all; it
    is null elsewhere. ``even`` says that ``df`` is stored with its rows lying evenly, and needs no
    copy of its keys.
    """
    names = unique_sorted(*key_sets.values())
    # Plain names inside, so that a key may be called a.b.
    inner = {n: f"_k{i}" for i, n in enumerate(names)}
    # Keys and target only, written once if need be: every later pass reads just these.
    # They lie evenly, for each row is about to meet all its groups.
    keys = df.select(*(F.col(quoted(n)).alias(inner[n]) for n in names), as_double(df, target).alias("_target"))
    narrow = keys if even else store(dealt(keys), "keys")
    columns = [inner[n] for n in names]
    sets = {prefix: [inner[c] for c in sorted(cols)] for prefix, cols in key_sets.items()}
    # grouping_id sets a bit for each column that is not part of the set.
    ids = {
        prefix: sum(1 << i for i, n in enumerate(reversed(columns)) if n not in cols)
        for prefix, cols in sets.items()
    }
    distinct_sets = {ids[p]: cols for p, cols in sets.items()}
    median_sets = {ids[p]: cols for p, cols in sets.items() if medians_of is None or p in medians_of}
    tag = F.grouping_id().alias("_set")

    total = narrow.count()
    one_pass = total <= min(row_limit, ONE_PASS_ROWS)
    median = percentile_columns("_target", {"median": 0.5}) if one_pass and median_sets else []
    long = narrow.groupingSets([[F.col(c) for c in cols] for cols in distinct_sets.values()],
                               *(F.col(c) for c in columns)).agg(
        tag, F.count(F.lit(1)).alias("_rows"), *_moments("_target"), *median)
    long = store(long, "groups", partition_by=["_set"])
    medians = None if one_pass or not median_sets else _medians(
        narrow, long.filter(F.col("_set").isin(list(median_sets))), median_sets, columns, total, row_limit)
    measured = long.groupBy("_set").agg(F.count(F.lit(1)).alias("n"), F.sum(text_bytes(long)).alias("b"))
    sizes = {r["_set"]: (r["n"], r["b"] or 0) for r in measured.collect()}

    result = {}
    for prefix, cols in sets.items():
        i = ids[prefix]
        table = long.filter((F.col("_set") == i) & ~any_null(cols))
        if i not in median_sets:
            table = table.withColumn("median", F.lit(None).cast("double"))
        elif medians is not None:
            # One row per group on both sides, so no key can be hot.
            table = table.join(medians.filter(F.col("_set") == i).select(*cols, "median"), cols, "left")
        table = table.select(*(F.col(inner[c]).alias(c) for c in key_sets[prefix]),
                             *(F.col(s).alias(f"{prefix}_{s}") for s in STATISTICS))
        rows, texts = sizes.get(i, (0, 0))
        result[prefix] = (table, rows, measured_bytes(table, rows, texts))
    return result


def hot_groups(table: DataFrame, keys: Sequence[str], size: str) -> list[int]:
    """Hashes of the groups with more than 1/HOT_KEYS of all rows: at most HOT_KEYS."""
    least = (table.agg(F.sum(size)).first()[0] or 0) / HOT_KEYS
    hot = table.filter(F.col(size) > least).select(key_hash(keys).alias("h"))
    return [r["h"] for r in hot.collect()]


def stat_encode(
    df: DataFrame,
    key_sets: Mapping[str, Sequence[str]],
    target: str,
    row_limit: int = ROW_LIMIT,
    statistics_from: DataFrame | None = None,
    salt: Column | None = None,
    medians: Collection[str] | None = None,
    even: bool = False,
    beside: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Add {prefix}_{mean, median, std, max, count} of the row's group for every key set.

    The row itself counts in its group. A row with a missing key gets nulls.
    ``statistics_from`` may name a cheaper table with the same rows to aggregate; ``salt``
    a stored ``row_salt`` of the rows (see ``left_join``); ``medians`` the prefixes whose median
    is needed, if not all. ``even`` says that the table to aggregate is stored evenly. ``beside``
    adds columns from further small tables, once the rows have been shuffled for the big ones.
    """
    tables = group_statistics(statistics_from or df, key_sets, target, row_limit, medians, even)
    release(df.sparkSession)
    room = BROADCAST_BYTES  # for all broadcasts of this plan together
    small = set()
    for prefix, (_, _, size) in tables.items():
        if size <= room:
            room -= size
            small.add(prefix)
    packs = {prefix: f"_pack{k}" for k, prefix in enumerate(key_sets)}
    # Big tables come first, while the rows to be shuffled carry no statistics yet.
    order = sorted(tables, key=small.__contains__)
    for at, prefix in enumerate(order):
        table, rows, size = tables[prefix]
        if beside is not None and at == len(tables) - len(small):
            df, beside = beside(df), None
        # One column per table, as every join copies its rows; all statistics are doubles or counts.
        values = F.array(*(F.col(quoted(f"{prefix}_{s}")).cast("double") for s in STATISTICS))
        side = table.select(*(F.col(quoted(k)) for k in key_sets[prefix]), values.alias(packs[prefix]))
        if prefix in small:
            df = left_join(df, side, key_sets[prefix], rows, broadcast_bytes=size, side_bytes=size)
        else:
            hot = hot_groups(table, key_sets[prefix], f"{prefix}_count")
            df = left_join(df, side, key_sets[prefix], rows, broadcast_bytes=-1, hot=hot, side_bytes=size, salt=salt)
    df = df if beside is None else beside(df)
    names = [c for c in df.columns if c not in packs.values()]
    made = (F.get(packs[prefix], F.lit(i)).cast("long" if s == "count" else "double").alias(f"{prefix}_{s}")
            for prefix in key_sets for i, s in enumerate(STATISTICS))
    return df.select(*map(quoted, names), *made)
