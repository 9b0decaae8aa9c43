"""Exact k-means of integer vectors by Shallot search: bounds, two remembered centroids, a shrinking ball."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from statloom.llm.common import drop_table, query, read, share_package, write_table

DIMENSIONS = 64
CENTROIDS = 16
ROUNDS = 3
# A component x becomes floor(SCALE * x).
SCALE = 64
# Components beyond this have no squared distance in a long at a few thousand dimensions.
LARGEST = 1 << 25
# Bounds are widened by this share, so that rounding never hides a nearer or equal centroid.
SLACK = 1e-9
# Vectors whose distances one step of a task computes.
BLOCK = 4_096


class Clusters(NamedTuple):
    """rows: id_col, cluster, distance of every kept vector; clusters: one row per centroid
    (cluster, n, cluster_inertia, inertia, centroid); skipped: per round, the share of
    vectors that their bounds kept from any distance, and distances computed per vector."""

    rows: DataFrame
    clusters: DataFrame
    skipped: list[dict]


# --- integer vectors ---------------------------------------------------------------


def integer_vectors(table: DataFrame, id_col: str, vector_col: str, dimensions: int = DIMENSIONS,
                    scale: int = SCALE) -> DataFrame:
    """(id, v): vectors of so many finite components, each component floor(scale * x)."""
    v = F.transform(F.col(vector_col), lambda x: x.cast("double"))
    good = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    kept = table.select(F.col(id_col).alias("id"), v.alias("v")).filter((F.size("v") == dimensions) & good)
    whole = F.transform("v", lambda x: F.floor(x * scale))
    held = F.forall("v", lambda x: F.abs(x * scale) < LARGEST)
    return kept.select("id", F.when(held, whole).otherwise(F.raise_error(
        F.lit(f"a component beyond {LARGEST} / {scale} has no exact distance in a long"))).alias("v"))


def first_centroids(vectors: DataFrame, k: int) -> np.ndarray:
    """The k vectors whose id has the smallest SHA-256, in that order; equal hashes by the vector."""
    seed = F.sha2(F.concat(F.lit("1:"), F.coalesce(F.col("id").cast("string"), F.lit(""))), 256)
    rows = vectors.select(seed.alias("h"), "v").orderBy("h", "v").limit(k).collect()
    return np.array([r["v"] for r in rows], dtype=np.int64)


# --- the search --------------------------------------------------------------------


def squared(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Exact squared distances of rows, in integers."""
    gap = x - y
    return np.einsum("ij,ij->i", gap, gap)


class Geometry(NamedTuple):
    """What all tasks of a round know about the centroids; k x k numbers."""

    centroids: np.ndarray
    order: np.ndarray  # per centroid the others, nearest first
    reach: np.ndarray  # their distances from it, a little too small
    half: np.ndarray  # half the distance to the nearest other, a little too small
    drift: np.ndarray  # how far each centroid moved, a little too large
    drift_others: np.ndarray  # the farthest that any other centroid moved


def geometry(centroids: np.ndarray, before: np.ndarray | None) -> Geometry:
    k = len(centroids)
    between = np.sqrt(np.array([squared(centroids, c) for c in centroids], dtype=float).reshape(k, k))
    np.fill_diagonal(between, -1.0)
    order = np.argsort(between, axis=1, kind="stable")[:, 1:]
    reach = np.take_along_axis(between, order, axis=1) * (1 - SLACK)
    half = reach[:, 0] / 2 if k > 1 else np.full(k, np.inf)
    drift = np.zeros(k) if before is None else np.sqrt(squared(centroids, before).astype(float)) * (1 + SLACK)
    others = np.array([np.delete(drift, i).max(initial=0.0) for i in range(k)])
    return Geometry(centroids, order, reach, half, drift, others)


def assign(x: np.ndarray, near: np.ndarray, second: np.ndarray, upper: np.ndarray, lower: np.ndarray,
           g: Geometry) -> tuple[int, int]:
    """Bring the state of the vectors ``x`` up to the centroids of ``g``, in place.

    ``near`` and ``second`` are the nearest and second-nearest centroid of the round before,
    ``upper`` bounds the distance to ``near`` from above and ``lower`` that to every other
    centroid from below. Returns how many vectors were searched and how many distances that took.
    """
    k = len(g.centroids)
    upper += g.drift[near]
    lower -= g.drift_others[near]
    # Strictly inside both bounds no other centroid is as near.
    todo = np.flatnonzero(upper >= np.maximum(lower, g.half[near]))
    if not len(todo):
        return 0, 0
    own = squared(x[todo], g.centroids[near[todo]])
    count = len(todo)
    tight = np.sqrt(own.astype(float)) * (1 + SLACK)
    upper[todo] = tight
    open_ = tight >= np.maximum(lower[todo], g.half[near[todo]])
    todo, own = todo[open_], own[open_]
    if k == 1 or not len(todo):
        return len(todo), count
    # The scan starts from the closer one of the two remembered centroids.
    a, b = near[todo].copy(), second[todo].copy()
    other = squared(x[todo], g.centroids[b])
    count += len(todo)
    swap = (other < own) | ((other == own) & (b < a))
    a[swap], b[swap] = b[swap], a[swap]
    own[swap], other[swap] = other[swap], own[swap]
    centre = a.copy()
    from_centre = np.sqrt(own.astype(float)) * (1 + SLACK)
    # A centroid as near as the second-nearest lies in the ball around the centre of this radius.
    ball = from_centre + np.sqrt(other.astype(float)) * (1 + SLACK)
    best, next_ = own, other
    rows = np.arange(len(todo))
    for place in range(k - 1):
        rows = rows[g.reach[centre[rows], place] <= ball[rows]]
        if not len(rows):
            break
        c = g.order[centre[rows], place]
        new = (c != a[rows]) & (c != b[rows])
        at, c = rows[new], c[new]
        d = squared(x[todo[at]], g.centroids[c])
        count += len(at)
        first = (d < best[at]) | ((d == best[at]) & (c < a[at]))
        then = ~first & ((d < next_[at]) | ((d == next_[at]) & (c < b[at])))
        up, behind = at[first], at[then]
        next_[up], b[up] = best[up], a[up]
        best[up], a[up] = d[first], c[first]
        next_[behind], b[behind] = d[then], c[then]
        moved = at[first | then]
        ball[moved] = from_centre[moved] + np.sqrt(next_[moved].astype(float)) * (1 + SLACK)
    near[todo], second[todo] = a, b
    upper[todo] = np.sqrt(best.astype(float)) * (1 + SLACK)
    lower[todo] = np.sqrt(next_.astype(float)) * (1 - SLACK)
    return len(todo), count


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width).astype(np.int64)


STATE = "near int, second int, upper double, lower double, searched int, compared int"


def _round(g: Geometry, width: int, first: bool, last: bool):
    """One round over the batches of a task: vectors with their state in, the same out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, BLOCK):
                part = batch.slice(start, BLOCK)
                n, x = part.num_rows, _matrix(part.column("v"), width)
                if first:
                    near, second = np.zeros(n, np.int32), np.full(n, min(1, len(g.centroids) - 1), np.int32)
                    upper, lower = np.full(n, np.inf), np.full(n, -np.inf)
                else:
                    near, second, upper, lower = (
                        part.column(c).to_numpy(zero_copy_only=False).copy() for c in ("near", "second", "upper", "lower"))
                searched, compared = assign(x, near, second, upper, lower, g)
                counts = [pa.array(np.concatenate([[v], np.zeros(n - 1)]).astype(np.int32)) for v in (searched, compared)]
                if last:
                    exact = squared(x, g.centroids[near])
                    yield pa.RecordBatch.from_arrays(
                        [part.column("id"), pa.array(near), pa.array(exact), *counts],
                        names=["id", "cluster", "distance", "searched", "compared"])
                else:
                    yield pa.RecordBatch.from_arrays(
                        [part.column("id"), part.column("v"), pa.array(near), pa.array(second), pa.array(upper),
                         pa.array(lower), *counts],
                        names=["id", "v", "near", "second", "upper", "lower", "searched", "compared"])

    return run


def _moved(state: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Componentwise floor of the exact means; a centroid without vectors stays."""
    width = centroids.shape[1]
    sums = state.groupBy("near").agg(F.count(F.lit(1)).alias("n"),
                                     *(F.sum(F.get("v", F.lit(i))).alias(f"s{i}") for i in range(width)))
    moved = centroids.copy()
    for r in sums.collect():  # one row per centroid
        moved[r["near"]] = [r[f"s{i}"] // r["n"] for i in range(width)]
    return moved


def cluster_vectors(table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                    k: int = CENTROIDS, rounds: int = ROUNDS, dimensions: int = DIMENSIONS,
                    scale: int = SCALE) -> Clusters:
    """Lloyd's k-means in integers, with Shallot search for the nearest centroid.

    Every vector carries its nearest and second-nearest centroid and bounds on both
    distances from round to round. Bounds that stay apart, or a nearest centroid that is
    nearer than half way to any other, need no distance. Else the closer one of the two
    remembered centroids is the centre; the others are met in the order of their distance
    from it, as long as they lie in a ball that shrinks with every nearer one found, and
    compared by exact integer distances. Ties go to the smaller number.

    The vectors and their state are a table in the shared folder that every round writes
    anew; the one before is deleted. Centroids (k rows) pass through the driver.

    Vectors that are null, of another length or with a null or non-finite component take no
    part; repeated rows and ids count as often as they occur; a null id is hashed as empty;
    fewer than k vectors give fewer centroids; further columns are not read. A component
    beyond LARGEST / scale raises an error, as its distances leave the range of a long. An
    empty table gives no rows.
    """
    spark = table.sparkSession
    share_package(spark)
    vectors = integer_vectors(table, id_col, vector_col, dimensions, scale)
    kind = vectors.schema["id"].dataType.simpleString()
    whole = "array<bigint>"
    state, path = write_table(vectors, "vectors")
    centroids, before = first_centroids(state, k), None
    if not len(centroids):
        none = spark.createDataFrame([], f"`{id_col}` {kind}, cluster int, distance long")
        nothing = "cluster int, n long, cluster_inertia long, inertia long, centroid {}".format(whole)
        return Clusters(none, spark.createDataFrame([], nothing), [])
    skipped = []
    for turn in range(rounds + 1):
        last = turn == rounds
        schema = (f"id {kind}, cluster int, distance long, searched int, compared int" if last
                  else f"id {kind}, v {whole}, {STATE}")
        old = path
        state, path = write_table(
            state.mapInArrow(_round(geometry(centroids, before), dimensions, turn == 0, last), schema), "clusters")
        drop_table(spark, old)
        seen = state.agg(F.count(F.lit(1)), F.sum("searched"), F.sum("compared")).first()
        skipped.append({"searched": seen[1] / seen[0], "distances": seen[2] / seen[0]})
        if not last:
            before, centroids = centroids, _moved(state, centroids)
    held = state.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), F.sum("distance").alias("cluster_inertia"))
    points = spark.createDataFrame([(i, c.tolist()) for i, c in enumerate(centroids)], f"cluster int, centroid {whole}")
    whole_sum = state.agg(F.sum("distance").alias("inertia"))
    clusters = points.join(held, "cluster", "left").join(F.broadcast(whole_sum)).select(
        "cluster", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("cluster_inertia", F.lit(0)).alias("cluster_inertia"),
        "inertia", "centroid")
    return Clusters(state.select(F.col("id").alias(id_col), "cluster", "distance"), clusters, skipped)


def centroid_digest(centroid: Column) -> Column:
    """SHA-256 of the components as decimal integers joined by commas."""
    return F.sha2(F.array_join(centroid.cast("array<string>"), ","), 256)


# --- the same in SQL ---------------------------------------------------------------


def _sql() -> str:
    steps = []
    for t in range(ROUNDS + 1):
        steps.append(f"""d{t} AS MATERIALIZED (SELECT rid, arg_min(c, (d, c)) AS c, min(d) AS d FROM (
            SELECT rid, c, list_sum([(v[i] - m[i]) * (v[i] - m[i]) FOR i IN range(1, 65)])::BIGINT AS d
            FROM vectors, m{t}) GROUP BY rid)""")
        if t < ROUNDS:
            steps.append(f"""s{t} AS (SELECT c, i, CAST(sum(v[i]) AS BIGINT) AS s, count(*) AS n
                FROM vectors JOIN d{t} USING (rid), range(1, 65) r(i) GROUP BY c, i),
            f{t} AS (SELECT c, list((s - ((s % n) + n) % n) // n ORDER BY i) AS m FROM s{t} GROUP BY c),
            m{t + 1} AS MATERIALIZED (SELECT m{t}.c, coalesce(f{t}.m, m{t}.m) AS m FROM m{t} LEFT JOIN f{t} USING (c))""")
    last = ROUNDS
    return f"""WITH whole AS MATERIALIZED (SELECT vec_id, row_number() OVER () AS rid, [x::DOUBLE FOR x IN embedding] AS e
          FROM embeddings WHERE len(embedding) = 64),
        vectors AS MATERIALIZED (SELECT vec_id, rid, [CAST(floor({SCALE} * x) AS BIGINT) FOR x IN e] AS v FROM whole
          WHERE len([x FOR x IN e IF x IS NULL OR NOT isfinite(x)]) = 0),
        m0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY h, v) - 1 AS c, v AS m FROM (
          SELECT sha256('1:' || coalesce(CAST(vec_id AS VARCHAR), '')) AS h, v FROM vectors ORDER BY h, v LIMIT {CENTROIDS})),
        {", ".join(steps)}
        SELECT vec_id, CAST(d{last}.c AS INTEGER) AS cluster, d AS distance,
          CAST(sum(d) OVER (PARTITION BY d{last}.c) AS BIGINT) AS cluster_inertia, CAST(sum(d) OVER () AS BIGINT) AS inertia,
          sha256(array_to_string(m, ',')) AS centroid_sha256
        FROM d{last} JOIN vectors USING (rid) JOIN m{last} USING (c)"""


@query("op12_centroid_clustering", _sql())
def op12_centroid_clustering(spark: SparkSession, sf: str) -> DataFrame:
    """Cluster and exact squared distance of every vector after three rounds over 16 centroids."""
    found = cluster_vectors(read(spark, sf, "embeddings"))
    named = found.clusters.withColumn("centroid_sha256", centroid_digest(F.col("centroid"))).drop("centroid", "n")
    # One row per centroid.
    return found.rows.join(F.broadcast(named), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
