"""Nearest neighbours by balanced posting lists, found through a graph of their centroids."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from statloom.llm.common import attach_groups, query, read, store

TOP = 20
QUERY_STEP = 20
# The sample that centroids are fitted on: about so many numbers; and vectors of a list, about.
SAMPLE_NUMBERS = 2_000_000
LIST_ROWS = 128
# A sample vector for each this many at least, so that a list's centre is a mean.
LIST_SAMPLE = 4
# Lists a vector is put in, and how much farther than the nearest centroid they may be.
REPLICAS, BUILD_RATIO = 8, 1.2
# A query looks into all lists up to this many times as far as its nearest one at least, and
# farther where a sample of so many queries needs it for this share of their true neighbours.
PROBE_RATIO = 1.1
RECALL, CALIBRATION = 0.95, 512
# Lists that a walk over the graph keeps at first; it keeps twice as many until the ratio ends it.
WALK = 64
# Neighbours in the graph, and candidates a search for a vector's own lists keeps.
DEGREE, BEAM = 24, 16
# Queries that a task holds at a time, at most about.
QUERY_ROWS = 50_000
# Vectors of a list that one task compares; distances or scores held at a time, about.
CHUNK_ROWS = 4_096
CELLS = 4_000_000
# Distances below this count as it where a ratio is taken.
TINY = 1e-9


class Index(NamedTuple):
    """radius: the largest norm; centroids have one dimension more, by which the largest
    inner product becomes the smallest distance. sizes: vectors per list."""

    radius: float
    centroids: np.ndarray
    graph: np.ndarray
    entries: np.ndarray
    sizes: np.ndarray


def lift(vectors: np.ndarray, radius: float) -> np.ndarray:
    """Vectors with a further coordinate that gives all of them the norm ``radius``."""
    rest = np.sqrt(np.maximum(0.0, radius**2 - (vectors**2).sum(axis=1)))
    return np.hstack([vectors, rest[:, None]])


def balanced_centroids(sample: np.ndarray, lists: int) -> np.ndarray:
    """Means of a balanced clustering: too large clusters are split until all are small."""
    rng = np.random.default_rng(7)
    largest = max(1.0, len(sample) / lists)
    waiting, done = [sample], []
    while waiting:
        part = waiting.pop()
        if len(part) <= largest:
            done.append(part.mean(axis=0))
            continue
        k = int(min(8, max(2, np.ceil(len(part) / largest))))
        means = part[rng.choice(len(part), k, replace=False)]
        for _ in range(8):
            label = ((means**2).sum(axis=1) - 2 * part @ means.T).argmin(axis=1)
            means = np.array([part[label == j].mean(axis=0) if (label == j).any() else
                              part[rng.integers(len(part))] for j in range(k)])
        pieces = [part[label == j] for j in range(k) if (label == j).any()]
        if len(pieces) < 2:  # alike: one centre serves them all
            done.append(part.mean(axis=0))
        else:
            waiting += pieces
    return np.array(done)


def neighbour_graph(centroids: np.ndarray) -> np.ndarray:
    """For each centroid its nearest ones, and a few at random that keep the graph connected."""
    rng, n = np.random.default_rng(11), len(centroids)
    degree = min(DEGREE, n)
    norms = (centroids**2).sum(axis=1)
    near = np.empty((n, degree), np.int32)
    for at in range(0, n, 1024):
        d = norms - 2 * centroids[at:at + 1024] @ centroids.T
        near[at:at + 1024] = np.argsort(d, axis=1, kind="stable")[:, :degree]
    far = rng.integers(0, n, (n, 4), dtype=np.int32)
    return np.hstack([near, np.roll(np.arange(n, dtype=np.int32), 1)[:, None], far])


def search_graph(index: Index, vectors: np.ndarray, keep: int) -> tuple[np.ndarray, np.ndarray]:
    """(lists, distances) of about the ``keep`` nearest centroids of each vector, nearest first.

    A best-first walk over the graph, for many vectors at once: in every step each vector
    opens its nearest unopened candidate, until all of its ``keep`` best are open.
    """
    centroids, n = index.centroids, len(vectors)
    keep = min(keep, len(centroids))
    norms = (centroids**2).sum(axis=1)
    own = (vectors**2).sum(axis=1)[:, None]

    def distance(ids: np.ndarray, rows: np.ndarray) -> np.ndarray:
        dots = np.einsum("nkd,nd->nk", centroids[ids], vectors[rows])
        return np.maximum(0, norms[ids] - 2 * dots + own[rows])

    rows = np.arange(n)
    entries = np.broadcast_to(index.entries, (n, len(index.entries)))
    ids, dist = np.full((n, keep), -1, np.int32), np.full((n, keep), np.inf)
    opened = np.zeros((n, keep), bool)

    def merge(who: np.ndarray, new: np.ndarray) -> None:
        d = distance(new, who)
        all_ids = np.hstack([ids[who], new])
        all_d = np.hstack([dist[who], d])
        all_open = np.hstack([opened[who], np.zeros_like(new, bool)])
        # One place per centroid, the opened one first.
        order = np.lexsort((~all_open, all_ids), axis=1)
        s = np.take_along_axis(all_ids, order, 1)
        again = np.zeros_like(s, bool)
        again[:, 1:] = s[:, 1:] == s[:, :-1]
        sd = np.where(again, np.inf, np.take_along_axis(all_d, order, 1))
        best = np.argsort(sd, axis=1, kind="stable")[:, :keep]
        dist[who] = np.take_along_axis(sd, best, 1)
        ids[who] = np.where(np.isinf(dist[who]), -1, np.take_along_axis(s, best, 1))
        opened[who] = np.take_along_axis(np.take_along_axis(all_open, order, 1), best, 1)

    merge(rows, entries.astype(np.int32))
    while len(rows):
        free = ~opened[rows] & (ids[rows] >= 0)
        going = free.any(axis=1)
        rows, free = rows[going], free[going]
        if not len(rows):
            break
        first = free.argmax(axis=1)
        opened[rows, first] = True
        merge(rows, index.graph[ids[rows, first]])
    return ids, dist


def _valid(vector: Column) -> Column:
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & ~F.coalesce(bad, F.lit(True)) & F.exists(vector, lambda x: x != 0)


def _stack(column: pd.Series) -> np.ndarray:
    return np.vstack(column.to_numpy()).astype(np.float64)


def fit(distinct: DataFrame, total: int, dims: int, radius: float) -> Index:
    """Fit centroids and their graph on a sample by hash of about SAMPLE_NUMBERS numbers."""
    want = max(1, SAMPLE_NUMBERS // dims)
    cut = min(1 << 30, int(want / max(1, total) * (1 << 30)))
    rows = distinct.filter(F.pmod("h1", F.lit(1 << 30)) < cut).select("h0", "vec").collect()
    sample = np.array([r["vec"] for r in sorted(rows, key=lambda r: r["h0"])], np.float64)
    sample = lift(sample.reshape(-1, dims), radius)
    lists = int(max(1, min(total // LIST_ROWS, len(sample) // LIST_SAMPLE)))
    centroids = balanced_centroids(sample, lists) if len(sample) else np.zeros((1, dims + 1))
    spread = np.linspace(0, len(centroids) - 1, min(8, len(centroids))).astype(np.int64)
    return Index(radius, centroids, neighbour_graph(centroids), np.unique(spread),
                 np.zeros(len(centroids), np.int64))


def _post(index: Index):
    """Each vector with the lists it goes to: the nearest, and others about as near."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), CHUNK_ROWS):
                part = batch.iloc[at:at + CHUNK_ROWS]
                ids, dist = search_graph(index, lift(_stack(part["vec"]), index.radius), BEAM)
                ids, dist = ids[:, :REPLICAS], dist[:, :REPLICAS]
                rows, columns = np.nonzero((ids >= 0) & (dist <= BUILD_RATIO**2 * dist[:, :1]))
                yield part.iloc[rows].assign(list=ids[rows, columns])

    return run


def _lift_queries(vectors: np.ndarray) -> np.ndarray:
    return np.hstack([vectors, np.zeros((len(vectors), 1))])


def _exact(vectors: np.ndarray, own: np.ndarray, top: int):
    """For each sample query (a place in ``vectors``, hashes in ``own``) the best of a task's rows."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        places = np.arange(len(vectors))[:, None]
        score = np.full((len(vectors), top), -np.inf)
        keys = np.zeros((len(vectors), top, 2), np.int64)
        for batch in batches:
            for at in range(0, len(batch), CHUNK_ROWS):
                part = batch.iloc[at:at + CHUNK_ROWS]
                hashes = part[["h0", "h1"]].to_numpy(np.int64)
                new = vectors @ _stack(part["vec"]).T
                new[(own[:, None] == hashes).all(axis=2)] = -np.inf  # itself
                few = min(top, new.shape[1])
                best = np.argpartition(-new, few - 1, axis=1)[:, :few]
                both = np.hstack([score, new[places, best]])
                hashes = np.hstack([keys, hashes[best]])
                best = np.argsort(-both, axis=1, kind="stable")[:, :top]
                score, keys = both[places, best], hashes[places, best]
        rows, columns = np.nonzero(score > -np.inf)
        yield pd.DataFrame({"place": rows.astype(np.int32), "h0": keys[rows, columns, 0],
                            "h1": keys[rows, columns, 1], "score": score[rows, columns]})

    return run


def calibrate(index: Index, distinct: DataFrame, posted: DataFrame, asked: DataFrame, top: int) -> float:
    """How many times as far as its nearest list a query must look for RECALL of its true neighbours.

    The sample are the CALIBRATION distinct queries of the smallest hash; their neighbours
    come from one pass that compares them with every vector.
    """
    rows = asked.orderBy("h1", "h0").select("h0", "h1", "vec").limit(CALIBRATION).collect()
    if not rows:
        return 1.0
    vectors = np.array([r["vec"] for r in rows], np.float64)
    own = np.array([(r["h0"], r["h1"]) for r in rows], np.int64)
    best = Window.partitionBy("place").orderBy(F.desc("score"), "h0", "h1")
    true = distinct.select("h0", "h1", "vec").mapInPandas(
        _exact(vectors, own, top), "place int, h0 long, h1 long, score double")
    true = true.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= top)
    true = store(true.select("place", "h0", "h1"), "true-neighbours")
    # At most CALIBRATION * top * REPLICAS rows.
    held: dict[int, dict[tuple[int, int], list[int]]] = {}
    for r in posted.select("h0", "h1", "list").join(F.broadcast(true), ["h0", "h1"]).collect():
        held.setdefault(r["place"], {}).setdefault((r["h0"], r["h1"]), []).append(r["list"])
    needed = []
    for place, lists in held.items():
        d = np.sqrt(((index.centroids - _lift_queries(vectors[place:place + 1])) ** 2).sum(axis=1))
        needed += [float(d[of].min() / max(d.min(), TINY)) for of in lists.values()]
    return sorted(needed)[int(np.ceil(RECALL * len(needed))) - 1] if needed else 1.0


def lists_within(index: Index, vectors: np.ndarray, ratio: float, enough: int
                 ) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows of ``vectors``, lists): all that the graph finds up to ``ratio`` times as far as the
    nearest one, and lists beyond until ``enough`` vectors are held.

    A walk whose last list still passes is repeated with twice as many.
    """
    rows, keep, count = np.arange(len(vectors)), min(WALK, len(index.centroids)), len(index.centroids)
    while len(rows):
        again = []
        step = max(1, CELLS // (keep * vectors.shape[1]))
        for at in range(0, len(rows), step):
            part = rows[at:at + step]
            ids, dist = search_graph(index, vectors[part], keep)
            held = np.where(ids >= 0, index.sizes[ids], 0)
            before = np.cumsum(held, axis=1) - held
            use = (dist <= ratio**2 * np.maximum(dist[:, :1], TINY**2)) | (before < enough)
            use &= ids >= 0
            ended = ~use[:, -1] if keep < count else np.ones(len(part), bool)
            again.append(part[~ended])
            places, columns = np.nonzero(use & ended[:, None])
            yield part[places], ids[places, columns]
        rows, keep = np.concatenate(again), min(2 * keep, count)


def _deal(index: Index) -> tuple[np.ndarray, np.ndarray]:
    """Parts that each list is cut into, and the number of its first part among all parts.

    A part has about CHUNK_ROWS vectors; parts are dealt over the tasks in turn.
    """
    parts = np.maximum(1, -(-index.sizes // CHUNK_ROWS))
    return parts, np.cumsum(parts) - parts


def _probe(index: Index, top: int, ratio: float, tasks: int):
    """Each query once per task, with the lists there that it looks into."""
    enough = REPLICAS * (top + 1)
    parts, first = _deal(index)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), CHUNK_ROWS):
                part = batch.iloc[at:at + CHUNK_ROWS]
                lifted = _lift_queries(_stack(part["vec"]))
                for rows, lists in lists_within(index, lifted, ratio, enough):
                    if not len(rows):
                        continue
                    n = np.minimum(parts[lists], tasks)  # the tasks that hold a part of a list
                    turn = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                    row, held = np.repeat(rows, n), np.repeat(lists, n)
                    task = (first[held] + turn) % tasks
                    order = np.lexsort((held, task, row))
                    row, held, task = row[order], held[order], task[order]
                    starts = np.flatnonzero(np.r_[True, (row[1:] != row[:-1]) | (task[1:] != task[:-1])])
                    yield part.iloc[row[starts]].assign(
                        task=task[starts], lists=pd.Series(np.split(held, starts[1:])).to_numpy())

    return run


class _Best:
    """The best vectors of each query among those of one task, which pass by list by list.

    A task holds its queries, ``top`` vectors for each of them and a few more, but never
    all of its vectors.
    """

    def __init__(self, top: int):
        self.top, self.asked, self.found, self.waiting, self.pending = top, [], None, [], 0

    def ask(self, queries: pd.DataFrame) -> None:
        self.asked.append(queries)

    def _start(self) -> None:
        queries = pd.concat(self.asked) if self.asked else None
        n = 0 if queries is None else len(queries)
        if n:
            self.keys, self.vectors = queries[["h0", "h1"]].to_numpy(np.int64), _stack(queries["vec"])
            sizes = queries["lists"].map(len).to_numpy()
            lists, rows = np.concatenate(queries["lists"].to_numpy()), np.repeat(np.arange(n), sizes)
            order = np.argsort(lists, kind="stable")
            self.lists, self.rows = lists[order], rows[order]
        else:
            self.lists = self.rows = np.empty(0, np.int64)
        self.least = np.full(n, -np.inf)
        none = np.empty(0, np.int64)
        # Query, score, smallest id, both hashes and all ids of a candidate.
        self.found = [none, np.empty(0), none, none, none, np.empty(0, object)]

    def look(self, number: int, posted: pd.DataFrame) -> None:
        """Compare vectors of one list with the queries that look into it."""
        if self.found is None:
            self._start()
        rows = self.rows[np.searchsorted(self.lists, number):np.searchsorted(self.lists, number, "right")]
        if not len(rows):
            return
        low = np.array([ids[0] for ids in posted["ids"]], np.int64)
        h0, h1 = posted["h0"].to_numpy(np.int64), posted["h1"].to_numpy(np.int64)
        # In the order of ties.
        order = np.lexsort((h1, h0, low))
        low, h0, h1, ids = low[order], h0[order], h1[order], posted["ids"].to_numpy()[order]
        vectors = _stack(posted["vec"])[order].T
        step = max(1, CELLS // len(order))
        for at in range(0, len(rows), step):
            some = rows[at:at + step]
            scores = self.vectors[some] @ vectors
            edge = self.least[some]
            if len(order) > self.top:
                edge = np.maximum(edge, np.partition(scores, -self.top, axis=1)[:, -self.top])
            use = scores >= edge[:, None]
            many = np.flatnonzero(use.sum(axis=1) > self.top)
            if len(many):  # of equal ones at the edge the first
                above = scores[many] > edge[many, None]
                equal = use[many] & ~above
                room = self.top - above.sum(axis=1)
                use[many] = above | (equal & (np.cumsum(equal, axis=1) <= room[:, None]))
            q, p = np.nonzero(use)
            self.waiting.append([some[q], scores[q, p], low[p], h0[p], h1[p], ids[p]])
            self.pending += len(q)
            if self.pending > max(CELLS // 16, len(self.found[0])):
                self._settle()

    def _settle(self) -> None:
        """Keep the ``top`` best of what was found so far."""
        q, score, low, h0, h1, ids = (np.concatenate(c) for c in zip(self.found, *self.waiting))
        self.waiting, self.pending = [], 0
        # A vector in several lists is found several times, with scores that may differ in the last bit.
        order = np.lexsort((-score, h1, h0, q))
        again = np.zeros(len(order), bool)
        again[1:] = np.all([c[order][1:] == c[order][:-1] for c in (q, h0, h1)], axis=0)
        order = order[~again]
        order = order[np.lexsort((h1[order], h0[order], low[order], -score[order], q[order]))]
        rank = np.arange(len(order)) - np.searchsorted(q[order], q[order])
        last = order[rank == self.top - 1]
        self.least[q[last]] = score[last]
        order = order[rank < self.top]
        self.found = [c[order] for c in (q, score, low, h0, h1, ids)]

    def result(self) -> Iterator[pd.DataFrame]:
        if self.found is None:
            return
        if self.waiting:
            self._settle()
        q, score, _, h0, h1, ids = self.found
        for at in range(0, len(q), CELLS // 16):
            part = slice(at, at + CELLS // 16)
            yield pd.DataFrame({"q0": self.keys[q[part], 0], "q1": self.keys[q[part], 1], "h0": h0[part],
                                "h1": h1[part], "score": score[part], "ids": ids[part]})


def _score(top: int):
    """The best vectors for each query of a block and task, whose rows come in one piece: its
    queries first, then its vectors by list."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, best = None, None
        for batch in batches:
            for key, part in batch.groupby(["block", "task", "list"], sort=True):
                if key[:2] != current:
                    if best is not None:
                        yield from best.result()
                    current, best = key[:2], _Best(top)
                if key[2] < 0:
                    best.ask(part)
                else:
                    best.look(key[2], part)
        if best is not None:
            yield from best.result()

    return run


def compare(index: Index, posted: DataFrame, asked: DataFrame, n_asked: int, ratio: float, top: int) -> DataFrame:
    """The ``top`` best vectors per query and task (q0, q1, h0, h1, score, ids) among the lists it looks into.

    There are as many tasks as shuffle partitions, whatever the number of lists, so the rows
    made grow with the queries alone. Queries beyond QUERY_ROWS come in blocks, each of
    which meets a copy of the lists.
    """
    spark = posted.sparkSession
    tasks, blocks = int(spark.conf.get("spark.sql.shuffle.partitions")), max(1, -(-n_asked // QUERY_ROWS))
    keys = ["h0", "h1"]
    vec, ids = (posted.schema[c].dataType.simpleString() for c in ("vec", "ids"))
    # Few rows, each with much work: dealt over all tasks.
    probes = asked.select(*keys, "vec").repartition(tasks, *keys).mapInPandas(
        _probe(index, top, ratio, tasks), f"h0 long, h1 long, vec {vec}, task int, lists array<int>")
    probes = probes.select(F.pmod("h1", F.lit(blocks)).cast("int").alias("block"), "task", F.lit(-1).alias("list"),
                           *keys, "vec", F.lit(None).cast(ids).alias("ids"), "lists")
    parts, first = (F.element_at(F.lit(a.tolist()), F.col("list") + 1) for a in _deal(index))
    held = posted.withColumn("task", F.pmod(first + F.pmod(F.col("h0"), parts), F.lit(tasks)).cast("int"))
    held = held.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    both = probes.unionByName(held.withColumn("lists", F.lit(None).cast("array<int>")))
    place = F.pmod(F.col("task") + F.col("block"), F.lit(tasks))
    together = both.repartitionById(tasks, place).sortWithinPartitions("block", "task", "list")
    return together.mapInPandas(_score(top), f"q0 long, q1 long, h0 long, h1 long, score double, ids {ids}")


def nearest(table: DataFrame, is_query: Column, top: int = TOP, id_col: str = "vec_id",
            vec_col: str = "embedding") -> DataFrame:
    """The ``top`` rows of largest inner product for each query row, itself left out.

    Equal vectors are indexed once, with their top + 1 smallest ids: no more can be among
    the nearest. Every distinct vector goes to its nearest list and to lists about as near;
    a query looks into all lists that pass a distance ratio, which is as wide as a sample of
    the queries needs for RECALL of its true neighbours. Scores are inner
    products of the original vectors in double precision; ties go to the smaller id. Returns
    query_id, rank (from 1), vec_id and score.

    Rows with a null id, and null, empty or zero vectors or ones with null or non-finite
    components, take no part, nor do vectors of another length than most (the longer of two
    equally common ones counts). Rows with one id and one vector count once; a query never
    finds its own id. An empty table gives no rows.
    """
    element = table.schema[vec_col].dataType.elementType.simpleString()
    kept = element if element in ("float", "double") else "double"
    vec = F.col(vec_col).cast(f"array<{kept}>")
    rows = table.select(F.col(id_col).cast("long").alias("id"), vec.alias("vec"),
                        F.coalesce(is_query, F.lit(False)).alias("asks"))
    rows = rows.filter(F.col("id").isNotNull() & _valid(F.col("vec")))
    rows = store(rows.select("*", F.xxhash64("vec").alias("h0"), F.xxhash64(F.lit(1), "vec").alias("h1")),
                 "vectors")
    size = F.size("vec").alias("dims")
    common = rows.groupBy(size).count().orderBy(F.desc("count"), F.desc("dims")).first()
    dims, total = (common["dims"], common["count"]) if common else (1, 0)
    rows = rows.filter(F.size("vec") == dims)

    keys = ["h0", "h1"]
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy("id"))
    few = rows.select(*keys, "id", "vec").distinct().withColumn("rank", rank).filter(F.col("rank") <= top + 1)
    distinct = few.groupBy(*keys).agg(
        F.sort_array(F.collect_list("id")).alias("ids"), F.first("vec").alias("vec"))
    distinct = store(distinct, "distinct-vectors")
    norm = F.sqrt(F.aggregate("vec", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))
    count, radius = distinct.agg(F.count("*"), F.max(norm)).first()
    index = fit(distinct, count, dims, radius or 1.0)

    kind = f"h0 long, h1 long, ids array<long>, vec array<{kept}>, list int"
    posted = store(distinct.mapInPandas(_post(index), kind), "posting-lists")
    sizes = posted.groupBy("list").count().collect()  # one row per centroid, which the driver has
    for r in sizes:
        index.sizes[r["list"]] = r["count"]
    asked = rows.filter("asks").groupBy(*keys).agg(F.first("vec").alias("vec"), F.count("*").alias("n"))
    asked = store(asked, "distinct-queries")
    ratio = max(PROBE_RATIO, calibrate(index, distinct, posted, asked, top))
    found = compare(index, posted, asked, asked.count(), ratio, top + 1)

    best = Window.partitionBy("q0", "q1").orderBy(F.desc("score"), F.col("ids")[0], "h0", "h1")
    # A vector in several lists is found by several tasks, with scores that may differ in the last bit.
    once = found.groupBy("q0", "q1", "h0", "h1").agg(F.max("score").alias("score"), F.first("ids").alias("ids"))
    once = once.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= top + 1)
    flat = once.select("q0", "q1", "score", F.explode("ids").alias("vec_id"))
    best = Window.partitionBy("q0", "q1").orderBy(F.desc("score"), "vec_id")
    # One more than needed for the query itself, which may stand among them.
    flat = flat.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= top + 1)
    lists = flat.groupBy("q0", "q1").agg(F.sort_array(F.collect_list(
        F.struct((-F.col("score")).alias("less"), "vec_id"))).alias("found"))
    lists = lists.join(asked.select(F.col("h0").alias("q0"), F.col("h1").alias("q1"), "n"), ["q0", "q1"])
    queries = rows.filter("asks").select("id", F.col("h0").alias("q0"), F.col("h1").alias("q1")).distinct()
    answers = attach_groups(queries, store(lists, "answers"), ["q0", "q1"], "n", total)
    others = F.filter("found", lambda r: r["vec_id"] != F.col("id"))
    answers = answers.select("id", F.posexplode(F.slice(others, 1, top)).alias("place", "r"))
    return answers.select(F.col("id").alias("query_id"), (F.col("place") + 1).alias("rank"),
                          F.col("r.vec_id").alias("vec_id"), (-F.col("r.less")).alias("score"))


@query("op7_nearest_neighbours")
def op7_nearest_neighbours(spark: SparkSession, sf: str) -> DataFrame:
    """The 20 nearest rows of every row whose vec_id is divisible by 20."""
    table = read(spark, sf, "embeddings")
    return nearest(table, F.col("vec_id") % QUERY_STEP == 0)
