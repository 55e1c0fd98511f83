"""Approximate nearest neighbours by inner product: low-dimensional stable projections in a
kd-tree, incremental verification, chi-square stopping test.

Largest inner product is turned into smallest distance: with R the largest norm, a vector x
becomes (x, sqrt(R^2 - |x|^2)) and a query q becomes (q R / |q|, 0). Gaussian (2-stable)
projections to ``DIMENSIONS`` numbers scale a distance d to d times the root of a chi-square
variable with that many degrees of freedom. Points are verified (true inner product, double
precision) in the order of their leaves' distances to the projected query; once every point
left lies at projected distance t or more and chi-square(t^2 / d_k^2) >= ``CERTAINTY``, d_k being
the k-th best distance so far, a missing neighbour is as unlikely as that, and the search stops.

The upper levels of the tree are fitted on a hash sample of at most about ``SAMPLE`` rows; every row
is indexed. A cell's rows are dealt to groups of about ``GROUP_ROWS``, each with a kd-tree of its
own, so copies of one vector spread over as many groups as they need. A query first searches
a group of its own cell, which gives d_k, then all groups whose bounding boxes the test does not rule out.

Defined results: null, zero and non-finite vectors, and vectors not of the commonest
length, take no part; equal scores go to the smaller id; with fewer candidates all are
returned; a query never finds rows of its own id; ids that repeat ask once; null ids
are found but don't ask; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from slotwise.llm.common import cut, prepare, query, table

DIMENSIONS = 8          # even: the chi-square distribution has a closed form
CERTAINTY = 0.98
SAMPLE, GROUP_ROWS, MOST_CELLS = 60_000, 16_384, 4_096
LEAF, STEP = 64, 8      # rows of a leaf; leaves verified between two tests


def chi_square(x: float, dof: int = DIMENSIONS) -> float:
    """P(chi-square <= x) for an even number of degrees of freedom."""
    term = total = 1.0
    for i in range(1, dof // 2):
        term *= x / 2 / i
        total += term
    return 1.0 - math.exp(-x / 2) * total


def quantile(p: float) -> float:
    low, high = 0.0, 1000.0
    while high - low > 1e-9:
        mid = (low + high) / 2
        low, high = (mid, high) if chi_square(mid) < p else (low, mid)
    return high


class Space:
    """The projection of candidates and queries."""

    def __init__(self, dim: int, radius: float, seed: int = 11) -> None:
        self.radius = radius
        self.lines = np.random.RandomState(seed).normal(size=(dim + 1, DIMENSIONS))

    def of_points(self, x: np.ndarray) -> np.ndarray:
        x = x.astype(np.float64)
        lift = np.sqrt(np.maximum(self.radius ** 2 - (x * x).sum(1), 0.0))
        return x @ self.lines[:-1] + lift[:, None] * self.lines[-1]

    def of_queries(self, q: np.ndarray) -> np.ndarray:
        q = q.astype(np.float64)
        return (q * (self.radius / np.sqrt((q * q).sum(1)))[:, None]) @ self.lines[:-1]

    def distance2(self, score: float, norm: float) -> float:
        """Squared distance of a pair, from its inner product and the query's norm."""
        return max(0.0, 2 * self.radius * (self.radius - score / norm))


def box_distance2(low: np.ndarray, high: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Squared distance from a point to each box."""
    gap = np.maximum(np.maximum(low - at, at - high), 0.0)
    return (gap * gap).sum(-1)


def split_cells(sample: np.ndarray, levels: int) -> list[tuple[int, float]]:
    """Splits of a complete kd-tree (node k has children 2k+1 and 2k+2)."""
    splits: list[tuple[int, float]] = []
    nodes = [sample]
    for _ in range(levels):
        below = []
        for rows in nodes:
            axis = int(np.argmax(np.ptp(rows, axis=0))) if len(rows) else 0
            at = float(np.median(rows[:, axis])) if len(rows) else 0.0
            splits.append((axis, at))
            right = rows[:, axis] > at
            below += [rows[~right], rows[right]]
        nodes = below
    return splits


def cell_of(points: np.ndarray, splits: list[tuple[int, float]]) -> np.ndarray:
    node = np.zeros(len(points), dtype=np.int64)
    if splits:
        axis = np.array([a for a, _ in splits])
        at = np.array([t for _, t in splits])
        rows = np.arange(len(points))
        for _ in range((len(splits) + 1).bit_length() - 1):
            node = 2 * node + 1 + (points[rows, axis[node]] > at[node])
    return node - len(splits)


class Tree:
    """A kd-tree over projected points; leaves hold row numbers and bounding boxes."""

    def __init__(self, points: np.ndarray) -> None:
        leaves, todo = [], [np.arange(len(points))]
        while todo:
            rows = todo.pop()
            part = points[rows]
            width = np.ptp(part, axis=0)
            if len(rows) <= LEAF or not width.any():
                leaves += [rows[k:k + LEAF] for k in range(0, len(rows), LEAF)]
                continue
            axis = int(np.argmax(width))
            order = np.argpartition(part[:, axis], len(rows) // 2)
            todo += [rows[order[:len(rows) // 2]], rows[order[len(rows) // 2:]]]
        self.leaves = leaves
        self.low = np.array([points[r].min(0) for r in leaves])
        self.high = np.array([points[r].max(0) for r in leaves])


class Index:
    """The candidates of one group."""

    def __init__(self, space: Space, ids: np.ndarray, vectors: np.ndarray) -> None:
        self.space, self.ids, self.vectors = space, ids, vectors.astype(np.float64)
        self.tree = Tree(space.of_points(vectors))
        self.stop = quantile(CERTAINTY)

    def nearest(self, own: int, q: np.ndarray, at: np.ndarray, k: int, d2: float) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the k best rows; d2: squared k-th distance known so far."""
        norm = math.sqrt(float(q @ q))
        away = box_distance2(self.tree.low, self.tree.high, at)
        order = np.argsort(away, kind="stable")
        ids, scores = np.zeros(0, dtype=np.int64), np.zeros(0)
        for n in range(0, len(order), STEP):
            if away[order[n]] >= self.stop * d2 and d2 < math.inf:
                break
            rows = np.concatenate([self.tree.leaves[x] for x in order[n:n + STEP]])
            rows = rows[self.ids[rows] != own]
            near = self.vectors[rows] @ q
            if len(scores) >= k:
                rows = rows[near >= scores[-1] - 1e-9 * (1 + abs(scores[-1]))]
            exact = (self.vectors[rows] * q).sum(1)       # the same rounding for equal vectors, wherever they lie
            ids, scores = np.concatenate([ids, self.ids[rows]]), np.concatenate([scores, exact])
            best = np.lexsort((ids, -scores))[:k]
            ids, scores = ids[best], scores[best]
            if len(scores) >= k:
                d2 = min(d2, self.space.distance2(float(scores[-1]), norm))
        return ids, scores


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return np.asarray(column.flatten(), dtype=np.float64).reshape(-1, dim)


def _search(space: Space, dim: int, k: int):
    """Streams sorted by (cell, part, kind): candidates of a group, then its queries."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, index = None, None
        ids: list[np.ndarray] = []
        vectors: list[np.ndarray] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            marks = np.stack([np.asarray(batch.column(c)) for c in ("cell", "part", "kind")], 1)
            starts = np.flatnonzero(np.r_[True, (marks[1:] != marks[:-1]).any(1)])
            for a, z in zip(starts, np.r_[starts[1:], len(marks)]):
                cell, part, kind = marks[a].tolist()
                some = batch.slice(a, z - a)
                if (cell, part) != group:
                    group, index, ids, vectors = (cell, part), None, [], []
                x = _matrix(some.column("v"), dim)
                if kind == 0:
                    ids.append(np.asarray(some.column("id").fill_null(-(1 << 63))))
                    vectors.append(x)
                    continue
                if not ids:
                    continue
                if index is None:
                    index = Index(space, np.concatenate(ids), np.concatenate(vectors))
                    ids, vectors = [np.zeros(0)], []
                at = space.of_queries(x)
                found = [index.nearest(i, q, p, k, d) for i, q, p, d in zip(
                    some.column("id").to_pylist(), x, at, some.column("d2").to_pylist())]
                own = np.repeat(np.asarray(some.column("id")), [len(f[0]) for f in found])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(own, pa.int64()), pa.array(np.concatenate([f[0] for f in found]), pa.int64()),
                     pa.array(np.concatenate([f[1] for f in found]), pa.float64())], ["query_id", "vec_id", "score"])
    return run


def _in_groups(rows: DataFrame) -> DataFrame:
    return rows.repartition("cell", "part").sortWithinPartitions("cell", "part", "kind")


def nearest_neighbours(vectors: DataFrame, is_query: Column, k: int = 20, id_col: str = "vec_id",
                       vector_col: str = "embedding") -> DataFrame:
    """query_id, rank (from 1), vec_id, score: of each query row its k nearest rows found."""
    spark = prepare(vectors.sparkSession)
    inf = float("inf")
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v"),
                          F.coalesce(is_query, F.lit(False)).alias("asks")) \
        .where(F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < inf)) & F.exists("v", lambda x: x != 0))
    size = rows.groupBy(F.size("v").alias("dim")).agg(
        F.count(F.lit(1)).alias("n"),
        F.max(F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x))).alias("radius")) \
        .orderBy(F.desc("n"), F.desc("dim")).first()
    result = "query_id long, rank int, vec_id long, score double"
    if size is None:
        return spark.createDataFrame([], result)
    dim, n = size["dim"], size["n"]
    space = Space(dim, size["radius"])
    rows = rows.where(F.size("v") == dim)

    levels = max(0, min(math.ceil(math.log2(max(1, n / GROUP_ROWS))), int(math.log2(MOST_CELLS))))
    share = min(1.0, SAMPLE / n)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p = space.of_points(_matrix(batch.column("v"), dim))
            yield pa.RecordBatch.from_arrays([pa.array(list(p), pa.list_(pa.float64()))], ["p"])

    sample = rows.where(F.pmod(F.xxhash64("v"), F.lit(1_000_000)) < math.ceil(share * 1_000_000)).select("v") \
        .mapInArrow(project, "p array<double>").toPandas()["p"] if levels else []
    splits = split_cells(np.array(sorted(map(tuple, sample))), levels) if len(sample) else []

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p = space.of_points(_matrix(batch.column("v"), dim))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("id", "v", "asks")), pa.array(cell_of(p, splits)),
                                              pa.array(list(p), pa.list_(pa.float64()))], ["id", "v", "asks", "cell", "p"])

    indexed = cut(rows.mapInArrow(index, "id long, v array<double>, asks boolean, cell long, p array<double>"), "ann-index")
    parts = indexed.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / GROUP_ROWS).alias("parts"))
    dealt = indexed.join(F.broadcast(parts), "cell") \
        .withColumn("part", F.pmod(F.xxhash64("id", "v"), F.col("parts")))   # at most MOST_CELLS rows of parts
    points = dealt.select("cell", "part", F.lit(0).alias("kind"), "id", "v", F.lit(inf).alias("d2"))
    asking = dealt.where("asks AND id IS NOT NULL").dropDuplicates(["id"])
    # first the query's own group ...
    first = asking.select("cell", "part", F.lit(1).alias("kind"), "id", "v", F.lit(inf).alias("d2"))
    found = "query_id long, vec_id long, score double"
    near = cut(_in_groups(points.union(first)).mapInArrow(_search(space, dim, k), found), "ann-first")
    known = near.groupBy("query_id").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("kth"))

    # ... then every group whose box the stopping test leaves open
    boxes = dealt.groupBy("cell", "part").agg(*(f(F.col("p")[i]).alias(f"{f.__name__}{i}")
                                                for i in range(DIMENSIONS) for f in (F.min, F.max)))
    boxes = boxes.toPandas().sort_values(["cell", "part"])                     # one row per group
    low = boxes[[f"min{i}" for i in range(DIMENSIONS)]].to_numpy()
    high = boxes[[f"max{i}" for i in range(DIMENSIONS)]].to_numpy()
    cells, of_cell = boxes["cell"].to_numpy(), boxes["part"].to_numpy()
    stop = quantile(CERTAINTY)

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column("v"), dim)
            norm = np.sqrt((x * x).sum(1))
            kth = batch.column("kth").to_pylist()
            d2 = np.array([inf if s is None else space.distance2(s, m) for s, m in zip(kth, norm)])
            home = np.stack([np.asarray(batch.column("cell")), np.asarray(batch.column("part"))], 1)
            take, to = [], []
            for i, p in enumerate(space.of_queries(x)):
                open_ = (box_distance2(low, high, p) < stop * d2[i]) & ~((cells == home[i, 0]) & (of_cell == home[i, 1]))
                at = np.flatnonzero(open_)
                take.append(np.full(len(at), i))
                to.append(at)
            take, to = np.concatenate(take), np.concatenate(to)
            for a in range(0, max(1, len(take)), 2000):
                t, g = pa.array(take[a:a + 2000], pa.int64()), to[a:a + 2000]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cells[g], pa.int64()), pa.array(of_cell[g], pa.int64()), pa.array(np.ones(len(g), dtype=np.int32)),
                     batch.column("id").take(t), batch.column("v").take(t), pa.array(d2[take[a:a + 2000]])],
                    ["cell", "part", "kind", "id", "v", "d2"])

    bound = asking.join(known, asking["id"] == known["query_id"], "left") \
        .select("cell", "part", "id", "v", F.when(F.col("n") >= k, F.col("kth")).alias("kth"))
    routed = bound.mapInArrow(route, "cell long, part long, kind int, id long, v array<double>, d2 double")
    more = _in_groups(points.union(routed)).mapInArrow(_search(space, dim, k), found)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return near.union(more).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k) \
        .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


@query("op7_nearest_neighbours")
def op7_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest_neighbours(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)
