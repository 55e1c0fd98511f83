"""Exact top-k by inner product: an impact-ordered index, read score-at-a-time.

Method. Vectors are dealt to blocks of bounded size. In a block every dimension has postings:
the members ordered by their component, cut into ``LEVELS`` segments of one quantised impact.
A query orders all segments of a block by what a member gains from them at most (query
component times the segment's best value, above the dimension's worst segment) and reads them
from the highest gain down. After a round with the threshold g, a member that met c segments
with gains G scores at most

    worst sum + G + sum over dimensions of min(g, best gain of the dimension) - c * g,

since what it has not met gains less than g. The k members with the highest bounds are scored exactly, which
gives a floor for the k-th place. Reading stops only on this proof: at most ``RESCORE``
members have a bound at or above the floor (or all segments are read); those are scored
exactly and nobody else can be among the k. Blocks whose best possible score is below the
floor are skipped.

Scale. The index is a Parquet table of one row per block and dimension (and one with the
block's ids and components), built in one shuffle of the vectors. Queries are dealt to groups
of ``QUERY_GROUP``; a task reads one block for one query group, so neither side is broadcast
and no task holds more than one block and one group. A block leaves k rows per query; the
final ranking is a window whose rows are cut to k before the shuffle. The work is queries
times vectors, in blocks, less what the proof saves.

Defined results. Vectors that are null or hold null or non-finite components and rows without
id take no part, neither as query nor as candidate. Missing components count as 0 (vectors of
different lengths, empty vectors). A row that repeats id and vector counts once; an id with
several vectors asks with each and is a candidate with each, its list is the best k of all.
A query's own id is never its candidate. Ties go to the smaller id, so copies of one vector
come in the order of their ids. Components beyond 2^62 are taken as +-2^62 and scores beyond 64 bits as the 64-bit limits;
sums that could pass 2^46 are computed in Python integers. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from slotwise.llm.common import cut, prepare, query, table
from slotwise.llm.groups import in_runs, runs

SCALE = 1024
K = 10
LEVELS = 32
BLOCK = 12_000            # vectors of a block on average
PART = 16_384             # and of one index part at most (a block by chance larger has two)
LEAST_BLOCK = 1_000       # small tables: blocks so small that every core has some
QUERY_GROUP = 2_048
RESCORE = 2_048
ROUNDS = 4
EXACT = 1 << 46           # sums below it are exact in doubles and leave room for the counts
LIMIT = 1 << 62
COUNT = 1 << 48           # a member's count of segments, packed above its gains


def whole_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = SCALE) -> DataFrame:
    """id, v: distinct rows with floor(scale * x) of every component, unusable ones left out."""
    col = F.col(f"`{vector_col}`").cast("array<double>")
    bad = F.exists(col, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    part = lambda x: F.greatest(F.least(F.floor(x * scale), F.lit(LIMIT)), F.lit(-LIMIT))
    return vectors.where(col.isNotNull() & ~bad & F.col(f"`{id_col}`").isNotNull()) \
        .select(F.col(f"`{id_col}`").cast("long").alias("id"), F.transform(col, part).alias("v")).distinct()


def matrix_of(column: pa.ChunkedArray | pa.Array, width: int | None = None) -> np.ndarray:
    """Lists as the rows of one matrix; missing components are 0."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    lengths = np.asarray(column.value_lengths(), dtype=np.int64)
    flat = np.asarray(column.flatten(), dtype=np.int64)
    out = np.zeros((len(column), int(lengths.max(initial=0))), dtype=np.int64)
    out[np.arange(out.shape[1]) < lengths[:, None]] = flat
    if width is None or width == out.shape[1]:
        return out
    same = np.zeros((len(out), width), dtype=np.int64)
    same[:, :min(width, out.shape[1])] = out[:, :width]
    return same


# ------------------------------------------------------------------ the index
_INDEX = "block int, part int, dim int, low long, step long, ends binary, slots binary, ids binary, size int"


def index_rows(block: int, part: int, ids: np.ndarray, values: np.ndarray) -> Iterator[tuple]:
    """One row per dimension, the postings from the highest segment down, and one row
    (dim -1) with ids and components."""
    yield block, part, -1, 0, 0, b"", values.tobytes(), ids.tobytes(), len(ids)
    for d in range(values.shape[1]):
        column = values[:, d]
        low, high = int(column.min()), int(column.max())
        step = -(-(high - low + 1) // LEVELS)
        level = np.array([(int(x) - low) // step for x in column]) if high - low >= LIMIT else (column - low) // step
        order = np.argsort(-level, kind="stable").astype(np.uint16)
        ends = np.cumsum(np.bincount(LEVELS - 1 - level, minlength=LEVELS)).astype(np.int32)
        yield block, part, d, low, step, ends.tobytes(), order.tobytes(), b"", len(ids)


def build_index(vectors: DataFrame, blocks: int) -> DataFrame:
    """The index table of (id, v) rows, written once in the shared folder."""
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in runs(batches, ["block"]):
            ids, values = np.asarray(run.column("id")), matrix_of(run.column("v"))
            for part, lo in enumerate(range(0, len(ids), PART)):
                rows = list(index_rows(run.column("block")[0].as_py(), part, ids[lo:lo + PART], values[lo:lo + PART]))
                for i in range(0, len(rows), 16):
                    names = [f.split()[0] for f in _INDEX.split(", ")]
                    types = [pa.int32()] * 3 + [pa.int64()] * 2 + [pa.binary()] * 3 + [pa.int32()]
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows[i:i + 16]), types)], names)
    dealt = vectors.withColumn("block", F.pmod(F.xxhash64("id", "v"), F.lit(blocks)).cast("int"))
    return cut(in_runs(dealt, "block").mapInArrow(build, _INDEX), "impact-index")


class Part:
    """One index part in memory."""

    def __init__(self, rows: list[dict]) -> None:
        rows = sorted(rows, key=lambda r: r["dim"])
        own, dims = rows[0], rows[1:]
        self.ids = np.frombuffer(own["ids"], dtype=np.int64)
        self.values = np.frombuffer(own["slots"], dtype=np.int64).reshape(len(self.ids), len(dims))
        self.slots = [np.frombuffer(r["slots"], dtype=np.uint16) for r in dims]
        self.ends = np.array([np.frombuffer(r["ends"], dtype=np.int32) for r in dims]).reshape(len(dims), LEVELS)
        self.low = [r["low"] for r in dims]
        self.step = [r["step"] for r in dims]
        self.reach = [int(max(abs(int(c.min())), abs(int(c.max())))) for c in self.values.T]
        self.small = self.values.astype(np.float64) if max(self.reach, default=0) < EXACT else None

    def score(self, members: np.ndarray, q: np.ndarray) -> np.ndarray:
        """Exact scores of the members: in doubles, where all sums are whole numbers below 2^53."""
        return (self.small[members] @ q).astype(np.int64)

    def score_wide(self, q: np.ndarray) -> list[int]:
        top = (1 << 63) - 1
        return [max(-top - 1, min(top, sum(int(a) * int(b) for a, b in zip(v, q)))) for v in self.values]

    def search(self, q: np.ndarray, own: int, k: int, floor: int | None) -> tuple[list[int], list[int], int]:
        """The members that may be among the k best (at or above ``floor``) with their exact
        scores, and how many postings were read."""
        dims = len(self.slots)
        if self.small is None or sum(abs(int(a)) * r for a, r in zip(q, self.reach)) >= EXACT:
            scores = self.score_wide(q)
            kept = sorted((-s, int(i)) for s, i in zip(scores, self.ids) if i != own)[:k]
            return [i for _, i in kept], [-s for s, _ in kept], self.values.size
        size = len(self.ids)
        # Best value of each segment: levels from the highest down, as the postings lie.
        steps = np.arange(LEVELS - 1, -1, -1)
        low, step = np.array(self.low, dtype=np.int64)[:, None], np.array(self.step, dtype=np.int64)[:, None]
        bottom = low + step * steps
        best = np.maximum(q[:, None] * bottom, q[:, None] * (bottom + step - 1))
        begins = np.concatenate([np.zeros((dims, 1), dtype=np.int64), self.ends[:, :-1]], axis=1)
        filled = self.ends > begins
        worst = np.where(filled, best, np.iinfo(np.int64).max).min(axis=1) if dims else np.zeros(0, dtype=np.int64)
        gain = np.where(filled, best - worst[:, None], 0)
        most = gain.max(axis=1) if dims else gain.sum(axis=1)
        base, total = int(worst.sum()), 0
        others = np.flatnonzero(self.ids != own)
        if floor is not None and base + int(most.sum()) < floor or not len(others):
            return [], [], 0
        # Segments by descending gain; a round ends where about 1 / ROUNDS of the postings are read.
        d, s = np.nonzero(gain)
        order = np.argsort(-gain[d, s], kind="stable")
        d, s = d[order], s[order]
        read = np.cumsum(self.ends[d, s] - begins[d, s])
        packed = np.zeros(size, dtype=np.int64)
        done = 0
        members, bound = others, None
        for r in range(1, ROUNDS + 1):
            if not len(d):
                break
            stop = int(np.searchsorted(read, read[-1] * r / ROUNDS)) + 1 if r < ROUNDS else len(d)
            # The round's threshold: gains above it are read whole, so ties go into one round.
            least = int(gain[d[stop - 1], s[stop - 1]])
            stop = int(np.searchsorted(-gain[d, s], -least, side="right"))
            for i in np.unique(d[done:stop]):
                mine = s[done:stop][d[done:stop] == i]
                for a, b in _stretches(mine):                 # neighbouring segments lie side by side
                    lo, hi = begins[i, a], self.ends[i, b]
                    add = np.repeat(gain[i, a:b + 1] + COUNT, self.ends[i, a:b + 1] - begins[i, a:b + 1])
                    packed[self.slots[i][lo:hi]] += add
            done, total = stop, int(read[stop - 1])
            counts, gains = packed >> 48, packed & (COUNT - 1)
            bound = base + gains + int(np.minimum(most, least).sum()) - counts * least
            bound = bound[others]
            if len(others) > k:
                tops = others[np.argpartition(-bound, k - 1)[:k]]
                kth = int(self.score(tops, q).min())
                floor = kth if floor is None else max(floor, kth)
            members = others if floor is None else others[bound >= floor]
            if len(members) <= RESCORE or done == len(d):
                break
        scores = self.score(members, q)
        if len(members) > k:
            place = np.lexsort((self.ids[members], -scores))[:k]
            members, scores = members[place], scores[place]
        return self.ids[members].tolist(), scores.tolist(), total


def _stretches(levels: np.ndarray) -> list[tuple[int, int]]:
    levels = np.sort(levels)
    gaps = np.flatnonzero(np.diff(levels) > 1)
    return list(zip(levels[np.concatenate([[0], gaps + 1])], levels[np.concatenate([gaps, [len(levels) - 1]])]))


# ------------------------------------------------------------------ the search
_FOUND = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])


def top_k(vectors: DataFrame, queries: DataFrame, k: int = K) -> DataFrame:
    """query_id, rank, vec_id, score: the k highest inner products of every (id, v) query
    over all (id, v) vectors, both as ``whole_vectors`` gives them."""
    spark = prepare(vectors.sparkSession)
    vectors, queries = cut(vectors, "impact-vectors"), cut(queries, "impact-queries")
    n, asked = vectors.count(), queries.count()
    cores = spark.sparkContext.defaultParallelism
    blocks = max(1, -(-n // BLOCK), min(cores, n // LEAST_BLOCK))
    groups = max(1, -(-asked // QUERY_GROUP))
    index = build_index(vectors, blocks).withColumn("g", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    asking = queries.withColumn("g", F.pmod(F.xxhash64("id", "v"), F.lit(groups)).cast("int")) \
        .withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))

    def search(postings: pa.Table, wanted: pa.Table) -> pa.Table:
        found: dict[str, list] = {name: [] for name in _FOUND.names}
        if postings.num_rows and wanted.num_rows:
            parts: dict[int, list[dict]] = {}
            for row in postings.to_pylist():
                parts.setdefault(row["part"], []).append(row)
            ids, floors = wanted.column("id").to_pylist(), [None] * wanted.num_rows
            for rows in parts.values():
                part = Part(rows)
                asked_for = matrix_of(wanted.column("v"), len(part.slots))
                for i, own in enumerate(ids):
                    names, scores, _ = part.search(asked_for[i], own, k, floors[i])
                    if len(names) >= k:
                        floors[i] = scores[-1] if floors[i] is None else max(floors[i], scores[-1])
                    found["query_id"] += [own] * len(names)
                    found["vec_id"] += names
                    found["score"] += scores
        return pa.table(found, schema=_FOUND)

    near = asking.groupBy("block", "g").cogroup(index.groupBy("block", "g"))
    hits = near.applyInArrow(lambda wanted, postings: search(postings, wanted), "query_id long, vec_id long, score long")
    by_score = Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("vec_id"))
    return hits.withColumn("rank", F.row_number().over(by_score)).where(F.col("rank") <= k) \
        .select("query_id", "rank", "vec_id", "score")


ORACLE = f"""
WITH v AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: floor({SCALE} * CAST(x AS DOUBLE))) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
),
pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON c.vec_id <> q.vec_id WHERE q.vec_id % 100 = 0
),
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM pairs
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= {K}
"""


@query("op11_impact_topk", ORACLE)
def op11_impact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = whole_vectors(table(spark, sf_dir, "embeddings"))
    return top_k(vectors, vectors.where("id % 100 = 0"))
