"""Mixing sources to target weights by Pfair scheduling.

Every source's documents are shuffled by a seeded hash and cut into blocks. A source of
weight w (whole number; W is the sum over the sources that still have blocks) has for its
block j, counted from 0, the release floor(j * W / w) and the deadline
ceil((j + 1) * W / w), in slots of one block. Earliest deadline first among the released
blocks meets every deadline, so after any number of slots each source is less than one block
away from its exact share. When a source has given its last block, a new phase begins with
the weights of the others; nothing is dropped or repeated.

A phase repeats itself every W slots, so the driver schedules at most one period per phase
(rows: sources x sum of weights); the place of every document follows from its rank in its
source by arithmetic. Ranks come from counts of hash ranges and a window inside each range,
so the largest source is spread over as many groups as it needs.

Defined results: null sources are a source of their own; sources without a target weight (or
with weight 0) follow after all weighted ones, in equal shares; rows that repeat an id are
documents of their own; null and empty texts are mixed like others; an empty table gives
an empty result.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from slotwise.llm.common import prepare, query, table

#: Documents of one block; rows of one ranking group.
BLOCK, RANK_ROWS = 32, 2_000
#: Schedule rows up to which every task gets the whole schedule.
SMALL_SCHEDULE = 500_000


@dataclass
class Phase:
    weights: dict[str, int]
    start: int                      # first slot
    first: dict[str, int]           # first block of each source
    end: dict[str, int]             # block after the last one
    missing: int                    # rows that partly filled blocks of earlier phases lack
    places: dict[str, list[int]]    # slots of one period's blocks


def period(weights: dict[str, int]) -> dict[str, list[int]]:
    """Slots of each source's blocks in one period, earliest deadline first."""
    total = sum(weights.values())
    released: list[list[tuple[int, str]]] = [[] for _ in range(total)]
    for source, w in weights.items():
        for j in range(w):
            released[j * total // w].append((-(-(j + 1) * total // w), source))
    waiting: list[tuple[int, str]] = []
    places: dict[str, list[int]] = {s: [] for s in weights}
    for slot in range(total):
        for job in released[slot]:
            heapq.heappush(waiting, job)
        places[heapq.heappop(waiting)[1]].append(slot)
    return places


def schedule(rows: dict[str, int], weights: dict[str, int], block: int) -> list[Phase]:
    """Phases until every block has its slot."""
    left = {s: -(-n // block) for s, n in rows.items() if n}
    given = dict.fromkeys(left, 0)
    phases: list[Phase] = []
    start = missing = 0
    while left:
        live = {s: weights.get(s, 0) for s in left if weights.get(s, 0) > 0} or dict.fromkeys(left, 1)
        total, places = sum(live.values()), period(live)
        cycles = min((left[s] - 1) // w for s, w in live.items())       # nobody ends in these
        taken = {s: cycles * w for s, w in live.items()}
        owner = {slot: s for s, slots in places.items() for slot in slots}
        slots = cycles * total
        for slot in range(total):
            taken[owner[slot]] += 1
            slots += 1
            if taken[owner[slot]] == left[owner[slot]]:
                break
        ended = owner[slot]
        phases.append(Phase(live, start, {s: given[s] for s in live}, {s: given[s] + taken[s] for s in live},
                            missing, places))
        for s, n in taken.items():
            left[s] -= n
            given[s] += n
        start += slots
        missing += -rows[ended] % block
        del left[ended]
    return phases


def _key(source: Column) -> Column:
    return F.when(source.isNull(), F.lit("n")).otherwise(F.concat(F.lit("s"), source.cast("string")))


def place(docs: DataFrame, weights: dict[str | None, int] | None = None, block: int = BLOCK, seed: int = 7,
          id_col: str = "doc_id", source_col: str = "source") -> DataFrame:
    """(row: the whole input row, source_key, block, release, deadline, slot, position).

    ``weights``: whole target weight per source; by default the square root of its rows, in
    thousandths of the sum. ``position`` is dense and starts at 0."""
    spark = prepare(docs.sparkSession)
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns))
    order = F.xxhash64(F.lit(seed), F.col(f"`{id_col}`"))
    keyed = docs.select(row.alias("row"), _key(F.col(f"`{source_col}`")).alias("key"), order.alias("h"),
                        F.col(f"`{id_col}`").alias("id"))

    # one row per source reaches the driver
    rows = {r["key"]: r["n"] for r in keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).collect()}
    if weights is None:
        total = sum(n ** 0.5 for n in rows.values())
        target = {s: max(1, round(1000 * n ** 0.5 / total)) for s, n in rows.items()}
    else:
        target = {"n" if s is None else "s" + str(s): w for s, w in weights.items()}
    phases = schedule(rows, target, block)

    # rank of each row in its source: rows of smaller hash ranges + place in its own range
    parts = spark.createDataFrame([(s, max(1, -(-n // RANK_ROWS))) for s, n in rows.items()], "key string, parts long")
    spread = keyed.join(F.broadcast(parts), "key").withColumn(
        "part", F.shiftright((F.shiftright("h", 33) + (1 << 30)) * F.col("parts"), 31)).drop("parts")
    counts = spread.groupBy("key", "part").agg(F.count(F.lit(1)).alias("n"))
    before = counts.withColumn("before", F.sum("n").over(
        Window.partitionBy("key").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))).drop("n")
    inside = Window.partitionBy("key", "part").orderBy("h", "id", F.xxhash64("row"))
    ranked = spread.withColumn("i", F.row_number().over(inside)).join(before, ["key", "part"]) \
        .withColumn("rank", F.coalesce("before", F.lit(0)) + F.col("i") - 1) \
        .select("row", "key", F.expr(f"rank div {block}").alias("block"), F.expr(f"rank % {block}").alias("within"))

    spans = [(s, k, p.first[s], p.end[s], p.weights[s], sum(p.weights.values()), p.start, p.missing)
             for k, p in enumerate(phases) for s in p.weights if p.end[s] > p.first[s]]
    places = [(s, k, j, slot) for k, p in enumerate(phases) for s, slots in p.places.items()
              if p.end[s] > p.first[s] for j, slot in enumerate(slots[:p.end[s] - p.first[s]])]
    small = F.broadcast if len(places) <= SMALL_SCHEDULE else (lambda df: df)
    spans_df = small(spark.createDataFrame(
        spans, "key string, phase long, first long, end long, w long, total long, start long, missing long"))
    places_df = small(spark.createDataFrame(places, "key string, phase long, j long, place long"))
    timed = ranked.join(spans_df, "key").where("block >= first AND block < end") \
        .withColumn("n", F.expr("block - first")).withColumn("j", F.expr("n % w")).join(places_df, ["key", "phase", "j"])
    slot = F.expr("start + (n div w) * total + place")
    return timed.select(
        "row", F.col("key").alias("source_key"), "block",
        F.expr("start + (n * total) div w").alias("release"),
        F.expr("start + ((n + 1) * total + w - 1) div w").alias("deadline"),
        slot.alias("slot"), (slot * block + F.col("within") - F.col("missing")).alias("position"))


def mix(docs: DataFrame, weights: dict[str | None, int] | None = None, block: int = BLOCK, seed: int = 7,
        id_col: str = "doc_id", source_col: str = "source", position_col: str | None = None) -> DataFrame:
    """All rows in mixing order: ranges of positions over the partitions, in order within;
    with ``position_col`` also the position (instead of a column of that name)."""
    placed = place(docs, weights, block, seed, id_col, source_col).repartitionByRange("position").sortWithinPartitions("position")
    if position_col is None:
        return placed.select("row.*")
    return placed.select(*(F.col("row")[c].alias(c) for c in docs.columns if c.lower() != position_col.lower()),
                         F.col("position").alias(position_col))


@query("op1_mixing")
def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source")
    return place(docs).select("row.doc_id", "row.source", "block", "release", "deadline", "slot", "position")
