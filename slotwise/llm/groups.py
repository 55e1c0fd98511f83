"""Groups in sorted task streams, and connected components as joins and aggregates."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slotwise.llm.common import cut


def runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Consecutive rows of equal keys, each run as one table. The stream must be sorted by
    the keys; a run must have a bound that its caller ensures."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_pylist() for k in keys]
        marks = list(zip(*columns))
        start = 0
        for i, mark in enumerate(marks):
            if mark != last:
                if i > start:
                    held.append(batch.slice(start, i - start))
                if held:
                    yield pa.Table.from_batches(held)
                held, start, last = [], i, mark
        held.append(batch.slice(start))
    if held:
        yield pa.Table.from_batches(held)


def in_runs(df: DataFrame, *keys: str) -> DataFrame:
    """Rows of equal keys together and in order within a partition."""
    return df.repartition(*keys).sortWithinPartitions(*keys)


def components(edges: DataFrame, name: str) -> DataFrame:
    """(node, root): every node of the edge list (a, b) with the smallest node that it is
    connected to. Alternating large-star and small-star steps: each is an aggregate with
    map-side combine and a join, the edge list never grows, and the number of steps goes
    with the logarithm of the longest path. Only a count and a checksum reach the driver.
    """
    def state(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    now = cut(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), name)
    mark = state(now)
    while mark[0]:
        both = now.union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")) \
            .where("a <> b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.explode(F.array(
            F.struct(F.col("b").alias("a"), F.col("m").alias("b")),
            F.struct(F.col("a"), F.col("m").alias("b")))).alias("e")).select("e.a", "e.b").where("a <> b").distinct()
        now = cut(small, name)
        before, mark = mark, state(now)
        if mark == before:
            break
    roots = now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.union(roots.select(F.col("root").alias("node"), "root").distinct())
