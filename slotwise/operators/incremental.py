"""Partitioned tables kept current by partition, not by full rewrites.

* ``reprocess_days``: recompute the last N days and replace exactly those partitions;
  ``refresh_touched``: recompute the days that new arrivals touch.
* ``upsert``: MERGE by key without a transactional table format. Only *touched*
  partitions are rewritten: those the new rows go to, plus those where their keys
  live now (a key can move to another partition). Inside them the latest row per key
  wins. A touched partition left without rows is removed explicitly, since a dynamic
  overwrite only replaces partitions that receive rows.

The rewrite is per partition, not atomic across partitions (no transaction log).
"""

from __future__ import annotations

import datetime
from collections.abc import Callable, Iterable, Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from slotwise.operators import key_index
from slotwise.operators.dedup import latest_per_key
from slotwise.session import path_exists, remove_path, scratch_path
from slotwise.sinks.writers import write_partitioned


# Folder name Spark gives a NULL partition value.
DEFAULT_PARTITION = "__HIVE_DEFAULT_PARTITION__"


def window_start(as_of: str, days: int):
    """First day of the last ``days`` days ending the day before ``as_of``."""
    return F.date_sub(F.lit(as_of).cast("date"), days)


def reprocess_window(df: DataFrame, date_col: str, as_of: str, days: int) -> DataFrame:
    """Rows whose day falls in the reprocessing window [as_of - days, ...)."""
    return df.filter(F.col(date_col) >= window_start(as_of, days))


def overwrite_partitions(df: DataFrame, path: str, partition_cols: Sequence[str],
                         fmt: str = "parquet") -> None:
    """Replace only the partitions present in ``df`` (dynamic overwrite)."""
    write_partitioned(df, path, partition_cols, fmt=fmt, mode="overwrite")


def partition_values(spark: SparkSession, path: str, partition_col: str) -> dict[str, str]:
    """Partition values of a table as its folders name them (value -> folder name)."""
    jvm = spark._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    unescape = jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName
    names = [s.getPath().getName() for s in fs.listStatus(root)] if fs.exists(root) else []
    return {unescape(n.split("=", 1)[1]): n for n in names if n.startswith(f"{partition_col}=")}


def fingerprints(df: DataFrame, partition_col: str) -> DataFrame:
    """Per partition value: the row count and two sums of row hashes, whatever the order of
    rows and files (columns are taken by name). Partial sums before the shuffle: one row
    per value and task."""
    columns = sorted(c for c in df.columns if c != partition_col)
    hashed = lambda seed: F.sum(F.xxhash64(F.lit(seed), *columns).cast("decimal(38,0)"))
    return df.groupBy(partition_col).agg(F.count(F.lit(1)).alias("n"), hashed(1).alias("h1"), hashed(2).alias("h2"))


def changed_values(new: DataFrame, old: DataFrame, partition_col: str) -> set:
    """Partition values whose rows differ between ``new`` and ``old`` (in one of them only, too)."""
    both = fingerprints(new, partition_col).withColumn("side", F.lit(1)) \
        .unionByName(fingerprints(old, partition_col).withColumn("side", F.lit(-1)))
    differs = both.groupBy(partition_col).agg(
        *[F.sum(F.col(c) * F.col("side")).alias(c) for c in ("n", "h1", "h2")], F.sum("side").alias("side")) \
        .where("n <> 0 OR h1 <> 0 OR h2 <> 0 OR side <> 0")
    return {r[0] for r in differs.select(partition_col).collect()}


def replace_days(df: DataFrame, path: str, partition_col: str, days: Iterable[str], fmt: str = "parquet",
                 changed_only: bool = False) -> list[str]:
    """Replace exactly the given days: those with rows in ``df`` are overwritten, those
    without lose their partition (a day whose rows were all withdrawn). Only day values
    reach the driver. With ``changed_only``, days whose fingerprint equals that of
    the table's rows are left as they are. Returns the days written or removed."""
    spark = df.sparkSession
    out = scratch_path(spark, "replace-days")
    df.write.parquet(out)                             # not recomputed by the second read
    rows = spark.read.schema(df.schema).parquet(out)
    kept = {r[0] for r in rows.select(partition_col).distinct().collect()}
    written = kept
    if changed_only and path_exists(spark, path):
        current = spark.read.format(fmt).schema(df.schema).load(path).where(partition_filter(partition_col, kept))
        written = changed_values(rows, current, partition_col)
        rows = rows.where(partition_filter(partition_col, written))
    if written:
        write_partitioned(rows, path, [partition_col], fmt=fmt)
    remove_path(spark, out)
    there = partition_values(spark, path, partition_col)
    named = {DEFAULT_PARTITION if d is None else str(d) for d in kept}
    removed = [d for d in days if d in there and d not in named]
    _remove_partitions(spark, path, partition_col, removed)
    return sorted({DEFAULT_PARTITION if d is None else str(d) for d in written} | set(removed))


def reprocess_days(df: DataFrame, path: str, partition_col: str, as_of: str, days: int, fmt: str = "parquet",
                   changed_only: bool = False) -> list[str]:
    """Replace the window [as_of - days, ...): recomputed days are overwritten (with
    ``changed_only`` those alone whose rows have changed), days of the table in the
    window that have no row any more are removed. Returns the days that it touched."""
    start = str(datetime.date.fromisoformat(as_of) - datetime.timedelta(days=days))
    there = partition_values(df.sparkSession, path, partition_col)
    window = [d for d in there if d != DEFAULT_PARTITION and d >= start]
    return replace_days(reprocess_window(df, partition_col, as_of, days), path, partition_col, window, fmt, changed_only)


def refresh_touched(arrivals: DataFrame, facts: DataFrame, path: str, partition_col: str,
                    compute: Callable[[DataFrame], DataFrame], fmt: str = "parquet") -> list[str]:
    """Recompute only the days that new arrivals touch. ``arrivals`` (new rows) gives
    the days, ``facts`` (all rows, by the same column) is read for those days only,
    ``compute`` makes the table's rows from them. Returns the days."""
    days = {r[0] for r in arrivals.select(partition_col).distinct().collect()}
    if days:
        replace_days(compute(facts.where(partition_filter(partition_col, days))), path, partition_col,
                     [DEFAULT_PARTITION if d is None else str(d) for d in days], fmt)
    return sorted(map(str, days))


def _remove_partitions(spark: SparkSession, path: str, partition_col: str, values: Sequence[str]) -> None:
    jvm = spark._jvm
    conf = spark._jsc.hadoopConfiguration()
    escape = jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
    for v in values:
        folder = v if v == DEFAULT_PARTITION else escape(v)
        p = jvm.org.apache.hadoop.fs.Path(f"{path}/{escape(partition_col)}={folder}")
        fs = p.getFileSystem(conf)
        if fs.exists(p):
            fs.delete(p, True)


def upsert(spark: SparkSession, updates: DataFrame, path: str, keys: Sequence[str],
           partition_col: str, order_by: Sequence[str], schema: StructType,
           fmt: str = "parquet", key_determines_partition: bool = False, keep: str = "last",
           index: str | None = None, located: DataFrame | None = None) -> None:
    """Merge ``updates`` into the partitioned table at ``path`` by ``keys``.

    ``order_by`` decides between an existing row and a new one (greatest wins, e.g.
    ingestion time then delivery id); ``keep="first"`` keeps the smallest instead (a
    deduplicating merge: the first delivery stays). ``schema`` is the table's schema
    (it fixes the partition column's type when read back).

    Only touched partitions are read: their values (a set of days, not rows) are
    collected and applied as a literal filter, which prunes partitions at the scan.
    Where the incoming keys live now comes from the key index at ``index`` (built on first
    use, see ``key_index``: only the buckets of the incoming keys are read); without an
    index from the key and partition columns of the whole table.
    ``key_determines_partition=True`` states that a key's partition is a function of the
    key (it can never move), which skips that search exactly. ``located`` restricts the
    search to the keys of those rows (the caller knows that the others are new).
    """
    keys = list(keys)
    # The incoming rows are read three times (partitions, key search, merge).
    updates = updates.select(*schema.fieldNames()).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        _upsert(spark, updates, path, keys, partition_col, order_by, schema, fmt, key_determines_partition, keep,
                index, located)
    finally:
        updates.unpersist()


def partition_filter(col: str, values: set):
    named = sorted((v for v in values if v is not None), key=str)
    cond = F.col(col).isin(named) if named else F.lit(False)
    return cond | F.col(col).isNull() if None in values else cond


def _upsert(spark: SparkSession, updates: DataFrame, path: str, keys: list[str], partition_col: str,
            order_by: Sequence[str], schema: StructType, fmt: str, key_determines_partition: bool,
            keep: str, index: str | None, located: DataFrame | None) -> None:
    exists = path_exists(spark, path)
    touched = {r[0] for r in updates.select(partition_col).distinct().collect()}
    if not key_determines_partition:
        asked = updates if located is None else located
        live = None
        if index:
            key_index.ensure(spark, path, index, keys, partition_col, schema, fmt)
            if key_index.buckets_of(spark, index):
                # Read once for both uses below: as many rows as the asked keys have places.
                live = key_index.locate(spark, index, asked, keys, partition_col, schema).persist(StorageLevel.MEMORY_AND_DISK)
        elif exists:
            # Partitions where the incoming keys live now (key and partition columns only).
            asked = asked.select(*keys).distinct()
            table = spark.read.format(fmt).schema(schema).load(path).select(*keys, partition_col)
            live = table.join(asked, key_index.same_keys(table, asked, keys), "left_semi")
        if live is not None and exists:
            touched |= {r[0] for r in live.select(partition_col).distinct().collect()}
        if index:
            # New pairs go to the index before the rows go to the table (keys not asked for are new).
            pairs = updates.select(*keys, partition_col).distinct()
            if live is not None:
                pairs = pairs.join(live, key_index.same_keys(pairs, live, [*keys, partition_col]), "left_anti")
            key_index.add(pairs, index, keys, partition_col)
            if live is not None:
                live.unpersist()
    if not exists:
        write_partitioned(latest_per_key(updates, keys, order_by, keep), path, [partition_col], fmt=fmt)
        return
    current = spark.read.format(fmt).schema(schema).load(path).filter(partition_filter(partition_col, touched))
    merged = latest_per_key(current.unionByName(updates), keys, order_by, keep)
    # Staged in the shared folder: the result must not be recomputed from files
    # the write replaces, and its lineage is cut for recovery after a lost executor.
    staged = scratch_path(spark, "merge")
    merged.write.parquet(staged)
    merged = spark.read.schema(merged.schema).parquet(staged)
    # A touched partition that ends up empty would keep its old files after a dynamic
    # overwrite: found before the write, removed after it.
    kept = {r[0] for r in merged.select(partition_col).distinct().collect()}
    write_partitioned(merged, path, [partition_col], fmt=fmt)
    remove_path(spark, staged)
    emptied = touched - kept
    if emptied:
        _remove_partitions(spark, path, partition_col,
                           [DEFAULT_PARTITION if v is None else str(v) for v in emptied])
