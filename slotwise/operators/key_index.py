"""Where a key lives: a hash-bucketed index (key -> partition) beside a partitioned table.

A merge must know in which partitions the incoming keys live now. Without an index that
means reading the key columns of the whole table; with it, only the buckets that the
incoming keys hash to are read, and in them only the key and partition columns.

The index is a Parquet table (``<path>/of=<buckets>/bucket=<n>``) and only grows: before a merge writes the
table, it appends the (key, partition) pairs that are new. An entry therefore means "this
key may have a row there". A crash between index and table costs a partition that is
read for nothing; it never loses a key. ``rebuild`` writes the index anew from the table
(after many merges, or for a table that was written without one), with as many buckets as the
table's size asks for.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from slotwise.session import child_names, path_exists, remove_path

#: Buckets of an index that begins with its table; rows of a bucket that a rebuild aims at, and its most buckets.
BUCKETS, BUCKET_ROWS, MOST_BUCKETS = 16, 1_000_000, 4_096


def index_path(table_path: str) -> str:
    return f"{table_path.rstrip('/')}_keys"


def bucket_of(keys: Sequence[str], buckets: int) -> F.Column:
    """The bucket of a key; it depends on the key's values and their types only."""
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def _schema(keys: Sequence[str], partition_col: str, table: StructType) -> StructType:
    fields = [table[k] for k in keys] + [table[partition_col]]
    return StructType([*fields, StructField("bucket", IntegerType())])


def buckets_of(spark: SparkSession, path: str) -> int:
    """The number of buckets of an index (0: there is none)."""
    return max((int(n[3:]) for n in child_names(spark, path) if n.startswith("of=")), default=0)


def read(spark: SparkSession, path: str, keys: Sequence[str], partition_col: str, table: StructType) -> DataFrame:
    return spark.read.schema(_schema(keys, partition_col, table)).parquet(f"{path}/of={buckets_of(spark, path)}")


def same_keys(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> F.Column:
    """NULL is a key value like others, as in an aggregate."""
    cond = F.lit(True)
    for k in keys:
        cond = cond & left[k].eqNullSafe(right[k])
    return cond


def locate(spark: SparkSession, path: str, wanted: DataFrame, keys: Sequence[str], partition_col: str,
           table: StructType) -> DataFrame:
    """(key, partition) pairs of the index for the ``wanted`` keys. Only their buckets are
    read: the bucket numbers (at most ``MOST_BUCKETS``) are a literal partition filter."""
    wanted, buckets = wanted.select(*keys).distinct(), buckets_of(spark, path)
    touched = sorted(r[0] for r in wanted.select(bucket_of(keys, buckets).alias("b")).distinct().collect())
    entries = read(spark, path, keys, partition_col, table).where(F.col("bucket").isin(touched))
    asked = wanted.select(*[F.col(k).alias(k) for k in keys])
    return entries.join(asked, same_keys(entries, asked, keys), "left_semi").select(*keys, partition_col).distinct()


def add(pairs: DataFrame, path: str, keys: Sequence[str], partition_col: str, buckets: int | None = None) -> None:
    """Append (key, partition) pairs to their buckets (``buckets``: of a new index)."""
    n = buckets or buckets_of(pairs.sparkSession, path) or BUCKETS
    (pairs.select(*keys, partition_col).distinct().withColumn("bucket", bucket_of(keys, n))
     .hint("rebalance", "bucket").write.mode("append").partitionBy("bucket").parquet(f"{path}/of={n}"))


def rebuild(spark: SparkSession, table_path: str, path: str, keys: Sequence[str], partition_col: str, table: StructType,
            fmt: str = "parquet", buckets: int | None = None) -> None:
    """Write the index from the key and partition columns of the whole table."""
    fresh = f"{path}_new"
    remove_path(spark, fresh)
    rows = spark.read.format(fmt).schema(table).load(table_path)
    add(rows, fresh, keys, partition_col, buckets or min(MOST_BUCKETS, max(BUCKETS, rows.count() // BUCKET_ROWS)))
    remove_path(spark, path)
    jpath = spark._jvm.org.apache.hadoop.fs.Path
    jpath(fresh).getFileSystem(spark._jsc.hadoopConfiguration()).rename(jpath(fresh), jpath(path))


def ensure(spark: SparkSession, table_path: str, path: str, keys: Sequence[str], partition_col: str, table: StructType,
           fmt: str = "parquet") -> None:
    """Build the index of a table that has none yet."""
    if not buckets_of(spark, path) and path_exists(spark, table_path):
        rebuild(spark, table_path, path, keys, partition_col, table, fmt)
