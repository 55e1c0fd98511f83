"""Columnar table scans."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

DRIVER_TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table (``<sf_dir>/<name>.parquet``), as scanned: column pruning and
    filters applied later reach the Parquet scan (ReadSchema / PushedFilters)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def read_columnar(spark: SparkSession, path: str | list[str], fmt: str = "parquet",
                  schema: StructType | None = None) -> DataFrame:
    """A columnar table directory (partition folders discovered). ``fmt`` may name any
    installed source (e.g. ``delta`` where the package is on the classpath). A
    ``schema`` fixes the partition columns' types (otherwise inferred from folder
    names, e.g. a day becomes a DATE)."""
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path)


def table_glob(sf_dir: str, name: str) -> str:
    """A glob a streaming source accepts (it needs a directory or pattern)."""
    return f"{sf_dir.rstrip('/')}/{name}*.parquet"
