"""Helpers the operators share: input tables, lineage cuts, batch settings."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from slotwise.session import remove_path, scratch_path, shared_dir

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None) -> Callable[[QueryFn], QueryFn]:
    """Register one query of this package (and its SQL, where SQL can state it)."""
    def wrap(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return wrap


def _ship(spark: SparkSession) -> None:
    """Give the executors' Python workers this package, once per application, through
    Spark's own file distribution."""
    sc = spark.sparkContext
    if getattr(sc, "_slotwise_shipped", False):
        return
    package = Path(__file__).resolve().parents[1]
    if package.is_dir():          # not when it runs from a zip that was shipped itself
        archive = Path(tempfile.mkdtemp(prefix="slotwise-ship-")) / "slotwise.zip"
        with zipfile.ZipFile(archive, "w") as z:
            for source in sorted(package.rglob("*.py")):
                z.write(source, str(source.relative_to(package.parent)))
        sc.addPyFile(str(archive))
    sc._slotwise_shipped = True


def prepare(spark: SparkSession) -> SparkSession:
    """What the operators rely on: batches of at most 1,000 rows between the JVM and
    Python (texts may be long, so a batch must stay small), lineage cuts in the shared
    folder, this package on the executors."""
    _ship(spark)
    shared_dir(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table, as scanned."""
    return prepare(spark).read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


@contextmanager
def shuffles_go(spark: SparkSession) -> Iterator[None]:
    """What is written meanwhile leaves no shuffle files behind once it is written (they would stay
    until the driver happens to collect its garbage)."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write an intermediate result once as Parquet in the shared folder and read it
    back: later steps restart from there when an executor is lost, and the planner
    knows its real size."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_cut(df: DataFrame) -> None:
    """Remove the table that ``cut`` wrote, once all that reads it is written itself."""
    files = df.inputFiles()
    if files:
        remove_path(df.sparkSession, files[0].rsplit("/", 1)[0])


def bucketed(df: DataFrame, key: str, name: str) -> tuple[DataFrame, Callable[[], None]]:
    """Write a table once in buckets of ``key``, one for each shuffle partition, in the shared folder:
    joins on that key don't shuffle it again. Also returns what removes it."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    of = path.rsplit("/", 1)[1].replace("-", "_")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    df.repartition(n, key).write.bucketBy(n, key).format("parquet").option("path", path).option("parquet.enable.dictionary", "false") \
        .option("compression", "zstd").saveAsTable(of)

    def done() -> None:
        spark.sql(f"DROP TABLE IF EXISTS {of}")
        remove_path(spark, path)
    return spark.table(of), done
