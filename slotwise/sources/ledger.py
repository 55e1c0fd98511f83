"""Which input files are new. A ledger remembers every file that was loaded (path,
size, modification time); an incremental run reads only files that the ledger does not hold in
that state: new ones, and ones that were replaced since.

The listing is a Spark scan of file metadata (``binaryFile`` without its content column:
no file is opened), anti-joined with the ledger. The ledger is an append-only Parquet
table of one row per loaded file state, written after the load has succeeded: a run that
fails in between loads its files again, so a load must replace what it wrote before
(``load_new_spend_days`` replaces whole days).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slotwise import schemas as S
from slotwise.session import path_exists
from slotwise.sinks import writers
from slotwise.sources import json_io

LEDGER = T.StructType([
    T.StructField("path", T.StringType()),
    T.StructField("size", T.LongType()),
    T.StructField("modified", T.TimestampType()),
    T.StructField("run", T.LongType()),
])
STATE = ("path", "size", "modified")


def listing(spark: SparkSession, path: str, path_glob: str | None = None) -> DataFrame:
    """path, size, modified of every file below ``path``."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if path_glob:
        reader = reader.option("pathGlobFilter", path_glob)
    return reader.load(path).select("path", F.col("length").alias("size"), F.col("modificationTime").alias("modified"))


def read_ledger(spark: SparkSession, ledger_path: str) -> DataFrame:
    if not path_exists(spark, ledger_path):
        return spark.createDataFrame([], LEDGER)
    return spark.read.schema(LEDGER).parquet(ledger_path)


def pending(spark: SparkSession, path: str, ledger_path: str, path_glob: str | None = None) -> DataFrame:
    """The files below ``path`` that the ledger does not hold in their present state."""
    return listing(spark, path, path_glob).join(read_ledger(spark, ledger_path), list(STATE), "left_anti")


def record(files: DataFrame, ledger_path: str) -> int:
    """Note files (path, size, modified, as they were listed before the load) as loaded.
    Returns the number of the run."""
    spark = files.sparkSession
    run = (read_ledger(spark, ledger_path).agg(F.max("run")).first()[0] or 0) + 1
    files.select(*STATE, F.lit(run).cast("long").alias("run")).write.mode("append").parquet(ledger_path)
    return run


def day_of(path: str = "path") -> F.Column:
    """The day that a spend file's name carries (``spend_data_<day>[.<number>].json``)."""
    name = F.element_at(F.split(path, "/"), -1)
    return F.regexp_extract(name, f"^{S.SPEND_FILE_PREFIX}([0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}})", 1)


def load_new_spend_days(spark: SparkSession, raw_path: str, ledger_path: str, table_path: str) -> list[str]:
    """Incremental spend load: the days that new or changed files touch are read (all
    files of such a day, so a day is never half old) and replace their partitions of
    ``table_path`` (date, channel, spend as number, by ``spend_date``). A second run over the same
    folder reads no file. Returns the days, which are what reaches the driver, with
    the names of their files."""
    every = listing(spark, raw_path, f"{S.SPEND_FILE_PREFIX}*").withColumn("day", day_of()).where("day <> ''")
    listed = every.join(read_ledger(spark, ledger_path).select(*STATE, F.lit(True).alias("loaded")), list(STATE), "left") \
        .groupBy("day").agg(F.collect_list(F.struct(*STATE)).alias("files"), F.count_if(F.col("loaded").isNull()).alias("new")) \
        .where("new > 0").collect()
    if not listed:
        return []
    days = sorted(r["day"] for r in listed)
    files = [tuple(f) for r in listed for f in r["files"]]
    rows = read_spend_days(spark, [f[0] for f in files])
    writers.write_partitioned(rows, table_path, ["spend_date"])
    seen = spark.createDataFrame(files, T.StructType(LEDGER.fields[:3]))
    record(seen.join(read_ledger(spark, ledger_path), list(STATE), "left_anti"), ledger_path)
    return days


def read_spend_days(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """date, channel, spend (number), spend_date of the spend files at ``paths``."""
    records = json_io.read_spend_files(spark, list(paths))
    return records.select("date", "channel", F.col("spend").try_cast("double").alias("spend"),
                          F.nullif(day_of("file_path"), F.lit("")).alias("spend_date"))
