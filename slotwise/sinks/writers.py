"""Sinks: JSON documents and lines, manifests, partitioned columnar tables, catalog.

Writes never funnel through one task: partitioned writes use the ``REBALANCE`` hint,
so adaptive execution splits a crowded partition value over several tasks (and
files) and packs small ones together.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Mapping, Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from slotwise import schemas as S
from slotwise.session import remove_path


#: Records of one JSON array file, at most.
RECORDS_PER_FILE = 50_000


def write_daily_arrays(records: DataFrame, path: str, day_col: str = "date",
                       fields: Sequence[str] = ("date", "channel", "spend"),
                       order_by: Sequence[str] = (), prefix: str = S.BRONZE_SPEND_PREFIX,
                       suffix: str = S.SPEND_FILE_SUFFIX) -> list[str]:
    """K1: JSON array documents per day, ``<path>/<prefix><day><suffix>``; returns the names.

    A document is one JSON value, so one task holds its records: a day of more than
    ``RECORDS_PER_FILE`` goes on in ``<prefix><day>.00001<suffix>`` and so on. Over its
    files a day is ordered by the first ``order_by`` column (a number), in a file by all of
    them and the fields. Without ``order_by`` the files of a day take its records by hash.

    No sort of everything: one aggregate per day (count, and a quantile sketch of the
    order column) says where the files of the day begin, and one exchange by (day, file)
    brings a file's records together. The sketch is off by at most 1 in 10,000 of a day, so
    a file may hold a little more than ``RECORDS_PER_FILE``; equal order values share a file. The
    folder is replaced; Spark's part files get their names by renames in parallel.
    """
    spark = records.sparkSession
    columns = list(dict.fromkeys([*order_by, *fields]))
    kept = records.where(F.col(day_col).isNotNull()).select(F.col(day_col).cast("string").alias("_day"), *columns)
    files = F.ceil(F.count(F.lit(1)) / RECORDS_PER_FILE).cast("int").alias("_files")
    if order_by:
        # Steps of 1 in 10,000: enough for any number of files that the sketch can tell apart.
        steps = F.percentile_approx(F.col(order_by[0]).cast("double"), [i / 1000 for i in range(1, 1000)], 10_000)
        days = kept.groupBy("_day").agg(files, steps.alias("_steps"))
        # The boundaries of a day's files: every (1000 / files)-th step, all of them for very large days.
        inner = F.when(F.col("_files") <= 1, F.array().cast("array<double>")).when(
            F.col("_files") >= 1000, F.array_distinct("_steps")).otherwise(
            F.transform(F.sequence(F.lit(1), F.col("_files") - 1),
                        lambda i: F.element_at("_steps", F.ceil(i * 1000 / F.col("_files")).cast("int"))))
        days = days.select("_day", "_files", inner.alias("_begins"))
        value = F.col(order_by[0]).cast("double")
        number = F.size(F.filter("_begins", lambda x: x < value))
    else:
        days = kept.groupBy("_day").agg(files)
        number = F.pmod(F.xxhash64(*columns), F.col("_files")).cast("int")
    placed = kept.join(days, "_day").withColumn("_file", number)
    items = F.array_sort(F.collect_list(F.struct(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(columns)],
                                                 F.struct(*fields).alias("_r"))))
    docs = placed.groupBy("_day", "_file").agg(F.to_json(F.transform(items, lambda x: x["_r"])).alias("value"))
    staging = f"{path.rstrip('/')}/_staging"
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    target = hadoop(path)
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.delete(target, True)
    docs.write.partitionBy("_day", "_file").text(staging)

    def name_files(day: str) -> list[str]:
        """A day's files, numbered from 0 without gaps (a step may have held no record)."""
        numbered = sorted((int(f.getPath().getName()[6:]), f.getPath()) for f in fs.listStatus(hadoop(f"{staging}/{day}")))
        names = []
        for number, (_, folder) in enumerate(numbered):
            part = next(f.getPath() for f in fs.listStatus(folder) if f.getPath().getName().startswith("part-"))
            names.append(f"{prefix}{day[5:]}{f'.{number:05d}' if number else ''}{suffix}")
            fs.rename(part, hadoop(f"{path}/{names[-1]}"))
        return names

    days_there = [d.getPath().getName() for d in fs.listStatus(hadoop(staging)) if d.getPath().getName().startswith("_day=")]
    names = [n for named in run_concurrently([lambda d=d: name_files(d) for d in days_there]) for n in named] if days_there else []
    fs.delete(hadoop(staging), True)
    return names


def write_json_lines(records: DataFrame, path: str, partition_col: str | None = None,
                     mode: str = "overwrite", compression: str = "lz4", dealt: bool = False) -> None:
    """K2: JSON lines, partitioned by ``partition_col`` (one folder per value).

    lz4 by default: nested webhook JSON shrinks about 6x at the same write speed and
    reads faster; readers pick the codec from the file extension. The files are sized
    by the rebalance, so a non-splittable codec still yields task-sized inputs. ``dealt``: the
    tasks of ``records`` have that size and few values each already, and write as they are.
    """
    writer = (records.hint("rebalance", partition_col) if partition_col and not dealt else records).write \
        .mode(mode).option("compression", compression)
    if partition_col:
        writer = writer.partitionBy(partition_col)
    writer.json(path)


def write_manifest(file_names: DataFrame, path: str, group_col: str | None = None) -> None:
    """K3: a manifest of ``{"files": [...]}`` lines. With ``group_col`` there is one
    line per group (e.g. per month: as many names as files that month); without it,
    one line per file, so no list grows with the number of files."""
    if group_col:
        lines = (file_names.select(F.col(group_col).alias("_g"), "file_name").distinct().groupBy("_g")
                 .agg(F.sort_array(F.collect_list("file_name")).alias("files")))
    else:
        lines = file_names.select(F.array("file_name").alias("files")).distinct()
    lines.select("files").write.mode("overwrite").json(path)


def write_partitioned(df: DataFrame, path: str, partition_cols: Sequence[str],
                      fmt: str = "parquet", mode: str = "overwrite",
                      observation: Observation | None = None, options: Mapping[str, str] | None = None,
                      dealt: bool = False) -> None:
    """K4/K5: partitioned columnar write. With ``partitionOverwriteMode=dynamic``
    (set by ``slotwise.session.configure``) an overwrite replaces only the partitions
    present in ``df``. ``observation`` collects the row count in the same pass (A8).
    ``dealt``: the tasks of ``df`` hold one or a few partitions each already, and write as they are."""
    if observation is not None:
        df = df.observe(observation, F.count(F.lit(1)).alias("rows"))
    ((df if dealt else df.hint("rebalance", *partition_cols))
     .write.format(fmt).options(**(options or {})).mode(mode).partitionBy(*partition_cols).save(path))


def without_dictionaries(columns: Sequence[str]) -> dict[str, str]:
    """Parquet write options: no dictionary for these columns. Where nearly every document has a value of
    its own, one is built and thrown away (or kept, as long as the text) in every file."""
    return {f"parquet.enable.dictionary#{c}": "false" for c in columns}


def copy_manifest(spark: SparkSession, manifest_path: str, bronze_path: str) -> None:
    """K3: the manifest stored beside the Bronze data as it was received, byte for byte (other
    fields, order and all). A manifest of several parts becomes a folder of that name."""
    jvm = spark._jvm
    conf = spark._jsc.hadoopConfiguration()
    source, target = (jvm.org.apache.hadoop.fs.Path(p) for p in (manifest_path, f"{bronze_path.rstrip('/')}/{S.MANIFEST_NAME}"))
    there, here = source.getFileSystem(conf), target.getFileSystem(conf)
    here.delete(target, True)
    jvm.org.apache.hadoop.fs.FileUtil.copy(there, source, here, target, False, True, conf)


def observed_rows(observation: Observation) -> int:
    """The observed count; 0 where the optimiser found the input empty and dropped the
    observation with it."""
    try:
        return int(observation.get["rows"])
    except (AssertionError, Py4JJavaError) as e:
        if "AssertionError" not in f"{type(e).__name__} {e}":
            raise
        return 0


def write_tables(tables: Mapping[str, DataFrame], root: str, fmt: str = "parquet",
                 concurrent: bool = True) -> dict[str, int]:
    """K6: write named tables (full overwrite); returns each table's row count,
    observed during its write rather than by a second job.

    All tables are written beside the old ones first and take their places when every
    write has succeeded: a run that fails on the way leaves all old tables as they were.
    ``concurrent`` submits the writes from parallel driver threads: Spark runs the
    jobs side by side, so small tables do not wait on each other's scheduling.
    """
    if not tables:
        return {}
    spark = next(iter(tables.values())).sparkSession
    staging = f"{root.rstrip('/')}/{VERSION_PREFIX}{uuid.uuid4().hex[:12]}"
    counts = write_version(tables, staging, fmt, concurrent)
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    fs = hadoop(root).getFileSystem(spark._jsc.hadoopConfiguration())
    for name in tables:
        fs.delete(hadoop(f"{root}/{name}"), True)
        fs.rename(hadoop(f"{staging}/{name}"), hadoop(f"{root}/{name}"))
    fs.delete(hadoop(staging), True)
    return counts


#: Folders of one run's tables below a root (no table scan looks into names with an underscore).
VERSION_PREFIX = "_version-"


def write_version(tables: Mapping[str, DataFrame], folder: str, fmt: str = "parquet", concurrent: bool = True) -> dict[str, int]:
    """Write named tables into a folder of their own; the folder goes if any write fails."""
    def write(name: str, df: DataFrame) -> int:
        obs = Observation(name)
        df.observe(obs, F.count(F.lit(1)).alias("rows")).write.format(fmt).mode("overwrite").save(f"{folder}/{name}")
        return observed_rows(obs)

    try:
        if not concurrent or len(tables) < 2:
            return {name: write(name, df) for name, df in tables.items()}
        return dict(zip(tables, run_concurrently([lambda n=n, d=d: write(n, d) for n, d in tables.items()])))
    except BaseException:
        remove_path(next(iter(tables.values())).sparkSession, folder)
        raise


def publish_tables(tables: Mapping[str, DataFrame], root: str, database: str, fmt: str = "parquet") -> dict[str, int]:
    """K6/K7: write all tables into a new folder below ``root``, then point the database's
    tables at it (``ALTER TABLE ... SET LOCATION``, one metadata change each). Readers see the old tables until
    all new ones are complete; the folder before the last stays for queries that still run,
    older ones are removed."""
    spark = next(iter(tables.values())).sparkSession
    folder = f"{root.rstrip('/')}/{VERSION_PREFIX}{time.time_ns():020d}"
    counts = write_version(tables, folder, fmt)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{root}'")
    for name in tables:
        if spark.catalog.tableExists(f"{database}.{name}") and \
                spark.table(f"{database}.{name}").schema == spark.read.format(fmt).load(f"{folder}/{name}").schema:
            spark.sql(f"ALTER TABLE {database}.{name} SET LOCATION '{folder}/{name}'")
            spark.sql(f"REFRESH TABLE {database}.{name}")
        else:                                             # new, or its columns have changed
            spark.sql(f"DROP TABLE IF EXISTS {database}.{name}")
            spark.sql(f"CREATE TABLE {database}.{name} USING {fmt} LOCATION '{folder}/{name}'")
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    fs = hadoop(root).getFileSystem(spark._jsc.hadoopConfiguration())
    versions = sorted(f.getPath().getName() for f in fs.listStatus(hadoop(root)) if f.getPath().getName().startswith(VERSION_PREFIX))
    for old in versions[:-2]:
        fs.delete(hadoop(f"{root}/{old}"), True)
    return counts


def run_concurrently(actions: Sequence, max_workers: int = 8) -> list:
    """Run independent Spark actions from parallel driver threads; results in order.
    An error in any action is raised after all have finished."""
    from concurrent.futures import ThreadPoolExecutor
    with ThreadPoolExecutor(max_workers=min(max_workers, len(actions))) as pool:
        futures = [pool.submit(a) for a in actions]
        return [f.result() for f in futures]


def register_tables(spark: SparkSession, database: str, root: str, names: Sequence[str],
                    fmt: str = "parquet", db_location: str | None = None, replace: bool = False) -> None:
    """K7: database and external tables over written folders. The database folder
    defaults to the tables' root (never the process's working directory).
    ``replace`` re-points existing table names at ``root`` (external tables: the
    old files are left alone)."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{db_location or root}'")
    for name in names:
        if replace:
            spark.sql(f"DROP TABLE IF EXISTS {database}.{name}")
        spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.{name} USING {fmt} LOCATION '{root}/{name}'")


def spend_file_name(day_col: str = "date") -> F.Column:
    """``spend_data_<day>.json``, the raw file a day's records arrive in."""
    return F.concat(F.lit(S.SPEND_FILE_PREFIX), F.col(day_col), F.lit(S.SPEND_FILE_SUFFIX))
