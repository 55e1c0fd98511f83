"""Session settings the engine relies on, and the shared scratch folder.

Only *semantic* settings are forced here (time zone, overwrite mode, AQE). Sizing
(`spark.sql.shuffle.partitions`, executor memory, `maxPartitionBytes`) belongs to the
cluster that submits the job and is left alone unless a local session is being built.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every query depends on for correct results.
SEMANTIC_CONF = {
    # All event times are read and bucketed in UTC, so to_date / hour / dayofweek agree.
    "spark.sql.session.timeZone": "UTC",
    # An overwrite replaces only the partitions present in the new data.
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # Runtime re-planning: coalesce small shuffle partitions, split skewed ones,
    # turn sort-merge joins into broadcast joins once the real size is known.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}


# A partitioned write keeps up to this many files of a task open instead of sorting the task's rows by
# partition first (wide rows, in memory); a task with more partitions sorts the rest.
WRITE_CONF = {"spark.sql.maxConcurrentOutputFileWriters": "64"}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in (SEMANTIC_CONF | WRITE_CONF).items():
        spark.conf.set(key, value)
    return spark


def sizing_conf(shuffle_bytes: int, total_cores: int,
                target_partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Settings for a cluster run, from the largest expected shuffle (bytes after
    partial aggregation: for these jobs the keyed merge or dedup of the booking
    table; every Gold aggregate shuffles far less) and the total executor cores.

    Start with enough shuffle partitions for ~``target_partition_bytes`` each (at
    least 3 per core) and let AQE coalesce small ones and split skewed ones; scan
    splits of the same size; broadcast only what AQE measured below 64 MB.
    """
    partitions = max(3 * total_cores, -(-shuffle_bytes // target_partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target_partition_bytes),
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 << 20),
    }


def apply_sizing(spark: SparkSession, shuffle_bytes: int, total_cores: int | None = None) -> SparkSession:
    cores = total_cores or spark.sparkContext.defaultParallelism
    for key, value in sizing_conf(shuffle_bytes, cores).items():
        spark.conf.set(key, value)
    return spark


def _local_memory() -> str:
    """Half the machine's memory, at most 8 GB (local mode: the driver is everything)."""
    try:
        with open("/proc/meminfo") as fh:
            kib = int(next(line for line in fh if line.startswith("MemTotal")).split()[1])
        return f"{max(1, min(8, kib // (2 << 20)))}g"
    except (OSError, StopIteration, ValueError):
        return "4g"


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "slotwise") -> SparkSession:
    """A local session for tests and the benchmark (never used on a cluster)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("SLOTWISE_DRIVER_MEMORY", _local_memory()))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.adaptive.advisoryPartitionSizeInBytes", "16m")
        # Local only: keep the default catalog's folder out of the working directory.
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="slotwise-warehouse-"))
    )
    for key, value in (SEMANTIC_CONF | WRITE_CONF).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster-wide folder named by `spark.checkpoint.dir`.

    A cluster names a shared folder (HDFS, object store) there; jobs write
    intermediate tables and streaming checkpoints below it so that they survive the
    loss of an executor. Only when the session names none (local tests) is a folder
    created and registered.
    """
    sc = spark.sparkContext
    configured = sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir names no folder that all executors share")
        # Unset: a local test session. Register a folder of our own.
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="slotwise-shared-"))
        configured = sc.getCheckpointDir()
    elif not sc.getCheckpointDir():
        sc.setCheckpointDir(configured)
    return configured.rstrip("/")


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a scratch folder of this run once nothing reads it any more."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def path_exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return bool(p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p))


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies directly in a folder (none if it does not exist)."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    return [f.getPath().getName() for f in fs.listStatus(p)] if fs.exists(p) else []


def make_folder(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(p)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder below the shared directory for one run."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"
