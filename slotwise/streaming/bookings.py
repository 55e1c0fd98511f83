"""Booking events as a stream.

* ``booking_stream``: file source with an explicit schema (new files are picked up
  as they land; ``availableNow`` processes what is there and stops).
* Event time (the booking start) and arrival time (ingestion) are separate columns. A
  watermark on the event time bounds what the state store (RocksDB) remembers; a row behind it
  is not lost: it takes the way over the table. So a stream's result is the batch result,
  however late a row is and however the rows are dealt to files and micro-batches.
* ``with_state``: every micro-batch carries its rows and, marked, those that the state store
  sees for the first time (``dropDuplicatesWithinWatermark``).
* ``daily_counts_to_table``: counts kept by deltas. First-seen deliveries are counted and
  added to the counts of their days; only the few rows of those counts are read. Rows that
  the state could not settle (repeated, or behind the watermark) are looked up in the log of their
  days; those that were late and new are counted too and kept in a correction table.
* ``dedup_stream``: one row per key, the first delivery. Only keys that the state store
  knows, or could have forgotten, are looked up in the table's key index.
* ``upsert_stream``: every micro-batch merged into the keyed Silver table.

All checkpoints and outputs live below the shared folder, so a restarted query
resumes from its last committed batch. Replayed batches and new checkpoints over an
existing table change nothing: a batch's log partition is replaced, a count remembers
the last batch that it holds, deliveries of earlier streams are found in the log. One stream
at a time writes a table.
"""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Callable, Mapping, Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from slotwise import schemas as S
from slotwise.operators import gold, incremental, key_index
from slotwise.session import child_names, make_folder, path_exists
from slotwise.sinks.writers import without_dictionaries, write_partitioned
from slotwise.sources import model

#: What a reader of the counts needs; ``COUNTS_TABLE`` adds the stream's bookkeeping.
DAILY_COUNTS = T.StructType([
    T.StructField("channel", T.StringType()),
    T.StructField("bookings_count", T.LongType()),
    T.StructField("booking_date", T.DateType()),
])
COUNTS_TABLE = T.StructType([
    T.StructField("channel", T.StringType()),
    T.StructField("bookings_count", T.LongType()),
    T.StructField("late_count", T.LongType()),       # of these, counted from behind the watermark
    T.StructField("stream", T.StringType()),
    T.StructField("last_batch", T.LongType()),
    T.StructField("booking_date", T.DateType()),
])
DELIVERIES = T.StructType([
    T.StructField("delivery_id", T.StringType()),
    T.StructField("channel", T.StringType()),
    T.StructField("late", T.BooleanType()),
    T.StructField("booking_date", T.DateType()),
    T.StructField("stream", T.StringType()),
    T.StructField("batch", T.LongType()),
])
#: A booking counts once under these.
DELIVERY_KEY = ("delivery_id", "booking_date", "channel")
LATE_AFTER = "1 day"
FRESH = "_fresh"
STATE_STORE = ("spark.sql.streaming.stateStore.providerClass",
               "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


def events_stream(spark: SparkSession, source: str, schema: T.StructType,
                  max_bytes_per_trigger: int | None = None) -> DataFrame:
    """The driver's ``events`` rows as a file stream (a directory or glob).
    ``max_bytes_per_trigger`` bounds a micro-batch by size."""
    reader = spark.readStream.schema(schema)
    if max_bytes_per_trigger:
        reader = reader.option("maxBytesPerTrigger", max_bytes_per_trigger)
    return reader.parquet(source)


def document_stream(spark: SparkSession, bronze_path: str, max_bytes_per_trigger: int | None = None,
                    schema: T.StructType = S.BOOKING_EVENT_DOC) -> DataFrame:
    """T1 for webhook documents: JSON lines under ``event_date=`` folders, explicit
    ``schema`` (for counts ``S.BOOKING_COUNT_DOC``: every document is read, its other fields are
    not parsed), the folder's day taken from the file path (NULL when absent)."""
    reader = spark.readStream.schema(schema).option("recursiveFileLookup", "true")
    if max_bytes_per_trigger:
        reader = reader.option("maxBytesPerTrigger", max_bytes_per_trigger)
    docs = reader.json(bronze_path)
    day = F.regexp_extract(F.col("_metadata.file_path"), S.EVENT_DATE_PATTERN, 1)
    return docs.withColumn("event_date", F.nullif(day, F.lit("")))


def silver_events_stream(docs: DataFrame, silver_path: str, checkpoint: str) -> None:
    """Streaming Silver: flatten every micro-batch of documents and append it to
    ``fact_events`` partitioned by ``event_date`` (the file sink commits each batch
    exactly once through its log)."""
    from slotwise.operators.flatten import flatten
    _run(flatten(docs).writeStream.format("parquet").outputMode("append").partitionBy("event_date")
         .options(**without_dictionaries(S.DOCUMENT_NAMES))
         .option("checkpointLocation", checkpoint).option("path", silver_path)
         .trigger(availableNow=True).start())


def _row_id(*columns: F.Column) -> F.Column:
    return F.sha2(F.to_json(F.struct(*columns)), 256)


def booking_stream(events: DataFrame, mapping: Mapping[str, str] = S.CHANNEL_URIS) -> DataFrame:
    """Enriched bookings from the driver's ``events`` columns, with ``event_time`` and
    ``arrival_time``; ``delivery_id`` names a delivery (NULL where it has no id)."""
    enriched = gold.enrich(model.booking_facts(events), mapping)
    return (enriched
            .withColumn("event_time", F.col("booking_ts").cast("timestamp"))
            .withColumn("arrival_time", F.col("ingestion_time").cast("timestamp"))
            .withColumn("delivery_id", F.col("event_id").cast("string")))


def document_booking_stream(docs: DataFrame, mapping: Mapping[str, str] = S.CHANNEL_URIS) -> DataFrame:
    """The same from webhook documents (no flattening: one row per document). A document
    without ``uri`` is named by its file and its fields as read (``row_id``; equal ones of a file are numbered)."""
    payload = "data.payload"
    rows = docs.select(
        F.col("data.event").alias(S.COL_EVENT),
        F.col(f"{payload}.scheduled_event.event_type").alias(S.COL_EVENT_TYPE),
        F.col(f"{payload}.scheduled_event.start_time").alias(S.COL_START_TIME),
        F.try_to_timestamp(F.col("ingestion_time")).alias("arrival_time"),
        F.col(f"{payload}.uri").alias("delivery_id"),
        F.when(F.col(f"{payload}.uri").isNull(),
               _row_id(F.col("_metadata.file_path"), *[F.col(c) for c in docs.columns])).alias("row_id"))
    return gold.enrich(rows, mapping).withColumn("event_time", F.col("booking_ts").cast("timestamp"))


def _run(query: StreamingQuery) -> None:
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))


def with_state(rows: DataFrame, keys: Sequence[str], late_after: str = LATE_AFTER) -> DataFrame:
    """All rows (``_fresh`` false) and once more (true) those whose key the state store
    meets for the first time and that are not behind the watermark. Rows without event
    time or with a NULL in the key have no second copy. Both come from one
    read of the source, in the same micro-batch."""
    marked = rows.withWatermark("event_time", late_after)
    usable = F.col("event_time").isNotNull()
    for k in keys:
        usable = usable & F.col(k).isNotNull()
    first = marked.where(usable).dropDuplicatesWithinWatermark(list(keys))
    return first.withColumn(FRESH, F.lit(True)).unionByName(marked.withColumn(FRESH, F.lit(False)))


def _each_batch(rows: DataFrame, merge: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    """Run ``merge`` on every micro-batch, state in RocksDB (memory does not grow with it). No
    batches without data: they would only forget keys, which the next batch does as well."""
    def adaptive(batch: DataFrame, batch_id: int) -> None:
        """A stream switches adaptive execution off for its own plan; the merge's jobs need it: without
        it a rebalance is no exchange, and every state partition writes a file for every day."""
        conf = batch.sparkSession.conf
        own = conf.get("spark.sql.adaptive.enabled")
        conf.set("spark.sql.adaptive.enabled", "true")
        try:
            merge(batch, batch_id)
        finally:
            conf.set("spark.sql.adaptive.enabled", own)

    spark = rows.sparkSession
    settings = {STATE_STORE[0]: STATE_STORE[1], "spark.sql.streaming.noDataMicroBatches.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        _run(rows.writeStream.foreachBatch(adaptive).option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def _checkpoint_lines(spark: SparkSession, path: str) -> list[str]:
    return [r[0] for r in spark.read.text(path, wholetext=True).collect()][0].splitlines() if path_exists(spark, path) else []


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that Spark gave the stream of this checkpoint."""
    return json.loads(_checkpoint_lines(spark, f"{checkpoint.rstrip('/')}/metadata")[0])["id"]


def batch_watermark(spark: SparkSession, checkpoint: str, batch_id: int) -> dt.datetime | None:
    """The watermark that Spark logged for a micro-batch before it ran (None: none yet)."""
    lines = _checkpoint_lines(spark, f"{checkpoint.rstrip('/')}/offsets/{batch_id}")
    ms = json.loads(lines[1]).get("batchWatermarkMs", 0) if len(lines) > 1 else 0
    return dt.datetime.fromtimestamp(ms / 1000, dt.timezone.utc) if ms else None


def _named(rows: DataFrame) -> DataFrame:
    """Rows without a delivery id get one: their content's hash and a running number among
    equals (an aggregate and a generator, so many equal rows are no hot group)."""
    ids = rows.where("delivery_id IS NOT NULL").drop("row_id")
    rest = [c for c in ids.columns if c != "delivery_id"]
    none = rows.where("delivery_id IS NULL").groupBy("row_id", *rest).agg(F.count(F.lit(1)).alias("_n")) \
        .withColumn("_i", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_n"))))
    return ids.unionByName(none.select(F.concat_ws("#", F.lit("row"), "row_id", F.col("_i").cast("string")).alias("delivery_id"), *rest))


def daily_counts_to_table(bookings: DataFrame, table_path: str, checkpoint: str, log_path: str | None = None,
                          late_after: str = LATE_AFTER, corrections_path: str | None = None) -> None:
    """Daily counts per channel, kept current per micro-batch by deltas.

    ``table_path``: the counts (``COUNTS_TABLE``), partitioned by booking day. ``log_path``: the
    counted deliveries, by day, stream and batch. ``corrections_path``: those of them that came
    behind the watermark (``late_after`` the latest event time seen before), by stream and
    batch; they are in the counts too (``late_count`` of ``bookings_count``).

    A batch reads the counts of its days (a row per channel), and of the log only what the
    state store could not settle: the days of repeated or late rows, and, under a new
    checkpoint, what earlier streams logged for the batch's days."""
    log_path = log_path or table_path.rstrip("/") + "_log"
    corrections_path = corrections_path or table_path.rstrip("/") + "_late"
    row_id = F.col("row_id") if "row_id" in bookings.columns else \
        F.when(F.col("delivery_id").isNull(), _row_id(*[F.col(c) for c in bookings.columns]))
    rows = bookings.select("delivery_id", "channel", "booking_date", "event_time", row_id.alias("row_id"))

    def merge(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        own = stream_id(spark, checkpoint)
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            # Per day: rows, and rows that the state store did not meet for the first time.
            found = batch.groupBy("booking_date").agg(
                (F.count_if(~F.col(FRESH)) - F.count_if(FRESH)).alias("rest")).collect()
            days = {r["booking_date"] for r in found}
            if days:
                _log_batch(spark, batch, days, {r["booking_date"] for r in found if r["rest"]}, own, batch_id)
        finally:
            batch.unpersist()
        if not days:
            return
        new = spark.read.schema(DELIVERIES).parquet(log_path).where(incremental.partition_filter("booking_date", days)) \
            .where((F.col("stream") == own) & (F.col("batch") == batch_id))
        write_partitioned(new.where("late"), corrections_path, ["stream", "batch"])
        _add_counts(spark, new, table_path, days, own, batch_id)

    def _log_batch(spark: SparkSession, batch: DataFrame, days: set, rest_days: set, own: str, batch_id: int) -> None:
        """``rest_days``: the days with rows that the state store passed over."""
        numbered = lambda df: df.withColumn("stream", F.lit(own)).withColumn("batch", F.lit(batch_id).cast("long")) \
            .select(*DELIVERIES.fieldNames())
        fresh = batch.where(FRESH).select(*DELIVERY_KEY, F.lit(False).alias("late"))
        log = spark.read.schema(DELIVERIES).parquet(log_path) if path_exists(spark, log_path) else None
        if log is not None and _streams_of(spark, log_path, days) - {own}:
            others = log.where(incremental.partition_filter("booking_date", days)).where(F.col("stream") != own)
            fresh = fresh.join(others, key_index.same_keys(fresh, others, DELIVERY_KEY), "left_anti")
        if not rest_days:
            write_partitioned(numbered(fresh), log_path, ["booking_date", "stream", "batch"])
            return
        raw = _named(batch.where(f"NOT {FRESH}").drop(FRESH).where(incremental.partition_filter("booking_date", rest_days)))
        known = batch.where(FRESH).select(*DELIVERY_KEY)
        # Of a row that the state store passed over: late if its event time is behind the watermark
        # (a row without event time or id is checked here and is not late).
        ids = raw.join(known, key_index.same_keys(raw, known, DELIVERY_KEY), "left_anti") \
            .select(*DELIVERY_KEY, (F.col("event_time").isNotNull() & ~F.col("delivery_id").startswith("row#")).alias("late"))
        rest = ids.groupBy(*DELIVERY_KEY).agg(F.max("late").alias("late"))
        if log is not None:
            earlier = log.where(incremental.partition_filter("booking_date", rest_days)) \
                .where((F.col("stream") != own) | (F.col("batch") != batch_id))
            rest = rest.join(earlier, key_index.same_keys(rest, earlier, DELIVERY_KEY), "left_anti")
        write_partitioned(numbered(fresh.unionByName(rest)), log_path, ["booking_date", "stream", "batch"])

    _each_batch(with_state(rows, DELIVERY_KEY, late_after), merge, checkpoint)


def _streams_of(spark: SparkSession, log_path: str, days: set) -> set[str]:
    """The streams that have logged deliveries of these days (from the folders' names)."""
    folders = incremental.partition_values(spark, log_path, "booking_date")
    names = [folders[k] for k in (incremental.DEFAULT_PARTITION if d is None else str(d) for d in days) if k in folders]
    return {n[len("stream="):] for f in names for n in child_names(spark, f"{log_path}/{f}") if n.startswith("stream=")}


def _add_counts(spark: SparkSession, new: DataFrame, table_path: str, days: set, own: str, batch_id: int) -> None:
    """Add a batch's deliveries to the counts of their days, once: a count that already
    holds this batch (of this stream) stays as it is."""
    empty = spark.createDataFrame([], COUNTS_TABLE)
    held = spark.read.schema(COUNTS_TABLE).parquet(table_path).where(incremental.partition_filter("booking_date", days)) \
        if path_exists(spark, table_path) else empty
    # Counts of a few days and channels: the result is staged by a checkpoint, since the write replaces what it read.
    added = new.groupBy("booking_date", "channel").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("late").alias("n_late"))
    both = held.select("booking_date", "channel", "bookings_count", "late_count", "stream", "last_batch") \
        .unionByName(added.select("booking_date", "channel", "n", "n_late"), allowMissingColumns=True) \
        .groupBy("booking_date", "channel").agg(*[F.max(c).alias(c) for c in (
            "bookings_count", "late_count", "stream", "last_batch", "n", "n_late")])
    done = F.coalesce((F.col("stream") == own) & (F.col("last_batch") >= batch_id), F.lit(False)) | F.col("n").isNull()
    plus = lambda old, n: F.coalesce(F.col(old), F.lit(0)) + F.when(done, 0).otherwise(F.col(n))
    result = both.select(
        "channel", plus("bookings_count", "n").alias("bookings_count"), plus("late_count", "n_late").alias("late_count"),
        F.when(done, F.col("stream")).otherwise(own).alias("stream"),
        F.when(done, F.col("last_batch")).otherwise(batch_id).cast("long").alias("last_batch"), "booking_date")
    write_partitioned(result.checkpoint(eager=True), table_path, ["booking_date"])


def late_rows(spark: SparkSession, table_path: str, corrections_path: str | None = None) -> DataFrame:
    """The correction table of ``daily_counts_to_table``: deliveries counted from behind the
    watermark, with the stream and micro-batch that counted them."""
    path = corrections_path or table_path.rstrip("/") + "_late"
    return spark.read.schema(DELIVERIES).parquet(path) if path_exists(spark, path) else spark.createDataFrame([], DELIVERIES)


def dedup_stream(bookings: DataFrame, output_path: str, checkpoint: str,
                 keys: Sequence[str] = ("invitee_id",),
                 columns: Sequence[str] = ("invitee_id", "channel", "booking_date", S.COL_MEMBER_USER),
                 order_by: Sequence[str] = ("arrival_time", "delivery_id"), late_after: str = LATE_AFTER,
                 key_determines_partition: bool = False) -> T.StructType:
    """One row per key, the first delivery, whenever its repetitions arrive. Returns
    the table's schema (partitioned by booking day).

    A key that the state store meets for the first time is new, unless an earlier delivery came late
    or is so old that the state has forgotten it. So while no day of the table is behind the
    watermark, only keys that the state passes over are looked up (in the key index), afterwards all.
    ``key_determines_partition`` states that a key has one booking day for ever, which
    needs no look-up at all."""
    names = [c for c in dict.fromkeys([*columns, *order_by]) if c != "booking_date"] + ["booking_date"]
    fields = [*names, *([] if "event_time" in names else ["event_time"])]
    rows = bookings.select(*fields)
    schema = rows.select(*names).schema
    index = key_index.index_path(output_path)
    spark, inherited = bookings.sparkSession, checkpoint.rstrip("/") + "_inherited"
    if path_exists(spark, output_path) and not path_exists(spark, f"{checkpoint.rstrip('/')}/offsets/0"):
        make_folder(spark, inherited)        # the table holds keys that this checkpoint's state will never know

    def merge(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            raw = batch.where(f"NOT {FRESH}").select(*names)
            located = None
            if not key_determines_partition and not path_exists(spark, inherited) \
                    and not _forgotten(spark, output_path, checkpoint, batch_id):
                fresh = batch.where(FRESH).select(*keys)
                asked = raw.select(*keys).distinct()
                located = asked.join(fresh, key_index.same_keys(asked, fresh, keys), "left_anti")
            incremental.upsert(spark, raw, output_path, keys, "booking_date", order_by, schema, keep="first",
                               key_determines_partition=key_determines_partition,
                               index=None if key_determines_partition else index, located=located)
        finally:
            batch.unpersist()

    _each_batch(with_state(rows, keys, late_after), merge, checkpoint)
    return schema


def _forgotten(spark: SparkSession, table_path: str, checkpoint: str, batch_id: int) -> bool:
    """Whether the table may hold keys that the state does not: days that the watermark has
    reached (rows that came late never were in the state, earlier ones have left it), rows without a day."""
    days = incremental.partition_values(spark, table_path, "booking_date")
    mark = batch_watermark(spark, checkpoint, batch_id)
    if mark is None:
        return incremental.DEFAULT_PARTITION in days
    return any(d == incremental.DEFAULT_PARTITION or d <= str(mark.date()) for d in days)


def upsert_stream(rows: DataFrame, table_path: str, checkpoint: str, keys: Sequence[str],
                  partition_col: str, order_by: Sequence[str], schema: T.StructType,
                  key_determines_partition: bool = False, keep: str = "last", index: bool = True) -> None:
    """T5: MERGE every micro-batch into a keyed, partitioned table. With
    ``keep="first"`` this is a deduplicating stream whose state is the table: each
    batch is reduced per key by a partial aggregate before any shuffle (a hot key
    never lands whole in one task), and only the touched partitions are read. Where the keys live
    comes from the key index beside the table (``index``): of it, only the buckets
    of the batch's keys are read."""

    def merge(batch: DataFrame, batch_id: int) -> None:
        incremental.upsert(batch.sparkSession, batch, table_path, keys, partition_col, order_by, schema,
                           key_determines_partition=key_determines_partition, keep=keep,
                           index=key_index.index_path(table_path) if index else None)

    _run(rows.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
