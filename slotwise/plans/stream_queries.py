"""Streaming queries: each runs a Structured Streaming query over the driver's
``events`` files until it has processed them (``availableNow``), then returns the
table the stream maintains."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slotwise import schemas as S
from slotwise.plans.batch_queries import _LATEST, _SILVER_BOOKINGS
from slotwise.plans.catalog import register
from slotwise.plans.oracle_sql import with_ctes
from slotwise.session import scratch_path
from slotwise.sources import model
from slotwise.sources.tables import read_columnar, read_table, table_glob
from slotwise.streaming import bookings as stream


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = read_table(spark, sf_dir, "events").schema  # footer only
    return stream.events_stream(spark, table_glob(sf_dir, "events"), schema)


@register("stream_daily_bookings", covers="T1 T2 T4 T5 D13", oracle=with_ctes(["enriched"], """
SELECT booking_date, channel, COUNT(*) AS bookings_count FROM enriched GROUP BY 1, 2"""))
def q_stream_daily_bookings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Streamed bookings counted per day and channel, merged per batch."""
    table, ckpt = scratch_path(spark, "stream-daily"), scratch_path(spark, "ckpt-daily")
    stream.daily_counts_to_table(stream.booking_stream(_events(spark, sf_dir)), table, ckpt)
    return read_columnar(spark, table, schema=stream.DAILY_COUNTS).select("booking_date", "channel", "bookings_count")


@register("stream_dedup", covers="T1 T2 T3", oracle=with_ctes(["enriched"], """
SELECT DISTINCT invitee_id, channel, booking_date, data_payload_scheduled_event_event_memberships_user
FROM enriched"""))
def q_stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Streamed bookings without repeated deliveries of an invitee."""
    out, ckpt = scratch_path(spark, "stream-dedup"), scratch_path(spark, "ckpt-dedup")
    schema = stream.dedup_stream(stream.booking_stream(_events(spark, sf_dir)), out, ckpt)
    return spark.read.schema(schema).parquet(out).select("invitee_id", "channel", "booking_date", S.COL_MEMBER_USER)


@register("stream_upsert", covers="T1 T5 D13 D6", oracle=with_ctes(["booking_facts"], """
SELECT invitee_id, event_id, ingestion_time, data_event,
  CAST(data_payload_scheduled_event_start_time AS DATE) AS booking_date,
  CAST(ingestion_time AS DATE) AS ingestion_date
FROM latest""", [_LATEST]))
def q_stream_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T5: streamed deliveries merged into the Silver booking table per micro-batch."""
    facts = model.booking_facts(_events(spark, sf_dir))
    rows = facts.select("invitee_id", "event_id", "ingestion_time", S.COL_EVENT,
                        F.to_date(S.COL_START_TIME).alias("booking_date"),
                        F.to_date("ingestion_time").alias("ingestion_date"))
    # A key moves between arrival days; the key index beside the table says where it lives.
    table, ckpt = scratch_path(spark, "stream-silver"), scratch_path(spark, "ckpt-silver")
    stream.upsert_stream(rows, table, ckpt, ["invitee_id"], "ingestion_date",
                         ["ingestion_time", "event_id"], _SILVER_BOOKINGS)
    return read_columnar(spark, table, schema=_SILVER_BOOKINGS)


_FIRST = """
first_delivery AS (
  SELECT * FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY invitee_id ORDER BY ingestion_time ASC, event_id ASC) AS rn
    FROM booking_facts) s
  WHERE rn = 1
)"""


@register("stream_dedup_merge", covers="T1 T3 T5 D6 D13", oracle=with_ctes(["booking_facts"], """
SELECT invitee_id, event_id, ingestion_time, data_event,
  CAST(data_payload_scheduled_event_start_time AS DATE) AS booking_date,
  CAST(ingestion_time AS DATE) AS ingestion_date
FROM first_delivery""", [_FIRST]))
def q_stream_dedup_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T3 without per-key state skew: every micro-batch merged into a table keyed by
    invitee that keeps the first delivery; the table is partitioned by booking day,
    which the key determines, so a merge reads only the days it touches."""
    facts = model.booking_facts(_events(spark, sf_dir))
    rows = facts.select("invitee_id", "event_id", "ingestion_time", S.COL_EVENT,
                        F.to_date(S.COL_START_TIME).alias("booking_date"),
                        F.to_date("ingestion_time").alias("ingestion_date"))
    table, ckpt = scratch_path(spark, "stream-first"), scratch_path(spark, "ckpt-first")
    schema = T.StructType([f for f in _SILVER_BOOKINGS.fields if f.name != "booking_date"]
                          + [T.StructField("booking_date", T.DateType())])
    stream.upsert_stream(rows, table, ckpt, ["invitee_id"], "booking_date", ["ingestion_time", "event_id"],
                         schema, key_determines_partition=True, keep="first")
    return read_columnar(spark, table, schema=schema)


@register("stream_daily_from_documents", covers="T1 T2 T4 T5", oracle=with_ctes([], """
SELECT CAST(ts AS DATE) AS booking_date,
  CASE event_type WHEN 'click' THEN 'facebook' WHEN 'view' THEN 'youtube' WHEN 'purchase' THEN 'tiktok' ELSE 'others' END
    AS channel,
  COUNT(DISTINCT CAST(event_id AS VARCHAR)) AS bookings_count
FROM events WHERE event_type <> 'error' GROUP BY 1, 2"""))
def q_stream_daily_from_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Webhook documents as a stream up to the daily counts table."""
    from slotwise.plans.ingest_queries import bronze_event_documents
    bronze = bronze_event_documents(spark, sf_dir)
    table, ckpt = scratch_path(spark, "stream-doc-daily"), scratch_path(spark, "ckpt-doc-daily")
    docs = stream.document_booking_stream(stream.document_stream(spark, bronze, schema=S.BOOKING_COUNT_DOC))
    stream.daily_counts_to_table(docs, table, ckpt)
    return read_columnar(spark, table, schema=stream.DAILY_COUNTS).select("booking_date", "channel", "bookings_count")


# ------------------------------------------------- late rows, rows without ids, moving keys
def _in_batches(spark: SparkSession, df: DataFrame, batches: int) -> DataFrame:
    """``df`` as a stream of about ``batches`` micro-batches of unordered rows, however many
    files the session deals them to (a batch is bounded by its bytes)."""
    root = scratch_path(spark, "unordered-files")
    df.repartition(batches, F.xxhash64(*df.columns)).write.parquet(root)
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    size = path.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(path).getLength()
    return stream.events_stream(spark, root, df.schema, max_bytes_per_trigger=max(1, size // batches))


@register("stream_late_corrections", covers="T1 T2 T3 T4 T5", oracle=with_ctes(["enriched"], """
SELECT booking_date, channel, COUNT(*) AS bookings_count FROM enriched GROUP BY 1, 2"""))
def q_stream_late_corrections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three unordered files, a micro-batch each; what comes behind the watermark is in the
    correction table. On-time counts and corrections together are the batch result."""
    events = _in_batches(spark, read_table(spark, sf_dir, "events"), 3)
    table, ckpt = scratch_path(spark, "stream-late"), scratch_path(spark, "ckpt-late")
    stream.daily_counts_to_table(stream.booking_stream(events), table, ckpt)
    on_time = spark.read.schema(stream.COUNTS_TABLE).parquet(table).select(
        "booking_date", "channel", (F.col("bookings_count") - F.col("late_count")).alias("n"))
    late = stream.late_rows(spark, table).groupBy("booking_date", "channel").agg(F.count(F.lit(1)).alias("n"))
    return on_time.unionByName(late).groupBy("booking_date", "channel").agg(F.sum("n").alias("bookings_count"))


@register("stream_daily_without_ids", covers="T1 T2 T4", oracle=with_ctes([], """
SELECT CAST(ts AS DATE) AS booking_date,
  CASE event_type WHEN 'click' THEN 'facebook' WHEN 'view' THEN 'youtube' WHEN 'purchase' THEN 'tiktok' ELSE 'others' END
    AS channel, COUNT(*) AS bookings_count
FROM events WHERE event_type <> 'error' GROUP BY 1, 2"""))
def q_stream_daily_without_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T4: webhook documents of which every fifth has no ``uri``; each counts once, and once
    only when a second checkpoint reads the same files again."""
    from slotwise.sinks.writers import write_json_lines
    docs = model.booking_documents(read_table(spark, sf_dir, "events"))
    number = F.regexp_extract("data.payload.scheduled_event.uri", "([0-9]+)$", 1).cast("long")
    uri = F.when(number % 5 != 0, F.col("data.payload.uri"))
    bronze = scratch_path(spark, "bronze-without-ids")
    write_json_lines(docs.withColumn("data", F.col("data").withField("payload.uri", uri)), bronze, "event_date")
    table = scratch_path(spark, "stream-without-ids")
    for _ in range(2):
        bookings = stream.document_booking_stream(stream.document_stream(spark, bronze, schema=S.BOOKING_COUNT_DOC))
        stream.daily_counts_to_table(bookings, table, scratch_path(spark, "ckpt-without-ids"))
    return read_columnar(spark, table, schema=stream.DAILY_COUNTS).select("booking_date", "channel", "bookings_count")


@register("stream_dedup_moving_days", covers="T1 T3 D13", oracle=with_ctes(["enriched"], """
SELECT invitee_id, channel, booking_date, data_payload_scheduled_event_event_memberships_user FROM (
  SELECT 'user-' || regexp_extract(data_payload_scheduled_event_event_memberships_user, '([0-9]+)$', 1) AS invitee_id,
    channel, booking_date, data_payload_scheduled_event_event_memberships_user,
    ROW_NUMBER() OVER (PARTITION BY data_payload_scheduled_event_event_memberships_user
                       ORDER BY ingestion_time, CAST(event_id AS VARCHAR)) AS rn
  FROM enriched) s
WHERE rn = 1"""))
def q_stream_dedup_moving_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An invitee (here: a user) who books on many days has one row, the first
    delivery, over two unordered micro-batches."""
    events = _in_batches(spark, read_table(spark, sf_dir, "events"), 2)
    bookings = stream.booking_stream(events) \
        .withColumn("invitee_id", F.concat(F.lit("user-"), F.regexp_extract(S.COL_MEMBER_USER, "([0-9]+)$", 1)))
    out, ckpt = scratch_path(spark, "stream-moving"), scratch_path(spark, "ckpt-moving")
    schema = stream.dedup_stream(bookings, out, ckpt)
    return spark.read.schema(schema).parquet(out).select("invitee_id", "channel", "booking_date", S.COL_MEMBER_USER)
