"""Ingest queries: JSON sources and sinks, manifests, flatten, partition overwrite.

Each writes below the shared folder (``spark.checkpoint.dir``) and reads its own
output back, so the result checks the whole round trip.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slotwise import schemas as S
from slotwise.operators import spend
from slotwise.operators.flatten import flatten
from slotwise.plans.catalog import register
from slotwise.plans.oracle_sql import with_ctes
from slotwise.session import scratch_path
from slotwise.sinks import writers
from slotwise.sources import json_io, model
from slotwise.sources.tables import read_table

# ----------------------------------------------------------------- oracle pieces
_SPEND_RECORDS_ALIGNED = """
spend_records_aligned AS (
  SELECT CAST(DATE '2024-01-01' + CAST(o_orderkey % 30 AS INTEGER) AS VARCHAR) AS date,
    CASE o_orderpriority WHEN '1-URGENT' THEN 'facebook_paid_ads' WHEN '2-HIGH' THEN 'youtube_paid_ads'
      WHEN '3-MEDIUM' THEN 'tiktok_paid_ads' WHEN '4-NOT SPECIFIED' THEN 'linkedin_paid_ads'
      WHEN '5-LOW' THEN 'podcast_paid_ads' END AS channel,
    o_totalprice AS spend, o_orderkey AS position
  FROM orders
)"""

_FIRST_ALIGNED = """
first_aligned AS (
  SELECT date, channel, spend FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY date, channel ORDER BY position) AS rn
    FROM spend_records_aligned
    WHERE channel IN ('youtube_paid_ads', 'facebook_paid_ads', 'tiktok_paid_ads')) s
  WHERE rn = 1
)"""

_FIRST_RAW_ALIGNED = """
first_raw_aligned AS (
  SELECT date, channel, spend FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY date, channel ORDER BY position) AS rn
    FROM spend_aligned_raw
    WHERE channel IN ('youtube_paid_ads', 'facebook_paid_ads', 'tiktok_paid_ads')) s
  WHERE rn = 1
)"""

_DOCS = """
docs AS (
  SELECT *,
    CASE WHEN event_id % 10 = 0 THEN ts - INTERVAL 1 SECOND
         ELSE ts + to_hours(CAST(k % 72 AS BIGINT)) + INTERVAL 1 SECOND END AS ing
  FROM (SELECT *, TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events) e
)"""

_FLAT = """
flat AS (
  SELECT
    CAST(CAST(ing AS DATE) AS VARCHAR) AS event_date,
    strftime(ing, '%Y-%m-%dT%H:%M:%S.%f') AS ingestion_time,
    CASE WHEN event_type = 'error' THEN 'invitee.canceled' ELSE 'invitee.created' END AS data_event,
    strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') AS data_created_at,
    'https://api.example.com/scheduled_events/' || CAST(event_id AS VARCHAR) || '/invitees/'
      || CAST(user_id AS VARCHAR) || '-' || event_type || '-' || strftime(ts, '%Y%m%d') AS data_payload_uri,
    'invitee' || CAST(event_id AS VARCHAR) || '@example.com' AS data_payload_email,
    (k % 7 = 0) AS data_payload_rescheduled,
    a.j AS data_payload_questions_and_answers_position,
    'answer-' || CAST(a.j AS VARCHAR) AS data_payload_questions_and_answers_answer,
    'https://api.example.com/event_types/' || event_type AS data_payload_scheduled_event_event_type,
    strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') AS data_payload_scheduled_event_start_time,
    CASE WHEN m.i = 1 THEN 'https://api.example.com/users/cohost-' || CAST(user_id AS VARCHAR)
         WHEN event_id % 97 = 0 THEN 'https://api.example.com/teams/' || CAST(user_id AS VARCHAR)
         ELSE 'https://api.example.com/users/' || CAST(user_id AS VARCHAR) END
      AS data_payload_scheduled_event_event_memberships_user,
    CASE WHEN k % 4 = 0 THEN 'guest' || CAST(event_id AS VARCHAR) || '@example.com' END
      AS data_payload_scheduled_event_event_guests,
    CAST(CASE WHEN event_type = 'error' THEN 0 ELSE 1 END AS BIGINT)
      AS data_payload_scheduled_event_invitees_counter_active,
    CASE k % 5 WHEN 0 THEN 'facebook' WHEN 1 THEN 'youtube' WHEN 2 THEN 'tiktok'
               WHEN 3 THEN 'newsletter' END AS data_payload_tracking_utm_source,
    event_type AS data_payload_scheduled_event_name
  FROM docs
  JOIN (VALUES (0), (1)) m(i) ON m.i = 0 OR docs.event_id % 2 = 1
  LEFT JOIN (VALUES (CAST(0 AS BIGINT)), (CAST(1 AS BIGINT))) a(j) ON a.j < docs.k % 3
)"""

FLAT_COLUMNS = [
    "event_date", "ingestion_time", "data_event", "data_created_at", "data_payload_uri",
    "data_payload_email", "data_payload_rescheduled",
    "data_payload_questions_and_answers_position", "data_payload_questions_and_answers_answer",
    "data_payload_scheduled_event_event_type", "data_payload_scheduled_event_start_time",
    "data_payload_scheduled_event_event_memberships_user", "data_payload_scheduled_event_event_guests",
    "data_payload_scheduled_event_invitees_counter_active", "data_payload_tracking_utm_source",
]


#: Documents of one multi-line file, about (files are dealt by hash).
DOCUMENTS_PER_FILE = 500


# ----------------------------------------------------------------- shared steps
def bronze_event_documents(spark: SparkSession, sf_dir: str) -> str:
    """Write the booking documents as Bronze JSON lines, one folder per arrival day."""
    root = scratch_path(spark, "bronze-events")
    docs = model.booking_documents(model.by_arrival_day(read_table(spark, sf_dir, "events")))
    writers.write_json_lines(docs, root, "event_date", dealt=True)
    return root


def fact_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze documents -> flattened ``fact_events`` (with ``event_date``)."""
    root = bronze_event_documents(spark, sf_dir)
    return flatten(json_io.read_event_documents(spark, root, layout="lines"))


def raw_spend_files(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    """Raw spend as published: JSON arrays per day in ``spend_data_<day>.json`` and, for large
    days, further numbered files (no field for the place in them), and their manifest."""
    raw = model.spend_raw(read_table(spark, sf_dir, "orders"), aligned=True)
    data_root, index_root = scratch_path(spark, "spend-raw"), scratch_path(spark, "spend-index")
    files = writers.write_daily_arrays(raw, data_root, "date", order_by=["position"], prefix=S.SPEND_FILE_PREFIX)
    names = spark.createDataFrame([(f,) for f in files], "file_name string") \
        .withColumn("month", F.substring("file_name", len(S.SPEND_FILE_PREFIX) + 1, 7))
    writers.write_manifest(names, index_root, group_col="month")
    return data_root, index_root


# ----------------------------------------------------------------- queries
@register("event_flatten", covers="S7 E14 X1 X2 X3 X4 X5 P3 K2 G7",
          oracle=with_ctes([], f"SELECT {', '.join(FLAT_COLUMNS)} FROM flat", [_DOCS, _FLAT]))
def q_event_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze webhook documents written as JSON and flattened into fact_events."""
    return fact_events(spark, sf_dir).select(*FLAT_COLUMNS)


@register("meeting_load_flattened", covers="X4 G5 A7 E1", oracle=with_ctes([], """
SELECT regexp_extract(data_payload_scheduled_event_event_memberships_user, 'users/([a-zA-Z0-9-]+)', 1) AS user_id,
  COUNT(*) AS total_meetings_count,
  COUNT(DISTINCT data_payload_uri) AS distinct_bookings
FROM flat WHERE data_event = 'invitee.created' GROUP BY 1""", [_DOCS, _FLAT]))
def q_meeting_load_flattened(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G5 over the flattened table: ``total_meetings_count`` counts flattened rows
    (members x answers, as the Gold job does); ``distinct_bookings`` counts each
    booking once per employee."""
    from slotwise.operators import gold
    enriched = gold.enrich(fact_events(spark, sf_dir))
    return (enriched
            .groupBy(F.regexp_extract(S.COL_MEMBER_USER, S.USER_ID_PATTERN, 1).alias("user_id"))
            .agg(F.count(F.lit(1)).alias("total_meetings_count"),
                 F.count_distinct("data_payload_uri").alias("distinct_bookings")))


@register("spend_json_roundtrip", covers="K1 K8 F3 S6 E13 F4 G6", oracle=with_ctes([], """
SELECT date, date AS spend_date, replace(channel, '_paid_ads', '') AS channel, spend FROM first_aligned""",
                                                                    [_SPEND_RECORDS_ALIGNED, _FIRST_ALIGNED]))
def q_spend_json_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze spend (first record per listed company and day) written as one JSON
    array per day, read back as multi-line JSON and cleaned into fact_marketing."""
    bronze = spend.listed_first(model.spend_records(read_table(spark, sf_dir, "orders"), aligned=True))
    root = scratch_path(spark, "bronze-spend")
    writers.write_daily_arrays(bronze, root, "date")
    return spend.clean_spend(json_io.read_spend_files(spark, root, layout="array"))


@register("spend_json_lines_roundtrip", covers="K2 S6 S9", oracle=with_ctes(["fact_marketing_aligned"], """
SELECT date, spend_date, channel, spend FROM fact_marketing_aligned"""))
def q_spend_json_lines_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K2: fact_marketing written as JSON lines by day and read back."""
    fact = spend.clean_spend(model.spend_raw(read_table(spark, sf_dir, "orders"), aligned=True))
    root = scratch_path(spark, "spend-lines")
    writers.write_json_lines(fact, root, "spend_date")
    # The schema names the partition column, so ``spend_date`` stays text.
    back = json_io.read_json(spark, root, S.FACT_MARKETING, "lines")
    return back.select("date", "spend_date", "channel", "spend")


@register("manifest_load", covers="S1 S2 S3 S4 S10 F5 J5 E3 G6", oracle=with_ctes(["spend_aligned_raw"], """
SELECT date, date AS spend_date, replace(channel, '_paid_ads', '') AS channel, spend
FROM first_raw_aligned WHERE spend IS NOT NULL""", [_FIRST_RAW_ALIGNED]))
def q_manifest_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The spend load: raw day files (one JSON array each, ``spend_data_<day>.json``)
    and a manifest naming them; every listed file is read in one scan, the day is
    taken from the file name, the first record per listed company and day is kept,
    and the result is cleaned into fact_marketing."""
    data_root, index_root = raw_spend_files(spark, sf_dir)
    records = spend.with_file_date(json_io.load_listed_files(spark, data_root, index_root))
    bronze = spend.listed_first(records, day_col="file_date")
    return spend.clean_spend(bronze)


@register("partition_overwrite", covers="K4 K5 D10 S8 S9 S10 U2", oracle=with_ctes(["fact_marketing_aligned"], """
SELECT date, spend_date, channel, spend FROM fact_marketing_aligned WHERE date < '2024-01-21'
UNION ALL
SELECT date, spend_date, channel, spend FROM fact_marketing_aligned WHERE date >= '2024-01-21' AND spend >= 0"""))
def q_partition_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """fact_marketing written by day; a corrected batch for the days from 2024-01-21
    (negative spend removed) then replaces only those day partitions."""
    fact = spend.clean_spend(model.spend_raw(read_table(spark, sf_dir, "orders"), aligned=True))
    root = scratch_path(spark, "fact-marketing")
    writers.write_partitioned(fact, root, ["date"])
    correction = fact.filter((F.col("date") >= "2024-01-21") & (F.col("spend") >= 0))
    writers.write_partitioned(correction, root, ["date"])
    # Read every data file of every day folder as one table (a glob over the
    # partition folders; basePath keeps ``date`` as a column).
    files = spark.read.schema(S.FACT_MARKETING).option("basePath", root).parquet(f"{root}/date=*/*.parquet")
    return files.select("date", "spend_date", "channel", "spend")


_MEDALLION = """
fe AS (
  SELECT CASE data_payload_scheduled_event_event_type
      WHEN 'https://api.example.com/event_types/click' THEN 'facebook'
      WHEN 'https://api.example.com/event_types/view' THEN 'youtube'
      WHEN 'https://api.example.com/event_types/purchase' THEN 'tiktok' ELSE 'others' END AS channel
  FROM flat WHERE data_event = 'invitee.created'
),
fm AS (SELECT replace(channel, '_paid_ads', '') AS channel, spend FROM first_raw_aligned WHERE spend IS NOT NULL),
mcpb AS (
  SELECT d.channel, COALESCE(bk.n, 0) AS total_bookings_count, COALESCE(sp.s, 0.0) AS total_spend,
    CASE WHEN COALESCE(bk.n, 0) = 0 THEN 0.0 ELSE COALESCE(sp.s, 0.0) / COALESCE(bk.n, 0) END AS cpb
  FROM dim d
  LEFT JOIN (SELECT channel, COUNT(*) AS n FROM fe GROUP BY channel) bk ON bk.channel = d.channel
  LEFT JOIN (SELECT CASE WHEN channel IN ('facebook', 'youtube', 'tiktok') THEN channel ELSE 'others' END AS channel,
                    CAST(CAST(SUM(CAST(CAST(spend AS VARCHAR) AS DECIMAL(28, 10))) AS VARCHAR) AS DOUBLE) AS s
             FROM fm GROUP BY 1) sp ON sp.channel = d.channel
)"""


@register("medallion_leaderboard", covers="S1 S2 S6 S7 S8 X1 K3 K1 K4 K5 K6 K7 A8 G2 G3 G6 G7",
          oracle=with_ctes(["dim", "spend_aligned_raw"], """
SELECT *, CAST(DENSE_RANK() OVER (ORDER BY total_bookings_count DESC) AS INTEGER) AS rank_by_volume,
  CAST(DENSE_RANK() OVER (ORDER BY cpb ASC NULLS LAST) AS INTEGER) AS rank_by_cpb
FROM mcpb""", [_DOCS, _FLAT, _FIRST_RAW_ALIGNED, _MEDALLION]))
def q_medallion_leaderboard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole flow: Bronze webhook documents -> Silver ``fact_events`` (flattened,
    by arrival day); raw spend day files + manifest -> Bronze day arrays -> Silver
    ``fact_marketing`` (by day); both Silver tables -> the five Gold tables,
    registered in a database; the leaderboard read back through the catalog.
    Counts are over flattened rows, as the Gold layer counts them."""
    from slotwise.plans.jobs import bronze_spend_job, gold_job, silver_events_job, silver_marketing_job
    silver_events = scratch_path(spark, "silver-fact-events")
    silver_marketing = scratch_path(spark, "silver-fact-marketing")

    def events_chain() -> None:
        silver_events_job(spark, bronze_event_documents(spark, sf_dir), silver_events, layout="lines", dealt=True)

    def spend_chain() -> None:
        raw_root, index_root = raw_spend_files(spark, sf_dir)
        bronze_spend = scratch_path(spark, "bronze-spend")
        bronze_spend_job(spark, raw_root, index_root, bronze_spend)
        silver_marketing_job(spark, bronze_spend, silver_marketing)

    # The two Silver chains are independent: run them side by side.
    writers.run_concurrently([events_chain, spend_chain])
    fact_events_table = spark.read.parquet(silver_events)
    fact_marketing_table = spark.read.schema(S.FACT_MARKETING).parquet(silver_marketing)
    gold_root = scratch_path(spark, "gold-medallion")
    gold_job(spark, fact_events_table, fact_marketing_table, gold_root, database="slotwise_medallion")
    return spark.table("slotwise_medallion.gold_channel_attribution")


@register("daily_bookings_booking_grain", covers="X4 G1 A1 D6",
          oracle=with_ctes(["daily"], "SELECT booking_date, channel, bookings_count, booking_week FROM daily"))
def q_daily_bookings_booking_grain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G1 over the flattened events at booking grain (one row per invitee URI): the
    answers x members fan-out of the flatten does not inflate the counts."""
    from slotwise.operators import gold
    fact = gold.at_booking_grain(fact_events(spark, sf_dir).select(
        "data_payload_uri", S.COL_EVENT, S.COL_EVENT_TYPE, S.COL_START_TIME))
    return gold.daily_bookings_by_channel(gold.enrich(fact))


@register("stream_silver_events", covers="T1 S7 X1 X2 X3 X4 K4 G7",
          oracle=with_ctes([], f"SELECT {', '.join(FLAT_COLUMNS)} FROM flat", [_DOCS, _FLAT]))
def q_stream_silver_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze webhook documents ingested as a stream, flattened per micro-batch into
    the day-partitioned ``fact_events`` table, read back as a table."""
    from slotwise.streaming import bookings as stream
    bronze = bronze_event_documents(spark, sf_dir)
    silver, ckpt = scratch_path(spark, "stream-fact-events"), scratch_path(spark, "ckpt-fact-events")
    stream.silver_events_stream(stream.document_stream(spark, bronze), silver, ckpt)
    table = spark.read.parquet(silver)  # the day folder is read back as a DATE: keep it text
    return table.withColumn("event_date", F.col("event_date").cast("string")).select(*FLAT_COLUMNS)


@register("flatten_two_arrays", covers="X3 X4 A1", oracle=with_ctes([], """
SELECT data_payload_uri, COUNT(*) AS flattened_rows FROM flat GROUP BY data_payload_uri""", [_DOCS, _FLAT]))
def q_flatten_two_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per booking after the flatten: members x max(1, answers) (two arrays in
    one document multiply; an empty array keeps one row)."""
    return (fact_events(spark, sf_dir).groupBy("data_payload_uri")
            .agg(F.count(F.lit(1)).alias("flattened_rows")))


@register("silver_event_names", covers="A10 F6 S8", oracle=with_ctes([], """
SELECT DISTINCT data_payload_scheduled_event_event_type, data_payload_scheduled_event_name FROM flat
WHERE data_payload_scheduled_event_event_type IN ('https://api.example.com/event_types/click',
  'https://api.example.com/event_types/view', 'https://api.example.com/event_types/purchase')""", [_DOCS, _FLAT]))
def q_silver_event_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Meeting names in the flattened fact_events for each paid channel's event type."""
    from slotwise.operators import report
    fact = fact_events(spark, sf_dir).filter(F.col(S.COL_EVENT_TYPE).isin(list(S.CHANNEL_URIS)))
    return report.distinct_values(fact, S.COL_EVENT_TYPE, "data_payload_scheduled_event_name")


_PROFILE_TYPES = {"data_payload_rescheduled": "boolean", "data_payload_questions_and_answers_position": "bigint",
                  "data_payload_scheduled_event_invitees_counter_active": "bigint"}
_PROFILE_SQL = "\nUNION ALL\n".join(
    f"SELECT {i} AS position, '{c}' AS column_name, '{_PROFILE_TYPES.get(c, 'string')}' AS data_type, "
    f"COUNT(*) AS rows, COUNT({c}) AS non_null FROM flat" for i, c in enumerate(FLAT_COLUMNS))


@register("fact_events_profile", covers="A13 A8 X1", oracle=with_ctes([], _PROFILE_SQL, [_DOCS, _FLAT]))
def q_fact_events_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row and non-NULL counts per column of the flattened fact_events, in one pass."""
    from slotwise.operators import report
    return report.column_profile(fact_events(spark, sf_dir).select(*FLAT_COLUMNS))


@register("spend_ingest_lines", covers="S1 S2 S3 K2 F8 P5", oracle=with_ctes(["spend_aligned_raw"], """
SELECT date, channel, spend, date AS spend_date FROM spend_aligned_raw"""))
def q_spend_ingest_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The older spend ingest: every record of every listed day file, spend as a
    number, the day from the file name, written as JSON lines by day and read back."""
    from slotwise.plans.jobs import ingest_spend_lines_job
    raw_root, index_root = raw_spend_files(spark, sf_dir)
    out = scratch_path(spark, "spend-lines-ingest")
    ingest_spend_lines_job(spark, raw_root, index_root, out)
    return json_io.read_json(spark, out, S.SPEND_LINES, "lines").select("date", "channel", "spend", "spend_date")


@register("event_documents_multiline", covers="S5 S7 X1 X3 G7",
          oracle=with_ctes([], f"SELECT {', '.join(FLAT_COLUMNS)} FROM flat", [_DOCS, _FLAT]))
def q_event_documents_multiline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Indented webhook documents read with the multi-line scan and flattened. A file
    holds one JSON value: an array of at most ``DOCUMENTS_PER_FILE`` documents."""
    docs = model.booking_documents(read_table(spark, sf_dir, "events"))
    doc = F.struct("ingestion_time", "source", "data")
    dealt = docs.select(doc.alias("doc"), "event_date", F.xxhash64(doc).alias("h"))
    sizes = dealt.groupBy("event_date").agg(F.ceil(F.count(F.lit(1)) / DOCUMENTS_PER_FILE).alias("files"))
    dealt = dealt.join(sizes, "event_date").withColumn("file_no", F.pmod("h", F.col("files")))
    values = dealt.groupBy("event_date", "file_no").agg(F.to_json(F.collect_list("doc"), {"pretty": "true"}).alias("value"))
    root = scratch_path(spark, "bronze-multiline")
    values.write.option("compression", "lz4").partitionBy("event_date", "file_no").text(root)
    return flatten(json_io.read_event_documents(spark, root, layout="document")).select(*FLAT_COLUMNS)


_SILVER_FROM_DOCS = """
facts AS (
  SELECT event_id, CAST(user_id AS VARCHAR) || '-' || event_type || '-' || strftime(ts, '%Y%m%d') AS invitee_id,
    ts AS created, ing, event_type, user_id,
    CASE WHEN event_id % 2 = 1 THEN 'cohost' ELSE 'user' END || CAST(user_id AS VARCHAR) || '@example.com' AS employee_email
  FROM docs
),
latest_docs AS (
  SELECT * FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY invitee_id
      ORDER BY ing DESC, 'https://api.example.com/scheduled_events/' || CAST(event_id AS VARCHAR) DESC) AS rn
    FROM facts) s WHERE rn = 1
)"""


@register("silver_bookings_from_documents", covers="D2 D4 D5 D6 D9 T2", oracle=with_ctes([], """
SELECT CAST(created AS DATE) AS event_date, invitee_id, CAST(created AS DATE) AS booking_date,
  CASE event_type WHEN 'click' THEN 'facebook' WHEN 'view' THEN 'youtube' WHEN 'purchase' THEN 'tiktok'
    ELSE 'others' END AS channel,
  employee_email, created AS event_start_time, CAST(ing AS DATE) AS ingestion_date,
  CASE WHEN created > ing THEN 'created_after_ingestion' ELSE '' END AS reject_reasons
FROM latest_docs""", [_DOCS, _SILVER_FROM_DOCS]))
def q_silver_bookings_from_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze documents through the Silver jobs: facts, then the documented bookings and
    the quarantine, both read back."""
    from slotwise.plans.jobs import silver_bookings_job, silver_events_job
    events, bookings, quarantine = (scratch_path(spark, n) for n in ("silver-events", "silver-bookings", "quarantine"))
    silver_events_job(spark, bronze_event_documents(spark, sf_dir), events, layout="lines", dealt=True)
    silver_bookings_job(spark, spark.read.parquet(events), bookings, quarantine)
    columns = ["event_date", "invitee_id", "booking_date", "channel", "employee_email", "event_start_time", "ingestion_date"]
    good = spark.read.parquet(bookings).select(*columns, F.lit("").alias("reject_reasons"))
    return good.unionByName(spark.read.parquet(quarantine).select(*columns, "reject_reasons"))


@register("utm_attribution_from_documents", covers="D16", oracle=with_ctes([], """
SELECT CASE WHEN data_payload_tracking_utm_source IS NOT NULL
            THEN CASE WHEN data_payload_tracking_utm_source IN ('facebook', 'youtube', 'tiktok')
                      THEN data_payload_tracking_utm_source ELSE 'others' END
            ELSE CASE data_payload_scheduled_event_name WHEN 'click' THEN 'facebook' WHEN 'view' THEN 'youtube'
                      WHEN 'purchase' THEN 'tiktok' ELSE 'others' END END AS channel,
  CASE WHEN data_payload_tracking_utm_source IS NOT NULL THEN 'utm' ELSE 'event_type' END AS attributed_by,
  COUNT(DISTINCT data_payload_uri) AS bookings_count
FROM flat WHERE data_event = 'invitee.created' GROUP BY 1, 2""", [_DOCS, _FLAT]))
def q_utm_attribution_from_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D16 over the flattened documents, each booking counted once."""
    from slotwise.operators import contracts, gold, metrics
    facts = gold.at_booking_grain(contracts.from_fact_events(fact_events(spark, sf_dir)))
    by_campaign = metrics.utm_attribution(gold.enrich(facts))
    return by_campaign.groupBy("channel", "attributed_by").agg(F.sum("bookings_count").alias("bookings_count"))


@register("gold_channel_map", covers="P7 G2 A2", oracle=with_ctes([], """
SELECT CASE data_payload_scheduled_event_name WHEN 'signup' THEN 'facebook' WHEN 'click' THEN 'tiktok' ELSE 'others' END
    AS channel, COUNT(*) AS total_bookings_count
FROM flat WHERE data_event = 'invitee.created' GROUP BY 1""", [_DOCS, _FLAT]))
def q_gold_channel_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bookings per channel under a channel map given by the caller."""
    from slotwise.operators import gold
    mapping = {S.EVENT_TYPE_BASE + "signup": "facebook", S.EVENT_TYPE_BASE + "click": "tiktok"}
    return gold.enrich(fact_events(spark, sf_dir), mapping).groupBy("channel") \
        .agg(F.count(F.lit(1)).alias("total_bookings_count"))


# ------------------------------------------------- new input, open documents, changed days
@register("ledger_arrivals", covers="D11 S1 S2 S6 S7 K5", oracle=with_ctes(["spend_aligned_raw"], """
SELECT date AS spend_date, channel, COUNT(*) AS records, COUNT(spend) AS amounts,
  CASE WHEN CAST(date AS DATE) < DATE '2024-01-11' THEN 1 WHEN date = '2024-01-15' THEN 3 ELSE 2 END AS last_run,
  CASE WHEN date = '2024-01-15' THEN 2 ELSE 1 END AS loads
FROM spend_aligned_raw WHERE date <> '2024-01-15' OR position % 2 = 0 GROUP BY 1, 2"""))
def q_ledger_arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spend files arrive three times: ten days, the other days, and one day's file
    again with half of its records. Each run loads only what the ledger does not hold, and a
    run in between finds nothing. Per day and channel: records, and from the ledger
    in which run the day was loaded last and how many states of its files were loaded."""
    from slotwise.sources import ledger
    raw = model.spend_raw(read_table(spark, sf_dir, "orders"), aligned=True)
    folder, book, table = (scratch_path(spark, n) for n in ("spend-arrivals", "ledger", "spend-table"))
    day = F.col("date").cast("date")
    arrivals = [raw.where(day < "2024-01-11"), raw.where(day >= "2024-01-11"),
                raw.where((F.col("date") == "2024-01-15") & (F.col("position") % 2 == 0))]
    for number, arrival in enumerate(arrivals):
        staging = scratch_path(spark, "spend-arrival")
        names = writers.write_daily_arrays(arrival, staging, "date", order_by=["position"], prefix=S.SPEND_FILE_PREFIX)
        _move_into(spark, staging, folder, names)
        ledger.load_new_spend_days(spark, folder, book, table)
        if ledger.load_new_spend_days(spark, folder, book, table):
            raise AssertionError("a second run over the same files loaded something")
    runs = ledger.read_ledger(spark, book).withColumn("spend_date", ledger.day_of()) \
        .groupBy("spend_date").agg(F.max("run").cast("int").alias("last_run"), F.count_distinct("run").cast("int").alias("loads"))
    rows = spark.read.schema(S.SPEND_LINES).parquet(table)
    return rows.groupBy("spend_date", "channel").agg(F.count(F.lit(1)).alias("records"), F.count("spend").alias("amounts")) \
        .join(runs, "spend_date")


def _move_into(spark: SparkSession, source: str, folder: str, names: list[str]) -> None:
    """Files of a delivery into the landing folder; a day delivered again replaces its files."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    fs = hadoop(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(hadoop(folder))
    for name in names:
        fs.delete(hadoop(f"{folder}/{name}"), False)
        fs.rename(hadoop(f"{source}/{name}"), hadoop(f"{folder}/{name}"))


@register("fact_events_open", covers="X1 S5 X2 X3 G7", oracle=with_ctes([], f"""
SELECT {', '.join(FLAT_COLUMNS)},
  CASE WHEN numbered % 3 = 0 THEN 'plan-' || CAST(numbered % 4 AS VARCHAR) END AS data_payload_custom_plan,
  CASE WHEN numbered % 3 = 0 THEN numbered END AS data_payload_custom_limits_seats,
  CASE WHEN numbered % 2 = 0 THEN 'v' || CAST(numbered % 5 AS VARCHAR) END AS data_payload_scheduled_event_series
FROM (SELECT *, CAST(regexp_extract(data_payload_email, '([0-9]+)@', 1) AS BIGINT) AS numbered FROM flat) s""", [_DOCS, _FLAT]))
def q_fact_events_open(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Webhook documents with nested fields that no schema names; the fields become columns of
    ``fact_events`` beside the known ones."""
    from slotwise.plans.jobs import silver_events_job
    docs = model.booking_documents(model.by_arrival_day(read_table(spark, sf_dir, "events")))
    number = F.regexp_extract("data.payload.email", "([0-9]+)@", 1).cast("long")
    custom = F.when(number % 3 == 0, F.struct(F.concat(F.lit("plan-"), (number % 4).cast("string")).alias("plan"),
                                              F.struct(number.alias("seats")).alias("limits")))
    series = F.when(number % 2 == 0, F.concat(F.lit("v"), (number % 5).cast("string")))
    data = F.col("data").withField("payload.custom", custom).withField("payload.scheduled_event.series", series)
    bronze, silver = scratch_path(spark, "bronze-open"), scratch_path(spark, "silver-open")
    writers.write_json_lines(docs.withColumn("data", data), bronze, "event_date", dealt=True)
    silver_events_job(spark, bronze, silver, layout="lines", open_fields=True, dealt=True)
    table = spark.read.option("mergeSchema", "true").parquet(silver)
    return table.withColumn("event_date", F.col("event_date").cast("string")).select(
        *FLAT_COLUMNS, "data_payload_custom_plan", "data_payload_custom_limits_seats", "data_payload_scheduled_event_series")
