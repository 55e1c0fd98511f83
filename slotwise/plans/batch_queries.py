"""Gold-layer and spend queries over the driver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slotwise import schemas as S
from slotwise.operators import contracts, dedup, gold, incremental, key_index, metrics, quality, spend
from slotwise.plans.catalog import register
from slotwise.plans.oracle_sql import with_ctes
from slotwise.session import scratch_path
from slotwise.sinks import writers
from slotwise.sources import model
from slotwise.sources.tables import read_columnar, read_table


# ---------------------------------------------------------------- shared inputs
def booking_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return model.booking_facts(read_table(spark, sf_dir, "events"))


def enriched_bookings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.enrich(booking_facts(spark, sf_dir))


def fact_marketing(spark: SparkSession, sf_dir: str, aligned: bool = False) -> DataFrame:
    return spend.clean_spend(model.spend_raw(read_table(spark, sf_dir, "orders"), aligned))


# ---------------------------------------------------------------- Gold
@register("bookings_enriched", covers="F1 P1 P7 E4 E8 G0", oracle=with_ctes(["enriched"], """
SELECT event_id, invitee_id, channel, booking_date, booking_ts, meeting_name FROM enriched"""))
def q_bookings_enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Created bookings with channel, booking day and start time."""
    return enriched_bookings(spark, sf_dir).select(
        "event_id", "invitee_id", "channel", "booking_date", "booking_ts", "meeting_name")


@register("daily_bookings_by_channel", covers="A1 A9 J1 J2 N1 E7 G1",
          oracle=with_ctes(["daily"], "SELECT booking_date, channel, bookings_count, booking_week FROM daily"))
def q_daily_bookings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G1 (flagship): bookings per day seen and channel, zero-filled, with ISO week."""
    return gold.daily_bookings_by_channel(enriched_bookings(spark, sf_dir))


@register("daily_bookings_calendar", covers="A1 J2 N1 E7 G1", oracle=with_ctes(["enriched", "dim"], """
SELECT d.booking_date, ch.channel, COALESCE(c.n, 0) AS bookings_count,
  CAST(week(d.booking_date) AS INTEGER) AS booking_week
FROM (SELECT CAST(gs AS DATE) AS booking_date
      FROM (SELECT MIN(booking_date) AS lo, MAX(booking_date) AS hi FROM enriched) b,
           generate_series(b.lo, b.hi, INTERVAL 1 DAY) AS t(gs)) d
CROSS JOIN dim ch
LEFT JOIN (SELECT booking_date, channel, COUNT(*) AS n FROM enriched GROUP BY 1, 2) c
  ON c.booking_date = d.booking_date AND c.channel = ch.channel"""))
def q_daily_bookings_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G1 over a full calendar (first to last booking day), zero-filled."""
    return gold.daily_bookings_by_channel(enriched_bookings(spark, sf_dir), calendar=True)


@register("cpb_by_channel", covers="A2 A3 A4 A5 J3 N1 N2 P8 S11 E9 E10 E15 P4 G2",
          oracle=with_ctes(["cpb"], "SELECT channel, total_bookings_count, total_spend, cpb FROM cpb"))
def q_cpb_by_channel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bookings, spend and cost per booking per channel (others = unlisted spend)."""
    return gold.cpb_by_channel(enriched_bookings(spark, sf_dir), fact_marketing(spark, sf_dir))


@register("channel_attribution", covers="W1 W2 G3", oracle=with_ctes(["attribution"], """
SELECT channel, total_bookings_count, total_spend, cpb, rank_by_volume, rank_by_cpb FROM attribution"""))
def q_channel_attribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G2 with dense ranks by volume and by cost per booking."""
    return gold.channel_attribution(q_cpb_by_channel(spark, sf_dir))


@register("booking_time_analysis", covers="E5 E6 A6 J4 N1 G4", oracle=with_ctes(["time_analysis"], """
SELECT channel, booking_hour, booking_day_of_week, bookings_count FROM time_analysis"""))
def q_booking_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bookings per channel, hour and weekday; channels without bookings kept."""
    return gold.booking_time_analysis(enriched_bookings(spark, sf_dir))


@register("meeting_load_per_employee", covers="E1 A7 G5",
          oracle=with_ctes(["meeting_load"], "SELECT user_id, total_meetings_count FROM meeting_load"))
def q_meeting_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per employee id taken from the member URI."""
    return gold.meeting_load_per_employee(enriched_bookings(spark, sf_dir))


# ---------------------------------------------------------------- spend
@register("spend_clean", covers="E2 E11 P2 P5 P6 F4 G6",
          oracle=with_ctes(["fact_marketing"], "SELECT date, spend_date, channel, spend FROM fact_marketing"))
def q_spend_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """fact_marketing from raw spend (suffix stripped, spend typed, NULL rows dropped)."""
    return fact_marketing(spark, sf_dir)


@register("spend_listed_first", covers="F5 J5 A9",
          oracle=with_ctes(["listed_first"], "SELECT date, channel, spend FROM listed_first"))
def q_spend_listed_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    """first record per day and listed company, by position in the day file."""
    return spend.listed_first(model.spend_records(read_table(spark, sf_dir, "orders")))


@register("spend_missing_companies", covers="F5 F8", oracle=with_ctes(["spend_records"], """
SELECT d.date, c.channel
FROM (SELECT DISTINCT date FROM spend_records) d
CROSS JOIN (VALUES ('youtube_paid_ads'), ('facebook_paid_ads'), ('tiktok_paid_ads')) c(channel)
WHERE NOT EXISTS (SELECT 1 FROM spend_records s WHERE s.date = d.date AND s.channel = c.channel)"""))
def q_spend_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days on which a listed company has no spend record."""
    return spend.missing_companies(model.spend_records(read_table(spark, sf_dir, "orders")))


@register("spend_others_union", covers="U1 S12 A3 A4 N2 F2 E9 E15", oracle=with_ctes(["fact_marketing"], """
SELECT channel, CAST(CAST(SUM(CAST(CAST(spend AS VARCHAR) AS DECIMAL(28, 10))) AS VARCHAR) AS DOUBLE) AS total_spend
FROM fact_marketing GROUP BY channel
UNION ALL BY NAME
SELECT 'others' AS channel, COALESCE(CAST(CAST(SUM(CAST(CAST(spend AS VARCHAR) AS DECIMAL(28, 10))) AS VARCHAR) AS DOUBLE), 0.0) AS total_spend
FROM fact_marketing WHERE channel NOT IN ('facebook', 'youtube', 'tiktok')"""))
def q_spend_others_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-channel spend with the others total appended by name."""
    return spend.spend_with_others(fact_marketing(spark, sf_dir))


# ---------------------------------------------------------------- quality, dedup
_BOOKING_REASONS = """concat_ws(';',
    CASE WHEN invitee_id IS NULL OR invitee_id = '' THEN 'missing_invitee_id' END,
    CASE WHEN data_created_at > ingestion_time THEN 'created_after_ingestion' END,
    CASE WHEN data_created_at IS NULL THEN 'missing_created_time' END,
    CASE WHEN ingestion_time IS NULL THEN 'missing_ingestion_time' END,
    CASE WHEN data_payload_scheduled_event_start_time IS NULL THEN 'missing_start_time' END)"""


def _flagged_bookings(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = booking_facts(spark, sf_dir).withColumn("booking_ts", F.col(S.COL_START_TIME))
    return quality.flag(facts, quality.booking_rules())


@register("booking_quality_flags", covers="D4 D5 D9", oracle=with_ctes(["booking_facts"], f"""
SELECT event_id, invitee_id, {_BOOKING_REASONS} AS reject_reasons,
  ({_BOOKING_REASONS}) = '' AS is_valid_record
FROM booking_facts"""))
def q_booking_quality_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every booking delivery with its validity flag and broken rules."""
    return _flagged_bookings(spark, sf_dir).select(
        "event_id", "invitee_id", F.concat_ws(";", "reject_reasons").alias("reject_reasons"), "is_valid_record")


@register("bookings_quarantine", covers="D5 D9", oracle=with_ctes(["booking_facts"], f"""
SELECT event_id, invitee_id, {_BOOKING_REASONS} AS reject_reasons FROM booking_facts
WHERE ({_BOOKING_REASONS}) <> ''"""))
def q_bookings_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rejected booking deliveries with their reasons."""
    _, rejected = quality.split(_flagged_bookings(spark, sf_dir))
    return rejected.select("event_id", "invitee_id", F.concat_ws(";", "reject_reasons").alias("reject_reasons"))


@register("spend_quarantine", covers="D7 D9 P5", oracle=with_ctes(["spend_raw"], """
SELECT date, channel, position,
  CASE defect WHEN 'bad' THEN 'unreadable_spend' WHEN 'missing' THEN 'missing_spend'
              WHEN 'negative' THEN 'negative_spend' END AS reject_reasons
FROM spend_raw WHERE defect IS NOT NULL"""))
def q_spend_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rejected raw spend records with their reasons."""
    raw = model.spend_raw(read_table(spark, sf_dir, "orders"))
    _, rejected = quality.split(quality.flag(raw, quality.spend_rules()))
    return rejected.select("date", "channel", "position", F.concat_ws(";", "reject_reasons").alias("reject_reasons"))


@register("quality_summary", covers="D4 D5 D7 D8 A8", oracle=with_ctes(["spend_raw", "daily"], """
SELECT 'bookings' AS source, 'missing_invitee_id' AS rule, COUNT(*) AS rows_checked,
  COUNT(*) FILTER (WHERE invitee_id IS NULL OR invitee_id = '') AS violations FROM booking_facts
UNION ALL SELECT 'bookings', 'created_after_ingestion', COUNT(*),
  COUNT(*) FILTER (WHERE data_created_at > ingestion_time) FROM booking_facts
UNION ALL SELECT 'bookings', 'missing_created_time', COUNT(*), COUNT(*) FILTER (WHERE data_created_at IS NULL)
  FROM booking_facts
UNION ALL SELECT 'bookings', 'missing_ingestion_time', COUNT(*), COUNT(*) FILTER (WHERE ingestion_time IS NULL)
  FROM booking_facts
UNION ALL SELECT 'bookings', 'missing_start_time', COUNT(*),
  COUNT(*) FILTER (WHERE data_payload_scheduled_event_start_time IS NULL) FROM booking_facts
UNION ALL SELECT 'spend', 'missing_date', COUNT(*), COUNT(*) FILTER (WHERE date IS NULL) FROM spend_raw
UNION ALL SELECT 'spend', 'missing_channel', COUNT(*), COUNT(*) FILTER (WHERE channel IS NULL) FROM spend_raw
UNION ALL SELECT 'spend', 'missing_spend', COUNT(*), COUNT(*) FILTER (WHERE defect = 'missing') FROM spend_raw
UNION ALL SELECT 'spend', 'unreadable_spend', COUNT(*), COUNT(*) FILTER (WHERE defect = 'bad') FROM spend_raw
UNION ALL SELECT 'spend', 'negative_spend', COUNT(*), COUNT(*) FILTER (WHERE defect = 'negative') FROM spend_raw
UNION ALL SELECT 'gold_daily', 'negative_bookings', COUNT(*), COUNT(*) FILTER (WHERE bookings_count < 0) FROM daily
UNION ALL SELECT 'gold_daily', 'missing_bookings', COUNT(*), COUNT(*) FILTER (WHERE bookings_count IS NULL) FROM daily"""))
def q_quality_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows checked and violations per rule for bookings, spend and the daily Gold table."""
    facts = booking_facts(spark, sf_dir).withColumn("booking_ts", F.col(S.COL_START_TIME))
    raw = model.spend_raw(read_table(spark, sf_dir, "orders"))
    daily = gold.daily_bookings_by_channel(gold.enrich(booking_facts(spark, sf_dir)))
    return (quality.violation_counts(facts, quality.booking_rules(), "bookings")
            .unionByName(quality.violation_counts(raw, quality.spend_rules(), "spend"))
            .unionByName(quality.violation_counts(daily, quality.count_rules(), "gold_daily")))


_SPEND_REASONS = """CASE defect WHEN 'bad' THEN 'unreadable_spend' WHEN 'missing' THEN 'missing_spend'
              WHEN 'negative' THEN 'negative_spend' ELSE '' END"""


@register("quality_flags", covers="D7 D9 P5 F4", oracle=with_ctes(["spend_raw"], f"""
SELECT position, date, channel, {_SPEND_REASONS} AS reject_reasons, defect IS NULL AS is_valid_record
FROM spend_raw"""))
def q_quality_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every raw spend record with its validity flag and the rules it breaks."""
    flagged = quality.flag(model.spend_raw(read_table(spark, sf_dir, "orders")), quality.spend_rules())
    return flagged.select("position", "date", "channel",
                          F.concat_ws(";", "reject_reasons").alias("reject_reasons"), "is_valid_record")


@register("quarantine", covers="D9 D4 D5 D7 U1", oracle=with_ctes(["booking_facts", "spend_raw"], f"""
SELECT 'bookings' AS source, CAST(event_id AS VARCHAR) AS record_id, {_BOOKING_REASONS} AS reject_reasons
FROM booking_facts WHERE ({_BOOKING_REASONS}) <> ''
UNION ALL
SELECT 'spend', CAST(position AS VARCHAR), {_SPEND_REASONS} FROM spend_raw WHERE defect IS NOT NULL"""))
def q_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All rejected records of both inputs in one table, with the reasons."""
    _, bad_bookings = quality.split(_flagged_bookings(spark, sf_dir))
    raw = model.spend_raw(read_table(spark, sf_dir, "orders"))
    _, bad_spend = quality.split(quality.flag(raw, quality.spend_rules()))
    def shape(df: DataFrame, source: str, id_col: str) -> DataFrame:
        return df.select(F.lit(source).alias("source"), F.col(id_col).cast("string").alias("record_id"),
                         F.concat_ws(";", "reject_reasons").alias("reject_reasons"))
    return shape(bad_bookings, "bookings", "event_id").unionByName(shape(bad_spend, "spend", "position"))


_LATEST = """
latest AS (
  SELECT * FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY invitee_id ORDER BY ingestion_time DESC, event_id DESC) AS rn
    FROM booking_facts) s
  WHERE rn = 1
)"""


@register("dedup_bookings", covers="D6", oracle=with_ctes(["booking_facts"], """
SELECT invitee_id, event_id, ingestion_time, data_event FROM latest""", [_LATEST]))
def q_dedup_bookings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per invitee, the latest delivery (ingestion time, then delivery id)."""
    rows = booking_facts(spark, sf_dir).select("invitee_id", "event_id", "ingestion_time", S.COL_EVENT)
    return dedup.latest_per_key(rows, ["invitee_id"], ["ingestion_time", "event_id"])


@register("duplicate_deliveries", covers="D6 A1", oracle=with_ctes(["booking_facts"], """
SELECT invitee_id, COUNT(*) AS deliveries FROM booking_facts GROUP BY invitee_id HAVING COUNT(*) > 1"""))
def q_duplicate_deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Invitees delivered more than once and how often."""
    return dedup.duplicates_report(booking_facts(spark, sf_dir), ["invitee_id"])


# ---------------------------------------------------------------- contracts
@register("bronze_contract", covers="D1", oracle=with_ctes(["booking_facts"], """
SELECT data_created_at AS event_created_at, invitee_id, invitee_email,
  data_payload_scheduled_event_start_time AS scheduled_event_start_time,
  data_payload_scheduled_event_event_type AS event_type, utm_source, utm_campaign,
  'https://api.example.com/scheduled_events/' || CAST(event_id AS VARCHAR) || '/invitees/' || invitee_id
    AS raw_payload_uri
FROM booking_facts"""))
def q_bronze_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The Bronze columns; the payload struct is carried whole (shown by its URI)."""
    docs = model.booking_documents(read_table(spark, sf_dir, "events"))
    bronze = contracts.bronze_contract(docs)
    return bronze.select(*[c for c in bronze.columns if c != "raw_payload"],
                         F.col("raw_payload.uri").alias("raw_payload_uri"))


@register("silver_contract", covers="D2 D6 D9", oracle=with_ctes(["booking_facts"], f"""
SELECT CAST(data_created_at AS DATE) AS event_date, invitee_id,
  CAST(data_payload_scheduled_event_start_time AS DATE) AS booking_date,
  CASE data_payload_scheduled_event_event_type
    WHEN 'https://api.example.com/event_types/click' THEN 'facebook'
    WHEN 'https://api.example.com/event_types/view' THEN 'youtube'
    WHEN 'https://api.example.com/event_types/purchase' THEN 'tiktok' ELSE 'others' END AS channel,
  employee_email, data_payload_scheduled_event_start_time AS event_start_time,
  CAST(ingestion_time AS DATE) AS ingestion_date,
  ({_BOOKING_REASONS}) = '' AS is_valid_record
FROM latest""", [_LATEST]))
def q_silver_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The Silver booking table (latest per invitee, typed, validity flag)."""
    return contracts.silver_contract(booking_facts(spark, sf_dir))


@register("silver_contract_without_ids", covers="D2 D6 D9", oracle=with_ctes(["booking_facts"], """
SELECT invitee_id, event_start_time, channel, array_to_string(reasons, ';') AS reject_reasons, COUNT(*) AS deliveries FROM (
  SELECT CASE WHEN event_id % 3 <> 0 THEN invitee_id END AS invitee_id, event_id,
    data_payload_scheduled_event_start_time AS event_start_time,
    CASE data_payload_scheduled_event_event_type
      WHEN 'https://api.example.com/event_types/click' THEN 'facebook'
      WHEN 'https://api.example.com/event_types/view' THEN 'youtube'
      WHEN 'https://api.example.com/event_types/purchase' THEN 'tiktok' ELSE 'others' END AS channel,
    list_filter([CASE WHEN event_id % 3 = 0 THEN 'missing_invitee_id' END,
      CASE WHEN data_created_at > ingestion_time THEN 'created_after_ingestion' END], lambda x: x IS NOT NULL) AS reasons,
    ROW_NUMBER() OVER (PARTITION BY CASE WHEN event_id % 3 <> 0 THEN invitee_id ELSE '//' || CAST(event_id AS VARCHAR) END
                       ORDER BY ingestion_time DESC, event_id DESC) AS rn
  FROM booking_facts) s
WHERE rn = 1 AND len(reasons) > 0 GROUP BY ALL"""))
def q_silver_contract_without_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D2/D9 where every third delivery has neither invitee nor event id: none folds into
    another, all reach the quarantine."""
    facts = booking_facts(spark, sf_dir)
    lost = F.col("event_id") % 3 == 0
    # Without ids, a delivery is told apart by what it holds: its arrival is made unique here.
    facts = facts.withColumn("invitee_id", F.when(~lost, F.col("invitee_id"))) \
        .withColumn("employee_email", F.col("invitee_email")).withColumn("event_id", F.when(~lost, F.col("event_id")))
    rejected = contracts.flagged_bookings(facts).where(~F.col("is_valid_record"))
    return rejected.groupBy("invitee_id", "event_start_time", "channel", F.concat_ws(";", "reject_reasons").alias("reject_reasons")) \
        .agg(F.count(F.lit(1)).alias("deliveries"))


_DAILY_SPEND = """
ds AS (
  SELECT CAST(date AS DATE) AS booking_date,
    CASE WHEN channel IN ('facebook', 'youtube', 'tiktok') THEN channel ELSE 'others' END AS channel,
    CAST(CAST(SUM(CAST(CAST(spend AS VARCHAR) AS DECIMAL(28, 10))) AS VARCHAR) AS DOUBLE) AS total_spend
  FROM fact_marketing_aligned WHERE channel IS NOT NULL GROUP BY 1, 2
)"""


_GOLD_CONTRACT = """
SELECT COALESCE(hd.booking_date, ds.booking_date) AS booking_date, COALESCE(hd.channel, ds.channel) AS channel,
  hd.booking_hour, CAST(week(COALESCE(hd.booking_date, ds.booking_date)) AS INTEGER) AS booking_week,
  CAST(COALESCE(hd.n, 0) AS INTEGER) AS total_bookings,
  CASE WHEN hd.n IS NULL THEN ds.total_spend
       ELSE (COALESCE(ds.total_spend, 0.0) / hd.day_bookings) * CAST(hd.n AS DOUBLE) END AS total_spend,
  CASE WHEN hd.n IS NOT NULL THEN COALESCE(ds.total_spend, 0.0) / hd.day_bookings END AS cost_per_booking
FROM (SELECT *, SUM(n) OVER (PARTITION BY booking_date, channel) AS day_bookings FROM (
        SELECT booking_date, date_trunc('hour', booking_ts) AS booking_hour, channel, COUNT(*) AS n
        FROM enriched GROUP BY 1, 2, 3) h) hd
FULL JOIN ds ON ds.booking_date = hd.booking_date AND ds.channel = hd.channel"""


@register("gold_contract", covers="D3",
          oracle=with_ctes(["enriched", "fact_marketing_aligned"], _GOLD_CONTRACT, [_DAILY_SPEND]))
def q_gold_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D3: hourly bookings per day and channel with the day's spend share and cost per booking."""
    return metrics.gold_contract(enriched_bookings(spark, sf_dir), fact_marketing(spark, sf_dir, aligned=True))


# ---------------------------------------------------------------- metrics
_DAILY_CPB = """
SELECT COALESCE(d.booking_date, ds.booking_date) AS booking_date, COALESCE(d.channel, ds.channel) AS channel,
  COALESCE(d.bookings_count, 0) AS bookings_count, COALESCE(ds.total_spend, 0.0) AS total_spend,
  CASE WHEN d.bookings_count > 0 THEN COALESCE(ds.total_spend, 0.0) / d.bookings_count END AS cost_per_booking
FROM daily d FULL JOIN ds ON ds.booking_date = d.booking_date AND ds.channel = d.channel"""


@register("daily_cpb", covers="D14 J2 P8",
          oracle=with_ctes(["daily", "fact_marketing_aligned"], _DAILY_CPB, [_DAILY_SPEND]))
def q_daily_cpb(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily bookings grid joined to daily spend, cost per booking per day and channel."""
    return metrics.daily_cpb(enriched_bookings(spark, sf_dir), fact_marketing(spark, sf_dir, aligned=True))


@register("daily_cpb_order_dates", covers="D14 J2 P8",
          oracle=with_ctes(["daily", "fact_marketing"], _DAILY_CPB,
                           [_DAILY_SPEND.replace("fact_marketing_aligned", "fact_marketing")]))
def q_daily_cpb_order_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D14 with spend dates outside the booking days: every day of spend is kept."""
    return metrics.daily_cpb(enriched_bookings(spark, sf_dir), fact_marketing(spark, sf_dir))


@register("gold_contract_order_dates", covers="D3",
          oracle=with_ctes(["enriched", "fact_marketing"], _GOLD_CONTRACT,
                           [_DAILY_SPEND.replace("fact_marketing_aligned", "fact_marketing")]))
def q_gold_contract_order_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D3 with spend dates outside the booking days: every day of spend is kept."""
    return metrics.gold_contract(enriched_bookings(spark, sf_dir), fact_marketing(spark, sf_dir))


@register("weekly_trend", covers="D15 D18", oracle=with_ctes(["enriched"], """
SELECT CAST(date_trunc('week', booking_date) AS DATE) AS week_start, channel, COUNT(*) AS bookings_count,
  CAST(week(CAST(date_trunc('week', booking_date) AS DATE)) AS INTEGER) AS booking_week
FROM enriched GROUP BY 1, 2"""))
def q_weekly_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bookings per ISO week and channel."""
    return metrics.weekly_trend(enriched_bookings(spark, sf_dir))


@register("utm_attribution", covers="D16", oracle=with_ctes(["enriched"], """
SELECT CASE WHEN utm_source IS NOT NULL
            THEN CASE WHEN utm_source IN ('facebook', 'youtube', 'tiktok') THEN utm_source ELSE 'others' END
            ELSE channel END AS channel,
  COALESCE(utm_campaign, '(none)') AS campaign,
  CASE WHEN utm_source IS NOT NULL THEN 'utm' ELSE 'event_type' END AS attributed_by,
  COUNT(*) AS bookings_count
FROM enriched GROUP BY 1, 2, 3"""))
def q_utm_attribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bookings per channel and campaign attributed through UTM fields."""
    return metrics.utm_attribution(enriched_bookings(spark, sf_dir))


@register("weekly_avg_meetings", covers="D17 E1", oracle=with_ctes(["enriched"], """
SELECT user_id, COUNT(*) AS weeks_active, CAST(SUM(meetings) AS BIGINT) AS total_meetings,
  CAST(SUM(meetings) AS DOUBLE) / CAST(COUNT(*) AS DOUBLE) AS avg_weekly_meetings
FROM (SELECT regexp_extract(data_payload_scheduled_event_event_memberships_user, 'users/([a-zA-Z0-9-]+)', 1)
             AS user_id, CAST(date_trunc('week', booking_date) AS DATE) AS week_start, COUNT(*) AS meetings
      FROM enriched GROUP BY 1, 2) w
GROUP BY user_id"""))
def q_weekly_avg_meetings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Meetings per employee per week, averaged over active weeks."""
    return metrics.weekly_avg_meetings(enriched_bookings(spark, sf_dir))


# ---------------------------------------------------------------- incremental
_COUNTS_SCHEMA = T.StructType([
    T.StructField("channel", T.StringType()),
    T.StructField("bookings_count", T.LongType()),
    T.StructField("booking_date", T.DateType()),
])


@register("reprocess_last_n", covers="D12 D10 K4", oracle=with_ctes(["enriched"], """
SELECT booking_date, channel, COUNT(*) AS bookings_count FROM enriched
WHERE ingestion_time < TIMESTAMP '2024-01-20 00:00:00' AND booking_date < DATE '2024-01-24' GROUP BY 1, 2
UNION ALL
SELECT booking_date, channel, COUNT(*) AS bookings_count FROM enriched
WHERE ingestion_time < TIMESTAMP '2024-02-03 00:00:00' AND booking_date >= DATE '2024-01-24' GROUP BY 1, 2"""))
def q_reprocess_last_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily counts kept by booking day: a first run as of 2024-01-20 over everything
    ingested by then, a second run as of 2024-02-03 that recomputes only the last
    10 days and replaces just those partitions."""
    enriched = enriched_bookings(spark, sf_dir)
    root = scratch_path(spark, "gold-daily-counts")

    def run(as_of: str, days: int | None) -> None:
        seen = enriched.filter(F.col("ingestion_time") < F.lit(as_of).cast("timestamp_ntz"))
        counts = seen.groupBy("booking_date", "channel").agg(F.count(F.lit(1)).alias("bookings_count"))
        counts = counts.select(*_COUNTS_SCHEMA.fieldNames())
        if days is None:
            incremental.overwrite_partitions(counts, root, ["booking_date"])
        else:
            incremental.reprocess_days(counts, root, "booking_date", as_of, days)

    run("2024-01-20", None)
    run("2024-02-03", 10)
    return read_columnar(spark, root, schema=_COUNTS_SCHEMA).select("booking_date", "channel", "bookings_count")


@register("incremental_touched_days", covers="D11 D10 K4", oracle=with_ctes(["enriched"], """
SELECT booking_date, channel, COUNT(*) AS bookings_count FROM enriched
WHERE ingestion_time < TIMESTAMP '2024-01-20 00:00:00'
   OR booking_date IN (SELECT booking_date FROM enriched WHERE ingestion_time >= TIMESTAMP '2024-01-20 00:00:00')
GROUP BY 1, 2"""))
def q_incremental_touched_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily counts of everything that arrived before 2024-01-20; then the rows that
    arrived later touch some days, and only those are read again and replaced."""
    enriched = enriched_bookings(spark, sf_dir).select("booking_date", "channel", "ingestion_time")
    facts, root = scratch_path(spark, "touched-facts"), scratch_path(spark, "touched-counts")
    cutoff = F.lit("2024-01-20").cast("timestamp_ntz")

    def counts(rows: DataFrame) -> DataFrame:
        return rows.groupBy("booking_date", "channel").agg(F.count(F.lit(1)).alias("bookings_count")) \
            .select(*_COUNTS_SCHEMA.fieldNames())

    writers.write_partitioned(enriched, facts, ["booking_date"])
    stored = spark.read.parquet(facts)
    incremental.overwrite_partitions(counts(stored.where(F.col("ingestion_time") < cutoff)), root, ["booking_date"])
    incremental.refresh_touched(stored.where(F.col("ingestion_time") >= cutoff), stored, root, "booking_date", counts)
    return read_columnar(spark, root, schema=_COUNTS_SCHEMA).select("booking_date", "channel", "bookings_count")


@register("changed_days_only", covers="D12 D10 K4", oracle=with_ctes(["enriched"], """
SELECT booking_date, channel, COUNT(*) AS bookings_count, booking_date >= DATE '2024-01-27' AS rewritten FROM enriched
WHERE booking_date >= DATE '2024-01-27' OR booking_date < DATE '2024-01-20'
  OR CAST(regexp_extract(data_payload_scheduled_event_event_memberships_user, '([0-9]+)$', 1) AS BIGINT) % 2 = 0
GROUP BY 1, 2"""))
def q_changed_days_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of all days are stored; from 2024-01-20 on half of the users, as first
    delivered. A run over the last 30 days then finds the other half for the days from 2024-01-27 on: only
    those days differ from the table, and only their files are written again."""
    enriched = enriched_bookings(spark, sf_dir)
    half = F.regexp_extract(S.COL_MEMBER_USER, "([0-9]+)$", 1).cast("long") % 2 == 0
    counts = lambda rows: rows.groupBy("booking_date", "channel").agg(
        F.count(F.lit(1)).alias("bookings_count")).select(*_COUNTS_SCHEMA.fieldNames())
    root = scratch_path(spark, "changed-days")
    incremental.overwrite_partitions(counts(enriched.where(half | (F.col("booking_date") < "2024-01-20"))), root, ["booking_date"])
    later = enriched.where(half | (F.col("booking_date") < "2024-01-20") | (F.col("booking_date") >= "2024-01-27"))
    days = incremental.reprocess_days(counts(later), root, "booking_date", "2024-01-31", 30, changed_only=True)
    return read_columnar(spark, root, schema=_COUNTS_SCHEMA).select(
        "booking_date", "channel", "bookings_count", F.col("booking_date").cast("string").isin(days).alias("rewritten"))


_GOLD_MERGED = T.StructType([
    T.StructField("channel", T.StringType()), T.StructField("booking_hour", T.TimestampNTZType()),
    T.StructField("booking_week", T.IntegerType()), T.StructField("total_bookings", T.IntegerType()),
    T.StructField("total_spend", T.DoubleType()), T.StructField("cost_per_booking", T.DoubleType()),
    T.StructField("booking_date", T.DateType()),
])


@register("gold_contract_merged", covers="D3 D10 D13 K4",
          oracle=with_ctes(["enriched", "fact_marketing_aligned"], _GOLD_CONTRACT, [_DAILY_SPEND]))
def q_gold_contract_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D3 stored by ``booking_date``: a first load of the days before 2024-01-15, then a
    merge of all days by (day, channel, hour); the key fixes the partition."""
    rows = q_gold_contract(spark, sf_dir)
    root = scratch_path(spark, "gold-contract")
    keys = ["booking_date", "channel", "booking_hour"]
    for part in (rows.where("booking_date < DATE '2024-01-15'"), rows):
        incremental.upsert(spark, part, root, keys, "booking_date", ["total_bookings", "total_spend"], _GOLD_MERGED,
                           key_determines_partition=True)
    return read_columnar(spark, root, schema=_GOLD_MERGED).select(*rows.columns)


_SILVER_BOOKINGS = T.StructType([
    T.StructField("invitee_id", T.StringType()),
    T.StructField("event_id", T.LongType()),
    T.StructField("ingestion_time", T.TimestampNTZType()),
    T.StructField("data_event", T.StringType()),
    T.StructField("booking_date", T.DateType()),
    T.StructField("ingestion_date", T.DateType()),
])


def silver_booking_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return booking_facts(spark, sf_dir).select(
        "invitee_id", "event_id", "ingestion_time", S.COL_EVENT,
        F.to_date(S.COL_START_TIME).alias("booking_date"),
        F.to_date("ingestion_time").alias("ingestion_date"))


@register("upsert_bookings", covers="D13 D6 K4", oracle=with_ctes(["booking_facts"], """
SELECT invitee_id, event_id, ingestion_time, data_event,
  CAST(data_payload_scheduled_event_start_time AS DATE) AS booking_date,
  CAST(ingestion_time AS DATE) AS ingestion_date
FROM latest""", [_LATEST]))
def q_upsert_bookings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver bookings by arrival day: a first load of what arrived before
    2024-01-20, then a MERGE of everything later (re-deliveries move a key to a
    later arrival partition)."""
    rows = silver_booking_rows(spark, sf_dir)
    root = scratch_path(spark, "silver-bookings")
    cutoff = F.lit("2024-01-20").cast("timestamp_ntz")
    order, index = ["ingestion_time", "event_id"], key_index.index_path(root)
    for part in (rows.filter(F.col("ingestion_time") < cutoff), rows.filter(F.col("ingestion_time") >= cutoff)):
        incremental.upsert(spark, part, root, ["invitee_id"], "ingestion_date", order, _SILVER_BOOKINGS, index=index)
    return read_columnar(spark, root, schema=_SILVER_BOOKINGS)
