"""Report-shaping queries over the Gold tables and facts (dashboard and validation
views without the drawing)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slotwise import schemas as S
from slotwise.operators import gold, report
from slotwise.plans.batch_queries import (
    booking_facts,
    enriched_bookings,
    fact_marketing,
    q_booking_time,
    q_channel_attribution,
    q_cpb_by_channel,
    q_daily_bookings,
    q_meeting_load,
)
from slotwise.plans.catalog import register
from slotwise.plans.oracle_sql import with_ctes
from slotwise.sources import model
from slotwise.sources.tables import read_table

_CHANNEL_POS = ("CASE channel WHEN 'facebook' THEN 1 WHEN 'youtube' THEN 2 WHEN 'tiktok' THEN 3 "
                "WHEN 'others' THEN 4 END")


@register("daily_pivot", covers="A11 A12 F7", oracle=with_ctes(["daily"], """
SELECT booking_date,
  CAST(COALESCE(SUM(bookings_count) FILTER (WHERE channel = 'facebook'), 0) AS BIGINT) AS facebook,
  CAST(COALESCE(SUM(bookings_count) FILTER (WHERE channel = 'youtube'), 0) AS BIGINT) AS youtube,
  CAST(COALESCE(SUM(bookings_count) FILTER (WHERE channel = 'tiktok'), 0) AS BIGINT) AS tiktok,
  CAST(COALESCE(SUM(bookings_count) FILTER (WHERE channel = 'others'), 0) AS BIGINT) AS others
FROM daily WHERE booking_date IS NOT NULL GROUP BY booking_date"""))
def q_daily_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per day, one column per channel (0 when missing)."""
    return report.daily_pivot(q_daily_bookings(spark, sf_dir))


@register("cpb_ordered", covers="O2", oracle=with_ctes(["cpb"], f"""
SELECT channel, total_bookings_count, total_spend, cpb,
  CAST(ROW_NUMBER() OVER (ORDER BY {_CHANNEL_POS} NULLS LAST, channel) AS INTEGER) AS row_no
FROM cpb"""))
def q_cpb_ordered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O2: the channel table in the reporting order of channels."""
    return report.in_category_order(q_cpb_by_channel(spark, sf_dir), "channel", S.CHANNELS)


@register("leaderboard_sorted", covers="O3 W1 W2", oracle=with_ctes(["attribution"], """
SELECT *, CAST(ROW_NUMBER() OVER (ORDER BY rank_by_volume, rank_by_cpb, channel) AS INTEGER) AS row_no
FROM attribution"""))
def q_leaderboard_sorted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O3: the leaderboard by volume rank, then cost rank."""
    return report.leaderboard(q_channel_attribution(spark, sf_dir))


@register("meeting_load_sorted", covers="O4", oracle=with_ctes(["meeting_load"], """
SELECT *, CAST(ROW_NUMBER() OVER (ORDER BY total_meetings_count DESC, user_id ASC NULLS LAST) AS INTEGER)
  AS row_no
FROM meeting_load"""))
def q_meeting_load_sorted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Employees by meetings, most first, with distributed positions."""
    return report.meeting_load_sorted(q_meeting_load(spark, sf_dir))


_DAY_NAME = ("CASE booking_day_of_week WHEN 1 THEN 'Sunday' WHEN 2 THEN 'Monday' WHEN 3 THEN 'Tuesday' "
             "WHEN 4 THEN 'Wednesday' WHEN 5 THEN 'Thursday' WHEN 6 THEN 'Friday' WHEN 7 THEN 'Saturday' END")


@register("booking_day_names", covers="E12 F7", oracle=with_ctes(["time_analysis"], f"""
SELECT channel, booking_hour, booking_day_of_week, bookings_count, {_DAY_NAME} AS day_name
FROM time_analysis WHERE ({_DAY_NAME}) IS NOT NULL"""))
def q_booking_day_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Time analysis with weekday names, selected days kept."""
    return report.with_day_names(q_booking_time(spark, sf_dir))


@register("weekdays_present", covers="O6 A10 E12", oracle=with_ctes(["time_analysis"], f"""
SELECT DISTINCT booking_day_of_week AS day_of_week, {_DAY_NAME} AS day_name
FROM time_analysis WHERE booking_day_of_week IS NOT NULL"""))
def q_weekdays_present(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weekdays that occur, with their names."""
    return report.weekdays_present(q_booking_time(spark, sf_dir))


@register("column_profile", covers="A13 A8", oracle=with_ctes(["spend_raw"], """
SELECT 0 AS position, 'date' AS column_name, 'string' AS data_type, COUNT(*) AS rows, COUNT(date) AS non_null
FROM spend_raw
UNION ALL SELECT 1, 'channel', 'string', COUNT(*), COUNT(channel) FROM spend_raw
UNION ALL SELECT 2, 'spend', 'string', COUNT(*), COUNT(*) FILTER (WHERE defect IS DISTINCT FROM 'missing')
FROM spend_raw
UNION ALL SELECT 3, 'position', 'bigint', COUNT(*), COUNT(position) FROM spend_raw"""))
def q_column_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per column of raw spend its type, rows and non-NULL count."""
    return report.column_profile(model.spend_raw(read_table(spark, sf_dir, "orders")))


@register("event_type_values", covers="A10 F6", oracle=with_ctes(["booking_facts"], """
SELECT DISTINCT data_payload_scheduled_event_event_type AS event_type_uri, meeting_name
FROM booking_facts
WHERE data_payload_scheduled_event_event_type IN ('https://api.example.com/event_types/click',
  'https://api.example.com/event_types/view', 'https://api.example.com/event_types/purchase')"""))
def q_event_type_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A10: meeting names seen for each paid channel's event type."""
    facts = booking_facts(spark, sf_dir).filter(F.col(S.COL_EVENT_TYPE).isin(list(S.CHANNEL_URIS)))
    return report.distinct_values(facts.withColumnRenamed(S.COL_EVENT_TYPE, "event_type_uri"),
                                  "event_type_uri", "meeting_name")


@register("preview_first_last", covers="O1 O5", oracle=with_ctes(["fact_marketing"], """
SELECT *, CAST(ROW_NUMBER() OVER (PARTITION BY "end" ORDER BY date, channel, spend) AS INTEGER) AS row_no
FROM (
  (SELECT *, 'head' AS "end" FROM fact_marketing ORDER BY date NULLS FIRST, channel NULLS FIRST,
     spend NULLS FIRST LIMIT 5)
  UNION ALL
  (SELECT *, 'tail' AS "end" FROM fact_marketing ORDER BY date DESC NULLS LAST, channel DESC NULLS LAST,
     spend DESC NULLS LAST LIMIT 5)) p"""))
def q_preview_first_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First and last five rows of fact_marketing."""
    return report.preview(fact_marketing(spark, sf_dir), ["date", "channel", "spend"])


@register("spend_days_sorted", covers="O1 A9", oracle=with_ctes(["fact_marketing"], """
SELECT date, CAST(ROW_NUMBER() OVER (ORDER BY date) AS INTEGER) AS row_no
FROM (SELECT DISTINCT date FROM fact_marketing) d"""))
def q_spend_days_sorted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sorted distinct spend days (the days a Bronze run writes), numbered."""
    days = fact_marketing(spark, sf_dir).select("date").distinct()
    return report.with_global_positions(days, F.col("date"))


@register("gold_from_cube", covers="G1 G2 G4 A1 A6", oracle=with_ctes(["daily"], """
SELECT booking_date, channel, bookings_count, booking_week FROM daily"""))
def q_gold_from_cube(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The daily table derived from the Gold job's hour cube (``gold.booking_cube``), which
    must agree with the direct computation."""
    cube = gold.booking_cube(enriched_bookings(spark, sf_dir))
    return gold.daily_bookings_by_channel(cube, weight="bookings")


@register("gold_catalog", covers="K6 K7 S8 A8 G1 G2 G3 G4 G5", oracle=with_ctes(["daily"], """
SELECT booking_date, channel, bookings_count, booking_week FROM daily"""))
def q_gold_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The Gold job end to end: five tables written and registered in a database,
    then the daily table read back through the catalog."""
    from slotwise.plans.jobs import gold_job
    from slotwise.session import scratch_path
    root = scratch_path(spark, "gold")
    gold_job(spark, booking_facts(spark, sf_dir), fact_marketing(spark, sf_dir), root, database="slotwise_gold")
    return spark.table("slotwise_gold.gold_daily_bookings_by_channel")
