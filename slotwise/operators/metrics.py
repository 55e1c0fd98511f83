"""The README's metrics (daily cost per booking, trends, UTM
attribution, weekly meeting load, the Gold contract table)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slotwise import schemas as S
from slotwise.functions import employee_id, exact_sum, guarded_ratio
from slotwise.operators.gold import daily_bookings_by_channel


def _bucket(channel_col: str = "channel", real: Sequence[str] = S.REAL_CHANNELS):
    return (F.when(F.col(channel_col).isin(list(real)), F.col(channel_col))
            .when(F.col(channel_col).isNotNull(), F.lit("others")))


def daily_spend(fact_marketing: DataFrame) -> DataFrame:
    """Spend per (day, channel bucket): one row per day and channel."""
    return (fact_marketing
            .groupBy(F.to_date("date").alias("booking_date"), _bucket().alias("channel"))
            .agg(exact_sum("spend").alias("total_spend"))
            .filter(F.col("channel").isNotNull()))


def daily_cpb(enriched: DataFrame, fact_marketing: DataFrame,
              channels: Sequence[str] = S.CHANNELS) -> DataFrame:
    """Daily bookings grid and daily spend on (day, channel). Spend of a day or
    channel without bookings stays (0 bookings, no cost per booking), so the totals
    equal those of both inputs.

    Both sides are aggregates (days x channels), joined in full on the key they are
    grouped by.
    """
    grid = daily_bookings_by_channel(enriched, channels)
    return (grid.join(daily_spend(fact_marketing), ["booking_date", "channel"], "full")
            .withColumn("bookings_count", F.coalesce("bookings_count", F.lit(0)))
            .select("booking_date", "channel", "bookings_count",
                    F.coalesce("total_spend", F.lit(0.0)).alias("total_spend"),
                    guarded_ratio(F.coalesce("total_spend", F.lit(0.0)), "bookings_count", None)
                    .alias("cost_per_booking")))


def weekly_trend(enriched: DataFrame) -> DataFrame:
    """Bookings per ISO week (Monday start, with its year) and channel."""
    week_start = F.date_trunc("week", F.col("booking_date")).cast("date")
    return (enriched
            .groupBy(week_start.alias("week_start"), "channel")
            .agg(F.count(F.lit(1)).alias("bookings_count"))
            .withColumn("booking_week", F.weekofyear("week_start")))


def utm_attribution(enriched: DataFrame, real: Sequence[str] = S.REAL_CHANNELS) -> DataFrame:
    """Attribute each booking to a channel and campaign through its UTM fields,
    falling back to the event-type channel when no UTM source is present."""
    from_utm = F.col("utm_source").isNotNull()
    channel = F.when(from_utm, _bucket("utm_source", real)).otherwise(F.col("channel"))
    return (enriched
            .groupBy(channel.alias("channel"),
                     F.coalesce("utm_campaign", F.lit("(none)")).alias("campaign"),
                     F.when(from_utm, F.lit("utm")).otherwise(F.lit("event_type")).alias("attributed_by"))
            .agg(F.count(F.lit(1)).alias("bookings_count")))


def weekly_avg_meetings(enriched: DataFrame, user_col: str = S.COL_MEMBER_USER) -> DataFrame:
    """Meetings per employee and week, averaged over the weeks with meetings."""
    week_start = F.date_trunc("week", F.col("booking_date")).cast("date")
    per_week = (enriched
                .groupBy(employee_id(user_col).alias("user_id"), week_start.alias("week_start"))
                .agg(F.count(F.lit(1)).alias("meetings")))
    return (per_week.groupBy("user_id")
            .agg(F.count(F.lit(1)).alias("weeks_active"),
                 F.sum("meetings").alias("total_meetings"))
            .withColumn("avg_weekly_meetings",
                        F.col("total_meetings").cast("double") / F.col("weeks_active").cast("double")))


def gold_contract(enriched: DataFrame, fact_marketing: DataFrame) -> DataFrame:
    """D3: one row per (day, hour, channel): bookings in the hour, the day's cost per
    booking for the channel, and the share of the day's spend those bookings carry.
    Spend of a day and channel without bookings has a row without hour, with 0 bookings
    and the whole spend, so ``total_spend`` adds up to the spend of the input.

    One aggregation by (day, channel) counts each of the 24 hours (and a NULL hour)
    and the day's total; ``inline`` turns the day row into hour rows. The hour domain
    is fixed, so this needs one shuffle and no window over a second partitioning.
    """
    hour = F.hour("booking_ts")
    slots = [(h, hour == h) for h in range(24)] + [(None, hour.isNull())]
    per_day = (enriched
               .groupBy("booking_date", "channel")
               .agg(F.count(F.lit(1)).alias("day_bookings"),
                    *[F.count_if(cond).alias(f"_h{i}") for i, (_, cond) in enumerate(slots)]))
    cells = F.array(*[F.struct(F.lit(h).cast("int").alias("h"), F.col(f"_h{i}").alias("n"))
                      for i, (h, _) in enumerate(slots)])
    hourly = (per_day.select("booking_date", "channel", "day_bookings", F.inline(cells))
              .filter(F.col("n") > 0)
              .join(daily_spend(fact_marketing), ["booking_date", "channel"], "full"))
    start = F.col("booking_date").cast("timestamp_ntz") + F.make_dt_interval(hours=F.col("h"))
    cpb = guarded_ratio(F.coalesce("total_spend", F.lit(0.0)), "day_bookings", None)
    return hourly.select(
        "booking_date", "channel",
        F.when(F.col("h").isNotNull(), start).alias("booking_hour"),
        F.weekofyear("booking_date").alias("booking_week"),
        F.coalesce("n", F.lit(0)).cast("int").alias("total_bookings"),
        F.when(F.col("n").isNull(), F.col("total_spend")).otherwise(cpb * F.col("n").cast("double")).alias("total_spend"),
        cpb.alias("cost_per_booking"))
