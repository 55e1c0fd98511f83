"""Gold layer: enriched bookings and the five Gold tables.

Scale notes (1000 executors, 100 TB of events):

* Every table is an aggregate whose group count does not grow with the events
  (days x channels, hours x weekdays x channels, employees). Each `groupBy` runs a
  partial (map-side) aggregate before its shuffle, so a hot channel or day is
  combined inside each task and only one row per task and group crosses the network.
* The channel dimension is a parameter (4 rows). It is joined only to aggregates
  whose key set is bounded by the dimension itself, and those are the broadcast side.
* The dense day x channel grid is built without a cross join: one conditional
  count per channel in a single aggregation by day, then `inline` expands the day's
  row into one row per channel.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slotwise import schemas as S
from slotwise.functions import as_timestamp, channel_of, employee_id, exact_sum, guarded_ratio


def channel_dim(spark: SparkSession, channels: Sequence[str] = S.CHANNELS) -> DataFrame:
    """The static channel dimension (a local relation, broadcast wherever joined)."""
    schema = T.StructType([T.StructField("channel", T.StringType(), False)])
    return spark.createDataFrame([(c,) for c in channels], schema)


def enrich(fact_events: DataFrame,
           mapping: Mapping[str, str] = S.CHANNEL_URIS,
           event_col: str = S.COL_EVENT,
           event_type_col: str = S.COL_EVENT_TYPE,
           start_col: str = S.COL_START_TIME) -> DataFrame:
    """Keep created bookings, add ``channel``, ``booking_ts`` and ``booking_date``.

    The start time is parsed once (ISO text or an already typed timestamp), so date,
    hour and weekday all come from the same UTC value.
    """
    start_type = fact_events.schema[start_col].dataType
    return (fact_events
            .filter(F.col(event_col) == S.BOOKING_EVENT)
            .withColumn("channel", channel_of(event_type_col, mapping))
            .withColumn("booking_ts", as_timestamp(start_col, start_type))
            .withColumn("booking_date", F.to_date("booking_ts")))


def at_booking_grain(fact_events: DataFrame, keys: Sequence[str] = ("data_payload_uri",)) -> DataFrame:
    """One row per booking (``keys``) instead of one per flattened row: several arrays
    in a document multiply its rows, which ``count(*)`` would count (the parity
    mode). For the employee load use the invitee and the member as keys.

    ``dropDuplicates`` is an aggregate with a partial step before its shuffle; the
    columns it keeps must be functions of the keys (which row survives is arbitrary).
    """
    return fact_events.dropDuplicates(list(keys))


def _count_where(cond, weight: str | None):
    """Rows meeting ``cond``, or the sum of their ``weight`` (pre-aggregated input)."""
    if weight is None:
        return F.count_if(cond)
    return F.coalesce(F.sum(F.when(cond, F.col(weight))), F.lit(0)).cast("bigint")


def _count(weight: str | None):
    return F.count(F.lit(1)) if weight is None else F.sum(weight).cast("bigint")


def daily_bookings_by_channel(enriched: DataFrame,
                              channels: Sequence[str] = S.CHANNELS,
                              weight: str | None = None,
                              calendar: bool = False) -> DataFrame:
    """G1: one row per (day seen in bookings, channel), zero-filled, with ISO week.

    Days come from the bookings themselves (not a calendar). A NULL day forms a row
    per channel with count 0, as a NULL key finds no partner in a grid join.
    ``weight`` names a count column when the input is already aggregated.
    ``calendar=True`` uses every day from the first to the last booking day instead
    (days without bookings get zeros; a NULL day is left out).
    """
    per_day = enriched.groupBy("booking_date").agg(
        *[_count_where(F.col("channel") == c, weight).alias(f"_n{i}") for i, c in enumerate(channels)])
    if calendar:
        # The calendar is generated from the per-day aggregate's bounds (one row), so
        # its size is the number of days; the day counts join to it by day.
        bounds = per_day.agg(F.min("booking_date").alias("lo"), F.max("booking_date").alias("hi"))
        days = bounds.select(F.explode(F.sequence("lo", "hi")).alias("booking_date"))
        per_day = days.join(per_day, "booking_date", "left").fillna(
            0, subset=[f"_n{i}" for i in range(len(channels))])
    cells = F.array(*[F.struct(F.lit(c).alias("channel"), F.col(f"_n{i}").alias("n"))
                      for i, c in enumerate(channels)])
    grid = per_day.select("booking_date", F.inline(cells))
    return grid.select(
        "booking_date",
        "channel",
        F.when(F.col("booking_date").isNull(), F.lit(0).cast("bigint"))
        .otherwise(F.col("n")).alias("bookings_count"),
        F.weekofyear("booking_date").alias("booking_week"),
    )


def spend_by_bucket(fact_marketing: DataFrame,
                    real_channels: Sequence[str] = S.REAL_CHANNELS) -> DataFrame:
    """A5: spend per paid channel, every other (non-NULL) channel summed as ``others``.

    One conditional aggregation; no driver round trip. The output has at most
    ``len(real_channels) + 1`` rows.
    """
    bucket = (F.when(F.col("channel").isin(list(real_channels)), F.col("channel"))
              .when(F.col("channel").isNotNull(), F.lit("others")))
    return (fact_marketing
            .groupBy(bucket.alias("channel"))
            .agg(exact_sum("spend").alias("total_spend"))
            .filter(F.col("channel").isNotNull()))


def cpb_by_channel(enriched: DataFrame, fact_marketing: DataFrame,
                   channels: Sequence[str] = S.CHANNELS,
                   zero_bookings: str = "zero", weight: str | None = None) -> DataFrame:
    """Bookings, spend and cost per booking per channel.

    ``zero_bookings="zero"`` gives cpb 0 to a channel without bookings (so it ranks
    first by cpb); ``"null"`` gives NULL (it ranks last).
    """
    spark = enriched.sparkSession
    dim = channel_dim(spark, channels)
    # Both aggregates have at most one row per channel bucket: safe to broadcast.
    bookings = enriched.groupBy("channel").agg(_count(weight).alias("total_bookings_count"))
    spend = spend_by_bucket(fact_marketing, [c for c in channels if c != "others"])
    joined = (dim
              .join(F.broadcast(bookings), "channel", "left")
              .join(F.broadcast(spend), "channel", "left")
              .fillna({"total_bookings_count": 0, "total_spend": 0.0}))
    zero = 0.0 if zero_bookings == "zero" else None
    return joined.select(
        "channel", "total_bookings_count", "total_spend",
        guarded_ratio("total_spend", "total_bookings_count", zero).alias("cpb"))


def channel_attribution(cpb: DataFrame) -> DataFrame:
    """Dense ranks by volume (desc) and by cpb (asc, NULLs last).

    The window has no partition key, i.e. runs in one task; its input is the
    per-channel table (one row per dimension channel), never the events.
    """
    by_volume = Window.orderBy(F.col("total_bookings_count").desc())
    by_cpb = Window.orderBy(F.col("cpb").asc_nulls_last())
    return (cpb
            .withColumn("rank_by_volume", F.dense_rank().over(by_volume))
            .withColumn("rank_by_cpb", F.dense_rank().over(by_cpb)))


def booking_time_analysis(enriched: DataFrame,
                          channels: Sequence[str] = S.CHANNELS,
                          weight: str | None = None) -> DataFrame:
    """Bookings per (channel, hour, weekday); a channel with no booking at all
    keeps one row with NULL hour and weekday and count 0 (right join to the
    dimension in the reference; here the dimension is the preserved left side).
    A pre-aggregated input (``weight``) already carries hour and weekday columns."""
    if weight is None:
        hour, dow = F.hour("booking_ts"), F.dayofweek("booking_ts")
    else:
        hour, dow = F.col("booking_hour"), F.col("booking_day_of_week")
    counts = (enriched
              .groupBy(hour.alias("booking_hour"), dow.alias("booking_day_of_week"), "channel")
              .agg(_count(weight).alias("bookings_count")))
    # At most 25 hours x 8 weekdays x channels rows (NULLs included): a bounded broadcast.
    dim = channel_dim(enriched.sparkSession, channels)
    return (dim.join(F.broadcast(counts), "channel", "left")
            .fillna({"bookings_count": 0})
            .select("channel", "booking_hour", "booking_day_of_week", "bookings_count"))


def meeting_load_per_employee(enriched: DataFrame,
                              user_col: str = S.COL_MEMBER_USER) -> DataFrame:
    """Rows per employee id extracted from the member URI (lifetime total)."""
    return (enriched
            .groupBy(employee_id(user_col).alias("user_id"))
            .agg(F.count(F.lit(1)).alias("total_meetings_count")))


def booking_cube(enriched: DataFrame) -> DataFrame:
    """Bookings per (day, hour, weekday, channel): at most days x 24 x channels rows,
    whatever the number of events. G1, G2 and G4 all derive from it."""
    return (enriched
            .groupBy("booking_date", F.hour("booking_ts").alias("booking_hour"),
                     F.dayofweek("booking_ts").alias("booking_day_of_week"), "channel")
            .agg(F.count(F.lit(1)).alias("bookings")))
