"""Report shaping (what a dashboard does to Gold tables, minus the drawing):
pivots, category order, leaderboards, day names, column profiles, previews.

Every function works on a Gold table or a fact table and stays a Spark plan.
Unpartitioned windows (one task) are used only over tables whose size is fixed by
the channel dimension; positions in longer sorted lists (employees, days) come from
a range sort plus per-partition offsets (``with_global_positions``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from slotwise import schemas as S
from slotwise.functions import category_position, day_name


def daily_pivot(daily: DataFrame, channels: Sequence[str] = S.CHANNELS,
                selected: Sequence[str] | None = None) -> DataFrame:
    """One row per day, one column per channel in the given order, 0 for
    a missing cell; rows with a NULL day are dropped (as a pivot table does)."""
    cols = list(selected) if selected is not None else list(channels)
    wide = (daily.filter(F.col("booking_date").isNotNull())
            .groupBy("booking_date").pivot("channel", list(channels))
            .agg(F.sum("bookings_count")))
    return wide.select("booking_date", *[F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c) for c in cols])


def with_row_numbers(df: DataFrame, *order: F.Column, name: str = "row_no") -> DataFrame:
    """A row number for a sorted report whose size is fixed by a dimension (a few
    rows): an unpartitioned window, i.e. one task."""
    return df.withColumn(name, F.row_number().over(Window.orderBy(*order)))


def with_global_positions(df: DataFrame, *order: F.Column, name: str = "row_no") -> DataFrame:
    """1-based position in ``order`` computed without gathering the rows in one task.

    The rows are range-partitioned and sorted (``orderBy``) and that result is
    checkpointed, so both passes below see the same partitions. Each row's place
    inside its partition comes from ``monotonically_increasing_id`` (partition index
    in the upper bits); a table of per-partition counts (one row per partition, a
    bounded broadcast) gives each partition's offset. ``order`` must be total.
    """
    from slotwise.session import shared_dir
    shared_dir(df.sparkSession)
    ranged = (df.orderBy(*order)
              .withColumn("_pid", F.spark_partition_id())
              .withColumn("_mid", F.monotonically_increasing_id())
              .checkpoint(eager=True))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (ranged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
               .withColumn("_offset", F.coalesce(F.sum("_n").over(before), F.lit(0))))
    local = F.col("_mid") - F.shiftleft(F.col("_pid").cast("bigint"), 33)
    return (ranged.join(F.broadcast(offsets.select("_pid", "_offset")), "_pid")
            .withColumn(name, F.col("_offset") + local + 1)
            .drop("_pid", "_mid", "_offset"))


def in_category_order(df: DataFrame, col: str, order: Sequence[str]) -> DataFrame:
    """O2: rows sorted by the position of ``col`` in ``order``; others last."""
    pos = category_position(col, order)
    return with_row_numbers(df, pos.asc_nulls_last(), F.col(col).asc_nulls_last())


def leaderboard(attribution: DataFrame) -> DataFrame:
    """O3: by volume rank, then cpb rank (channel breaks remaining ties)."""
    return with_row_numbers(attribution, F.col("rank_by_volume"), F.col("rank_by_cpb"), F.col("channel"))


def meeting_load_sorted(load: DataFrame) -> DataFrame:
    """Most meetings first (user id breaks ties). The employee list has no fixed
    bound, so positions are computed without a single-task window."""
    return with_global_positions(load, F.col("total_meetings_count").desc(), F.col("user_id").asc_nulls_last())


def with_day_names(time_analysis: DataFrame, selected_days: Sequence[str] | None = None) -> DataFrame:
    """Weekday names; keep the selected days (default: every day). Rows whose
    weekday is NULL have no name and are not kept by a day selection."""
    named = time_analysis.withColumn("day_name", day_name("booking_day_of_week"))
    days = list(selected_days) if selected_days is not None else list(S.DAY_NAMES)
    return named.filter(F.col("day_name").isin(days))


def weekdays_present(time_analysis: DataFrame) -> DataFrame:
    """The weekdays that occur, in week order."""
    present = (time_analysis.filter(F.col("booking_day_of_week").isNotNull())
               .select(F.col("booking_day_of_week").cast("int").alias("day_of_week")).distinct()
               .withColumn("day_name", day_name("day_of_week")))
    return present.filter(F.col("day_name").isNotNull())


def column_profile(df: DataFrame) -> DataFrame:
    """Per column its type, the row count and the non-NULL count, in one pass."""
    fields = df.schema.fields
    counts = df.agg(F.count(F.lit(1)).alias("_rows"),
                    *[F.count(F.col(f"`{f.name}`")).alias(f"_c{i}") for i, f in enumerate(fields)])
    cells = F.array(*[F.struct(F.lit(i).alias("position"), F.lit(f.name).alias("column_name"),
                               F.lit(f.dataType.simpleString()).alias("data_type"),
                               F.col("_rows").alias("rows"), F.col(f"_c{i}").alias("non_null"))
                      for i, f in enumerate(fields)])
    return counts.select(F.inline(cells))


def distinct_values(df: DataFrame, *cols: str) -> DataFrame:
    """A10: distinct value combinations."""
    return df.select(*cols).distinct()


def preview(df: DataFrame, order: Sequence[str], n: int = 5) -> DataFrame:
    """First and last ``n`` rows under a total order (head and tail of a table).

    Each end is a top-k (``TakeOrderedAndProject``): every task keeps its own k best
    rows, so only k rows per task reach the final merge.
    """
    asc = [F.col(c).asc_nulls_first() for c in order]
    desc = [F.col(c).desc_nulls_last() for c in order]
    head = df.orderBy(*asc).limit(n).withColumn("end", F.lit("head"))
    tail = df.orderBy(*desc).limit(n).withColumn("end", F.lit("tail"))
    both = head.unionByName(tail)
    by_end = Window.partitionBy("end").orderBy(*asc)
    return both.withColumn("row_no", F.row_number().over(by_end))
