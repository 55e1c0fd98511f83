"""Marketing spend: Bronze selection and Silver cleaning."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slotwise import schemas as S
from slotwise.functions import exact_sum


def clean_spend(bronze: DataFrame) -> DataFrame:
    """G6 ``fact_marketing``: strip the paid-ads suffix, keep the date as text (and a
    copy as ``spend_date``), read spend as a double, drop rows with any NULL.

    ``try_cast`` turns unreadable spend text into NULL (then dropped) instead of
    failing the job under ANSI mode.
    """
    return (bronze
            .select(F.col("date").cast("string").alias("date"),
                    F.col("date").cast("string").alias("spend_date"),
                    F.replace(F.col("channel"), F.lit(S.PAID_SUFFIX), F.lit("")).alias("channel"),
                    F.col("spend").try_cast("double").alias("spend"))
            .dropna(how="any", subset=["date", "spend_date", "channel", "spend"]))


def listed_first(records: DataFrame,
                 companies: Sequence[str] = S.LISTED_COMPANIES,
                 day_col: str = "file_date",
                 position_col: str = "position") -> DataFrame:
    """Per day file and listed company, the first record (by position in the
    file) whose channel is the company and whose date is the file's day. Records whose
    place is not known cannot be first.

    ``min_by`` is an ordinary aggregate: it is combined inside each task before the
    shuffle, so one crowded (day, company) never lands whole in a single task.
    """
    if day_col not in records.columns:
        records = records.withColumn(day_col, F.col("date"))
    wanted = records.filter(F.col("channel").isin(list(companies))
                            & (F.col("date") == F.col(day_col))
                            & F.col(position_col).isNotNull())
    first = (wanted
             .groupBy(day_col, "channel")
             .agg(F.min_by(F.struct("date", "channel", "spend"), F.col(position_col)).alias("r")))
    return first.select("r.date", "r.channel", "r.spend")


def missing_companies(records: DataFrame,
                      companies: Sequence[str] = S.LISTED_COMPANIES,
                      day_col: str = "date", days: DataFrame | None = None) -> DataFrame:
    """Completeness report for F5: (day, company) pairs with no record that day.

    One aggregation by day with a presence flag per company, then `inline` to one
    row per company; no grid join. ``days`` (column ``day_col``) names the days that
    must be there, so a day without any record is reported too.
    """
    per_day = records.groupBy(day_col).agg(
        *[F.max(F.col("channel") == c).alias(f"_p{i}") for i, c in enumerate(companies)])
    if days is not None:
        per_day = days.select(day_col).distinct().join(per_day, day_col, "left")
    cells = F.array(*[F.struct(F.lit(c).alias("channel"), F.coalesce(F.col(f"_p{i}"), F.lit(False)).alias("present"))
                      for i, c in enumerate(companies)])
    return (per_day.select(F.col(day_col).alias("date"), F.inline(cells))
            .filter(~F.col("present"))
            .select("date", "channel"))


def spend_with_others(fact_marketing: DataFrame,
                      real_channels: Sequence[str] = S.REAL_CHANNELS) -> DataFrame:
    """U1/S12 parity: per-channel sums of *every* channel, plus one ``others`` row
    holding the total outside the paid channels, appended by name.

    One pass over the spend: the rolled-up total of the unpaid channels comes from the
    per-channel sums (grouping sets), an empty input gives 0.0 (as ``sum(...) or 0.0``).
    """
    unpaid = ~F.col("channel").isin(list(real_channels))
    sums = fact_marketing.groupBy("channel").agg(
        F.sum(F.col("spend").cast("decimal(28,10)")).alias("exact"))
    sums = sums.select("channel", "exact", F.col("exact").cast("double").alias("total_spend"))
    others = sums.agg(F.coalesce(F.sum(F.when(unpaid, F.col("exact"))).cast("double"), F.lit(0.0)).alias("total_spend")) \
        .withColumn("channel", F.lit("others"))
    return sums.drop("exact").unionByName(others).select("channel", "total_spend")


def with_file_date(records: DataFrame, file_name_col: str = "file_name") -> DataFrame:
    """S3: the day a spend file covers, from its name ``spend_data_<day>.json`` or
    ``spend_data_<day>.<number>.json``."""
    name = F.regexp_replace(file_name_col, S.SPEND_FILE_NUMBER, S.SPEND_FILE_SUFFIX)
    day = F.replace(F.replace(name, F.lit(S.SPEND_FILE_PREFIX), F.lit("")),
                    F.lit(S.SPEND_FILE_SUFFIX), F.lit(""))
    return records.withColumn("file_date", day)
