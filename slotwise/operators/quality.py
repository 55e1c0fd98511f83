"""Validation rules, ``is_valid_record`` and quarantine.

A rule is a name and the condition under which a row *violates* it. All rules of a
row are evaluated in one projection (no extra pass, no shuffle); the names of the
violated rules are kept in ``reject_reasons`` so a quarantined row says why.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Rule = tuple[str, Column]


def flag(df: DataFrame, rules: Sequence[Rule], reasons_col: str = "reject_reasons",
         valid_col: str = "is_valid_record") -> DataFrame:
    """Add the violated rule names (array) and the validity flag.

    A rule whose condition is NULL (its inputs are missing) is not counted as
    violated: give missing inputs their own rule.
    """
    violated = F.array_compact(F.array(*[F.when(cond, F.lit(name)) for name, cond in rules]))
    return df.withColumn(reasons_col, violated).withColumn(valid_col, F.size(reasons_col) == 0)


def split(flagged: DataFrame, valid_col: str = "is_valid_record") -> tuple[DataFrame, DataFrame]:
    """(valid rows, quarantined rows). Both are lazy filters over the same input;
    persist or checkpoint ``flagged`` when both are written."""
    return flagged.filter(F.col(valid_col)), flagged.filter(~F.col(valid_col))


class EmptyInput(ValueError):
    pass


def require_rows(df: DataFrame, what: str) -> DataFrame:
    """F8: fail early when an input has no row at all (reads up to one row)."""
    if df.isEmpty():
        raise EmptyInput(f"{what}: no rows")
    return df


def violation_counts(df: DataFrame, rules: Sequence[Rule], source: str) -> DataFrame:
    """One row per rule: rows checked and rows violating it (a single aggregate)."""
    agg = df.agg(F.count(F.lit(1)).alias("_rows"),
                 *[F.count_if(F.coalesce(cond, F.lit(False))).alias(f"_v{i}")
                   for i, (_, cond) in enumerate(rules)])
    cells = F.array(*[F.struct(F.lit(source).alias("source"), F.lit(name).alias("rule"),
                               F.col("_rows").alias("rows_checked"), F.col(f"_v{i}").alias("violations"))
                      for i, (name, _) in enumerate(rules)])
    return agg.select(F.inline(cells))


# ------------------------------------------------------------------- rule sets
def booking_rules(invitee_col: str = "invitee_id", created_col: str = "data_created_at",
                  ingestion_col: str = "ingestion_time", start_col: str = "booking_ts") -> list[Rule]:
    """D4 primary key present; D5 event (creation) time not after ingestion time;
    a booking start time that parsed."""
    return [
        ("missing_invitee_id", F.col(invitee_col).isNull() | (F.col(invitee_col) == "")),
        ("created_after_ingestion", F.col(created_col) > F.col(ingestion_col)),
        ("missing_created_time", F.col(created_col).isNull()),
        ("missing_ingestion_time", F.col(ingestion_col).isNull()),
        ("missing_start_time", F.col(start_col).isNull()),
    ]


def spend_rules(date_col: str = "date", channel_col: str = "channel",
                spend_col: str = "spend") -> list[Rule]:
    """D7 spend >= 0, plus presence and readability of every field (raw text spend)."""
    value = F.col(spend_col).try_cast("double")
    return [
        ("missing_date", F.col(date_col).isNull()),
        ("missing_channel", F.col(channel_col).isNull()),
        ("missing_spend", F.col(spend_col).isNull()),
        ("unreadable_spend", F.col(spend_col).isNotNull() & value.isNull()),
        ("negative_spend", value < 0),
    ]


def count_rules(count_col: str = "bookings_count") -> list[Rule]:
    """D8 booking counts >= 0 (and present)."""
    return [("negative_bookings", F.col(count_col) < 0),
            ("missing_bookings", F.col(count_col).isNull())]
