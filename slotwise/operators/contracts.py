"""The documented Bronze and Silver table contracts."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slotwise import schemas as S
from slotwise.functions import channel_of, invitee_id_of, quoted
from slotwise.operators import quality
from slotwise.operators.dedup import latest_per_key


def _ts(text_col) -> F.Column:
    # ISO text -> timestamp (NULL when unreadable); wall clock in UTC, without zone.
    return F.try_to_timestamp(text_col).cast("timestamp_ntz")


def bronze_contract(documents: DataFrame) -> DataFrame:
    """Typed Bronze columns over the raw webhook documents, payload kept whole."""
    payload = quoted("data", "payload")
    return documents.select(
        _ts(quoted("data", "created_at")).alias("event_created_at"),
        invitee_id_of(quoted("data", "payload", "uri")).alias("invitee_id"),
        quoted("data", "payload", "email").alias("invitee_email"),
        _ts(quoted("data", "payload", "scheduled_event", "start_time")).alias("scheduled_event_start_time"),
        quoted("data", "payload", "scheduled_event", "event_type").alias("event_type"),
        quoted("data", "payload", "tracking", "utm_source").alias("utm_source"),
        quoted("data", "payload", "tracking", "utm_campaign").alias("utm_campaign"),
        payload.alias("raw_payload"),
    )


def from_fact_events(fact_events: DataFrame) -> DataFrame:
    """The booking columns of the flattened ``fact_events``: ids from URIs, times typed,
    the first member's e-mail, the UTM fields. One row per flattened row; a delivery's
    rows share ``event_id`` (the scheduled event's URI)."""
    return fact_events.select(
        invitee_id_of("data_payload_uri").alias("invitee_id"),
        F.col("data_payload_scheduled_event_uri").alias("event_id"),
        "data_event",
        _ts(F.col("data_created_at")).alias("data_created_at"),
        _ts(F.col("ingestion_time")).alias("ingestion_time"),
        "data_payload_scheduled_event_event_type",
        _ts(F.col("data_payload_scheduled_event_start_time")).alias("data_payload_scheduled_event_start_time"),
        "data_payload_scheduled_event_event_memberships_user",
        F.col("data_payload_scheduled_event_event_memberships_user_email").alias("employee_email"),
        F.col("data_payload_tracking_utm_source").alias("utm_source"),
        F.col("data_payload_tracking_utm_campaign").alias("utm_campaign"),
        F.col("data_payload_uri"))


def flagged_bookings(facts: DataFrame, mapping: Mapping[str, str] = S.CHANNEL_URIS) -> DataFrame:
    """D2 with the rules each row breaks: one row per invitee (latest delivery wins,
    then the smallest e-mail of its members), typed, with the validity flag.

    ``event_date`` is the day the event was created; ``ingestion_date`` the day it
    arrived. Rows without an invitee are no copies of each other: they are told apart by
    their event id and, without that too, by all their columns.
    """
    rows = facts.select(
        "invitee_id", "event_id", "data_created_at", "ingestion_time",
        channel_of("data_payload_scheduled_event_event_type", mapping).alias("channel"),
        "employee_email",
        F.col("data_payload_scheduled_event_start_time").alias("booking_ts"))
    rows = rows.groupBy(*[c for c in rows.columns if c != "employee_email"]).agg(F.min("employee_email").alias("employee_email"))
    named = lambda c: F.nullif(F.col(c).cast("string"), F.lit(""))
    # Neither id: the key is the row itself, so that nothing else folds into it.
    key = F.coalesce(named("invitee_id"), F.concat(F.lit("//"), named("event_id")),
                     F.concat(F.lit("///"), F.sha2(F.to_json(F.struct(*rows.columns)), 256)))
    latest = latest_per_key(rows.withColumn("_key", key), ["_key"], ["ingestion_time", "event_id"]).drop("_key")
    flagged = quality.flag(latest, quality.booking_rules())
    return flagged.select(
        F.to_date("data_created_at").alias("event_date"),
        "invitee_id",
        F.to_date("booking_ts").alias("booking_date"),
        "channel",
        "employee_email",
        F.col("booking_ts").alias("event_start_time"),
        F.to_date("ingestion_time").alias("ingestion_date"),
        "is_valid_record",
        "reject_reasons",
    )


def silver_contract(facts: DataFrame, mapping: Mapping[str, str] = S.CHANNEL_URIS) -> DataFrame:
    """The Silver bookings, valid or not, without the reasons."""
    return flagged_bookings(facts, mapping).drop("reject_reasons")
