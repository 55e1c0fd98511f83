"""Driver tables -> booking and spend data.

The driver ships generic tables; the engine's inputs are webhook booking events and
daily channel spend. These functions derive them row by row (no grouping, no driver
round trip), so they grow linearly with the tables and partition like the scan.

* ``events``  -> one booking delivery per row (``booking_facts``: the Silver columns
  Gold reads; ``booking_documents``: the nested webhook document Bronze holds).
* ``orders``  -> one raw spend record per order (``spend_raw``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slotwise import schemas as S
from slotwise.functions import iso_local_text, iso_utc_text


def _k() -> Column:
    """The small integer carried in ``events.props`` ({"k": n})."""
    return F.get_json_object(F.col("props"), "$.k").try_cast("int")


def _ingestion_time(ts: Column, k: Column) -> Column:
    # Deliveries arrive 1 s plus (k % 72) hours after the event; every 10th delivery
    # carries an ingestion time one second *before* its creation (a clock fault).
    late = F.make_dt_interval(F.lit(0), k % 72, F.lit(0), F.lit(1))
    return (F.when(F.col("event_id") % 10 == 0, ts - F.make_dt_interval(secs=F.lit(1)))
            .otherwise(ts + late))


def _utm_source(k: Column) -> Column:
    expr = F.when(k % 5 == 0, F.lit(S.UTM_SOURCES[0]))
    for i, name in enumerate(S.UTM_SOURCES[1:], start=1):
        expr = expr.when(k % 5 == i, F.lit(name))
    return expr


def _invitee_id(ts: Column) -> Column:
    # One invitee per (user, event type, day): repeated deliveries share it.
    return F.concat_ws("-", F.col("user_id").cast("string"), F.col("event_type"),
                       F.date_format(ts, "yyyyMMdd"))


def booking_facts(events: DataFrame) -> DataFrame:
    """Flat booking rows with the flattened-event column names Gold reads.

    Times are typed (``timestamp_ntz``, wall clock UTC) rather than ISO text.
    """
    ts, k = F.col("ts"), _k()
    return events.select(
        F.col("event_id"),
        _invitee_id(ts).alias("invitee_id"),
        F.when(F.col("event_type") == "error", F.lit(S.CANCEL_EVENT))
        .otherwise(F.lit(S.BOOKING_EVENT)).alias(S.COL_EVENT),
        ts.alias("data_created_at"),
        _ingestion_time(ts, k).alias("ingestion_time"),
        F.concat(F.lit(S.EVENT_TYPE_BASE), F.col("event_type")).alias(S.COL_EVENT_TYPE),
        F.col("event_type").alias("meeting_name"),
        ts.alias(S.COL_START_TIME),
        F.concat(F.lit(S.USER_BASE), F.col("user_id").cast("string")).alias(S.COL_MEMBER_USER),
        F.concat(F.lit("user"), F.col("user_id").cast("string"), F.lit("@example.com"))
        .alias("employee_email"),
        F.concat(F.lit("invitee"), F.col("event_id").cast("string"), F.lit("@example.com"))
        .alias("invitee_email"),
        _utm_source(k).alias("utm_source"),
        F.when(k % 5 != 4, F.concat(F.lit("cmp-"), (k % 8).cast("string"))).alias("utm_campaign"),
    )


#: Documents that one task of ``by_arrival_day`` makes, about; and below which no further task is begun.
DOCUMENTS_PER_TASK, FEW_DOCUMENTS = 100_000, 5_000


def by_arrival_day(events: DataFrame) -> DataFrame:
    """``events`` in tasks of about equal size, each with the deliveries of one or a few arrival days. The
    narrow rows are exchanged, so the documents made of them need not be."""
    spark = events.sparkSession
    rows = events.count()                                   # from the Parquet footers
    tasks = max(-(-rows // DOCUMENTS_PER_TASK), min(spark.sparkContext.defaultParallelism, -(-rows // FEW_DOCUMENTS)), 1)
    day = F.to_date(_ingestion_time(F.col("ts"), _k()))
    return events.repartitionByRange(tasks, day, F.xxhash64(*events.columns))


def booking_documents(events: DataFrame) -> DataFrame:
    """One nested webhook document per delivery (schema ``BOOKING_EVENT_DOC``) plus the
    ``event_date`` folder value (the delivery's ingestion day).

    Arrays are built from the row itself, so their length is bounded per document:
    ``questions_and_answers`` has ``k % 3`` entries (often empty), ``event_memberships``
    one host plus a co-host on odd ids (every 97th host URI lacks ``users/``), and
    ``event_guests`` one guest when ``k % 4 == 0``.
    """
    ts, k = F.col("ts"), _k()
    ingestion = _ingestion_time(ts, k)
    user = F.col("user_id").cast("string")
    host_uri = F.when(F.col("event_id") % 97 == 0, F.concat(F.lit(f"{S.API_BASE}/teams/"), user)) \
        .otherwise(F.concat(F.lit(S.USER_BASE), user))
    host = F.struct(host_uri.alias("user"),
                    F.concat(F.lit("user"), user, F.lit("@example.com")).alias("user_email"),
                    F.concat(F.lit("User "), user).alias("user_name"))
    cohost = F.struct(F.concat(F.lit(S.USER_BASE + "cohost-"), user).alias("user"),
                      F.concat(F.lit("cohost"), user, F.lit("@example.com")).alias("user_email"),
                      F.concat(F.lit("Cohost "), user).alias("user_name"))
    members = F.when(F.col("event_id") % 2 == 1, F.array(host, cohost)).otherwise(F.array(host))
    answers = F.filter(
        F.array(*[F.struct(F.lit(f"answer-{j}").alias("answer"), F.lit(j).cast("bigint").alias("position"),
                           F.lit(f"question-{j}").alias("question")) for j in range(2)]),
        lambda qa: qa["position"] < k % 3)
    guests = F.when(k % 4 == 0, F.array(F.concat(F.lit("guest"), F.col("event_id").cast("string"),
                                                 F.lit("@example.com")))) \
        .otherwise(F.array().cast("array<string>"))
    event_uri = F.concat(F.lit(S.SCHEDULED_EVENT_BASE), F.col("event_id").cast("string"))
    invitee_uri = F.concat(event_uri, F.lit("/invitees/"), _invitee_id(ts))
    scheduled = F.struct(
        iso_utc_text(ts).alias("created_at"),
        iso_utc_text(ts + F.make_dt_interval(mins=F.lit(30))).alias("end_time"),
        guests.alias("event_guests"),
        members.alias("event_memberships"),
        F.concat(F.lit(S.EVENT_TYPE_BASE), F.col("event_type")).alias("event_type"),
        F.struct(F.lit(1).cast("bigint").alias("total"),
                 F.when(F.col("event_type") == "error", 0).otherwise(1).cast("bigint").alias("active"),
                 F.lit(1).cast("bigint").alias("limit")).alias("invitees_counter"),
        F.struct(F.lit(None).cast("string").alias("join_url"), F.lit("pushed").alias("status"),
                 F.lit("zoom").alias("type")).alias("location"),
        F.lit(None).cast("string").alias("meeting_notes_html"),
        F.lit(None).cast("string").alias("meeting_notes_plain"),
        F.col("event_type").alias("name"),
        iso_utc_text(ts).alias("start_time"),
        F.lit("active").alias("status"),
        iso_utc_text(ts).alias("updated_at"),
        event_uri.alias("uri"),
    )
    tracking = F.struct(
        F.when(k % 5 != 4, F.concat(F.lit("cmp-"), (k % 8).cast("string"))).alias("utm_campaign"),
        _utm_source(k).alias("utm_source"),
        *[F.lit(None).cast("string").alias(n)
          for n in ("utm_medium", "utm_content", "utm_term", "salesforce_uuid")],
    )
    event_name = F.when(F.col("event_type") == "error", F.lit(S.CANCEL_EVENT)).otherwise(F.lit(S.BOOKING_EVENT))
    nulls = {n: F.lit(None).cast("string") for n in (
        "first_name", "invitee_scheduled_by", "last_name", "new_invitee", "no_show", "old_invitee",
        "payment", "reconfirmation", "routing_form_submission", "scheduling_method")}
    payload = F.struct(
        F.concat(F.lit(f"{S.API_BASE}/cancellations/"), F.col("event_id").cast("string")).alias("cancel_url"),
        iso_utc_text(ts).alias("created_at"),
        F.concat(F.lit("invitee"), F.col("event_id").cast("string"), F.lit("@example.com")).alias("email"),
        F.lit("active").alias("event"),
        nulls["first_name"].alias("first_name"),
        nulls["invitee_scheduled_by"].alias("invitee_scheduled_by"),
        nulls["last_name"].alias("last_name"),
        F.concat(F.lit("Invitee "), F.col("event_id").cast("string")).alias("name"),
        nulls["new_invitee"].alias("new_invitee"),
        nulls["no_show"].alias("no_show"),
        nulls["old_invitee"].alias("old_invitee"),
        nulls["payment"].alias("payment"),
        answers.alias("questions_and_answers"),
        nulls["reconfirmation"].alias("reconfirmation"),
        F.concat(F.lit(f"{S.API_BASE}/reschedulings/"), F.col("event_id").cast("string")).alias("reschedule_url"),
        (k % 7 == 0).alias("rescheduled"),
        nulls["routing_form_submission"].alias("routing_form_submission"),
        scheduled.alias("scheduled_event"),
        nulls["scheduling_method"].alias("scheduling_method"),
        F.when(F.col("event_type") == "error", F.lit("canceled")).otherwise(F.lit("active")).alias("status"),
        F.lit(None).cast("string").alias("text_reminder_number"),
        F.lit("UTC").alias("timezone"),
        tracking.alias("tracking"),
        iso_utc_text(ts).alias("updated_at"),
        invitee_uri.alias("uri"),
    )
    data = F.struct(iso_utc_text(ts).alias("created_at"),
                    F.concat(F.lit(S.USER_BASE), user).alias("created_by"),
                    event_name.alias("event"),
                    payload.alias("payload"))
    return events.select(
        iso_local_text(ingestion).alias("ingestion_time"),
        F.lit("webhook").alias("source"),
        data.alias("data"),
        F.to_date(ingestion).cast("string").alias("event_date"),
    )


def _spend_text(orders_key: Column, price: Column) -> Column:
    # Raw spend as delivered: text, with junk ('bad'), gaps (NULL) and refunds (negative).
    text = price.cast("string")
    return (F.when(orders_key % 50 == 0, F.lit("bad"))
            .when(orders_key % 51 == 0, F.lit(None).cast("string"))
            .when(orders_key % 53 == 0, F.concat(F.lit("-"), text))
            .otherwise(text))


def _channel_of_priority() -> Column:
    items = list(S.PRIORITY_CHANNELS.items())
    expr = F.when(F.col("o_orderpriority") == items[0][0], F.lit(items[0][1]))
    for prio, channel in items[1:]:
        expr = expr.when(F.col("o_orderpriority") == prio, F.lit(channel))
    return expr


def spend_date(aligned: bool) -> Column:
    """Order date, or (``aligned``) a day of the 30-day booking calendar."""
    if aligned:
        return F.date_add(F.lit(S.SPEND_CALENDAR_START).cast("date"),
                          (F.col("o_orderkey") % S.SPEND_CALENDAR_DAYS).cast("int")).cast("string")
    return F.to_date(F.col("o_orderdate")).cast("string")


def spend_raw(orders: DataFrame, aligned: bool = False) -> DataFrame:
    """One raw spend record per order: ``date`` text, ``channel`` with the paid-ads
    suffix, ``spend`` as text (dirty), ``position`` (order key = place in the day file)."""
    return orders.select(
        spend_date(aligned).alias("date"),
        _channel_of_priority().alias("channel"),
        _spend_text(F.col("o_orderkey"), F.col("o_totalprice")).alias("spend"),
        F.col("o_orderkey").alias("position"),
    )


def spend_records(orders: DataFrame, aligned: bool = False) -> DataFrame:
    """Clean spend records ``(date, channel, spend double, position)``."""
    return orders.select(
        spend_date(aligned).alias("date"),
        _channel_of_priority().alias("channel"),
        F.col("o_totalprice").alias("spend"),
        F.col("o_orderkey").alias("position"),
    )
