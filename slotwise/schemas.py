"""Explicit schemas and the fixed values the results depend on.

Every JSON scan uses one of these schemas, so column names never depend on what a
batch happened to contain (an all-empty array would otherwise be inferred as
``array<string>`` and lose its fields).
"""

from __future__ import annotations

from pyspark.sql import types as T

# --------------------------------------------------------------------------------------
# Fixed values (must stay exactly as written for results to match)
# --------------------------------------------------------------------------------------
# Channel dimension, in reporting order.
CHANNELS = ["facebook", "youtube", "tiktok", "others"]
# The three paid channels; everything else is bucketed into "others".
REAL_CHANNELS = ["facebook", "youtube", "tiktok"]
# Companies kept by the Bronze spend load, in the order the load lists them.
LISTED_COMPANIES = ["youtube_paid_ads", "facebook_paid_ads", "tiktok_paid_ads"]
# Suffix removed from raw spend channel names.
PAID_SUFFIX = "_paid_ads"
# Booking events that count as bookings.
BOOKING_EVENT = "invitee.created"
CANCEL_EVENT = "invitee.canceled"
# Employee id inside a user URI.
USER_ID_PATTERN = r"users/([a-zA-Z0-9-]+)"
# Invitee id at the end of an invitee URI.
INVITEE_ID_PATTERN = r"invitees/(.+)$"
# Partition value inside a Bronze event path.
EVENT_DATE_PATTERN = r"event_date=([0-9\-]+)"
# Day numbers (1 = Sunday ... 7 = Saturday) and their names.
DAY_NAMES = ["Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday"]
# Raw spend file naming.
SPEND_FILE_PREFIX = "spend_data_"
SPEND_FILE_SUFFIX = ".json"
#: The number of a day's further files, ``spend_data_<day>.00001.json``.
SPEND_FILE_NUMBER = r"\.(\d{5,})\.json$"
MANIFEST_NAME = "file_index.json"
# Bronze spend file naming.
BRONZE_SPEND_PREFIX = "spend-date-"

# URI prefixes of the synthetic booking model built from the driver tables.
API_BASE = "https://api.example.com"
EVENT_TYPE_BASE = f"{API_BASE}/event_types/"
USER_BASE = f"{API_BASE}/users/"
SCHEDULED_EVENT_BASE = f"{API_BASE}/scheduled_events/"

# Event type (driver `events.event_type`) of each paid channel's booking page.
CHANNEL_EVENT_TYPES = {"facebook": "click", "youtube": "view", "tiktok": "purchase"}
# Channel URI -> channel map used by attribution (a small broadcast table in spirit).
CHANNEL_URIS = {f"{EVENT_TYPE_BASE}{t}": c for c, t in CHANNEL_EVENT_TYPES.items()}
# Order priority (driver `orders.o_orderpriority`) -> raw spend channel.
PRIORITY_CHANNELS = {
    "1-URGENT": "facebook_paid_ads",
    "2-HIGH": "youtube_paid_ads",
    "3-MEDIUM": "tiktok_paid_ads",
    "4-NOT SPECIFIED": "linkedin_paid_ads",
    "5-LOW": "podcast_paid_ads",
}
# UTM source by props.k % 5 (4 -> no UTM source).
UTM_SOURCES = ["facebook", "youtube", "tiktok", "newsletter"]
# First day of the booking calendar that aligned spend dates are laid on.
SPEND_CALENDAR_START = "2024-01-01"
SPEND_CALENDAR_DAYS = 30

# --------------------------------------------------------------------------------------
# Schemas
# --------------------------------------------------------------------------------------
SPEND_RECORD = T.StructType([
    T.StructField("date", T.StringType()),
    T.StructField("channel", T.StringType()),
    T.StructField("spend", T.DoubleType()),
])

# Raw spend as it arrives: spend may be text, a number, or missing.
SPEND_RECORD_RAW = T.StructType([
    T.StructField("date", T.StringType()),
    T.StructField("channel", T.StringType()),
    T.StructField("spend", T.StringType()),
])

# Raw spend with its place in the day's file (first match wins).
SPEND_RECORD_RAW_POS = T.StructType(SPEND_RECORD_RAW.fields + [T.StructField("position", T.LongType())])

# fact_marketing as stored (date is the partition column).
FACT_MARKETING = T.StructType([
    T.StructField("date", T.StringType()),
    T.StructField("spend_date", T.StringType()),
    T.StructField("channel", T.StringType()),
    T.StructField("spend", T.DoubleType()),
])

# The older JSON-lines spend layout (``spend_date`` is the partition folder).
SPEND_LINES = T.StructType(SPEND_RECORD.fields + [T.StructField("spend_date", T.StringType())])

MANIFEST = T.StructType([T.StructField("files", T.ArrayType(T.StringType()))])

QUESTION_AND_ANSWER = T.StructType([
    T.StructField("answer", T.StringType()),
    T.StructField("position", T.LongType()),
    T.StructField("question", T.StringType()),
])

EVENT_MEMBERSHIP = T.StructType([
    T.StructField("user", T.StringType()),
    T.StructField("user_email", T.StringType()),
    T.StructField("user_name", T.StringType()),
])

SCHEDULED_EVENT = T.StructType([
    T.StructField("created_at", T.StringType()),
    T.StructField("end_time", T.StringType()),
    T.StructField("event_guests", T.ArrayType(T.StringType())),
    T.StructField("event_memberships", T.ArrayType(EVENT_MEMBERSHIP)),
    T.StructField("event_type", T.StringType()),
    T.StructField("invitees_counter", T.StructType([
        T.StructField("total", T.LongType()),
        T.StructField("active", T.LongType()),
        T.StructField("limit", T.LongType()),
    ])),
    T.StructField("location", T.StructType([
        T.StructField("join_url", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("type", T.StringType()),
    ])),
    T.StructField("meeting_notes_html", T.StringType()),
    T.StructField("meeting_notes_plain", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("start_time", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("updated_at", T.StringType()),
    T.StructField("uri", T.StringType()),
])

TRACKING = T.StructType([
    T.StructField("utm_campaign", T.StringType()),
    T.StructField("utm_source", T.StringType()),
    T.StructField("utm_medium", T.StringType()),
    T.StructField("utm_content", T.StringType()),
    T.StructField("utm_term", T.StringType()),
    T.StructField("salesforce_uuid", T.StringType()),
])

PAYLOAD = T.StructType([
    T.StructField("cancel_url", T.StringType()),
    T.StructField("created_at", T.StringType()),
    T.StructField("email", T.StringType()),
    T.StructField("event", T.StringType()),
    T.StructField("first_name", T.StringType()),
    T.StructField("invitee_scheduled_by", T.StringType()),
    T.StructField("last_name", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("new_invitee", T.StringType()),
    T.StructField("no_show", T.StringType()),
    T.StructField("old_invitee", T.StringType()),
    T.StructField("payment", T.StringType()),
    T.StructField("questions_and_answers", T.ArrayType(QUESTION_AND_ANSWER)),
    T.StructField("reconfirmation", T.StringType()),
    T.StructField("reschedule_url", T.StringType()),
    T.StructField("rescheduled", T.BooleanType()),
    T.StructField("routing_form_submission", T.StringType()),
    T.StructField("scheduled_event", SCHEDULED_EVENT),
    T.StructField("scheduling_method", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("text_reminder_number", T.StringType()),
    T.StructField("timezone", T.StringType()),
    T.StructField("tracking", TRACKING),
    T.StructField("updated_at", T.StringType()),
    T.StructField("uri", T.StringType()),
])

# One webhook delivery: envelope around the event document.
BOOKING_EVENT_DOC = T.StructType([
    T.StructField("ingestion_time", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("data", T.StructType([
        T.StructField("created_at", T.StringType()),
        T.StructField("created_by", T.StringType()),
        T.StructField("event", T.StringType()),
        T.StructField("payload", PAYLOAD),
    ])),
])

# Of it, what a count of bookings reads.
BOOKING_COUNT_DOC = T.StructType([
    T.StructField("ingestion_time", T.StringType()),
    T.StructField("data", T.StructType([
        T.StructField("event", T.StringType()),
        T.StructField("payload", T.StructType([
            T.StructField("scheduled_event", T.StructType([
                T.StructField("event_type", T.StringType()), T.StructField("start_time", T.StringType())])),
            T.StructField("uri", T.StringType()),
        ])),
    ])),
])

# Columns of the flattened event table the Gold layer reads.
COL_EVENT = "data_event"
COL_EVENT_TYPE = "data_payload_scheduled_event_event_type"
COL_START_TIME = "data_payload_scheduled_event_start_time"
COL_MEMBER_USER = "data_payload_scheduled_event_event_memberships_user"
# Columns that name one document or invitee.
DOCUMENT_NAMES = ("data_payload_uri", "data_payload_cancel_url", "data_payload_reschedule_url", "data_payload_email",
                  "data_payload_name", "data_payload_scheduled_event_uri")


def fact_events_schema() -> T.StructType:
    """``fact_events`` as stored: every leaf of the document under its flattened name, and
    the partition column."""
    out: list[T.StructField] = []

    def walk(prefix: str, dt: T.DataType) -> None:
        while isinstance(dt, T.ArrayType):
            dt = dt.elementType
        if isinstance(dt, T.StructType):
            for f in dt.fields:
                walk(f"{prefix}_{f.name}", f.dataType)
        else:
            out.append(T.StructField(prefix, dt))

    for f in BOOKING_EVENT_DOC.fields:
        walk(f.name, f.dataType)
    return T.StructType([*out, T.StructField("event_date", T.StringType())])
