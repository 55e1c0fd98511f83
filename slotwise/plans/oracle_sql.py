"""Reference SQL (DuckDB dialect) for the registered queries.

Each query's SQL re-derives its inputs from the driver tables with the same rules as
``slotwise.sources.model`` and then states the result declaratively, independent of
the Spark code path.
"""

from __future__ import annotations

# Common table expressions, composed per query.
CTE = {
    "booking_facts": """
booking_facts AS (
  SELECT event_id,
    CAST(user_id AS VARCHAR) || '-' || event_type || '-' || strftime(ts, '%Y%m%d') AS invitee_id,
    CASE WHEN event_type = 'error' THEN 'invitee.canceled' ELSE 'invitee.created' END AS data_event,
    ts AS data_created_at,
    CASE WHEN event_id % 10 = 0 THEN ts - INTERVAL 1 SECOND
         ELSE ts + to_hours(CAST(k % 72 AS BIGINT)) + INTERVAL 1 SECOND END AS ingestion_time,
    'https://api.example.com/event_types/' || event_type AS data_payload_scheduled_event_event_type,
    event_type AS meeting_name,
    ts AS data_payload_scheduled_event_start_time,
    'https://api.example.com/users/' || CAST(user_id AS VARCHAR)
      AS data_payload_scheduled_event_event_memberships_user,
    'user' || CAST(user_id AS VARCHAR) || '@example.com' AS employee_email,
    'invitee' || CAST(event_id AS VARCHAR) || '@example.com' AS invitee_email,
    CASE k % 5 WHEN 0 THEN 'facebook' WHEN 1 THEN 'youtube' WHEN 2 THEN 'tiktok'
               WHEN 3 THEN 'newsletter' END AS utm_source,
    CASE WHEN k % 5 <> 4 THEN 'cmp-' || CAST(k % 8 AS VARCHAR) END AS utm_campaign
  FROM (SELECT *, TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events) e
)""",
    "enriched": """
enriched AS (
  SELECT *,
    CASE data_payload_scheduled_event_event_type
      WHEN 'https://api.example.com/event_types/click' THEN 'facebook'
      WHEN 'https://api.example.com/event_types/view' THEN 'youtube'
      WHEN 'https://api.example.com/event_types/purchase' THEN 'tiktok'
      ELSE 'others' END AS channel,
    data_payload_scheduled_event_start_time AS booking_ts,
    CAST(data_payload_scheduled_event_start_time AS DATE) AS booking_date
  FROM booking_facts WHERE data_event = 'invitee.created'
)""",
    "dim": """
dim(channel) AS (VALUES ('facebook'), ('youtube'), ('tiktok'), ('others'))""",
    "spend_raw": """
spend_raw AS (
  SELECT CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS date,
    CASE o_orderpriority WHEN '1-URGENT' THEN 'facebook_paid_ads' WHEN '2-HIGH' THEN 'youtube_paid_ads'
      WHEN '3-MEDIUM' THEN 'tiktok_paid_ads' WHEN '4-NOT SPECIFIED' THEN 'linkedin_paid_ads'
      WHEN '5-LOW' THEN 'podcast_paid_ads' END AS channel,
    CASE WHEN o_orderkey % 50 = 0 THEN NULL WHEN o_orderkey % 51 = 0 THEN NULL
         WHEN o_orderkey % 53 = 0 THEN -o_totalprice ELSE o_totalprice END AS spend,
    CASE WHEN o_orderkey % 50 = 0 THEN 'bad' WHEN o_orderkey % 51 = 0 THEN 'missing'
         WHEN o_orderkey % 53 = 0 THEN 'negative' END AS defect,
    o_totalprice AS price,
    o_orderkey AS position
  FROM orders
)""",
    "spend_aligned_raw": """
spend_aligned_raw AS (
  SELECT CAST(DATE '2024-01-01' + CAST(o_orderkey % 30 AS INTEGER) AS VARCHAR) AS date,
    CASE o_orderpriority WHEN '1-URGENT' THEN 'facebook_paid_ads' WHEN '2-HIGH' THEN 'youtube_paid_ads'
      WHEN '3-MEDIUM' THEN 'tiktok_paid_ads' WHEN '4-NOT SPECIFIED' THEN 'linkedin_paid_ads'
      WHEN '5-LOW' THEN 'podcast_paid_ads' END AS channel,
    CASE WHEN o_orderkey % 50 = 0 THEN NULL WHEN o_orderkey % 51 = 0 THEN NULL
         WHEN o_orderkey % 53 = 0 THEN -o_totalprice ELSE o_totalprice END AS spend,
    o_orderkey AS position
  FROM orders
)""",
    "fact_marketing": """
fact_marketing AS (
  SELECT date, date AS spend_date, replace(channel, '_paid_ads', '') AS channel, spend
  FROM spend_raw WHERE date IS NOT NULL AND channel IS NOT NULL AND spend IS NOT NULL
)""",
    "fact_marketing_aligned": """
fact_marketing_aligned AS (
  SELECT date, date AS spend_date, replace(channel, '_paid_ads', '') AS channel, spend
  FROM spend_aligned_raw WHERE date IS NOT NULL AND channel IS NOT NULL AND spend IS NOT NULL
)""",
    "spend_records": """
spend_records AS (
  SELECT CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS date,
    CASE o_orderpriority WHEN '1-URGENT' THEN 'facebook_paid_ads' WHEN '2-HIGH' THEN 'youtube_paid_ads'
      WHEN '3-MEDIUM' THEN 'tiktok_paid_ads' WHEN '4-NOT SPECIFIED' THEN 'linkedin_paid_ads'
      WHEN '5-LOW' THEN 'podcast_paid_ads' END AS channel,
    o_totalprice AS spend, o_orderkey AS position
  FROM orders
)""",
    "listed_first": """
listed_first AS (
  SELECT date, channel, spend FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY date, channel ORDER BY position) AS rn
    FROM spend_records
    WHERE channel IN ('youtube_paid_ads', 'facebook_paid_ads', 'tiktok_paid_ads')) s
  WHERE rn = 1
)""",
    "cpb": """
cpb AS (
  SELECT d.channel,
    COALESCE(bk.n, 0) AS total_bookings_count,
    COALESCE(sp.s, 0.0) AS total_spend,
    CASE WHEN COALESCE(bk.n, 0) = 0 THEN 0.0
         ELSE COALESCE(sp.s, 0.0) / COALESCE(bk.n, 0) END AS cpb
  FROM dim d
  LEFT JOIN (SELECT channel, COUNT(*) AS n FROM enriched GROUP BY channel) bk ON bk.channel = d.channel
  LEFT JOIN (SELECT CASE WHEN channel IN ('facebook', 'youtube', 'tiktok') THEN channel ELSE 'others' END AS channel,
                    CAST(CAST(SUM(CAST(CAST(spend AS VARCHAR) AS DECIMAL(28, 10))) AS VARCHAR) AS DOUBLE) AS s
             FROM fact_marketing WHERE channel IS NOT NULL GROUP BY 1) sp ON sp.channel = d.channel
)""",
    "attribution": """
attribution AS (
  SELECT *,
    CAST(DENSE_RANK() OVER (ORDER BY total_bookings_count DESC) AS INTEGER) AS rank_by_volume,
    CAST(DENSE_RANK() OVER (ORDER BY cpb ASC NULLS LAST) AS INTEGER) AS rank_by_cpb
  FROM cpb
)""",
    "daily": """
daily AS (
  SELECT d.booking_date, ch.channel, COALESCE(c.n, 0) AS bookings_count,
    CAST(week(d.booking_date) AS INTEGER) AS booking_week
  FROM (SELECT DISTINCT booking_date FROM enriched) d
  CROSS JOIN dim ch
  LEFT JOIN (SELECT booking_date, channel, COUNT(*) AS n FROM enriched GROUP BY 1, 2) c
    ON c.booking_date = d.booking_date AND c.channel = ch.channel
)""",
    "time_analysis": """
time_analysis AS (
  SELECT d.channel, t.booking_hour, t.booking_day_of_week, COALESCE(t.n, 0) AS bookings_count
  FROM dim d LEFT JOIN (
    SELECT channel, CAST(hour(booking_ts) AS INTEGER) AS booking_hour,
      CAST(dayofweek(booking_ts) + 1 AS INTEGER) AS booking_day_of_week, COUNT(*) AS n
    FROM enriched GROUP BY 1, 2, 3) t ON t.channel = d.channel
)""",
    "meeting_load": """
meeting_load AS (
  SELECT regexp_extract(data_payload_scheduled_event_event_memberships_user, 'users/([a-zA-Z0-9-]+)', 1) AS user_id,
    COUNT(*) AS total_meetings_count
  FROM enriched GROUP BY 1
)""",
}

# Dependencies between the expressions above (emitted in this order).
_ORDER = ["booking_facts", "enriched", "dim", "spend_raw", "spend_aligned_raw", "fact_marketing",
          "fact_marketing_aligned", "spend_records", "listed_first", "cpb", "attribution", "daily",
          "time_analysis", "meeting_load"]
_NEEDS = {
    "enriched": ["booking_facts"],
    "fact_marketing": ["spend_raw"],
    "fact_marketing_aligned": ["spend_aligned_raw"],
    "listed_first": ["spend_records"],
    "cpb": ["enriched", "dim", "fact_marketing"],
    "attribution": ["cpb"],
    "daily": ["enriched", "dim"],
    "time_analysis": ["enriched", "dim"],
    "meeting_load": ["enriched"],
}


def with_ctes(names: list[str], body: str, extra: list[str] | None = None) -> str:
    """``WITH`` the named expressions (and what they need) followed by ``body``.

    ``extra`` holds further query-specific ``name AS (...)`` expressions, emitted last.
    """
    wanted: set[str] = set()

    def add(n: str) -> None:
        if n in wanted:
            return
        for dep in _NEEDS.get(n, []):
            add(dep)
        wanted.add(n)

    for n in names:
        add(n)
    parts = [CTE[n].strip() for n in _ORDER if n in wanted] + [e.strip() for e in (extra or [])]
    if not parts:
        return body.strip()
    return "WITH " + ",\n".join(parts) + "\n" + body.strip()
