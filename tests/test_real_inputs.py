"""Inputs in the layout they are published in, and the cases where rows used to get lost."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from slotwise import schemas as S
from slotwise.functions import exact_sum
from slotwise.operators import contracts, gold, incremental, metrics, spend
from slotwise.plans import jobs
from slotwise.session import scratch_path
from slotwise.sources import json_io

DAY = "2026-01-14"
RECORDS = [{"date": DAY, "channel": "facebook_paid_ads", "spend": 10.5},
           {"date": DAY, "channel": "tiktok_paid_ads", "spend": "7"},
           {"date": DAY, "channel": "youtube_paid_ads", "spend": 3},
           {"date": DAY, "channel": "youtube_paid_ads", "spend": 99}]


@pytest.fixture()
def published(tmp_path):
    raw, index = tmp_path / "raw", tmp_path / "index"
    raw.mkdir()
    index.mkdir()
    (raw / f"spend_data_{DAY}.json").write_text(json.dumps(RECORDS, indent=1))
    (raw / "spend_data_2026-01-15.json").write_text(json.dumps([dict(r, date=DAY) for r in RECORDS]))
    (raw / "spend_data_2026-01-16.json").write_text("[]")     # not listed
    (index / S.MANIFEST_NAME).write_text(json.dumps(
        {"files": [f"spend_data_{DAY}.json", "spend_data_2026-01-15.json", "spend_data_2026-01-20.json"]}, indent=2))
    return str(raw), str(index)


def test_manifest_indented(spark, published):
    assert json_io.read_manifest(spark, published[1]).count() == 3


def test_listed_files_flat_arrays(spark, published):
    rows = json_io.load_listed_files(spark, *published)
    assert rows.count() == 8
    found, missing = json_io.listed_files(spark, *published)
    assert sorted(found) == [f"spend_data_{DAY}.json", "spend_data_2026-01-15.json"]
    assert missing == ["spend_data_2026-01-20.json"]
    first = spend.listed_first(spend.with_file_date(rows)).collect()
    assert {(r.channel, r.spend) for r in first} == {
        ("facebook_paid_ads", "10.5"), ("tiktok_paid_ads", "7"), ("youtube_paid_ads", "3")}


def test_bronze_names_manifest_and_missing_days(spark, published, tmp_path):
    bronze = str(tmp_path / "bronze")
    missing = jobs.bronze_spend_job(spark, *published, bronze)
    assert {(r.date, r.channel) for r in missing.collect()} == {
        (d, c) for d in ("2026-01-15", "2026-01-20") for c in S.LISTED_COMPANIES}
    names = sorted(p.name for p in (tmp_path / "bronze").iterdir() if not p.name.startswith("."))
    assert names == [S.MANIFEST_NAME, f"spend-date-{DAY}.json"]
    assert len(json.loads((tmp_path / "bronze" / f"spend-date-{DAY}.json").read_text())) == 3
    assert json_io.read_spend_files(spark, bronze).count() == 3
    assert jobs.silver_marketing_job(spark, bronze, str(tmp_path / "silver")) == 3


def test_empty_spend_writes_nothing_and_counts_zero(spark, tmp_path):
    (tmp_path / "b").mkdir()
    (tmp_path / "b" / f"spend-date-{DAY}.json").write_text("[]")
    assert jobs.silver_marketing_job(spark, str(tmp_path / "b"), str(tmp_path / "s")) == 0


def test_sums_below_a_cent(spark):
    got = spark.range(1000).select(F.lit(0.004).alias("s")).agg(exact_sum("s")).first()[0]
    assert got == pytest.approx(4.0)


def _bookings_and_spend(spark):
    bookings = spark.sql("SELECT DATE '2026-01-14' AS booking_date, 'facebook' AS channel, "
                         "TIMESTAMP_NTZ '2026-01-14 09:30:00' AS booking_ts")
    marketing = spark.createDataFrame([(DAY, DAY, "facebook", 10.0), (DAY, DAY, "podcast", 90.0),
                                       ("2026-02-01", "2026-02-01", "tiktok", 5.0)],
                                      "date string, spend_date string, channel string, spend double")
    return bookings, marketing


def test_no_spend_is_lost(spark):
    bookings, marketing = _bookings_and_spend(spark)
    for table in (metrics.daily_cpb(bookings, marketing), metrics.gold_contract(bookings, marketing)):
        assert table.agg(F.sum("total_spend")).first()[0] == pytest.approx(105.0)


def test_reprocessing_removes_withdrawn_days(spark):
    path = scratch_path(spark, "withdrawn")
    rows = spark.createDataFrame([("a", "2026-01-10"), ("b", "2026-01-12"), ("c", "2026-01-13")], "k string, d string") \
        .withColumn("d", F.col("d").cast("date"))
    incremental.overwrite_partitions(rows, path, ["d"])
    incremental.reprocess_days(rows.where("k <> 'b'"), path, "d", "2026-01-14", 3)
    assert sorted(r.k for r in spark.read.parquet(path).collect()) == ["a", "c"]


def _document(n: int, event_type: str = "https://api.example.com/event_types/x") -> dict:
    return {"ingestion_time": f"2026-01-15T06:0{n}:00.5", "source": "webhook", "data": {
        "created_at": "2026-01-15T06:00:00Z", "event": "invitee.created", "payload": {
            "uri": f"https://api.example.com/scheduled_events/e{n}/invitees/i1", "email": "a@example.com",
            "tracking": {"utm_source": "facebook", "utm_campaign": None}, "questions_and_answers": [],
            "scheduled_event": {"uri": f"https://api.example.com/scheduled_events/e{n}", "event_type": event_type,
                                "start_time": "2026-01-16T17:15:00Z", "event_guests": [],
                                "event_memberships": [{"user": "https://api.example.com/users/u1",
                                                       "user_email": "e@example.com"}]}}}}


def test_silver_from_documents_with_a_broken_one(spark, tmp_path):
    day = tmp_path / "bronze" / "event_date=2026-01-15"
    day.mkdir(parents=True)
    (day / "a.json").write_text(json.dumps(_document(1), indent=2))
    (day / "b.json").write_text(json.dumps(_document(2)))
    (day / "c.json").write_text("{broken")
    silver, broken = str(tmp_path / "silver"), str(tmp_path / "broken")
    assert jobs.silver_events_job(spark, str(tmp_path / "bronze"), silver, quarantine_path=broken) == 2
    assert spark.read.json(broken).count() == 1
    facts = spark.read.schema(S.fact_events_schema()).parquet(silver)
    uri = {"https://api.example.com/event_types/x": "facebook"}
    booking = contracts.silver_contract(contracts.from_fact_events(facts), uri).collect()
    assert [(r.invitee_id, r.channel, r.employee_email, r.is_valid_record) for r in booking] == [
        ("i1", "facebook", "e@example.com", True)]
    utm = metrics.utm_attribution(gold.enrich(contracts.from_fact_events(facts), uri)).collect()
    assert [(r.channel, r.attributed_by, r.bookings_count) for r in utm] == [("facebook", "utm", 2)]
    out = jobs.silver_bookings_job(spark, facts, str(tmp_path / "bookings"), str(tmp_path / "rejected"))
    assert out == {"silver_bookings": 1, "quarantined": 0}


def test_channel_map_names_three_channels(spark):
    uris = {"u1": "facebook", "u2": "youtube", "u3": "tiktok"}
    rows = spark.createDataFrame([(S.BOOKING_EVENT, u, "2026-01-16T17:15:00Z") for u in ("u1", "u2", "u3", "u4")],
                                 f"{S.COL_EVENT} string, {S.COL_EVENT_TYPE} string, {S.COL_START_TIME} string")
    assert sorted(r.channel for r in gold.enrich(rows, uris).collect()) == ["facebook", "others", "tiktok", "youtube"]
