"""Streaming across several micro-batches: late rows, re-runs, corrupt input."""

from __future__ import annotations

import datetime as dt
import json
import os

import pandas as pd

from slotwise.session import scratch_path
from slotwise.sources import json_io
from slotwise.streaming import bookings as stream

EVENT_COLUMNS = ["event_id", "ts", "user_id", "event_type", "value", "props"]


def _events_file(folder: str, name: str, rows: list[tuple]) -> None:
    os.makedirs(folder, exist_ok=True)
    df = pd.DataFrame(rows, columns=EVENT_COLUMNS)
    df["ts"] = pd.to_datetime(df["ts"]).astype("datetime64[us]")
    df.to_parquet(os.path.join(folder, name), index=False)


def _schema(spark, folder):
    return spark.read.parquet(folder).schema


def test_late_rows_count_whenever_they_arrive(spark):
    src = scratch_path(spark, "stream-src").replace("file:", "")
    table, ckpt = scratch_path(spark, "stream-table"), scratch_path(spark, "stream-ckpt")
    _events_file(src, "a.parquet", [(1, dt.datetime(2024, 1, 10, 9), 7, "click", 1.0, '{"k": 1}'),
                                    (2, dt.datetime(2024, 1, 10, 11), 8, "click", 1.0, '{"k": 1}')])
    schema = _schema(spark, src)

    def run():
        events = stream.events_stream(spark, src, schema)
        stream.daily_counts_to_table(stream.booking_stream(events), table, ckpt)

    run()
    # Second delivery: one row 9 days late, one a day late, one more on the same day.
    _events_file(src, "b.parquet", [(3, dt.datetime(2024, 1, 1, 9), 7, "click", 1.0, '{"k": 1}'),
                                    (4, dt.datetime(2024, 1, 9, 9), 7, "click", 1.0, '{"k": 1}'),
                                    (5, dt.datetime(2024, 1, 10, 20), 9, "click", 1.0, '{"k": 1}')])
    run()
    got = {(str(r.booking_date), r.channel): r.bookings_count
           for r in spark.read.schema(stream.DAILY_COUNTS).parquet(table).collect()}
    assert got == {("2024-01-10", "facebook"): 3, ("2024-01-09", "facebook"): 1, ("2024-01-01", "facebook"): 1}
    # A run with nothing new changes nothing (the checkpoint holds the progress).
    run()
    assert spark.read.schema(stream.DAILY_COUNTS).parquet(table).count() == 3
    # A new checkpoint over the table reads everything again and counts nothing twice.
    _events_file(src, "c.parquet", [(6, dt.datetime(2024, 1, 10, 21), 9, "click", 1.0, '{"k": 1}')])
    events = stream.events_stream(spark, src, schema)
    stream.daily_counts_to_table(stream.booking_stream(events), table, scratch_path(spark, "stream-ckpt"))
    got = {(str(r.booking_date), r.channel): r.bookings_count
           for r in spark.read.schema(stream.DAILY_COUNTS).parquet(table).collect()}
    assert got == {("2024-01-10", "facebook"): 4, ("2024-01-09", "facebook"): 1, ("2024-01-01", "facebook"): 1}


def test_streams_equal_the_batch_whatever_the_file_layout(spark, sf_dir):
    from pyspark.sql import functions as F
    from slotwise.operators import gold
    from slotwise.sources import model
    from slotwise.sources.tables import read_table
    events = read_table(spark, sf_dir, "events")
    src = scratch_path(spark, "six-files").replace("file:", "")
    events.repartition(6, F.xxhash64("event_id")).write.parquet(src)
    rows = gold.enrich(model.booking_facts(events))
    for limit in (None, 1):                     # all files in one batch, one file per batch
        bookings = stream.booking_stream(stream.events_stream(spark, src, events.schema, limit))
        table, out = scratch_path(spark, "t-daily"), scratch_path(spark, "t-dedup")
        stream.daily_counts_to_table(bookings, table, scratch_path(spark, "c-daily"))
        total = spark.read.schema(stream.DAILY_COUNTS).parquet(table).agg(F.sum("bookings_count")).first()[0]
        assert total == rows.count()
        schema = stream.dedup_stream(bookings, out, scratch_path(spark, "c-dedup"))
        assert spark.read.schema(schema).parquet(out).count() == rows.select("invitee_id").distinct().count()


def test_stream_dedup_keeps_the_first_delivery(spark):
    src = scratch_path(spark, "dedup-src").replace("file:", "")
    out, ckpt = scratch_path(spark, "dedup-out"), scratch_path(spark, "dedup-ckpt")
    # Same user, type and day -> one invitee, delivered twice in two files.
    _events_file(src, "a.parquet", [(1, dt.datetime(2024, 1, 10, 9), 7, "click", 1.0, '{"k": 1}')])
    schema = _schema(spark, src)
    stream.dedup_stream(stream.booking_stream(stream.events_stream(spark, src, schema)), out, ckpt)
    _events_file(src, "b.parquet", [(2, dt.datetime(2024, 1, 10, 15), 7, "click", 1.0, '{"k": 1}'),
                                    (3, dt.datetime(2024, 1, 10, 15), 8, "click", 1.0, '{"k": 1}')])
    stream.dedup_stream(stream.booking_stream(stream.events_stream(spark, src, schema)), out, ckpt)
    ids = sorted(r.invitee_id for r in spark.read.parquet(out).collect())
    assert ids == ["7-click-20240110", "8-click-20240110"]


def test_corrupt_documents_are_kept_aside(spark, tmp_path):
    folder = tmp_path / "event_date=2026-01-15"
    folder.mkdir()
    good = {"ingestion_time": "2026-01-15T06:00:00.5", "source": "webhook",
            "data": {"event": "invitee.created", "payload": {"uri": "u/invitees/i1"}}}
    (folder / "part-0.json").write_text(json.dumps(good) + "\n{not json\n")
    docs = json_io.read_event_documents(spark, str(tmp_path), layout="lines", corrupt_col="_corrupt_record")
    rows = docs.collect()
    assert len(rows) == 2
    assert sum(r._corrupt_record is not None for r in rows) == 1
    assert {r.event_date for r in rows} == {"2026-01-15"}


def test_dedup_merge_keeps_the_first_delivery_across_batches(spark):
    from pyspark.sql import functions as F
    from pyspark.sql import types as T
    from slotwise import schemas as S
    from slotwise.sources import model
    src = scratch_path(spark, "first-src").replace("file:", "")
    table, ckpt = scratch_path(spark, "first-table"), scratch_path(spark, "first-ckpt")
    _events_file(src, "a.parquet", [(1, dt.datetime(2024, 1, 10, 9), 7, "click", 1.0, '{"k": 1}')])
    schema = _schema(spark, src)
    out = T.StructType([T.StructField("invitee_id", T.StringType()), T.StructField("event_id", T.LongType()),
                        T.StructField("booking_date", T.DateType())])

    def run():
        facts = model.booking_facts(stream.events_stream(spark, src, schema))
        rows = facts.select("invitee_id", "event_id", F.to_date(S.COL_START_TIME).alias("booking_date"))
        stream.upsert_stream(rows, table, ckpt, ["invitee_id"], "booking_date", ["event_id"], out,
                             key_determines_partition=True, keep="first")

    run()
    # A re-delivery of invitee 7-click-20240110 (later id) and a new invitee.
    _events_file(src, "b.parquet", [(5, dt.datetime(2024, 1, 10, 15), 7, "click", 1.0, '{"k": 1}'),
                                    (6, dt.datetime(2024, 1, 11, 8), 7, "click", 1.0, '{"k": 1}')])
    run()
    got = sorted((r.invitee_id, r.event_id) for r in spark.read.schema(out).parquet(table).collect())
    assert got == [("7-click-20240110", 1), ("7-click-20240111", 6)]
