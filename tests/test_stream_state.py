"""Watermark and corrections, state-store dedup, counts by deltas, the key index."""

from __future__ import annotations

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slotwise.operators import contracts, incremental, key_index
from slotwise.session import scratch_path
from slotwise.streaming import bookings as stream
from tests.test_streaming import _events_file, _schema


def day(d: int, h: int = 9) -> dt.datetime:
    return dt.datetime(2024, 1, d, h)


def counts(spark, table):
    return {(str(r.booking_date), r.channel): r.bookings_count for r in spark.read.schema(stream.DAILY_COUNTS).parquet(table).collect()}


def test_rows_behind_the_watermark_are_counted_and_kept_as_corrections(spark):
    src = scratch_path(spark, "late-src").replace("file:", "")
    table, ckpt = scratch_path(spark, "late-table"), scratch_path(spark, "late-ckpt")
    runs = [[(1, day(10), 7, "click", 1.0, '{"k": 1}')],
            [(2, day(20), 8, "click", 1.0, '{"k": 1}')],
            # days behind the watermark; once more as a repeated delivery; on time
            [(3, day(3), 7, "click", 1.0, '{"k": 1}'), (3, day(3), 7, "click", 1.0, '{"k": 1}'), (1, day(10), 7, "click", 1.0, '{"k": 1}'),
             (4, day(20, 12), 8, "click", 1.0, '{"k": 1}')],
            [(3, day(3), 7, "click", 1.0, '{"k": 1}'), (5, day(4), 7, "view", 1.0, '{"k": 1}')]]
    for i, rows in enumerate(runs):
        _events_file(src, f"{i}.parquet", rows)
        schema = _schema(spark, src)
        stream.daily_counts_to_table(stream.booking_stream(stream.events_stream(spark, src, schema)), table, ckpt)
    assert counts(spark, table) == {("2024-01-10", "facebook"): 1, ("2024-01-20", "facebook"): 2, ("2024-01-03", "facebook"): 1,
                                    ("2024-01-04", "youtube"): 1}
    assert sorted(r.delivery_id for r in stream.late_rows(spark, table).collect()) == ["3", "5"]
    late = {str(r.booking_date): r.late_count for r in spark.read.schema(stream.COUNTS_TABLE).parquet(table).collect()}
    assert late == {"2024-01-10": 0, "2024-01-20": 0, "2024-01-03": 1, "2024-01-04": 1}
    mark = stream.batch_watermark(spark, ckpt, 2)
    assert mark is not None and mark.date() <= dt.date(2024, 1, 19)


def test_a_replayed_batch_adds_nothing(spark):
    table = scratch_path(spark, "replay-table")
    new = spark.createDataFrame([("a", dt.date(2024, 1, 1), "facebook", False), ("b", dt.date(2024, 1, 1), "facebook", True),
                                 ("c", None, "others", False)], "delivery_id string, booking_date date, channel string, late boolean")
    days = {dt.date(2024, 1, 1), None}
    for own, batch in (("s", 0), ("s", 0), ("s", 1), ("s", 1), ("t", 0)):
        stream._add_counts(spark, new, table, days, own, batch)
    got = {r.channel: (r.bookings_count, r.late_count) for r in spark.read.schema(stream.COUNTS_TABLE).parquet(table).collect()}
    assert got == {"facebook": (6, 3), "others": (3, 0)}


def document(i: int, uri: str | None, hour: int = 9) -> dict:
    return {"ingestion_time": f"2026-01-15T1{i % 10}:00:00", "source": "webhook", "data": {"event": "invitee.created", "payload": {
        **({"uri": uri} if uri else {}), "scheduled_event": {"event_type": "x", "start_time": f"2026-01-16T{hour:02d}:00:00Z"}}}}


def test_deliveries_without_uri_count(spark, tmp_path):
    folder = tmp_path / "event_date=2026-01-15"
    folder.mkdir()
    docs = [document(1, "u/1"), document(2, "u/2"), document(3, None), document(3, None), document(4, None), document(2, "u/2")]
    (folder / "a.json").write_text("\n".join(map(json.dumps, docs)) + "\n")
    table = scratch_path(spark, "without-uri")
    for ckpt in ("c1", "c1", "c2"):                     # run, nothing new, a new checkpoint over the same files
        rows = stream.document_booking_stream(stream.document_stream(spark, str(tmp_path)))
        stream.daily_counts_to_table(rows, table, f"{scratch_path(spark, 'x')[:-14]}{ckpt}-{os.path.basename(table)}")
        assert counts(spark, table) == {("2026-01-16", "others"): 5}


@pytest.mark.parametrize("days", [(10, 12), (10, 25)])     # inside the state's memory, and long forgotten
def test_one_invitee_on_two_days_is_one_row(spark, days):
    src = scratch_path(spark, "moving-src").replace("file:", "")
    out, ckpt = scratch_path(spark, "moving-out"), scratch_path(spark, "moving-ckpt")
    for n, d in enumerate((days[0], 20, days[1])):
        _events_file(src, f"{n}.parquet", [(n, day(d), 1 if n != 1 else 2, "click", 1.0, '{"k": 1}')])
        events = stream.events_stream(spark, src, _schema(spark, src))
        rows = stream.booking_stream(events).withColumn("invitee_id", F.col("invitee_id").substr(1, 1))
        schema = stream.dedup_stream(rows, out, ckpt)
    got = sorted((r.invitee_id, str(r.booking_date)) for r in spark.read.schema(schema).parquet(out).collect())
    assert got == [("1", f"2024-01-{days[0]}"), ("2", "2024-01-20")]
    # a new checkpoint over the table: its state knows nothing, the table does
    _events_file(src, "9.parquet", [(9, day(28), 1, "click", 1.0, '{"k": 1}')])
    events = stream.events_stream(spark, src, _schema(spark, src), 1)
    rows = stream.booking_stream(events).withColumn("invitee_id", F.col("invitee_id").substr(1, 1))
    stream.dedup_stream(rows, out, scratch_path(spark, "moving-ckpt"))
    assert spark.read.schema(schema).parquet(out).count() == 2


def test_a_late_row_is_found_by_the_next_delivery(spark):
    """The late row never entered the state; its day is the watermark's own."""
    src = scratch_path(spark, "late-key-src").replace("file:", "")
    out, ckpt = scratch_path(spark, "late-key-out"), scratch_path(spark, "late-key-ckpt")
    steps = [(1, day(20, 21), 5), (2, day(19, 10), 1), (3, day(20, 22), 1)]       # the watermark is at the 19th, 21:00
    for n, (event, at, user) in enumerate(steps):
        _events_file(src, f"{n}.parquet", [(event, at, user, "click", 1.0, '{"k": 1}')])
        events = stream.events_stream(spark, src, _schema(spark, src))
        rows = stream.booking_stream(events).withColumn("invitee_id", F.col("invitee_id").substr(1, 1))
        schema = stream.dedup_stream(rows, out, ckpt)
    got = sorted((r.invitee_id, str(r.booking_date)) for r in spark.read.schema(schema).parquet(out).collect())
    assert got == [("1", "2024-01-19"), ("5", "2024-01-20")]


TABLE = T.StructType([T.StructField("id", T.StringType()), T.StructField("v", T.LongType()), T.StructField("day", T.DateType())])


def rows(spark, *values):
    return spark.createDataFrame([(i, v, dt.date(2024, 1, d) if d else None) for i, v, d in values], TABLE)


def test_key_index_follows_moving_keys(spark):
    path, plain = scratch_path(spark, "indexed"), scratch_path(spark, "plain")
    index = key_index.index_path(path)
    batches = [[("a", 1, 1), ("b", 1, 1), (None, 1, 2), ("c", 1, None)], [("a", 2, 3), ("d", 2, 1)], [("c", 3, 1), (None, 3, 3), ("b", 0, 5)],
               [("a", 4, 1)]]
    for batch in batches:
        for p, i in ((path, index), (plain, None)):
            incremental.upsert(spark, rows(spark, *batch), p, ["id"], "day", ["v"], TABLE, index=i)
    read = lambda p: {tuple(r) for r in spark.read.schema(TABLE).parquet(p).collect()}
    assert read(path) == read(plain) == {("a", 4, dt.date(2024, 1, 1)), ("b", 1, dt.date(2024, 1, 1)), ("c", 3, dt.date(2024, 1, 1)),
                                         ("d", 2, dt.date(2024, 1, 1)), (None, 3, dt.date(2024, 1, 3))}
    places = {(r.id, str(r.day)) for r in key_index.read(spark, index, ["id"], "day", TABLE).collect()}
    assert {("a", "2024-01-01"), ("a", "2024-01-03"), ("b", "2024-01-05")} <= places      # where it may be
    key_index.rebuild(spark, path, index, ["id"], "day", TABLE)
    places = {(r.id, str(r.day)) for r in key_index.read(spark, index, ["id"], "day", TABLE).collect()}
    assert places == {("a", "2024-01-01"), ("b", "2024-01-01"), ("c", "2024-01-01"), ("d", "2024-01-01"), (None, "2024-01-03")}


def test_key_index_is_built_for_a_table_that_has_none(spark):
    path = scratch_path(spark, "late-index")
    incremental.upsert(spark, rows(spark, ("a", 1, 1), ("b", 1, 2)), path, ["id"], "day", ["v"], TABLE)
    incremental.upsert(spark, rows(spark, ("a", 2, 9)), path, ["id"], "day", ["v"], TABLE, index=key_index.index_path(path))
    assert {tuple(r)[:2] for r in spark.read.schema(TABLE).parquet(path).collect()} == {("a", 2), ("b", 1)}


def test_only_the_buckets_of_the_keys_are_read(spark):
    index = scratch_path(spark, "buckets")
    table = spark.range(5_000).select(F.col("id").cast("string").alias("id"), F.lit(0).cast("long").alias("v"), F.lit("2024-01-01").cast("date").alias("day"))
    key_index.add(table, index, ["id"], "day", buckets=200)
    folder = f"{index}/of=200"
    assert key_index.buckets_of(spark, index) == 200 == len([f for f in os.listdir(folder.replace("file:", "")) if f.startswith("bucket=")])
    wanted = rows(spark, ("7", 0, 1), ("4999", 0, 1), ("none", 0, 1))
    touched = {r[0] for r in wanted.select(key_index.bucket_of(["id"], 200)).collect()}
    assert len(touched) <= 3
    for b in set(range(200)) - touched:                    # no reader gets through these
        where = f"{folder.replace('file:', '')}/bucket={b}"
        for f in os.listdir(where):
            os.remove(f"{where}/{f}")
        with open(f"{where}/part-0.parquet", "wb") as fh:
            fh.write(b"not Parquet")
    found = key_index.locate(spark, index, wanted, ["id"], "day", TABLE)
    assert {r.id for r in found.collect()} == {"7", "4999"}


def test_deliveries_without_any_id_are_all_quarantined(spark):
    facts = spark.createDataFrame(
        [(None, None, "invitee.created", dt.datetime(2024, 1, 1, i), dt.datetime(2024, 1, 1, i), "x", dt.datetime(2024, 1, 3), "u", "e", None, None, None)
         for i in range(5)] +
        [("", "", "invitee.created", dt.datetime(2024, 1, 2), dt.datetime(2024, 1, 2), "x", dt.datetime(2024, 1, 3), "u", "e", None, None, None)],
        "invitee_id string, event_id string, data_event string, data_created_at timestamp_ntz, ingestion_time timestamp_ntz, "
        "data_payload_scheduled_event_event_type string, data_payload_scheduled_event_start_time timestamp_ntz, "
        "data_payload_scheduled_event_event_memberships_user string, employee_email string, utm_source string, utm_campaign string, "
        "data_payload_uri string")
    out = contracts.flagged_bookings(facts).collect()
    assert len(out) == 6 and not any(r.is_valid_record for r in out)
