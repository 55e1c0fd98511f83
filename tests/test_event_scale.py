"""Event documents at scale: no sort of wide rows before a write, narrow exchanges, compressed text."""

from __future__ import annotations

import glob
import json
import os

from pyspark.sql import functions as F

from slotwise import schemas as S
from slotwise.session import configure, scratch_path, shared_dir
from slotwise.sources import json_io, model
from slotwise.sources.tables import read_table
from slotwise.streaming import bookings as stream


def test_a_partitioned_write_does_not_sort_its_rows(spark):
    configure(spark)
    spark.sql("CREATE TABLE by_day (text STRING, day STRING) USING parquet PARTITIONED BY (day)")
    try:
        plan = spark.sql("EXPLAIN INSERT INTO by_day SELECT CAST(id AS STRING), CAST(id % 3 AS STRING) FROM range(9)").first()[0]
        assert "Sort" not in plan, plan
        spark.sql("INSERT INTO by_day SELECT CAST(id AS STRING), CAST(id % 90 AS STRING) FROM range(0, 900, 1, 2)")
        assert spark.table("by_day").count() == 900              # more days than files a task keeps open
        assert spark.table("by_day").groupBy("day").count().where("count = 10").count() == 90
    finally:
        spark.sql("DROP TABLE by_day")


def test_documents_are_made_after_the_exchange(spark, sf_dir):
    events = read_table(spark, sf_dir, "events")
    docs = model.booking_documents(model.by_arrival_day(events))
    assert docs.exceptAll(model.booking_documents(events)).isEmpty() and docs.count() == events.count()
    tasks = docs.select(F.spark_partition_id().alias("t"), "event_date").distinct()
    days = tasks.select("event_date").distinct().count()
    assert tasks.count() <= days + docs.rdd.getNumPartitions()   # a task has one or a few neighbouring days


def test_multiline_documents_are_written_compressed(spark, sf_dir):
    from slotwise.plans.ingest_queries import q_event_documents_multiline
    assert q_event_documents_multiline(spark, sf_dir).count() > 0
    files = glob.glob(f"{shared_dir(spark).removeprefix('file:')}/bronze-multiline-*/**/part-*", recursive=True)
    assert files and all(f.endswith(".lz4") for f in files)


def test_documents_are_parsed_once_for_their_schema(spark, monkeypatch):
    texts = spark.createDataFrame([(' {"source": "w", "more": {"n": 1}}',), ("[1]",), ('"{"',), ("{broken",), ("{}",), (None,)], "value string")
    plans, first = [], type(texts).first
    monkeypatch.setattr(type(texts), "first", lambda self: (plans.append(self._jdf.queryExecution().optimizedPlan().toString()), first(self))[1])
    schema = json_io.document_schema(texts.repartition(2))
    assert schema.fieldNames() == [*S.BOOKING_EVENT_DOC.fieldNames(), "more"]
    assert schema["more"].dataType.fieldNames() == ["n"]
    assert len(plans) == 1 and plans[0].lower().replace("_", "").count("parsejson") == 1, plans


def test_a_stream_batch_writes_few_files(spark, sf_dir):
    """The log of counted deliveries: not one file for each day of each state partition."""
    from slotwise.plans.stream_queries import q_stream_daily_from_documents
    configure(spark)
    days = q_stream_daily_from_documents(spark, sf_dir).select("booking_date").distinct().count()
    logs = sorted(glob.glob(f"{shared_dir(spark).removeprefix('file:')}/stream-doc-daily-*_log"), key=os.path.getmtime)
    files = glob.glob(f"{logs[-1]}/**/part-*.parquet", recursive=True)
    assert days <= len(files) <= 2 * days


def test_counts_read_only_their_fields(spark, tmp_path):
    """Documents without ``uri`` that differ in other fields only are counted one by one, and once."""
    doc = lambda uri, email: {"ingestion_time": "2026-01-01T10:00:00.000000", "source": "webhook", "data": {
        "event": "invitee.created", "payload": {"uri": uri, "email": email, "scheduled_event": {
            "event_type": S.EVENT_TYPE_BASE + "click", "start_time": "2026-01-02T10:00:00.000000Z"}}}}
    folder = tmp_path / "event_date=2026-01-01"
    folder.mkdir()
    (folder / "a.json").write_text("\n".join(json.dumps(doc(u, e)) for u, e in (
        (None, "a"), (None, "b"), (None, "b"), ("u/1", "c"), ("u/1", "c"))))
    table = scratch_path(spark, "narrow")
    for _ in range(2):
        docs = stream.document_stream(spark, str(tmp_path), schema=S.BOOKING_COUNT_DOC)
        assert docs.columns == ["ingestion_time", "data", "event_date"]
        stream.daily_counts_to_table(stream.document_booking_stream(docs), table, scratch_path(spark, "ckpt-narrow"))
        assert [r.bookings_count for r in spark.read.schema(stream.COUNTS_TABLE).parquet(table).collect()] == [4]
