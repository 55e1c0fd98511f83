"""New input by ledger, arrays read in splits, documents with further fields, changed days,
tables that change together."""

from __future__ import annotations

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slotwise import schemas as S
from slotwise.operators import incremental
from slotwise.operators.flatten import flatten
from slotwise.session import scratch_path
from slotwise.sinks import writers
from slotwise.sources import json_io, ledger


def spend_file(folder, day: str, rows: list, number: int = 0, text: str | None = None) -> None:
    name = f"{S.SPEND_FILE_PREFIX}{day}{f'.{number:05d}' if number else ''}{S.SPEND_FILE_SUFFIX}"
    (folder / name).write_text(json.dumps([{"date": day, "channel": c, "spend": v} for c, v in rows], indent=1) if text is None else text)


# ------------------------------------------------------------------ ledger
def test_ledger_loads_new_and_changed_files_once(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    book, table = scratch_path(spark, "book"), scratch_path(spark, "table")
    load = lambda: ledger.load_new_spend_days(spark, str(raw), book, table)
    rows = lambda: sorted((r.spend_date, r.channel, r.spend) for r in spark.read.schema(S.SPEND_LINES).parquet(table).collect())
    spend_file(raw, "2026-01-01", [("a", 1), ("b", "junk")])
    spend_file(raw, "2026-01-02", [("a", 2)])
    (raw / S.MANIFEST_NAME).write_text('{"files": []}')
    assert load() == ["2026-01-01", "2026-01-02"] and load() == []
    spend_file(raw, "2026-01-02", [("c", 5)], number=1)              # a day goes on in a new file
    assert load() == ["2026-01-02"]
    assert rows() == [("2026-01-01", "a", 1.0), ("2026-01-01", "b", None), ("2026-01-02", "a", 2.0), ("2026-01-02", "c", 5.0)]
    spend_file(raw, "2026-01-01", [("a", 7)])                        # replaced since
    assert load() == ["2026-01-01"] and rows()[0] == ("2026-01-01", "a", 7.0) and len(rows()) == 3
    assert ledger.read_ledger(spark, book).count() == 4
    assert ledger.pending(spark, str(raw), book, f"{S.SPEND_FILE_PREFIX}*").count() == 0


def test_a_failed_load_is_not_noted(spark, tmp_path, monkeypatch):
    raw = tmp_path / "raw"
    raw.mkdir()
    spend_file(raw, "2026-01-01", [("a", 1)])
    book, table = scratch_path(spark, "book"), scratch_path(spark, "table")

    def fail(*_, **__):
        raise RuntimeError("lost")
    with monkeypatch.context() as m:
        m.setattr(writers, "write_partitioned", fail)
        with pytest.raises(RuntimeError):
            ledger.load_new_spend_days(spark, str(raw), book, table)
    assert ledger.load_new_spend_days(spark, str(raw), book, table) == ["2026-01-01"]


# ------------------------------------------------------------------ arrays in splits
def as_read(df):
    return sorted((r.file_name, r.place, r.date, r.channel, r.spend) for r in df.collect())


def test_a_large_array_is_read_by_several_tasks(spark, tmp_path):
    day = "2026-01-01"
    spend_file(tmp_path, day, [(f"channel {i}", i / 4) for i in range(20_000)])
    spend_file(tmp_path, "2026-01-02", [("x", None)])
    path = [str(tmp_path / f) for f in os.listdir(tmp_path)]
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "128k")
    try:
        pieces = spark.read.option("lineSep", "}").text(path)
        assert pieces.rdd.getNumPartitions() > 5
        got = as_read(json_io.read_array_records(spark, path))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert got == sorted([(f"spend_data_{day}.json", i, day, f"channel {i}", str(i / 4)) for i in range(20_000)]
                         + [("spend_data_2026-01-02.json", 0, "2026-01-02", "x", None)])


@pytest.mark.parametrize("text", [
    '[{"date": "d", "channel": "curly } brace", "spend": 1}, {"date": "e", "channel": "open { too", "spend": "2"}]',
    '[null, {"date": "d", "channel": "c", "spend": {"amount": 3}}]',
    '[{"channel": "c", "extra": [1, 2], "spend": null}\n,\n{"date": "d"}\n]\n', "[]", " [ ]\n", "[{}]",
    '[{"date": "d", "channel": "quote \\" and \\\\", "spend": -1.5e3}]', '[{"date":"d","channel":"c","spend":"1"},{"date":"d"}]'])
def test_arrays_are_read_as_documents_are(spark, tmp_path, text):
    spend_file(tmp_path, "2026-01-03", [], text=text)
    spend_file(tmp_path, "2026-01-04", [("plain", 1)])
    paths = [str(tmp_path / f) for f in os.listdir(tmp_path)]
    whole = spark.read.text(paths, wholetext=True).select(
        F.col("_metadata.file_name").alias("file_name"), F.posexplode(F.from_json("value", T.ArrayType(S.SPEND_RECORD_RAW))).alias("place", "r")) \
        .select("file_name", "place", "r.*")
    assert as_read(json_io.read_array_records(spark, paths)) == as_read(whole)


def test_daily_arrays_without_a_sort_of_everything(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(writers, "RECORDS_PER_FILE", 100)
    rows = spark.range(3_000).select(
        F.when(F.col("id") % 3 == 0, "2026-01-02").when(F.col("id") % 500 == 1, None).otherwise("2026-01-01").alias("date"),
        F.concat(F.lit("c"), (F.col("id") % 7).cast("string")).alias("channel"), F.col("id").cast("string").alias("spend"),
        ((F.col("id") * 7919) % 3001).alias("position"))
    out = str(tmp_path / "out")
    names = writers.write_daily_arrays(rows, out, "date", order_by=["position"])
    assert sorted(names) == sorted(os.path.basename(f) for f in os.listdir(out) if f.endswith(".json"))
    wanted = [(r.date, r.spend) for r in rows.where("date IS NOT NULL").orderBy("date", "position").collect()]
    got = []
    for day in ("2026-01-01", "2026-01-02"):
        files = sorted(n for n in names if day in n)
        # `<day>.json` first, then the numbered ones
        for n in sorted(files, key=lambda n: n.count(".") > 1 and int(n.split(".")[-2]) or 0):
            part = json.loads(open(f"{out}/{n}").read())
            assert 0 < len(part) <= 110
            got += [(r["date"], r["spend"]) for r in part]
    assert got == wanted
    assert writers.write_daily_arrays(rows.limit(0), out, "date") == []


# ------------------------------------------------------------------ documents with further fields
def test_fields_outside_the_schema_are_kept(spark, tmp_path):
    docs = [{"source": "webhook", "data": {"event": "invitee.created", "payload": {
                "uri": "u/1", "custom": {"plan": "gold", "seats": 3}, "scheduled_event": {"name": "n", "buffer": {"before": 1.5}},
                "questions_and_answers": [{"answer": "a", "score": 7}]}}},
            {"data": {"event": "invitee.created", "payload": {"uri": "u/2", "custom": {"seats": "many"}, "nothing": None}}, "top": [1, 2]}]
    (tmp_path / "a.json").write_text("\n".join(map(json.dumps, docs)) + "\n{broken\n[1]\n")
    read = json_io.read_open_documents(spark, str(tmp_path), corrupt_col="_corrupt_record")
    rows = flatten(read.where("_corrupt_record IS NULL").drop("_corrupt_record")).where("data_payload_uri IS NOT NULL").collect()
    by_uri = {}
    for r in rows:
        by_uri.setdefault(r.data_payload_uri, []).append(r)
    one, = by_uri["u/1"]
    assert (one.data_payload_custom_plan, one.data_payload_custom_seats, one.data_payload_scheduled_event_buffer_before) == ("gold", "3", 1.5)
    assert one.data_payload_questions_and_answers_score == 7 and one.data_payload_nothing is None
    assert sorted(r.top for r in by_uri["u/2"]) == [1, 2] and by_uri["u/2"][0].data_payload_custom_seats == "many"
    known = flatten(json_io.read_event_documents(spark, str(tmp_path))).columns
    assert set(known) <= set(flatten(read.drop("_corrupt_record")).columns)


def test_documents_without_further_fields_keep_the_schema(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"source": "webhook"}\n\n"text"\n')
    assert json_io.document_schema(spark.read.text(str(tmp_path))) == S.BOOKING_EVENT_DOC
    assert json_io.document_schema(spark.createDataFrame([], "value string")) == S.BOOKING_EVENT_DOC


# ------------------------------------------------------------------ changed days
TABLE = T.StructType([T.StructField("v", T.LongType()), T.StructField("w", T.StringType()), T.StructField("day", T.DateType())])


def test_only_changed_days_are_written(spark):
    root = scratch_path(spark, "changed")
    table = lambda rows: spark.createDataFrame([(v, w, dt.date(2024, 1, d)) for v, w, d in rows], TABLE)
    first = [(1, "a", 1), (2, "b", 1), (3, None, 2), (4, "d", 3), (5, "e", 4), (5, "e", 4)]
    incremental.overwrite_partitions(table(first), root, ["day"])
    stamp = lambda: {d: sorted(os.listdir(f"{root.replace('file:', '')}/{d}")) for d in os.listdir(root.replace("file:", "")) if d.startswith("day=")}
    before = stamp()
    # same rows in another order; a changed value; a day gone; one copy fewer; a new day
    second = [(2, "b", 1), (1, "a", 1), (3, "x", 2), (5, "e", 4), (6, "f", 5)]
    days = incremental.reprocess_days(table(second).repartition(3), root, "day", "2024-01-10", 30, changed_only=True)
    assert days == ["2024-01-02", "2024-01-03", "2024-01-04", "2024-01-05"]
    after = stamp()
    assert after["day=2024-01-01"] == before["day=2024-01-01"] and "day=2024-01-03" not in after
    read = sorted(tuple(r) for r in spark.read.schema(TABLE).parquet(root).select("v", "day").collect())
    assert read == sorted((v, dt.date(2024, 1, d)) for v, _, d in second)
    assert incremental.reprocess_days(table(second), root, "day", "2024-01-10", 30, changed_only=True) == []


# ------------------------------------------------------------------ all tables or none
def gold_like(spark, n: int, fail: bool = False):
    broken = F.raise_error(F.lit("lost")).cast("long") if fail else F.col("id")
    return {f"t{i}": spark.range(n).select((broken if i == 3 else F.col("id")).alias("id")) for i in range(5)}


def test_a_failed_run_leaves_all_old_tables(spark, tmp_path):
    root, db = str(tmp_path / "gold"), f"switch_{os.getpid()}"
    counts = lambda: [spark.table(f"{db}.t{i}").count() for i in range(5)]
    assert writers.publish_tables(gold_like(spark, 3), root, db) == {f"t{i}": 3 for i in range(5)}
    held = spark.table(f"{db}.t0")
    with pytest.raises(Exception, match="lost"):
        writers.publish_tables(gold_like(spark, 9, fail=True), root, db)
    assert counts() == [3] * 5
    writers.publish_tables(gold_like(spark, 4), root, db)
    assert counts() == [4] * 5 and held.count() in (3, 4)             # the version before stays readable
    writers.publish_tables({**gold_like(spark, 5), "t1": spark.range(5).withColumn("more", F.lit("x"))}, root, db)
    assert counts() == [5] * 5 and spark.table(f"{db}.t1").columns == ["id", "more"]
    assert len([f for f in os.listdir(root) if f.startswith(writers.VERSION_PREFIX)]) == 2
    spark.sql(f"DROP DATABASE {db} CASCADE")


def test_a_failed_run_leaves_all_old_folders(spark, tmp_path):
    root = str(tmp_path / "gold")
    writers.write_tables(gold_like(spark, 3), root)
    with pytest.raises(Exception, match="lost"):
        writers.write_tables(gold_like(spark, 9, fail=True), root)
    assert [spark.read.parquet(f"{root}/t{i}").count() for i in range(5)] == [3] * 5
    assert sorted(os.listdir(root)) == [f"t{i}" for i in range(5)]
