"""Hand-made cases for the behaviours the engine must reproduce (or fixes on
purpose): flatten, time zones, channel mapping, Gold edge cases, spend cleaning."""

from __future__ import annotations

import datetime as dt
import json
import os

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slotwise import schemas as S
from slotwise.functions import category_position, day_name, employee_id
from slotwise.operators import dedup, gold, quality, report, spend
from slotwise.operators.flatten import FlattenNameCollision, flatten, flattened_names
from slotwise.sources import json_io

FB = S.EVENT_TYPE_BASE + "click"
YT = S.EVENT_TYPE_BASE + "view"


def _events(spark, rows):
    schema = T.StructType([
        T.StructField(S.COL_EVENT, T.StringType()),
        T.StructField(S.COL_EVENT_TYPE, T.StringType()),
        T.StructField(S.COL_START_TIME, T.StringType()),
        T.StructField(S.COL_MEMBER_USER, T.StringType()),
    ])
    return spark.createDataFrame(rows, schema)


# ------------------------------------------------------------------ flatten
NESTED = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("doc", T.StructType([
        T.StructField("members", T.ArrayType(T.StructType([T.StructField("user", T.StringType())]))),
        T.StructField("answers", T.ArrayType(T.StringType())),
        T.StructField("meta", T.StructType([T.StructField("k", T.LongType())])),
    ])),
    T.StructField("tags", T.ArrayType(T.StringType())),
    T.StructField("tail", T.StringType()),
])


def test_flatten_multiplies_arrays_and_keeps_empty(spark):
    rows = [
        (1, Row(members=[Row(user="a"), Row(user="b")], answers=["x", "y", "z"], meta=Row(k=1)), ["t"], "e"),
        (2, Row(members=[], answers=None, meta=None), [], "f"),
    ]
    flat = flatten(spark.createDataFrame(rows, NESTED))
    out = flat.collect()
    assert len([r for r in out if r.id == 1]) == 6          # 2 members x 3 answers
    empty = [r for r in out if r.id == 2]
    assert len(empty) == 1 and empty[0].doc_members_user is None and empty[0].tags is None
    assert sorted(flat.columns) == sorted(flattened_names(NESTED))


def test_flatten_column_order(spark):
    flat = flatten(spark.createDataFrame([], NESTED))
    # Arrays keep their place; expanded struct fields move to the end, round by round.
    assert flat.columns == ["id", "tags", "tail", "doc_answers", "doc_meta_k", "doc_members_user"]


def test_flatten_name_collision_raises(spark):
    schema = T.StructType([
        T.StructField("a", T.StructType([T.StructField("b_c", T.LongType())])),
        T.StructField("a_b", T.StructType([T.StructField("c", T.LongType())])),
    ])
    with pytest.raises(FlattenNameCollision):
        flatten(spark.createDataFrame([], schema))


def test_flatten_names_with_dots(spark):
    schema = T.StructType([T.StructField("x.y", T.StructType([T.StructField("z", T.LongType())]))])
    flat = flatten(spark.createDataFrame([Row(**{"x.y": Row(z=5)})], schema))
    assert flat.columns == ["x.y_z"] and flat.first()[0] == 5


def test_event_date_from_path(spark, tmp_path):
    good = tmp_path / "event_date=2026-01-15"
    bad = tmp_path / "elsewhere"
    good.mkdir()
    bad.mkdir()
    doc = {"ingestion_time": "2026-01-15T06:00:00.5", "source": "webhook",
           "data": {"event": "invitee.created", "payload": {"uri": "u/invitees/i1"}}}
    (good / "a.json").write_text(json.dumps(doc, indent=2))
    (bad / "b.json").write_text(json.dumps(doc, indent=2))
    docs = json_io.read_event_documents(spark, str(tmp_path), layout="document")
    days = sorted((r.event_date or "") for r in docs.select("event_date").collect())
    assert days == ["", "2026-01-15"]


def test_document_layout_and_lines_layout(spark, tmp_path):
    lines = tmp_path / "lines"
    lines.mkdir()
    (lines / "part-0.json").write_text("\n".join(json.dumps(
        {"date": "2026-01-14", "channel": c, "spend": 1}) for c in ("a", "b", "c")))
    # JSON lines must be read as lines: a document reader would keep only the first.
    assert json_io.read_spend_files(spark, str(lines), layout="lines").count() == 3
    assert json_io.read_spend_files(spark, str(lines), layout="document").count() == 1


# ------------------------------------------------------------------ time and channel
def test_utc_date_hour_weekday_agree(spark):
    enriched = gold.enrich(_events(spark, [(S.BOOKING_EVENT, FB, "2026-01-17T01:15:00Z", "u")]))
    r = enriched.select("booking_date", F.hour("booking_ts").alias("h"),
                        F.dayofweek("booking_ts").alias("d")).first()
    assert (r.booking_date, r.h, r.d) == (dt.date(2026, 1, 17), 1, 7)


def test_iso_week_and_malformed_time(spark):
    df = spark.createDataFrame([("2027-01-01",)], ["d"]).select(F.weekofyear(F.to_date("d")).alias("w"))
    assert df.first().w == 53
    enriched = gold.enrich(_events(spark, [(S.BOOKING_EVENT, FB, "not a time", "u")]))
    assert enriched.first().booking_date is None             # no exception under ANSI


def test_channel_mapping_null_and_unmapped_are_others(spark):
    rows = [(S.BOOKING_EVENT, FB, "2026-01-01T00:00:00Z", "u"),
            (S.BOOKING_EVENT, None, "2026-01-01T00:00:00Z", "u"),
            (S.BOOKING_EVENT, "https://x/other", "2026-01-01T00:00:00Z", "u"),
            (S.CANCEL_EVENT, FB, "2026-01-01T00:00:00Z", "u")]
    got = sorted(r.channel for r in gold.enrich(_events(spark, rows)).collect())
    assert got == ["facebook", "others", "others"]


def test_employee_id_extraction(spark):
    df = spark.createDataFrame([("https://a/users/AB-12",), ("https://a/teams/x",), (None,)], "u string")
    got = [r[0] for r in df.select(employee_id("u")).collect()]
    assert got == ["AB-12", "", None]


# ------------------------------------------------------------------ Gold edge cases
def test_daily_grid_null_date_and_zero_fill(spark):
    rows = [(S.BOOKING_EVENT, FB, "2026-01-01T10:00:00Z", "u"),
            (S.BOOKING_EVENT, YT, "2026-01-02T10:00:00Z", "u"),
            (S.BOOKING_EVENT, YT, "garbage", "u")]
    daily = gold.daily_bookings_by_channel(gold.enrich(_events(spark, rows))).collect()
    assert len(daily) == 12                                  # 3 days (one NULL) x 4 channels
    assert all(r.bookings_count == 0 for r in daily if r.booking_date is None)
    assert sum(r.bookings_count for r in daily) == 2


def test_cpb_zero_bookings_and_literal_others(spark):
    events = gold.enrich(_events(spark, [(S.BOOKING_EVENT, FB, "2026-01-01T10:00:00Z", "u")] * 2))
    marketing = spark.createDataFrame(
        [("2026-01-01", "2026-01-01", "facebook", 10.0), ("2026-01-01", "2026-01-01", "youtube", 5.0),
         ("2026-01-01", "2026-01-01", "others", 1.0), ("2026-01-01", "2026-01-01", "linkedin", 2.0)],
        "date string, spend_date string, channel string, spend double")
    cpb = {r.channel: r for r in gold.cpb_by_channel(events, marketing).collect()}
    assert len(cpb) == 4
    assert cpb["facebook"].cpb == 5.0
    assert cpb["youtube"].cpb == 0.0 and cpb["youtube"].total_spend == 5.0
    assert cpb["others"].total_spend == 3.0                   # one row, literal 'others' included
    assert cpb["tiktok"].total_spend == 0.0
    ranks = {r.channel: r.rank_by_cpb for r in gold.channel_attribution(gold.cpb_by_channel(events, marketing)).collect()}
    assert ranks["youtube"] == 1                              # zero cpb ranks first
    nulls = {r.channel: r.rank_by_cpb for r in gold.channel_attribution(
        gold.cpb_by_channel(events, marketing, zero_bookings="null")).collect()}
    assert nulls["youtube"] == max(nulls.values())


def test_time_analysis_keeps_channels_without_bookings(spark):
    enriched = gold.enrich(_events(spark, [(S.BOOKING_EVENT, FB, "2026-01-01T10:00:00Z", "u")]))
    rows = gold.booking_time_analysis(enriched).collect()
    empty = [r for r in rows if r.channel != "facebook"]
    assert len(empty) == 3 and all(r.booking_hour is None and r.bookings_count == 0 for r in empty)


def test_gold_invariants(spark, sf_dir):
    from slotwise.plans.batch_queries import enriched_bookings
    enriched = enriched_bookings(spark, sf_dir)
    n = enriched.count()
    daily = gold.daily_bookings_by_channel(enriched)
    assert daily.agg(F.sum("bookings_count")).first()[0] == n
    assert gold.booking_time_analysis(enriched).agg(F.sum("bookings_count")).first()[0] == n
    assert daily.count() == 4 * enriched.select("booking_date").distinct().count()
    cube = gold.booking_cube(enriched)
    assert gold.daily_bookings_by_channel(cube, weight="bookings").exceptAll(daily).count() == 0


# ------------------------------------------------------------------ spend
def test_clean_spend_rules(spark):
    raw = spark.createDataFrame(
        [("2026-01-14", "youtube_paid_ads", "827.67"), ("2026-01-14", "a_paid_ads_paid_ads", "3"),
         ("2026-01-14", "x", "bad"), ("2026-01-14", None, "1"), (None, "y", "1")],
        S.SPEND_RECORD_RAW)
    out = {r.channel: r.spend for r in spend.clean_spend(raw).collect()}
    assert out == {"youtube": 827.67, "a": 3.0}


def test_listed_first_and_missing(spark):
    recs = spark.createDataFrame(
        [("2026-01-14", "youtube_paid_ads", 1.0, 2), ("2026-01-14", "youtube_paid_ads", 9.0, 1),
         ("2026-01-13", "facebook_paid_ads", 5.0, 3), ("2026-01-14", "facebook_paid_ads", 4.0, 4)],
        "date string, channel string, spend double, position long")
    recs = recs.withColumn("file_date", F.lit("2026-01-14"))
    first = {r.channel: r.spend for r in spend.listed_first(recs, day_col="file_date").collect()}
    assert first == {"youtube_paid_ads": 9.0, "facebook_paid_ads": 4.0}
    missing = {(r.date, r.channel) for r in spend.missing_companies(recs.drop("file_date")).collect()}
    assert ("2026-01-14", "tiktok_paid_ads") in missing and ("2026-01-13", "youtube_paid_ads") in missing


def test_spend_mixed_number_types_read(spark, tmp_path):
    d = tmp_path / "spend"
    d.mkdir()
    (d / "part-0.json").write_text(json.dumps([{"date": "2026-01-14", "channel": "a", "spend": 3},
                                               {"date": "2026-01-14", "channel": "b", "spend": 2.5},
                                               {"date": "2026-01-14", "channel": "c", "spend": "x"}]))
    (d / "file_index.json").write_text(json.dumps({"files": ["part-0.json"]}))
    got = {r.channel: r.spend for r in spend.clean_spend(json_io.read_spend_files(spark, str(d))).collect()}
    assert got == {"a": 3.0, "b": 2.5}                       # manifest file not read as data


# ------------------------------------------------------------------ reports
def test_pivot_order_and_fill(spark):
    daily = spark.createDataFrame(
        [(dt.date(2026, 1, 1), "youtube", 2), (None, "facebook", 1), (dt.date(2026, 1, 2), "facebook", 3)],
        "booking_date date, channel string, bookings_count long")
    wide = report.daily_pivot(daily)
    assert wide.columns == ["booking_date", *S.CHANNELS]
    assert {r.booking_date: (r.facebook, r.youtube) for r in wide.collect()} == \
        {dt.date(2026, 1, 1): (0, 2), dt.date(2026, 1, 2): (3, 0)}


def test_category_order_unlisted_last(spark):
    df = spark.createDataFrame([("zeta",), ("others",), ("facebook",)], "channel string")
    got = [r.channel for r in report.in_category_order(df, "channel", S.CHANNELS).orderBy("row_no").collect()]
    assert got == ["facebook", "others", "zeta"]
    assert df.select(category_position("channel", S.CHANNELS).alias("p")).orderBy("p").first().p is None


def test_day_names(spark):
    df = spark.createDataFrame([(1,), (7,), (9,)], "d int")
    assert [r[0] for r in df.select(day_name("d")).collect()] == ["Sunday", "Saturday", None]


# ------------------------------------------------------------------ quality and dedup
def test_quality_split_partitions_rows(spark, sf_dir):
    from slotwise.plans.batch_queries import _flagged_bookings
    flagged = _flagged_bookings(spark, sf_dir)
    valid, rejected = quality.split(flagged)
    assert valid.count() + rejected.count() == flagged.count()
    assert rejected.filter(F.array_contains("reject_reasons", "created_after_ingestion")).count() == rejected.count()


def test_latest_per_key_tie_break(spark):
    df = spark.createDataFrame([("k", 1, 5), ("k", 1, 7), ("j", 0, 1)], "key string, t int, id int")
    got = {r.key: r.id for r in dedup.latest_per_key(df, ["key"], ["t", "id"]).collect()}
    assert got == {"k": 7, "j": 1}


def test_upsert_moves_keys_and_clears_emptied_partitions(spark):
    from slotwise.operators import incremental
    from slotwise.session import scratch_path
    schema = T.StructType([T.StructField("k", T.StringType()), T.StructField("v", T.LongType()),
                           T.StructField("p", T.StringType())])
    path = scratch_path(spark, "upsert-test")
    first = spark.createDataFrame([("a", 1, "d1"), ("b", 1, "d1"), ("c", 1, "d2")], schema)
    incremental.upsert(spark, first, path, ["k"], "p", ["v"], schema)
    # c moves from d2 to d3 (d2 becomes empty); a is updated in place; b untouched.
    second = spark.createDataFrame([("a", 2, "d1"), ("c", 2, "d3")], schema)
    incremental.upsert(spark, second, path, ["k"], "p", ["v"], schema)
    got = sorted(tuple(r) for r in spark.read.schema(schema).parquet(path).collect())
    assert got == [("a", 2, "d1"), ("b", 1, "d1"), ("c", 2, "d3")]
    assert not os.path.exists(path.replace("file:", "") + "/p=d2")


# ------------------------------------------------------------------ plans
def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_flagship_plan_shape(spark, sf_dir):
    from slotwise.plans.batch_queries import q_daily_bookings
    plan = _plan(q_daily_bookings(spark, sf_dir))
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan
    assert "ReadSchema: struct<ts:timestamp_ntz,event_type:string>" in plan
    # One shuffle on the day (a small single-split scan may add a round-robin spread).
    assert plan.count("Exchange hashpartitioning") == 1


def test_partition_pruning_on_reprocess(spark, sf_dir):
    from slotwise.plans.batch_queries import _COUNTS_SCHEMA, q_reprocess_last_n
    from slotwise.sources.tables import read_columnar
    q_reprocess_last_n(spark, sf_dir)
    # Re-read a written table with a day filter: only matching folders are listed.
    from slotwise.session import shared_dir
    import glob
    roots = sorted(glob.glob(shared_dir(spark).replace("file:", "") + "/gold-daily-counts-*"))
    df = read_columnar(spark, roots[-1], schema=_COUNTS_SCHEMA).filter(F.col("booking_date") >= "2024-01-24")
    assert "PartitionFilters: [isnotnull(booking_date" in _plan(df)


def test_all_empty_arrays_keep_their_fields(spark, tmp_path):
    """With an explicit schema a batch whose arrays are all empty still flattens to
    the member column Gold reads (inference would type the array as strings)."""
    folder = tmp_path / "event_date=2026-01-15"
    folder.mkdir()
    doc = {"ingestion_time": "2026-01-15T06:00:00.5", "source": "webhook",
           "data": {"event": "invitee.created",
                    "payload": {"questions_and_answers": [],
                                "scheduled_event": {"event_memberships": [], "event_guests": []}}}}
    (folder / "part-0.json").write_text(json.dumps(doc))
    flat = flatten(json_io.read_event_documents(spark, str(tmp_path), layout="lines"))
    assert S.COL_MEMBER_USER in flat.columns
    assert flat.count() == 1 and flat.first()[S.COL_MEMBER_USER] is None


def test_spend_bucket_total_equals_spend_total(spark, sf_dir):
    from slotwise.plans.batch_queries import fact_marketing
    fact = fact_marketing(spark, sf_dir)
    total = fact.agg(F.sum(F.col("spend").cast("decimal(18,2)"))).first()[0]
    buckets = gold.spend_by_bucket(fact).agg(F.sum(F.col("total_spend").cast("decimal(18,2)"))).first()[0]
    assert total == buckets


def test_upsert_null_partition_and_fixed_key_partition(spark):
    from slotwise.operators import incremental
    from slotwise.session import scratch_path
    schema = T.StructType([T.StructField("k", T.StringType()), T.StructField("v", T.LongType()),
                           T.StructField("p", T.StringType())])
    path = scratch_path(spark, "upsert-null")
    incremental.upsert(spark, spark.createDataFrame([("a", 1, None), ("b", 1, "d1")], schema),
                       path, ["k"], "p", ["v"], schema)
    incremental.upsert(spark, spark.createDataFrame([("c", 1, None)], schema), path, ["k"], "p", ["v"], schema)
    got = sorted(tuple(r) for r in spark.read.schema(schema).parquet(path).collect())
    assert got == [("a", 1, None), ("b", 1, "d1"), ("c", 1, None)]
    incremental.upsert(spark, spark.createDataFrame([("b", 2, "d1")], schema), path, ["k"], "p", ["v"], schema,
                       key_determines_partition=True)
    got = sorted(tuple(r) for r in spark.read.schema(schema).parquet(path).collect())
    assert got == [("a", 1, None), ("b", 2, "d1"), ("c", 1, None)]


def test_cli_pipeline(spark, sf_dir, tmp_path, capsys):
    """The jobs from the command line: Bronze docs -> silver-events; spend -> gold."""
    from slotwise import cli
    from slotwise.plans.ingest_queries import bronze_event_documents
    from slotwise.plans.batch_queries import fact_marketing
    bronze = bronze_event_documents(spark, sf_dir)
    silver = str(tmp_path / "silver")
    assert cli.main(["silver-events", bronze, f"{silver}/fact_events", "--layout", "lines"]) == 0
    fact_marketing(spark, sf_dir).write.partitionBy("date").parquet(f"{silver}/fact_marketing")
    assert cli.main(["gold", silver, str(tmp_path / "gold")]) == 0
    out = capsys.readouterr().out.strip().splitlines()
    assert json.loads(out[0])["fact_events_rows"] > 0
    assert json.loads(out[1])["gold_cpb_by_channel"] == 4


def test_global_positions_across_many_partitions(spark):
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    old = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        n = 20000
        df = spark.range(0, n).select(((F.col("id") * 7919) % n).alias("v")).repartition(13)
        out = report.with_global_positions(df, F.col("v").desc())
        rows = out.collect()
        assert len(rows) == n and all(r.row_no == n - r.v for r in rows)
    finally:
        spark.conf.set(key, old)


def test_spend_jobs_both_layouts(spark, sf_dir):
    """Raw files + manifest -> Bronze arrays and -> JSON lines; both Silver loads agree."""
    from slotwise.plans import jobs
    from slotwise.session import scratch_path
    from slotwise.sources import model
    from slotwise.sources.tables import read_table
    from slotwise.plans.ingest_queries import raw_spend_files
    raw = model.spend_raw(read_table(spark, sf_dir, "orders"), aligned=True)
    raw_root, index = raw_spend_files(spark, sf_dir)
    arrays, lines = scratch_path(spark, "t-arrays"), scratch_path(spark, "t-lines")
    missing = jobs.bronze_spend_job(spark, raw_root, index, arrays)
    n = jobs.ingest_spend_lines_job(spark, raw_root, index, lines)
    assert n == raw.count() and missing.count() == 0      # the lines ingest keeps every record
    a, b = scratch_path(spark, "t-silver-a"), scratch_path(spark, "t-silver-b")
    rows_a = jobs.silver_marketing_job(spark, arrays, a, layout="array")
    rows_b = jobs.silver_marketing_job(spark, lines, b, layout="lines")
    # Silver from the lines layout equals cleaning the raw records directly.
    cols = ["date", "spend_date", "channel", "spend"]
    tb = spark.read.schema(S.FACT_MARKETING).parquet(b).select(*cols)
    direct = spend.clean_spend(raw.drop("position")).select(*cols)
    assert rows_b == direct.count() and tb.exceptAll(direct).count() == 0
    assert 0 < rows_a <= 3 * direct.select("date").distinct().count()


def test_large_days_are_dealt_to_numbered_files(spark, sf_dir, monkeypatch):
    from pathlib import Path
    from slotwise.plans.ingest_queries import raw_spend_files
    from slotwise.sinks import writers
    from slotwise.sources import model
    from slotwise.sources.tables import read_table
    monkeypatch.setattr(writers, "RECORDS_PER_FILE", 7, raising=False)
    root, index = raw_spend_files(spark, sf_dir)
    sizes = [len(json.loads(p.read_text())) for p in Path(root.replace("file:", "")).glob("*.json")]
    assert max(sizes) == 7 and len(sizes) == json_io.read_manifest(spark, index).count()
    got = spend.with_file_date(json_io.load_listed_files(spark, root, index))
    raw = model.spend_raw(read_table(spark, sf_dir, "orders"), aligned=True)
    assert got.count() == raw.count() and got.where("date <> file_date").count() == 0
    places = [[(r.date, r.channel, r.spend) for r in rows.orderBy("date", "position").collect()] for rows in (got, raw)]
    assert places[0] == places[1]


def test_manifest_one_name_per_line_and_empty_guard(spark):
    from slotwise.operators.quality import EmptyInput, require_rows
    from slotwise.session import scratch_path
    from slotwise.sinks import writers
    names = spark.createDataFrame([("a.json",), ("b.json",), ("a.json",)], "file_name string")
    path = scratch_path(spark, "manifest-test")
    writers.write_manifest(names, path)
    assert sorted(r.file_name for r in json_io.read_manifest(spark, path).collect()) == ["a.json", "b.json"]
    with pytest.raises(EmptyInput):
        require_rows(names.filter(F.lit(False)), "nothing")


def test_sizing_conf():
    from slotwise.session import sizing_conf
    small = sizing_conf(1 << 20, 8)
    assert small["spark.sql.shuffle.partitions"] == "24"
    big = sizing_conf(10 << 40, 8000)          # 10 TB shuffle on 8000 cores
    assert int(big["spark.sql.shuffle.partitions"]) == 40960


def test_gold_job_booking_grain_on_flattened_events(spark, sf_dir):
    """Over flattened documents, booking grain gives the flat model's daily counts;
    row grain counts the members x answers fan-out."""
    from slotwise.plans import jobs
    from slotwise.plans.batch_queries import enriched_bookings, fact_marketing
    from slotwise.plans.ingest_queries import fact_events
    from slotwise.session import scratch_path
    flat, marketing = fact_events(spark, sf_dir), fact_marketing(spark, sf_dir)
    expected = gold.daily_bookings_by_channel(enriched_bookings(spark, sf_dir))
    booking_root, row_root = scratch_path(spark, "g-booking"), scratch_path(spark, "g-row")
    jobs.gold_job(spark, flat, marketing, booking_root, grain="booking")
    jobs.gold_job(spark, flat, marketing, row_root, grain="row")
    by_booking = spark.read.parquet(f"{booking_root}/gold_daily_bookings_by_channel")
    by_row = spark.read.parquet(f"{row_root}/gold_daily_bookings_by_channel")
    assert by_booking.exceptAll(expected).count() == 0 and expected.exceptAll(by_booking).count() == 0
    total = lambda df: df.agg(F.sum("bookings_count")).first()[0]
    assert total(by_row) > total(by_booking)
    load = spark.read.parquet(f"{booking_root}/gold_meeting_load_per_employee")
    assert load.agg(F.sum("total_meetings_count")).first()[0] <= \
        spark.read.parquet(f"{row_root}/gold_meeting_load_per_employee").agg(F.sum("total_meetings_count")).first()[0]


def test_cli_stream_daily_and_bronze_spend(spark, sf_dir, capsys):
    from slotwise import cli
    from slotwise.session import scratch_path
    table, ckpt = scratch_path(spark, "cli-daily"), scratch_path(spark, "cli-ckpt")
    assert cli.main(["stream-daily", f"{sf_dir}/events*.parquet", table, ckpt]) == 0
    from slotwise.streaming.bookings import DAILY_COUNTS
    from slotwise.plans.batch_queries import enriched_bookings
    assert spark.read.schema(DAILY_COUNTS).parquet(table).agg(F.sum("bookings_count")).first()[0] == \
        enriched_bookings(spark, sf_dir).count()
    from slotwise.plans.ingest_queries import raw_spend_files
    raw_root, index = raw_spend_files(spark, sf_dir)
    assert cli.main(["bronze-spend", raw_root, index, scratch_path(spark, "cli-bronze")]) == 0
    assert json.loads(capsys.readouterr().out.strip().splitlines()[-1])["days_missing_a_company"] >= 0


def test_upsert_empties_partition_with_special_characters(spark):
    from slotwise.operators import incremental
    from slotwise.session import scratch_path
    schema = T.StructType([T.StructField("k", T.StringType()), T.StructField("v", T.LongType()),
                           T.StructField("p", T.StringType())])
    path = scratch_path(spark, "upsert-escape")
    incremental.upsert(spark, spark.createDataFrame([("a", 1, "x y/z")], schema), path, ["k"], "p", ["v"], schema)
    incremental.upsert(spark, spark.createDataFrame([("a", 2, "plain")], schema), path, ["k"], "p", ["v"], schema)
    got = sorted(tuple(r) for r in spark.read.schema(schema).parquet(path).collect())
    assert got == [("a", 2, "plain")]


def test_hot_partition_value_is_split_on_write(spark):
    """A day holding a third of the rows is written by several tasks (REBALANCE +
    adaptive skew splitting), not funnelled through one."""
    import glob as _glob
    from slotwise.session import scratch_path
    from slotwise.sinks import writers
    keys = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
            "spark.sql.adaptive.coalescePartitions.enabled": "true"}
    old = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    try:
        n = 300000
        df = spark.range(0, n, numPartitions=8).select(
            F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise((F.col("id") % 97).cast("string")).alias("day"),
            (F.col("id") * 7919 % 1000003).alias("v"))
        path = scratch_path(spark, "hot-write")
        writers.write_partitioned(df, path, ["day"])
        hot_files = _glob.glob(path.replace("file:", "") + "/day=hot/*.parquet")
        assert len(hot_files) > 1
        assert spark.read.parquet(path).count() == n
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_keyed_reductions_combine_before_the_shuffle(spark, sf_dir):
    """Latest-per-key and first-per-day run a partial aggregate before their shuffle,
    so a hot key is reduced inside each task."""
    from slotwise.plans.batch_queries import q_dedup_bookings, q_spend_listed_first
    for df, fn in ((q_dedup_bookings(spark, sf_dir), "partial_max_by"),
                   (q_spend_listed_first(spark, sf_dir), "partial_min_by")):
        plan = _plan(df)
        assert fn in plan
        assert plan.index("Exchange hashpartitioning") < plan.index(fn)   # printed top-down: partial is below


def test_dashboard_selections(spark):
    daily = spark.createDataFrame(
        [(dt.date(2026, 1, 1), "youtube", 2), (dt.date(2026, 1, 1), "tiktok", 1)],
        "booking_date date, channel string, bookings_count long")
    wide = report.daily_pivot(daily, selected=["tiktok", "facebook"])
    assert wide.columns == ["booking_date", "tiktok", "facebook"]
    assert tuple(wide.first())[1:] == (1, 0)
    times = spark.createDataFrame(
        [("youtube", 9, 1, 3), ("youtube", 10, 2, 4), ("others", None, None, 0)],
        "channel string, booking_hour int, booking_day_of_week int, bookings_count long")
    picked = report.with_day_names(times, ["Monday"]).collect()
    assert [(r.day_name, r.bookings_count) for r in picked] == [("Monday", 4)]
    assert [r.day_name for r in report.weekdays_present(times).orderBy("day_of_week").collect()] == \
        ["Sunday", "Monday"]


def test_dedup_with_a_key_holding_a_third_of_the_rows(spark):
    n = 30000
    df = spark.range(0, n, numPartitions=6).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("k"),
        ((F.col("id") * 7919) % n).alias("t"), F.col("id"))
    last = {r.k: r.id for r in dedup.latest_per_key(df, ["k"], ["t", "id"]).collect()}
    first = {r.k: r.id for r in dedup.latest_per_key(df, ["k"], ["t", "id"], keep="first").collect()}
    hot = [(((i * 7919) % n), i) for i in range(0, n, 3)]
    assert last["hot"] == max(hot)[1] and first["hot"] == min(hot)[1]
    assert len(last) == 1 + (n - n // 3)


def test_gold_job_zero_bookings_null(spark):
    from slotwise.plans import jobs
    from slotwise.session import scratch_path
    events = _events(spark, [(S.BOOKING_EVENT, FB, "2026-01-01T10:00:00Z", S.USER_BASE + "u1")])
    marketing = spark.createDataFrame(
        [("2026-01-01", "2026-01-01", "facebook", 10.0), ("2026-01-01", "2026-01-01", "youtube", 5.0)],
        "date string, spend_date string, channel string, spend double")
    root = scratch_path(spark, "gold-null")
    jobs.gold_job(spark, events, marketing, root, zero_bookings="null")
    rows = {r.channel: r for r in spark.read.parquet(f"{root}/gold_channel_attribution").collect()}
    assert rows["facebook"].cpb == 10.0 and rows["youtube"].cpb is None
    assert rows["youtube"].rank_by_cpb > rows["facebook"].rank_by_cpb
