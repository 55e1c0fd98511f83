"""Multi-table jobs: Bronze spend, Silver events and marketing, Gold.

Each job is a few lazy plans ending in writes. Intermediate results that feed several
outputs are checkpointed to the shared folder (``spark.checkpoint.dir``): that cuts
their lineage (a lost executor does not recompute the scan) and each input is read
once per job. Row counts come from ``Observation`` on the writes, not extra jobs.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from slotwise import schemas as S
from slotwise.operators import contracts, gold, quality, spend
from slotwise.operators.flatten import flatten
from slotwise.session import remove_path, scratch_path, shared_dir
from slotwise.sinks import writers
from slotwise.sources import json_io

GOLD_NAMES = (
    "gold_daily_bookings_by_channel",
    "gold_cpb_by_channel",
    "gold_channel_attribution",
    "gold_booking_time_analysis",
    "gold_meeting_load_per_employee",
)


def bronze_spend_job(spark: SparkSession, raw_path: str, manifest_path: str, bronze_path: str,
                     companies: Sequence[str] = S.LISTED_COMPANIES, layout: str = "array") -> DataFrame:
    """Raw day files named by a manifest -> a JSON array per day holding the first
    record of each listed company, and the manifest beside them. Returns the days missing
    a company (reported, not raised): listed files that are not there, and files whose
    records carry other dates, miss all of them."""
    records = spend.with_file_date(json_io.load_listed_files(spark, raw_path, manifest_path, layout))
    bronze = spend.listed_first(records, companies, day_col="file_date")
    writers.write_daily_arrays(bronze, bronze_path, "date")
    writers.copy_manifest(spark, manifest_path, bronze_path)
    days = spend.with_file_date(json_io.read_manifest(spark, manifest_path)).select(F.col("file_date").alias("date")).distinct()
    return spend.missing_companies(records.filter(F.col("date") == F.col("file_date")), companies, days=days)


def ingest_spend_lines_job(spark: SparkSession, raw_path: str, manifest_path: str, out_path: str,
                           layout: str = "array") -> int:
    """The older spend ingest: every record of every listed file, ``spend`` read as a
    number (unreadable text becomes NULL instead of failing the run), ``spend_date``
    taken from the file name; written as JSON lines partitioned by ``spend_date``
    (one folder per day, files sized by the rebalance rather than one single-task
    file). Fails when the listed files hold no record. Returns the rows written."""
    records = spend.with_file_date(json_io.load_listed_files(spark, raw_path, manifest_path, layout))
    quality.require_rows(records, "listed spend files")
    rows = records.select("date", "channel", F.col("spend").try_cast("double").alias("spend"),
                          F.col("file_date").alias("spend_date"))
    obs = Observation("spend_lines")
    writers.write_json_lines(rows.observe(obs, F.count(F.lit(1)).alias("rows")), out_path, "spend_date")
    return writers.observed_rows(obs)


CORRUPT = "_corrupt_record"


def silver_events_job(spark: SparkSession, bronze_path: str, silver_path: str,
                      layout: str = "document", fmt: str = "parquet",
                      quarantine_path: str | None = None, open_fields: bool = False, dealt: bool = False) -> int:
    """Bronze webhook documents -> flattened ``fact_events`` by ``event_date``
    (dynamic partition overwrite), counted on write. Documents that are no JSON are no
    facts: they go to ``quarantine_path`` (text, day, what could be read of them) if
    one is given. With ``open_fields`` (JSON lines) fields that the schema does not name become columns too,
    after one pass that finds them; read such a table with ``mergeSchema``. ``dealt``: Bronze holds files of
    task size in day folders (not one per document), so the wide rows need no exchange by day."""
    if open_fields and layout != "lines":
        raise ValueError("open_fields reads JSON lines")
    docs = json_io.read_open_documents(spark, bronze_path, corrupt_col=CORRUPT) if open_fields else \
        json_io.read_event_documents(spark, bronze_path, layout=layout, corrupt_col=CORRUPT)
    if quarantine_path:
        broken = json_io.read_event_documents(spark, bronze_path, layout=layout, corrupt_col=CORRUPT) \
            .select(F.col(CORRUPT).alias("document"), "event_date", F.lit("unreadable_document").alias("reject_reasons"),
                    F.to_json(F.struct("ingestion_time", "source", "data")).alias("readable_part")) \
            .where(F.col("document").isNotNull())
        broken.write.mode("overwrite").json(quarantine_path)
    fact = flatten(docs.where(F.col(CORRUPT).isNull()).drop(CORRUPT))
    obs = Observation("fact_events")
    writers.write_partitioned(fact, silver_path, ["event_date"], fmt=fmt, observation=obs,
                              options=writers.without_dictionaries(S.DOCUMENT_NAMES), dealt=dealt)
    return writers.observed_rows(obs)


def silver_bookings_job(spark: SparkSession, fact_events: DataFrame, silver_path: str, quarantine_path: str,
                        mapping: Mapping[str, str] = S.CHANNEL_URIS, fmt: str = "parquet") -> dict[str, int]:
    """``fact_events`` -> the documented Silver bookings (latest delivery per invitee,
    typed, ``is_valid_record``) by ``event_date``; rows that break a rule go to the
    quarantine with the rules they break."""
    flagged = contracts.flagged_bookings(contracts.from_fact_events(fact_events), mapping)
    path = scratch_path(spark, "silver-flagged")
    flagged.write.parquet(path)                       # read by both writes; lineage ends here
    flagged = spark.read.schema(flagged.schema).parquet(path)
    valid, rejected = quality.split(flagged)
    seen, kept_out = Observation("silver_bookings"), Observation("silver_rejected")
    writers.write_partitioned(valid.drop("reject_reasons"), silver_path, ["event_date"], fmt=fmt, observation=seen)
    rejected.withColumn("reject_reasons", F.concat_ws(";", "reject_reasons")) \
        .observe(kept_out, F.count(F.lit(1)).alias("rows")).write.format(fmt).mode("overwrite").save(quarantine_path)
    remove_path(spark, path)
    return {"silver_bookings": writers.observed_rows(seen), "quarantined": writers.observed_rows(kept_out)}


def silver_marketing_job(spark: SparkSession, bronze_path: str, silver_path: str,
                         layout: str = "array", fmt: str = "parquet") -> int:
    """Bronze spend arrays -> ``fact_marketing`` by ``date``."""
    fact = spend.clean_spend(json_io.read_spend_files(spark, bronze_path, layout=layout))
    obs = Observation("fact_marketing")
    writers.write_partitioned(fact, silver_path, ["date"], fmt=fmt, observation=obs)
    return writers.observed_rows(obs)


def gold_job(spark: SparkSession, fact_events: DataFrame, fact_marketing: DataFrame, gold_root: str,
             database: str | None = None, channels: Sequence[str] = S.CHANNELS,
             fmt: str = "parquet", grain: str = "row",
             booking_key: str = "data_payload_uri", zero_bookings: str = "zero",
             mapping: Mapping[str, str] = S.CHANNEL_URIS) -> dict[str, int]:
    """The five Gold tables, written in full: all five take the old ones' places, or none.
    With a ``database`` its tables are pointed at the new folder (``writers.publish_tables``), else the
    tables are at ``gold_root/<name>``.

    The events are scanned twice, both column-pruned: once into the hour cube
    (days x 24 x channels rows) from which the daily, channel and time tables derive,
    once for the per-employee load. The cube and the 4-row channel table are
    checkpointed, so the five writes never rescan the facts.

    ``grain="row"`` counts flattened rows (as the reference's Gold does);
    ``grain="booking"`` counts each booking once (per employee for the load).
    ``mapping`` names the channel of each event-type URI (others: ``others``).
    ``zero_bookings="null"`` gives a channel without bookings a NULL cost per booking
    (ranked last) instead of 0 (ranked first).
    """
    if grain not in ("row", "booking"):
        raise ValueError(f"unknown grain {grain!r}")
    shared_dir(spark)
    enriched = gold.enrich(fact_events, mapping)
    load_input = enriched
    if grain == "booking":
        load_input = gold.at_booking_grain(enriched, [booking_key, S.COL_MEMBER_USER])
        enriched = gold.at_booking_grain(enriched, [booking_key])
    cube = gold.booking_cube(enriched).checkpoint(eager=True)
    cpb = gold.cpb_by_channel(cube, fact_marketing, channels, zero_bookings=zero_bookings,
                              weight="bookings").checkpoint(eager=True)
    tables = {
        "gold_daily_bookings_by_channel": gold.daily_bookings_by_channel(cube, channels, weight="bookings"),
        "gold_cpb_by_channel": cpb,
        "gold_channel_attribution": gold.channel_attribution(cpb),
        "gold_booking_time_analysis": gold.booking_time_analysis(cube, channels, weight="bookings"),
        "gold_meeting_load_per_employee": gold.meeting_load_per_employee(load_input),
    }
    if database:
        return writers.publish_tables(tables, gold_root, database, fmt=fmt)
    return writers.write_tables(tables, gold_root, fmt=fmt)
