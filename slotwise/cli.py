"""Command line for the jobs (run under ``spark-submit`` or ``python -m slotwise.cli``).

    bronze-spend     RAW MANIFEST BRONZE              raw day files -> Bronze day arrays
    ingest-spend     RAW MANIFEST OUT                 raw day files -> JSON lines by spend_date
    silver-events    BRONZE SILVER [--layout]         webhook documents -> fact_events
    silver-marketing BRONZE SILVER [--layout]         Bronze spend -> fact_marketing
    gold             SILVER GOLD [--database DB]      fact_events + fact_marketing -> Gold
    silver-bookings  SILVER BOOKINGS QUARANTINE       fact_events -> documented bookings, rejected rows
    stream-daily     SOURCE TABLE CHECKPOINT          booking files or documents -> daily counts table

Paths may be any Hadoop file system URI (hdfs://, s3a://, file:/). The session is
the one the cluster provides; only semantic settings are applied.
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession

from slotwise import schemas as S
from slotwise.session import configure


def _session(app: str) -> SparkSession:
    return configure(SparkSession.builder.appName(app).getOrCreate())


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="slotwise")
    sub = ap.add_subparsers(dest="cmd", required=True)
    b = sub.add_parser("bronze-spend")
    b.add_argument("raw")
    b.add_argument("manifest")
    b.add_argument("bronze")
    b.add_argument("--layout", default="array", choices=["array", "lines"])
    il = sub.add_parser("ingest-spend")
    il.add_argument("raw")
    il.add_argument("manifest")
    il.add_argument("out")
    il.add_argument("--layout", default="array", choices=["array", "lines"])
    se = sub.add_parser("silver-events")
    se.add_argument("bronze")
    se.add_argument("silver")
    se.add_argument("--layout", default="document", choices=["document", "lines"])
    se.add_argument("--quarantine", help="folder for documents that are no JSON")
    se.add_argument("--open-fields", action="store_true", help="keep fields that the schema does not name (JSON lines)")
    sm = sub.add_parser("silver-marketing")
    sm.add_argument("bronze")
    sm.add_argument("silver")
    sm.add_argument("--layout", default="array", choices=["array", "lines"])
    ns = sub.add_parser("ingest-new-spend", help="load the days of new and changed spend files")
    ns.add_argument("raw")
    ns.add_argument("ledger")
    ns.add_argument("table")
    g = sub.add_parser("gold")
    g.add_argument("silver")
    g.add_argument("gold")
    g.add_argument("--database")
    g.add_argument("--grain", default="row", choices=["row", "booking"])
    g.add_argument("--zero-bookings", default="zero", choices=["zero", "null"],
                   help="cost per booking of a channel without bookings")
    st = sub.add_parser("stream-daily")
    st.add_argument("source")
    st.add_argument("table")
    st.add_argument("checkpoint")
    st.add_argument("--documents", action="store_true", help="SOURCE holds webhook documents (JSON lines)")
    sb = sub.add_parser("silver-bookings")
    sb.add_argument("silver")
    sb.add_argument("bookings")
    sb.add_argument("quarantine")
    for p in (g, st, sb):
        p.add_argument("--channel-map", help="JSON file: event-type URI -> channel")
    ap.add_argument("--format", default="parquet", help="table format of Silver and Gold (e.g. delta)")
    ap.add_argument("--shuffle-gb", type=float, default=None,
                    help="largest expected shuffle in GB: sizes shuffle partitions and splits")
    args = ap.parse_args(argv)

    from slotwise.plans import jobs
    from slotwise.session import apply_sizing
    spark = _session(f"slotwise-{args.cmd}")
    mapping = S.CHANNEL_URIS
    if getattr(args, "channel_map", None):
        # a small configuration file, read as one value
        mapping = json.loads(spark.read.text(args.channel_map, wholetext=True).first()["value"])
    if args.shuffle_gb:
        apply_sizing(spark, int(args.shuffle_gb * (1 << 30)))
    if args.cmd == "bronze-spend":
        missing = jobs.bronze_spend_job(spark, args.raw, args.manifest, args.bronze, layout=args.layout)
        report = {"days_missing_a_company": missing.count()}
    elif args.cmd == "ingest-spend":
        report = {"spend_rows": jobs.ingest_spend_lines_job(spark, args.raw, args.manifest, args.out, args.layout)}
    elif args.cmd == "ingest-new-spend":
        from slotwise.sources import ledger
        report = {"days": ledger.load_new_spend_days(spark, args.raw, args.ledger, args.table)}
    elif args.cmd == "silver-events":
        report = {"fact_events_rows": jobs.silver_events_job(spark, args.bronze, args.silver, args.layout, args.format,
                                                             args.quarantine, args.open_fields)}
    elif args.cmd == "silver-marketing":
        report = {"fact_marketing_rows": jobs.silver_marketing_job(spark, args.bronze, args.silver, args.layout, args.format)}
    elif args.cmd == "silver-bookings":
        events = spark.read.format(args.format).schema(S.fact_events_schema()).load(f"{args.silver}/fact_events")
        report = jobs.silver_bookings_job(spark, events, args.bookings, args.quarantine, mapping, args.format)
    elif args.cmd == "gold":
        events = spark.read.format(args.format).schema(S.fact_events_schema()).load(f"{args.silver}/fact_events")
        marketing = spark.read.format(args.format).schema(S.FACT_MARKETING).load(f"{args.silver}/fact_marketing")
        report = jobs.gold_job(spark, events, marketing, args.gold, database=args.database, fmt=args.format,
                               grain=args.grain, zero_bookings=args.zero_bookings, mapping=mapping)
    else:
        from slotwise.streaming import bookings as stream
        if args.documents:
            bookings = stream.document_booking_stream(stream.document_stream(spark, args.source), mapping)
        else:
            schema = spark.read.parquet(args.source).schema
            bookings = stream.booking_stream(stream.events_stream(spark, args.source, schema), mapping)
        stream.daily_counts_to_table(bookings, args.table, args.checkpoint)
        report = {"table": args.table}
    print(json.dumps(report))
    return 0


if __name__ == "__main__":
    sys.exit(main())
