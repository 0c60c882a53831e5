"""Command line: ``python -m jsonloom ingest|validate|arrival|files ...`` (also through ``spark-submit``)."""

from __future__ import annotations

import argparse
import sys
from datetime import datetime, timezone

from pyspark.sql import SparkSession

from jsonloom.operators.arrival import METRICS, arrival_issues, compare_metrics, score_issues
from jsonloom.operators.metrics import entity_metrics, rates, size_metrics
from jsonloom.operators.quality.suite import gate
from jsonloom.operators.shred import shred
from jsonloom.plans import school
from jsonloom.plans.ingest import stored_catalog
from jsonloom.plans.validate import recount, validate
from jsonloom.session import DEFAULTS
from jsonloom.sources.documents import list_files, read_documents
from jsonloom.sources.reports import comparison_markdown
from jsonloom.sources.store import TableStore
from jsonloom.streaming.ingest import discover_then_ingest, document_every, start_ingest


def now() -> str:
    return datetime.now(timezone.utc).isoformat()


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="jsonloom")
    commands = parser.add_subparsers(dest="command", required=True)

    ingest = commands.add_parser("ingest", help="load JSON documents into a table store")
    ingest.add_argument("--input-dir", required=True)
    ingest.add_argument("--store", required=True)
    ingest.add_argument("--checkpoint", required=True)
    ingest.add_argument("--processed-dir", help="archive of processed files")
    ingest.add_argument("--interval", help="e.g. '10 seconds'; without it, load what is there and stop")
    ingest.add_argument("--schema-samples", type=int, default=50, help="files to discover the tables on; 0: discover with every batch")
    ingest.add_argument("--contracts", action="store_true", help="validate against the school contracts instead of discovering")
    ingest.add_argument("--docs-dir", help="where the schema documents go")
    ingest.add_argument("--lines", action="store_true", help="one document per line")
    ingest.add_argument("--buckets", type=int)

    check = commands.add_parser("validate", help="run the quality suite; exit status 1 when there are errors")
    check.add_argument("--store", required=True)
    check.add_argument("--report-dir", required=True)

    arrival = commands.add_parser("arrival", help="integrity in arrival order, optionally of two inputs side by side")
    arrival.add_argument("--input-dir", required=True)
    arrival.add_argument("--compare-dir")

    files = commands.add_parser("files", help="file and record metrics")
    files.add_argument("--input-dir", required=True)
    files.add_argument("--expected", type=int)
    files.add_argument("--seconds", type=float, default=0.0, help="duration the rate refers to")
    return parser.parse_args(argv)


def run_ingest(spark: SparkSession, args: argparse.Namespace) -> int:
    store = TableStore(spark, args.store, args.buckets)
    settings = {
        "lines": args.lines, "interval": args.interval, "archive_dir": args.processed_dir,
        "after_batch": document_every(100, args.docs_dir, now) if args.docs_dir and not args.contracts else None,
    }
    if args.contracts:
        query = start_ingest(spark, args.input_dir, store, args.checkpoint, contracts=school.CONTRACTS, **settings)
    elif args.schema_samples:
        query = discover_then_ingest(spark, args.input_dir, store, args.checkpoint, args.schema_samples, **settings)
    else:
        query = start_ingest(spark, args.input_dir, store, args.checkpoint, **settings)
    query.awaitTermination()
    recount(store, *school.RECOUNT)
    return 0


def run_validate(spark: SparkSession, args: argparse.Namespace) -> int:
    store = TableStore(spark, args.store)
    catalog = stored_catalog(store)
    rules = school.with_school_rules(catalog.rules() if catalog else school.contract_rules())
    result = validate(spark, store.read_all(), rules)
    result.write(spark, args.report_dir, now())
    result.summary.show(truncate=False)
    return gate(result.summary)


def run_arrival(spark: SparkSession, args: argparse.Namespace) -> int:
    def score(path):
        return score_issues(arrival_issues(shred(read_documents(spark, path), keep_rejects=True), school.ARRIVAL))

    first = score(args.input_dir)
    if args.compare_dir:
        compared = compare_metrics(first, score(args.compare_dir), METRICS)
        print(comparison_markdown(compared, (args.input_dir, args.compare_dir), now()))
    else:
        first.show(truncate=False)
    return 0


def run_files(spark: SparkSession, args: argparse.Namespace) -> int:
    from pyspark.sql import functions as F

    sizes = size_metrics(list_files(spark, args.input_dir, "*.json"))
    rates(sizes, F.lit(args.seconds), F.lit(args.expected)).show(truncate=False)
    entity_metrics(shred(read_documents(spark, args.input_dir))).show(truncate=False)
    return 0


def main(argv: list[str] | None = None) -> int:
    args = arguments(argv)
    builder = SparkSession.builder.appName(f"jsonloom-{args.command}")
    for key, value in DEFAULTS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    run = {"ingest": run_ingest, "validate": run_validate, "arrival": run_arrival, "files": run_files}
    return run[args.command](spark, args)


if __name__ == "__main__":
    sys.exit(main())
