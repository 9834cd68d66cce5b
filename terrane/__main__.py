"""Command line for spark-submit or ``python -m terrane``: one sub-command per job."""

from __future__ import annotations

import argparse
import logging

from .plans import bronze, gold, silver
from .session import build_session
from .sources import Lake, clear_staged, file_source, kafka_source, show_sample
from .streaming import run_for


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="terrane", description=__doc__)
    top.add_argument("--root", required=True, help="folder of the tables")
    top.add_argument("--format", default="orc", help="file or table format")
    top.add_argument("--catalog", help="catalog to use instead of the session catalog")
    top.add_argument("--buckets", type=int, default=0, help="bucket the event tables by id")
    jobs = top.add_subparsers(dest="job", required=True)
    jobs.add_parser("create-tables", help="create missing tables")
    for name in ("load-titles", "load-customers"):
        jobs.add_parser(name, help="append a CSV file").add_argument("path")
    ingest = jobs.add_parser("ingest", help="run the four streams for a while")
    ingest.add_argument("--servers", help="Kafka bootstrap servers")
    ingest.add_argument("--folder", help="folder with one sub-folder of JSON lines per topic")
    ingest.add_argument("--checkpoints", required=True)
    ingest.add_argument("--option", action="append", default=[], metavar="NAME=VALUE", help="option of the Kafka reader")
    ingest.add_argument("--seconds", type=int, default=100, help="stop after this time")
    to_silver = jobs.add_parser("silver", help="refresh the silver tables")
    to_silver.add_argument("--since", help="look only at events that landed then or later")
    to_silver.add_argument("--key-bits", action="store_true", help="prove most new ids new by bitmaps kept beside the tables")
    to_gold = jobs.add_parser("gold", help="refresh the gold tables")
    to_gold.add_argument("--on-fail", choices=("abort", "warn", "quarantine"), default="abort")
    for name, text in (("preview", "print columns and first rows of a table"), ("describe", "print column names and types")):
        jobs.add_parser(name, help=text).add_argument("table")
    return top


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    logging.basicConfig(level=logging.INFO)
    spark = build_session(f"terrane {args.job}")
    try:
        _run(Lake(spark, args.root, args.format, args.catalog, buckets=args.buckets), args)
    finally:
        clear_staged(spark)


def _run(lake: Lake, args: argparse.Namespace) -> None:
    spark = lake.spark
    if args.job == "create-tables":
        lake.create()
    elif args.job == "load-titles":
        show_sample(bronze.load_titles(lake, args.path))
    elif args.job == "load-customers":
        show_sample(bronze.load_customers(lake, args.path))
    elif args.job == "ingest":
        def source_of(topic: str):
            if args.servers:
                return kafka_source(spark, args.servers, topic, dict(o.split("=", 1) for o in args.option))
            return file_source(spark, f"{args.folder}/{topic}")

        run_for(bronze.ingest_all(lake, source_of, args.checkpoints), args.seconds)
        bronze.count_rejects(lake)
    elif args.job == "silver":
        silver.run_bronze_to_silver(lake, args.since, args.key_bits)
    elif args.job == "gold":
        gold.run_silver_to_gold(lake, on_fail=args.on_fail)
    elif args.job == "describe":
        lake.describe(args.table).show(1000, truncate=False)
    else:
        show_sample(lake.preview(args.table))


if __name__ == "__main__":
    main()
