"""Command line for spark-submit: one subcommand per job.

spark-submit run_job.py silver  --landing s3a://bucket/landing --namespace shop --date 2026-06-10
spark-submit run_job.py gold    --namespace shop
spark-submit run_job.py prices  --landing s3a://bucket/landing/crypto_data --table market.crypto_prices
spark-submit run_job.py explore --namespace shop

Catalog and object-store settings come from spark-submit (--conf, --properties-file).
"""

from __future__ import annotations

import argparse
import datetime

from sediment.operators import report
from sediment.plans import tables
from sediment.plans.jobs import backfill, bronze_to_silver, load_prices, silver_to_gold
from sediment.session import session
from sediment.sources.landing import parse_run_date


def now() -> datetime.datetime:
    """The run's timestamp in UTC."""
    return datetime.datetime.now(datetime.timezone.utc)


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="sediment")
    parser.add_argument("--provider", default="parquet", help="table format of new tables")
    jobs = parser.add_subparsers(dest="job", required=True)

    silver = jobs.add_parser("silver", help="merge one landed day into the silver tables")
    gold = jobs.add_parser("gold", help="recompute and merge the gold tables")
    days = jobs.add_parser("backfill", help="silver and gold for every day of a range")
    prices = jobs.add_parser("prices", help="append new price snapshots")
    explore = jobs.add_parser("explore", help="show all tables and the revenue report")

    for job in (silver, days, prices):
        job.add_argument("--landing", required=True)
    for job in (silver, gold, days, explore):
        job.add_argument("--namespace", required=True)
    silver.add_argument("--date", type=parse_run_date, default=now().date())
    days.add_argument("--first", type=parse_run_date, required=True)
    days.add_argument("--last", type=parse_run_date, required=True)
    days.add_argument(
        "--changed-days-only", action="store_true", help="recompute daily sales of changed days only"
    )
    prices.add_argument("--table", required=True)
    prices.add_argument("--coins", nargs="*", help="known coins; without them the schema is inferred")
    prices.add_argument("--one-object-per-file", action="store_true")
    return parser.parse_args(argv)


def run(spark, args: argparse.Namespace) -> None:
    if args.job == "silver":
        bronze_to_silver(spark, args.landing, args.namespace, args.date, args.provider)
    elif args.job == "gold":
        silver_to_gold(spark, args.namespace, now(), args.provider)
    elif args.job == "backfill":
        span = (args.last - args.first).days + 1
        dates = [args.first + datetime.timedelta(days=n) for n in range(span)]
        backfill(
            spark,
            args.landing,
            args.namespace,
            dates,
            lambda _: now(),
            args.provider,
            args.changed_days_only,
        )
    elif args.job == "prices":
        load_prices(
            spark, args.landing, args.table, args.coins, args.one_object_per_file, provider=args.provider
        )
    elif args.job == "explore":
        report.show_tables(spark, args.namespace)
        silver = [
            spark.table(f"{args.namespace}.{spec.name}")
            for spec in (tables.ORDER_ITEMS, tables.ORDERS, tables.CUSTOMERS, tables.PRODUCTS)
        ]
        report.ranked(report.country_category_revenue(*silver)).show(20, truncate=False)


def main() -> None:
    args = arguments()
    spark = session(f"sediment-{args.job}")
    try:
        run(spark, args)
    finally:
        spark.stop()
