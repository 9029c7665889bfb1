"""Batch jobs: ``python -m ledgerfold`` or ``spark-submit``.

    ingest  CSV files          -> raw parquet table, or a catalog table with comments
    build   raw tables         -> stored marts, in a folder or a database
    append  raw tables, marts  -> marts in a folder brought up to date, or built if it is empty
    check   raw tables, marts  -> quality report, exit code 1 if a check fails
    alerts  stored marts       -> alerts of their latest day and a summary row,
                                  exit code 2 if there is no day to look at

Raw tables are given by folder, or by name as ``database.table``.
"""

from __future__ import annotations

import argparse
from datetime import date
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession

from ledgerfold.functions.change import THRESHOLD_PERCENT
from ledgerfold.operators.alerts import alert_summary, balance_change_alerts, balance_day_pairs
from ledgerfold.plans import checks, tables
from ledgerfold.schemas import RAW_INVOICES, RAW_ORGANIZATIONS
from ledgerfold.sources import catalog, increments, marts, raw
from ledgerfold.sources.workspace import exists


def _raw_tables(spark: SparkSession, args: argparse.Namespace) -> dict[str, DataFrame]:
    return tables.build_tables(
        raw.read_table(spark, args.invoices, RAW_INVOICES),
        raw.read_table(spark, args.organizations, RAW_ORGANIZATIONS),
        args.as_of,
    )


def _marts(spark: SparkSession, args: argparse.Namespace) -> dict[str, DataFrame]:
    if args.database:
        return catalog.load(spark, args.database)
    return (increments if exists(spark, f"{args.marts}/{increments.RUNS}") else marts).load(spark, args.marts)


def ingest(spark: SparkSession, args: argparse.Namespace) -> int:
    schema = RAW_INVOICES if args.table == "invoices" else RAW_ORGANIZATIONS
    if args.database:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {args.database}")
        catalog.save_table(raw.read_csv(spark, args.csv, schema), f"{args.database}.raw_{args.table}")
    else:
        raw.ingest_csv(spark, args.csv, args.out, schema)
    return 0


def build(spark: SparkSession, args: argparse.Namespace) -> int:
    if args.database:
        catalog.refresh(_raw_tables(spark, args), args.as_of, args.database)
    else:
        marts.refresh(_raw_tables(spark, args), args.as_of, args.out)
    return 0


def append(spark: SparkSession, args: argparse.Namespace) -> int:
    increments.append(_raw_tables(spark, args), args.as_of, args.out)
    return 0


def check(spark: SparkSession, args: argparse.Namespace) -> int:
    stored = {**_raw_tables(spark, args), **_marts(spark, args)}
    report = checks.run_suite(stored, args.relationships, by_summaries=True)
    marts.write_table(report, args.out)
    return 0 if spark.read.parquet(args.out).where("NOT passed").isEmpty() else 1


def alerts(spark: SparkSession, args: argparse.Namespace) -> int:
    stored = _marts(spark, args)
    pairs = balance_day_pairs(stored[marts.FACT], stored[marts.LATEST].scalar())
    marts.write_table(balance_change_alerts(pairs, args.threshold), f"{args.out}/alerts")
    marts.write_table(alert_summary(pairs, args.threshold), f"{args.out}/summary")
    summary = spark.read.parquet(f"{args.out}/summary").first()
    print(f"{summary.snapshot_date}: {summary.organizations_processed} organisations,"
          f" {summary.alerts_raised} alerts")
    return 0 if summary.organizations_processed else 2


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="ledgerfold")
    commands = parser.add_subparsers(required=True)

    def command(job) -> argparse.ArgumentParser:
        sub = commands.add_parser(job.__name__)
        sub.set_defaults(job=job)
        reads_marts = job in (check, alerts)
        to_folder = reads_marts or job is append
        place = sub if to_folder else sub.add_mutually_exclusive_group(required=True)
        place.add_argument("--out", required=to_folder, help="folder to replace, or to bring up to date")
        if reads_marts:
            place = sub.add_mutually_exclusive_group(required=True)
            place.add_argument("--marts", help="folder written by build")
        if job is not append:
            place.add_argument("--database", help="database of catalog tables")
        return sub

    sub = command(ingest)
    sub.add_argument("--csv", required=True, help="file, folder or glob")
    sub.add_argument("--table", choices=["invoices", "organizations"], default="invoices")
    for job in (build, append, check):
        sub = command(job)
        sub.add_argument("--invoices", required=True)
        sub.add_argument("--organizations", required=True)
        sub.add_argument("--as-of", type=date.fromisoformat, required=True,
                         help="the day after the last one; nothing reads the clock")
    sub.add_argument("--relationships", action="store_true")
    sub = command(alerts)
    sub.add_argument("--threshold", type=Decimal, default=THRESHOLD_PERCENT)
    return parser


def main(argv: list[str] | None = None) -> int:
    args = _parser().parse_args(argv)
    spark = (
        SparkSession.builder.appName("ledgerfold")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    # Malformed keys and dates in CSV files must fail.
    spark.conf.set("spark.sql.ansi.enabled", "true")
    return args.job(spark, args)


if __name__ == "__main__":
    raise SystemExit(main())
