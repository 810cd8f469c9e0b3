"""Command-line entry point (``python -m dailytally``, or
``spark-submit --py-files dailytally.zip dailytally/__main__.py``).

    python -m dailytally --orders PATH --metrics PATH --state PATH            # incremental
    python -m dailytally ... --mode backfill --start-date 2024-01-01 --end-date 2024-01-31
    python -m dailytally ... --mode full
    python -m dailytally ... --dry-run
    python -m dailytally ... --reset-mark                                     # next run starts at the epoch

The session comes from ``SparkSession.builder.getOrCreate()``, so the
cluster's own settings (master, ``spark.checkpoint.dir``, memory) apply.
"""

from __future__ import annotations

import argparse
import datetime as dt
import json
import sys

from pyspark.sql import SparkSession

from dailytally.config import DEFAULT_PIPELINE_ID
from dailytally.plans.jobs import JobConfig, MetricsJob
from dailytally.session import SESSION_CONF
from dailytally.sources.orders import jdbc_options, read_orders, read_orders_by_day, read_orders_jdbc
from dailytally.sources.raw_orders import TEXT_FORMATS, read_raw_orders


def _date(s: str) -> dt.date:
    return dt.datetime.strptime(s, "%Y-%m-%d").date()


def parse_args(argv: list[str] | None = None) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="dailytally", description="Daily order metrics, kept current incrementally.")
    p.add_argument("--orders", required=True, help="orders table path (contract schema)")
    p.add_argument("--orders-layout", choices=["plain", "day"], default="plain",
                   help="day: Parquet partitioned by order_date, of which only touched days are read")
    p.add_argument("--orders-format", default="parquet", help="file format of a plain table; json and csv are parsed line by line, malformed lines are rejects")
    p.add_argument("--jdbc-table", help="with --orders-format jdbc (--orders is then the database's URL): the orders table")
    p.add_argument("--jdbc-split", nargs=3, metavar=("FROM", "TO", "N"),
                   help="read it in N ranges of updated_at between two times (ISO); rows outside are read too")
    p.add_argument("--jdbc-option", action="append", default=[], metavar="NAME=VALUE", help="further options of the driver, each by itself")
    p.add_argument("--changes", help="change feed path (Parquet): where changed rows are looked up")
    p.add_argument("--metrics", required=True, help="daily_metrics table path")
    p.add_argument("--state", required=True, help="state log path")
    p.add_argument("--pipeline-id", default=DEFAULT_PIPELINE_ID)
    p.add_argument("--mode", choices=["incremental", "backfill", "full"], default="incremental")
    p.add_argument("--start-date", type=_date)
    p.add_argument("--end-date", type=_date)
    p.add_argument("--dry-run", action="store_true")
    p.add_argument("--reset-mark", action="store_true", help="set the stored mark back to the epoch and stop")
    p.add_argument("--quality", choices=["strict", "quarantine"], default="strict")
    p.add_argument("--quarantine", help="path for rejected rows (quarantine mode)")
    p.add_argument("--lookback-hours", type=float, help="also look at changes up to so many hours before the mark")
    p.add_argument("--batch-size", type=int, help="page size (default: all changes in one pass)")
    args = p.parse_args(argv)
    if args.orders_format == "jdbc":
        if not args.jdbc_table or not args.jdbc_split:
            p.error("a database needs --jdbc-table and --jdbc-split")
        try:
            low, high = (dt.datetime.fromisoformat(x) for x in args.jdbc_split[:2])
            args.jdbc_split = (low, high, int(args.jdbc_split[2]))
        except ValueError as e:
            p.error(f"--jdbc-split: {e}")
        if low >= high or args.jdbc_split[2] < 1:
            p.error("--jdbc-split needs an earlier and a later time and at least one range")
        if any("=" not in x for x in args.jdbc_option):
            p.error("--jdbc-option takes NAME=VALUE")
    if args.mode == "backfill":
        if not args.start_date or not args.end_date:
            p.error("backfill needs --start-date and --end-date")
        if args.start_date > args.end_date:
            p.error("--start-date must not be after --end-date")
    return args


def jdbc_source(args: argparse.Namespace) -> dict[str, str]:
    """The options of the parallel read of a database."""
    return {**jdbc_options(args.orders, args.jdbc_table, *args.jdbc_split), **dict(x.split("=", 1) for x in args.jdbc_option)}


def build_job(spark: SparkSession, args: argparse.Namespace) -> MetricsJob:
    cfg = JobConfig(
        metrics_path=args.metrics,
        state_path=args.state,
        pipeline_id=args.pipeline_id,
        quality=args.quality,
        quarantine_path=args.quarantine,
        lookback=dt.timedelta(hours=args.lookback_hours) if args.lookback_hours else None,
        batch_size=args.batch_size,
    )
    if args.orders_layout == "day":
        source = lambda: read_orders_by_day(spark, args.orders)
    elif args.orders_format == "jdbc":
        source = lambda: read_orders_jdbc(spark, jdbc_source(args))
    elif args.orders_format in TEXT_FORMATS:
        source = lambda: read_raw_orders(spark, args.orders, args.orders_format)
    else:
        source = lambda: read_orders(spark, args.orders, args.orders_format)
    changes = (lambda: read_orders(spark, args.changes)) if args.changes else None
    return MetricsJob(spark, source, cfg, changes)


def main(argv: list[str] | None = None) -> int:
    args = parse_args(argv)
    builder = SparkSession.builder.appName("dailytally")
    for k, v in SESSION_CONF.items():
        builder = builder.config(k, v)
    job = build_job(builder.getOrCreate(), args)
    if args.reset_mark:
        job.reset_mark()
        summary = {"mode": "reset", "pipeline_id": args.pipeline_id}
    elif args.mode == "backfill":
        summary = job.run_backfill(args.start_date, args.end_date, dry_run=args.dry_run)
    elif args.mode == "full":
        summary = job.run_full(dry_run=args.dry_run)
    else:
        summary = job.run_incremental(dry_run=args.dry_run)
    print(json.dumps(summary, default=str))
    return 0


if __name__ == "__main__":
    sys.exit(main())
