"""Command-line job: one segmentation run (a month and a look-back period) as a Spark
application.

    spark-submit --py-files segmint.zip segmint/job.py --hot PATH --archive PATH --users PATH \\
        --rates-legacy PATH --rates-current PATH --day 2024-04-20 --period 3 --out PATH

Inputs are read with their schemas pinned (``segmint.sources``); the result replaces only
its own (month, period) partition of the output. Results are the currency rows
(``--out`` or ``--out-table``) and, if asked for, the wide table with one row per customer
(``--wide-out`` or ``--wide-table``). Staged intermediates go to ``--staging-dir`` or the
session's ``spark.checkpoint.dir`` and are removed at the end, also after a failure, unless
``--run-name`` is given: then a failed run keeps them and can be resumed.
"""

from __future__ import annotations

import argparse
from datetime import date

from pyspark.sql import SparkSession

from segmint.operators.output import write_result, write_result_table
from segmint.operators.joins import DEFAULT_BROADCAST_BYTES, rows_within
from segmint.operators.rates import DEFAULT_CUTOVER, daily_rates
from segmint.operators.window import DEFAULT_FIRST_TX_DATE, observation_window
from segmint.plans.pipeline import segment_customers
from segmint.plans.specs import CONSISTENT_ELITE_SPECS, CONSISTENT_METRIC_SPECS, DEFAULT_ELITE_SPECS, DEFAULT_METRIC_SPECS
from segmint.sources import read_rates_current, read_rates_legacy, read_transactions, read_users


def parse_args(argv=None) -> argparse.Namespace:
    p = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    p.add_argument("--hot", required=True, help="current transactions")
    p.add_argument("--archive", action="append", default=[], help="older transactions (repeatable)")
    p.add_argument("--users", required=True)
    p.add_argument("--rates-legacy", required=True)
    p.add_argument("--rates-current", required=True)
    p.add_argument("--day", required=True, type=date.fromisoformat, help="any day of the month to segment")
    p.add_argument("--period", required=True, type=int, help="0 (all history), 1, 3, 6, 9 or 12 months")
    out = p.add_mutually_exclusive_group(required=True)
    out.add_argument("--out", help="path of the currency rows")
    out.add_argument("--out-table", help="catalog table of the currency rows")
    wide = p.add_mutually_exclusive_group()
    wide.add_argument("--wide-out", help="path of the wide table")
    wide.add_argument("--wide-table", help="catalog table of the wide rows")
    p.add_argument("--staging-dir", help="shared folder for intermediates (default: spark.checkpoint.dir)")
    p.add_argument("--run-name", help="keep the stages of a failed run, and go on after them when called again with this name")
    p.add_argument(
        "--broadcast-mb", type=int, default=DEFAULT_BROADCAST_BYTES >> 20, help="size up to which a side of a join is broadcast"
    )
    p.add_argument("--format", default="parquet", help='input format, or "table" for catalog table names')
    p.add_argument("--first-tx-date", type=date.fromisoformat, default=DEFAULT_FIRST_TX_DATE)
    p.add_argument("--cutover", type=date.fromisoformat, default=DEFAULT_CUTOVER)
    p.add_argument("--consistent-specs", action="store_true", help="each metric's own value, population and bound")
    p.add_argument(
        "--date-partition-column",
        help="partition column of the transaction tables holding the date of CreateDate (prunes partitions)",
    )
    return p.parse_args(argv)


def main(argv=None) -> None:
    args = parse_args(argv)
    spark = SparkSession.builder.appName("segmint").getOrCreate()
    window = observation_window(args.day, args.period, args.first_tx_date)
    part = args.date_partition_column
    sources = {"hot": read_transactions(spark, args.hot, args.format, window, part)}
    for i, path in enumerate(args.archive):
        sources[f"archive{i}" if i else "archive"] = read_transactions(spark, path, args.format, window, part)
    rates = daily_rates(
        read_rates_legacy(spark, args.rates_legacy, args.format),
        read_rates_current(spark, args.rates_current, args.format),
        args.cutover,
    )
    metric_specs, elite_specs = (
        (CONSISTENT_METRIC_SPECS, CONSISTENT_ELITE_SPECS) if args.consistent_specs else (DEFAULT_METRIC_SPECS, DEFAULT_ELITE_SPECS)
    )
    res = segment_customers(
        spark, sources, read_users(spark, args.users, args.format), rates, args.day, args.period,
        args.first_tx_date, metric_specs, elite_specs, rows_within(args.broadcast_mb << 20), staging_dir=args.staging_dir,
        run_name=args.run_name,
    )
    written = False
    try:
        if args.out:
            write_result(res.segments, args.out, window)
        else:
            write_result_table(res.segments, args.out_table, window)
        if args.wide_out:
            write_result(res.wide, args.wide_out, window)
        elif args.wide_table:
            write_result_table(res.wide, args.wide_table, window)
        written = True
    finally:
        if written or args.run_name is None:
            res.release()


if __name__ == "__main__":
    main()
