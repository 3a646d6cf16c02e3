"""Command line: ``python -m cirrus <command> ...``, or on a cluster
``spark-submit --py-files cirrus.zip cirrus/__main__.py <command> ...``.

Commands
  analyse       load readings, check them, run the sixteen queries, print
                the results and the quality summary, optionally export
  validate      load readings and print the quality report
  list-exports  print the export manifest

Input (analyse, validate): ``--sample`` (generated), ``--parquet PATH``,
``--jdbc-url URL`` (full load) or ``--jdbc-url URL --incremental TARGET``.
"""

from __future__ import annotations

import argparse
import datetime as dt
import sys

from cirrus.session import build_session


def _readings(spark, args):
    from cirrus.plans.pipelines import load_readings

    if args.sample:
        return load_readings(spark, "sample", hours=args.hours, seed=args.seed)
    if args.parquet:
        return load_readings(spark, "parquet", path=args.parquet)
    if args.jdbc_url and args.incremental:
        return load_readings(spark, "incremental", url=args.jdbc_url, table=args.table, target=args.incremental,
                             day_partition=args.day_partition)
    if args.jdbc_url:
        return load_readings(spark, "full", url=args.jdbc_url, table=args.table)
    raise SystemExit("choose an input: --sample, --parquet PATH or --jdbc-url URL")


def _input_args(p: argparse.ArgumentParser) -> None:
    p.add_argument("--sample", action="store_true", help="generated readings")
    p.add_argument("--hours", type=int, default=240, help="sample: hourly steps per city")
    p.add_argument("--seed", type=int, default=42, help="sample: random seed")
    p.add_argument("--parquet", help="stored readings (path or table)")
    p.add_argument("--jdbc-url", help="JDBC URL of the source database")
    p.add_argument("--table", default="weather_data", help="source table")
    p.add_argument("--incremental", metavar="TARGET", help="append only newer rows to TARGET, analyse TARGET")
    p.add_argument("--day-partition", help="store TARGET partitioned by day in this column")


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="cirrus")
    sub = ap.add_subparsers(dest="command", required=True)
    a = sub.add_parser("analyse")
    _input_args(a)
    a.add_argument("--export", metavar="DIR", help="write results as Snappy Parquet under DIR")
    a.add_argument("--as-of", help="freshness reference time (YYYY-MM-DD HH:MM:SS), default now")
    a.add_argument("--strict", action="store_true", help="stop when a quality check fails")
    a.add_argument("--rows", type=int, default=20, help="rows shown per result")
    v = sub.add_parser("validate")
    _input_args(v)
    lst = sub.add_parser("list-exports")
    lst.add_argument("dir")
    args = ap.parse_args(argv)

    spark = build_session(app_name=f"cirrus-{args.command}")
    if args.command == "list-exports":
        from cirrus.sinks.parquet_export import list_exports

        list_exports(spark, args.dir).show(1000, truncate=False)
        return 0
    readings = _readings(spark, args)
    if args.command == "validate":
        from cirrus.plans.pipelines import validate

        report, summary = validate(readings)
        report.show(truncate=False)
        summary.show(truncate=False)
        return 0
    from cirrus.plans.pipelines import analyse

    as_of = dt.datetime.fromisoformat(args.as_of) if args.as_of else None
    run = analyse(spark, readings, export_dir=args.export, strict=args.strict, as_of=as_of)
    run.summary.show(truncate=False)
    for name, df in run.results.items():
        print(f"== {name}")
        df.show(args.rows, truncate=False)
    run.status.show(100, truncate=False)
    if args.export:
        print(f"exported {sum(1 for p in run.exported.values() if p)} results to {args.export}")
    return 0


if __name__ == "__main__":
    sys.exit(main())
