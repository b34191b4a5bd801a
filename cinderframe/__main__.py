"""Command line: ``python -m cinderframe <command> --warehouse DIR [...]``.

    land       load the driver's test tables through the ingestion rules (--sf-dir)
    transform  staging -> scopes -> marts -> checks -> export, of what loads changed (--since DATE: and the
               months from there on; --full: everything)
    report     print one report (--name, --as-of, --days)

The session comes from ``spark-submit``/the environment; ``--local`` starts a local one.
"""

from __future__ import annotations

import argparse
import datetime as dt

from pyspark.sql import SparkSession

from .plans import pipeline, serving
from .session import local_session


def _date(s: str) -> dt.date:
    return dt.date.fromisoformat(s)


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="cinderframe")
    ap.add_argument("command", choices=["land", "transform", "report"])
    ap.add_argument("--warehouse", required=True, help="table root on shared storage")
    ap.add_argument("--sf-dir", default="/root/testdata/sf0.01")
    ap.add_argument("--run-ts", default=None, help="run timestamp (default: now)")
    ap.add_argument("--since", type=_date, default=None)
    ap.add_argument("--full", action="store_true")
    ap.add_argument("--name", default="kpi", choices=serving.REPORTS)
    ap.add_argument("--as-of", type=_date, default=None)
    ap.add_argument("--days", type=int, default=None)
    ap.add_argument("--local", action="store_true", help="start a local[*] session")
    args = ap.parse_args(argv)

    spark = local_session() if args.local else SparkSession.builder.getOrCreate()
    run_ts = dt.datetime.fromisoformat(args.run_ts) if args.run_ts else dt.datetime.now(dt.timezone.utc).replace(
        microsecond=0)
    wh = pipeline.Warehouse(args.warehouse)
    if args.command == "land":
        print(pipeline.land_fixtures(spark, args.sf_dir, wh, run_ts))
    elif args.command == "transform":
        res = pipeline.transform(spark, wh, run_ts, since=args.since, full=args.full)
        print({"rows": res.rows, "exported": res.exported, "failed": res.export_failures})
    else:
        as_of = args.as_of or run_ts.date()
        serving.report(spark, wh, args.name, as_of, args.days).show(50, truncate=False)


if __name__ == "__main__":
    main()
