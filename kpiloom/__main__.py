"""Command line: list the analyses, or run some and write their results.

    python -m kpiloom list
    python -m kpiloom run --sales-csv FILE --visits-csv FILE --out OUT [--format parquet|csv] [NAME ...]
    python -m kpiloom report --sales-csv FILE --out OUT [--format parquet|csv]

``--sf-dir DIR`` reads the star-schema test tables instead of CSV files.

Each result is written to OUT/NAME (Parquet by default, CSV with a header
otherwise), the form a dashboard or a notebook reads.  Without names, every
registered analysis runs.
"""

from __future__ import annotations

import argparse
import datetime as dt
import sys

from kpiloom.registry import queries
from kpiloom.session import get_spark, size_session
from kpiloom.sources.files import QUOTING
from kpiloom.sources.store import TABLES, cleaned_sales, pin_cleaned_sales, pin_csv


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="kpiloom")
    sub = ap.add_subparsers(dest="cmd", required=True)
    sub.add_parser("list", help="print the registered analyses")
    run = sub.add_parser("run", help="run analyses and write their results")
    rep = sub.add_parser("report", help="the whole retail report, shared work done once")
    for p in (run, rep):
        p.add_argument("--sf-dir", help="folder with the star-schema tables")
        p.add_argument("--sales-csv", help="invoice lines as CSV (file or folder) instead of tables")
        p.add_argument("--visits-csv", help="experiment visits as CSV")
        p.add_argument("--date-format", help="pattern of InvoiceDate in the CSV, e.g. 'M/d/yyyy H:mm'")
        p.add_argument("--encoding", default="UTF-8", help="encoding of the CSV files")
        p.add_argument("--multi-line", action="store_true", help="the CSV has line breaks inside quotes")
        p.add_argument("--start", help="report: first date, e.g. 2011-01-01")
        p.add_argument("--out", required=True, help="output folder (shared storage on a cluster)")
        p.add_argument("--format", choices=["parquet", "csv"], default="parquet")
        p.add_argument("--master", default=None, help="Spark master; default from spark-submit")
        p.add_argument("--table-path", default=None,
                       help="stable folder for the cleaned table: reused for the same input, written when missing")
        p.add_argument("--rebuild", action="store_true", help="replace a table of other input at --table-path")
    run.add_argument("names", nargs="*")
    args = ap.parse_args(argv)

    qs = queries()
    if args.cmd == "list":
        print("\n".join(qs))
        return 0
    unknown = [n for n in getattr(args, "names", []) if n not in qs]
    if unknown:
        ap.error(f"unknown analyses: {', '.join(unknown)}")
    if not (args.sf_dir or args.sales_csv or args.visits_csv):
        ap.error("give --sf-dir, or --sales-csv and / or --visits-csv")
    spark = get_spark(args.master)
    source = args.sf_dir or "csv"
    tables = [f"{args.sf_dir.rstrip('/')}/{t}.parquet" for t in (*TABLES, "events")] if args.sf_dir else []
    size_session(spark, [*tables, *[p for p in (args.sales_csv, args.visits_csv) if p]])
    if args.sales_csv or args.visits_csv:
        pin_csv(spark, source, args.sales_csv, args.visits_csv, date_format=args.date_format,
                table_path=args.table_path if args.sales_csv else None, rebuild=args.rebuild,
                multi_line=args.multi_line, encoding=args.encoding)
    elif args.table_path:  # the analyses read the stable table instead of building one
        pin_cleaned_sales(spark, source, args.table_path, args.rebuild)
    if args.cmd == "report":
        from kpiloom import registry as R
        from kpiloom.plans.report import retail_report
        start = dt.date.fromisoformat(args.start) if args.start else R.ALL.start
        frames = retail_report(cleaned_sales(spark, source), start,
                               quarters=[f"Q{i} {start.year}" for i in range(1, 5)],
                               bins=R.ALL.bins, revenue_cuts=R.ALL.cuts)
    else:
        frames = {name: qs[name](spark, source) for name in (args.names or list(qs))}
    for name, df in frames.items():
        w = df.write.mode("overwrite")
        out = f"{args.out.rstrip('/')}/{name}"
        (w.options(header=True, **QUOTING).csv(out) if args.format == "csv" else w.parquet(out))
        print(f"{name} -> {out}", file=sys.stderr)
    return 0


if __name__ == "__main__":
    sys.exit(main())
