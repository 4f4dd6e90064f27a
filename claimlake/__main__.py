"""Command line: ingest the inputs, build the project, show a report.

    python -m claimlake ingest --sf-dir /root/testdata/sf0.01 --out /data/raw
    python -m claimlake ingest --csv raw_prescribers=/x.csv ... --years 2019-2023 --out /data/raw
    python -m claimlake build --raw /data/raw --warehouse /data/wh [--select marts commercial]
    python -m claimlake report report_top_drugs --raw /data/raw --warehouse /data/wh [--out /data/export]
"""

from __future__ import annotations

import argparse
import json
import os
import sys


def _years(text: str) -> tuple[int, ...]:
    lo, _, hi = text.partition("-")
    return tuple(range(int(lo), int(hi or lo) + 1))


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="claimlake")
    sub = ap.add_subparsers(dest="cmd", required=True)
    ing = sub.add_parser("ingest", help="write the five inputs as tables")
    ing.add_argument("--sf-dir", help="driver tables folder (fixture inputs)")
    ing.add_argument("--csv", nargs="*", default=[], help="name=path for delivered CSV files")
    ing.add_argument("--years", type=_years, default=(), help="year span of the spending file (--csv)")
    ing.add_argument("--out", required=True)
    b = sub.add_parser("build", help="staging views, intermediate and mart tables, checks")
    b.add_argument("--raw", required=True)
    b.add_argument("--warehouse", required=True)
    b.add_argument("--select", nargs="*", default=[], help="tags (layer / domain)")
    b.add_argument("--threads", type=int, default=4)
    b.add_argument("--snapshot-at", default=None, help="also run the SCD-2 snapshot at this time")
    b.add_argument("--database", help="also register the written tables, with comments, in this catalog database")
    r = sub.add_parser("report", help="run a dashboard report over a built warehouse")
    r.add_argument("name")
    r.add_argument("--raw", required=True)
    r.add_argument("--warehouse", required=True)
    r.add_argument("--rows", type=int, default=50)
    r.add_argument("--out", help="export as CSV to this folder instead of showing (partner reports)")
    for p in (b, r):
        p.add_argument("--years", type=_years, default=(),
                       help="year span to analyse (default: every year the spending extract has)")
        p.add_argument("--release-year", type=int, default=None,
                       help="year of the prescriber extracts (default: the last analysed)")
    for p in (ing, b, r):
        p.add_argument("--master", default=os.environ.get("SPARK_MASTER"))
    args = ap.parse_args(argv)

    from .plans.build import build, ingest, ingest_csv, open_warehouse, params_for
    from .session import build_session

    spark = build_session(args.master)
    if args.cmd == "ingest":
        if args.sf_dir:
            print(json.dumps(ingest(spark, args.sf_dir, args.out)))
        else:
            if not args.years:
                ap.error("--csv needs --years, the year span of the spending file")
            paths = dict(kv.split("=", 1) for kv in args.csv)
            print(json.dumps(ingest_csv(spark, paths, args.years, args.out)))
        spark.stop()
        return 0
    params = params_for(spark, args.raw, args.years, args.release_year)
    if args.cmd == "build":
        prj, times = build(spark, args.raw, args.warehouse, params, tags=tuple(args.select),
                         threads=args.threads, snapshot_at=args.snapshot_at)
        if args.database:
            from .plans.metadata import register_tables
            register_tables(prj, args.warehouse, args.database)
        print(json.dumps({k: round(v, 3) for k, v in times.items()}))
    else:
        from .plans.reports import REPORTS
        from .sources.sinks import write_csv
        out = REPORTS[args.name](open_warehouse(spark, args.raw, args.warehouse, params))
        if args.out:
            write_csv(out, args.out)
        else:
            out.show(args.rows, truncate=False)
    spark.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main())
