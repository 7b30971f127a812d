"""Command-line jobs, for ``spark-submit`` or ``python -m carelake.plans.jobs``.

  medallion  one triggered bronze -> silver -> gold update
  load       one incremental, exactly-once file load

Scheduling, retries and alerts belong to whatever runs the job; the jobs are
idempotent, so running one again after a failure is safe.
"""

from __future__ import annotations

import argparse
import json
import sys

from carelake.session import build_session, drop_scratch, scratch_made


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="carelake.plans.jobs")
    sub = p.add_subparsers(dest="job", required=True)
    m = sub.add_parser("medallion", help="one triggered bronze/silver/gold update")
    m.add_argument("--landing", required=True, help="folder (or glob) where CSV files arrive")
    m.add_argument("--out", required=True, help="folder for layer data and checkpoints")
    m.add_argument("--year", type=int, required=True)
    m.add_argument("--db", required=True)
    m.add_argument("--full-refresh", action="store_true")
    ld = sub.add_parser("load", help="load files not loaded before")
    ld.add_argument("--source", required=True)
    ld.add_argument("--schema", required=True, help="DDL, e.g. 'a INT, b STRING'")
    ld.add_argument("--target", required=True)
    ld.add_argument("--checkpoint", required=True)
    ld.add_argument("--format", default="csv")
    p.add_argument("--master", default=None)
    args = p.parse_args(argv)

    spark = build_session(master=args.master)
    before = len(scratch_made(spark))
    if args.job == "medallion":
        from carelake.plans.medallion import run_medallion
        res = run_medallion(spark, args.landing, args.out, args.year, args.db, full_refresh=args.full_refresh)
        report = [r.asDict() for r in res["report"].collect()]  # one row per rule
        print(json.dumps({"bronze_rows_added": res["bronze_rows_added"], "rules": report}))
    else:
        from carelake.streaming.incremental import incremental_load
        n = incremental_load(spark, args.source, args.schema, args.target, args.checkpoint, fmt=args.format)
        print(json.dumps({"rows_added": n}))
    drop_scratch(spark, scratch_made(spark)[before:])  # what this job put there; its tables lie elsewhere
    return 0


if __name__ == "__main__":
    sys.exit(main())
