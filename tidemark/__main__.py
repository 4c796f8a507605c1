"""Refresh a lake from the command line: ``spark-submit -m tidemark`` or ``python -m tidemark``."""

from __future__ import annotations

import argparse
import datetime as dt

from tidemark.plans.refresh import Lake, refresh_lake, wanted_files
from tidemark.plans.silver import AIR_QUALITY, WEATHER
from tidemark.session import session


def main() -> None:
    parser = argparse.ArgumentParser(prog="tidemark")
    parser.add_argument("lake", help="root folder of the lake")
    parser.add_argument("--run-ts", default=dt.datetime.now(dt.timezone.utc).strftime("%Y-%m-%d %H:%M:%S"))
    parser.add_argument("--backfill-days", type=int, default=0, help="list documents missing in the last N days")
    parser.add_argument("--date", type=dt.date.fromisoformat, help="list documents missing on this day only")
    parser.add_argument("--max-files-per-batch", type=int)
    parser.add_argument("--no-forecast", action="store_true")
    args = parser.parse_args()

    spark = session()
    batches = refresh_lake(
        spark, args.lake, args.run_ts, args.max_files_per_batch, forecast=not args.no_forecast
    )
    for name, count in batches.items():
        print(f"{name}: {count} batches")
    if args.backfill_days or args.date:
        today = dt.datetime.fromisoformat(args.run_ts).date()
        for stream in (WEATHER, AIR_QUALITY):
            wanted = wanted_files(
                spark, Lake(args.lake.rstrip("/")), stream, today, 0 if args.date else args.backfill_days, args.date
            )
            wanted.write.mode("overwrite").json(f"{args.lake.rstrip('/')}/snapshots/wanted_{stream.name}")
            print(f"{stream.name}: {wanted.count()} documents missing")


if __name__ == "__main__":
    main()
