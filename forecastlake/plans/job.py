"""spark-submit entry point: one ingestion run over landed responses.

    spark-submit forecastlake/plans/job.py --landing s3://…/landing \\
        --interval hourly --lake s3://…/lake --state s3://…/state

Exit code 0 when at least one location succeeded, 1 otherwise (including any
error, and attempts that are all still pending). ``--stream`` consumes only
responses landed since the last run (availableNow trigger; ``--checkpoint``
required); with nothing new it exits with 0.
"""

from __future__ import annotations

import argparse
import logging
import sys

log = logging.getLogger("forecastlake")


def parse_args(argv: list[str]) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="forecastlake-job")
    p.add_argument("--landing", required=True, help="landed responses (JSON lines, RESPONSE schema)")
    p.add_argument("--interval", required=True, choices=["hourly", "daily"])
    p.add_argument("--lake", required=True, help="lake base path")
    p.add_argument("--state", default=None, help="state root (versioned table)")
    p.add_argument("--provider", default="open_meteo")
    p.add_argument("--compression", default="zstd", choices=["snappy", "gzip", "zstd"])
    p.add_argument("--layout", default="by_date", choices=["by_location", "by_date"])
    p.add_argument("--quarantine", default=None, help="where rows that fail validation go (default: below the lake)")
    p.add_argument("--table", default=None, help="write through this catalog table")
    p.add_argument("--max-attempts", type=int, default=3)
    p.add_argument("--close-cycles", action="store_true", help="count pending cycles as failed")
    p.add_argument("--stream", action="store_true", help="only newly landed files (availableNow)")
    p.add_argument("--checkpoint", default=None, help="stream checkpoint (with --stream)")
    return p.parse_args(argv)


def main(argv: list[str] | None = None, spark=None) -> int:
    args = parse_args(sys.argv[1:] if argv is None else argv)
    try:
        from forecastlake.plans.run import run_batch
        from forecastlake.session import get_spark
        from forecastlake.sources.responses import read_responses
        from forecastlake.streaming.incremental import run_available_now

        spark = spark or get_spark()
        options = dict(interval=args.interval, base_path=args.lake, provider=args.provider, state_root=args.state,
                       compression=args.compression, layout=args.layout, quarantine_path=args.quarantine,
                       table_name=args.table, max_attempts=args.max_attempts, close_cycles=args.close_cycles)
        if args.stream:
            if not args.checkpoint:
                raise ValueError("--stream needs --checkpoint")
            res = run_available_now(spark, args.landing, checkpoint=args.checkpoint, **options)
            if res is None:
                log.info("nothing new landed")
                return 0
        else:
            res = run_batch(spark, read_responses(spark, args.landing), **options)
        rr = res.run_report.first()
        if rr["success"]:
            print(f"[SUCCESS] run {res.run_id}: {rr['records_processed']} records in "
                  f"{rr['files_written']} files, {rr['failed_count']} failed, {rr['pending_count']} pending, "
                  f"{rr['rejected_count']} rows rejected")
            return 0
        print(f"[FAILED] run {res.run_id}: {rr['error'] or 'no location has finished'}")
        return 1
    except Exception as exc:  # any failure is a failed run
        print(f"Pipeline error: {exc}")
        return 1


if __name__ == "__main__":
    sys.exit(main())
