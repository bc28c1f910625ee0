"""Benchmark the headline queries.

Runs each query at $BENCH_SF_DIR (default /root/testdata/sf0.1) on
local[$BENCH_CPUS] and prints ONE JSON line:
{"metric": "total_query_seconds", "value": N, "unit": "sec", "queries": {...}, "sf": ...}
Each query is fully executed with the no-op sink (every row computed, nothing
collected). Queries over raw responses read a landing zone that is written once
before the timing, as a fetcher would leave it. Before timing, every query runs
once on the smallest tables ($BENCH_WARMUP_DIR, default /root/testdata/sf0.001;
"" times cold runs). Each query is then timed $BENCH_REPEATS times (default 2):
"queries" and "value" are the first timed runs, "best" the fastest ones.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from forecastlake.operators import flatten as fl  # noqa: E402
from forecastlake.operators import quality  # noqa: E402
from forecastlake.operators.parse import parse_responses, split_ok_failed  # noqa: E402
from forecastlake.operators.validate import check_rows  # noqa: E402
from forecastlake.plans.queries import QUERIES  # noqa: E402
from forecastlake.plans.run import run_batch  # noqa: E402
from forecastlake.session import get_spark, scratch_path, table_path  # noqa: E402
from forecastlake.sources import tables as tb  # noqa: E402
from forecastlake.sources.responses import read_responses  # noqa: E402

FROM_TABLES = [
    "flatten_daily",
    "multi_location_body",
    "completeness",
    "ranges_daily",
    "comparison_daily",
    "duplicates",
    "null_counts",
    "sample_rows",
    "state_after_run",
    "stale_locations",
    "attempt_resolution",
    "partitioned_write_hourly",
    "partitioned_write_daily",
]


def _rows(responses):
    return check_rows(fl.flatten_hourly(split_ok_failed(parse_responses(responses))[0]))


def _run(responses):
    spark = responses.sparkSession
    return run_batch(spark, responses, interval="hourly", base_path=scratch_path(spark, "bench-lake"),
                     state_root=scratch_path(spark, "bench-state"), run_id="bench").run_report


FROM_LANDING = {
    "ranges_from_responses": lambda r: quality.ranges(_rows(r)[0], "hourly"),
    "flatten_hourly": lambda r: _rows(r)[0],
    "row_validation": lambda r: _rows(r)[1],
    "split_failed": lambda r: split_ok_failed(parse_responses(r))[1],
    "run_report": _run,
}


def land(spark, sf_dir: str):
    """Responses packed from ``events``, one fetch cycle each, as JSON files."""
    from pyspark.sql import functions as F

    path = scratch_path(spark, "bench-landing")
    responses = tb.events_responses(spark.read.parquet(table_path(sf_dir, "events")))
    responses.withColumn("run_id", F.concat_ws("-", "run_id", "chunk")).drop("chunk").write.json(path)
    return read_responses(spark, path)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1].split(",") if len(sys.argv) > 1 else [*FROM_LANDING, *FROM_TABLES]
    spark = get_spark(f"local[{cpus}]", shuffle_partitions=int(cpus) * 2,
                      extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g")})

    def run(name: str, folder: str, landed) -> float:
        t0 = time.perf_counter()
        df = FROM_LANDING[name](landed) if name in FROM_LANDING else QUERIES[name](spark, folder)
        df.write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - t0, 3)

    warm_dir = os.environ.get("BENCH_WARMUP_DIR", "/root/testdata/sf0.001")
    if warm_dir and warm_dir != sf_dir:
        landed = land(spark, warm_dir)
        for name in names:
            run(name, warm_dir, landed)
    landed = land(spark, sf_dir)
    repeats = max(1, int(os.environ.get("BENCH_REPEATS", "2")))
    runs = {name: [] for name in names}
    for _ in range(repeats):
        for name in names:
            runs[name].append(run(name, sf_dir, landed))
    first = {name: v[0] for name, v in runs.items()}
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "total_query_seconds",
        "value": round(sum(first.values()), 3),
        "unit": "sec",
        "queries": first,
        "best": {name: min(v) for name, v in runs.items()},
        "repeats": repeats,
        "sf": float(m.group(1)) if m else sf_dir,
    }))


if __name__ == "__main__":
    main()
