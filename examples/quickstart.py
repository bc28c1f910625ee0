"""End-to-end example on the test tables.

    python examples/quickstart.py [/root/testdata/sf0.001]

Builds landed responses from ``events``, runs one ingestion, then the
quality checks over the lake and a look at the fetch state. Output goes under
the session's ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from forecastlake import quality, read_lake, read_state, run_batch  # noqa: E402
from forecastlake.session import get_spark, scratch_path, table_path  # noqa: E402
from forecastlake.sources.tables import events_responses  # noqa: E402


def main(sf_dir: str) -> None:
    spark = get_spark("local[4]")
    lake, state = scratch_path(spark, "example-lake"), scratch_path(spark, "example-state")
    responses = events_responses(spark.read.parquet(table_path(sf_dir, "events")))

    res = run_batch(spark, responses, interval="hourly", base_path=lake, state_root=state)
    res.run_report.select("success", "records_processed", "files_written", "failed_count").show()

    hourly = read_lake(spark, lake, "hourly", provider="open_meteo")
    quality.completeness(hourly).show()
    quality.ranges(hourly, "hourly").show()
    quality.ingestion_span(hourly).show()
    quality.sample(hourly, "hourly").show(truncate=False)
    read_state(spark, state).orderBy("location_name").show(truncate=False)


if __name__ == "__main__":
    main(sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001")
