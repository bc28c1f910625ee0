"""Write and run reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forecastlake.functions.scalars import partition_path, prototype_partition_path
from forecastlake.sources.lake import read_lake

# Fixed value: run-report error text when no location succeeded.
ALL_FAILED = "All locations failed to fetch data."


def write_report(spark: SparkSession, base_path: str, *, interval: str, provider: str,
                 run_ids: list[str] | None = None, ingest_dates=None) -> DataFrame:
    """Per (location, run) file report from a read-back of the lake (K8, K3).

    Only partition columns, ``run_id`` and the ingestion time are read; run ids and
    dates are partition filters. The path uses the ingestion time of the location's
    first row in the run (A14: its minimum, which is deterministic). A run itself
    counts its rows from its staging table and needs no read-back.
    """
    lake = read_lake(spark, base_path, interval, provider=provider, run_ids=run_ids,
                     ingest_dates=ingest_dates)
    g = (lake.groupBy("location_name", "run_id")
         .agg(F.count(F.lit(1)).alias("records_written"),
              F.min("ingestion_timestamp_utc").alias("first_ingest")))
    return g.select(
        "location_name", "run_id",
        partition_path(F.lit(provider), "location_name", F.lit(interval), "run_id",
                       "first_ingest").alias("path"),
        "records_written", F.lit("parquet").alias("format"),
    ).orderBy("location_name", "run_id")


def report_totals(report: DataFrame) -> DataFrame:
    """Total records written and number of files (K8)."""
    return report.agg(F.coalesce(F.sum("records_written"), F.lit(0)).cast("long").alias("records_processed"),
                      F.count(F.lit(1)).alias("files_written"))


def run_report(resolved: DataFrame, *, run_id: str, run_start, run_end) -> DataFrame:
    """One-row run report (K9, G3): counts by a single aggregation.

    ``resolved`` has one row per response with its ``outcome`` and row counts
    (``n_good`` written, ``n_bad`` rejected). ``success`` is true iff a response is
    usable; one with an empty series succeeds with 0 records. The fixed error text
    says that every location failed; cycles that are still pending have not failed.
    responses = ok_count + failed_count + pending_count + superseded_count. Files and
    failures are tables of the run's result, not lists in this row.
    """
    def n(outcome):
        return F.count_if(F.col("outcome") == outcome).alias(f"{outcome}_count")

    written = F.when(F.col("n_good") > 0, F.col("location.name"))
    sums = resolved.agg(F.count(F.lit(1)).alias("responses"), n("ok"), n("failed"), n("pending"), n("superseded"),
                        F.coalesce(F.sum("n_good"), F.lit(0)).cast("long").alias("records_processed"),
                        F.coalesce(F.sum("n_bad"), F.lit(0)).cast("long").alias("rejected_count"),
                        F.count_distinct(written).alias("files_written"))
    success = F.col("ok_count") > 0
    return sums.select(
        success.alias("success"), F.lit(run_id).alias("run_id"),
        F.lit(run_start).cast("timestamp").alias("run_start"), F.lit(run_end).cast("timestamp").alias("run_end"),
        "records_processed", "rejected_count", "files_written", "responses",
        "ok_count", "failed_count", "pending_count", "superseded_count",
        F.when(~success & (F.col("pending_count") == 0), F.lit(ALL_FAILED)).alias("error"))


def prototype_paths(df: DataFrame, interval: str) -> DataFrame:
    """Distinct prototype paths per (location, ingestion time)."""
    return (df.select("location_name", "ingestion_timestamp_utc").distinct()
            .select("location_name", "ingestion_timestamp_utc",
                    prototype_partition_path(F.lit(interval), "location_name",
                                             "ingestion_timestamp_utc").alias("path")))
