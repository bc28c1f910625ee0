"""One ingestion run as Spark jobs (the whole ingestion lifecycle).

landed responses -> parsed once into a staging table (envelope, outcome, typed
series) -> final attempt of each fetch cycle, from the envelope columns -> flatten,
validate, write lake and rejected rows -> state upsert (after the write) -> reports.
Every staged response of the run's provider and interval ends in exactly one
outcome: ok, failed, pending or superseded (another attempt of its cycle counts).
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forecastlake.functions.scalars import partition_path
from forecastlake.operators.flatten import flatten_series, forecast_end_expr, series_counts
from forecastlake.operators.parse import parse_responses
from forecastlake.operators.state import (
    DEFAULT_MAX_ATTEMPTS,
    RETRYABLE_CLASSES,
    outcomes,
    resolve_attempts,
)
from forecastlake.operators.validate import check_rows
from forecastlake.schemas import require_interval
from forecastlake.session import scratch_path
from forecastlake.sinks.catalog import write_lake_table
from forecastlake.sinks.lake import DEFAULT_LAYOUT, rejected_root, write_forecasts
from forecastlake.sinks.reports import run_report
from forecastlake.sources.state_store import save_state, update_buckets

DEFAULT_PROVIDER = "open_meteo"
#: What makes attempts belong together: the fetch cycle is the envelope's run id.
CYCLE_KEY = ["provider", "interval", "location", "cycle"]
#: Columns of a staged response that resolving needs: all but its series.
ENVELOPE = ["rid", *CYCLE_KEY, "attempt", "attempt_class", "error_class", "ingestion_timestamp_utc", "error",
            "forecast_end_date", "n_good", "n_bad", "n_times", "first_time", "last_time"]


@dataclass
class RunResult:
    run_id: str
    report: DataFrame          # per (location, run) file report
    failed: DataFrame          # failed responses
    pending: DataFrame         # cycles whose attempts are all retryable so far
    quarantined: DataFrame     # rows that failed validation, as written
    resolved: DataFrame        # one row per staged response: rid, cycle key, outcome
    run_report: DataFrame      # one row
    state_path: str | None


def stage_responses(responses: DataFrame, *, interval: str, provider: str,
                    max_attempts: int = DEFAULT_MAX_ATTEMPTS, epoch: int = 0) -> DataFrame:
    """Parse each body once; one row per response without the raw body.

    Responses of other providers belong to their own runs; a response without a
    provider counts as this one's. An attempt without a number is a fetch that isn't
    retried. Only the interval's series of a usable response are kept; its good and bad
    points are counted inside the row, so that no later step counts exploded rows.
    """
    batch = (responses.filter(F.col("interval") == interval)
             .withColumn("provider", F.coalesce("provider", F.lit(provider)))
             .filter(F.col("provider") == provider)
             .withColumn("attempt", F.coalesce("attempt", F.lit(max_attempts))))
    block = F.col("doc").getField(interval)
    failed_fetch = F.col("transport_error").isNotNull()
    staged = parse_responses(batch).select(
        F.format_string("%010d-%020d", F.lit(epoch), F.monotonically_increasing_id()).alias("rid"),
        "location", "provider", "interval", F.col("run_id").alias("cycle"), "attempt", "error_class",
        F.when(failed_fetch, F.coalesce("error_class", F.lit("unknown"))).alias("attempt_class"),
        "ingestion_timestamp_utc", "error", "api_latitude", "api_longitude",
        forecast_end_expr().alias("forecast_end_date"),
        F.when(F.col("error").isNull(), F.struct(block.alias(interval))).alias("doc"))
    return series_counts(staged, interval)


def resolve_cycles(envelopes: DataFrame, *, max_attempts: int = DEFAULT_MAX_ATTEMPTS,
                   retryable: tuple[str, ...] = RETRYABLE_CLASSES, close: bool = False) -> DataFrame:
    """One row per staged response with its outcome.

    A cycle's final attempt is the earliest that is terminal; without one the cycle
    is pending, or failed by its latest attempt when ``close`` is set. Cycles are
    grouped by value, so responses without a location name count too. Daily: of the
    usable responses of a location and ingestion day only the latest is written.
    """
    log = envelopes.select(*ENVELOPE)
    picked = resolve_attempts(log, CYCLE_KEY, class_col="attempt_class",
                              order_cols=("ingestion_timestamp_utc", "rid"), carry=("rid",),
                              max_attempts=max_attempts, retryable=retryable)
    picked = picked.select("rid", (F.col("final_status") == "pending").alias("_open"))
    rows = log.join(picked, "rid", "left")
    waiting = F.col("_open") & F.lit(not close)
    rows = rows.withColumn("outcome", F.when(F.col("_open").isNull(), "superseded")
                           .when(waiting, "pending").when(F.col("error").isNull(), "ok").otherwise("failed"))
    ok = F.col("outcome") == "ok"
    day = F.to_date("ingestion_timestamp_utc")
    latest = (rows.filter(ok & (F.col("interval") == "daily"))
              .groupBy("provider", F.col("location.name").alias("_name"), day.alias("_day"))
              .agg(F.max(F.struct("ingestion_timestamp_utc", "attempt", "rid"))["rid"].alias("rid"))
              .select("rid", F.lit(True).alias("_latest")))
    rows = rows.join(latest, "rid", "left")
    write = ok & ((F.col("interval") == "hourly") | F.coalesce("_latest", F.lit(False)))
    # Points of responses that aren't written are neither good nor bad rows of the run.
    rows = rows.withColumn("written", write).drop("_open", "_latest")
    return rows.withColumns({c: F.when(F.col("written"), F.col(c)).otherwise(F.lit(0).cast("long"))
                             for c in ("n_good", "n_bad")})


def run_manifest(resolved: DataFrame, run_id: str) -> DataFrame:
    """The run's manifest rows from its responses' counts; the series aren't read for it."""
    return (resolved.filter("n_good > 0")
            .groupBy(F.col("location.name").alias("location_name"), F.to_date("ingestion_timestamp_utc").alias("ingest_date"))
            .agg(F.max("ingestion_timestamp_utc").alias("ingestion_timestamp_utc"), F.sum("n_good").alias("n_rows"),
                 F.sum("n_times").alias("n_times"),
                 F.min("first_time").alias("first_time"), F.max("last_time").alias("last_time"))
            .withColumn("run_id", F.lit(run_id)))


def response_outcomes(resolved: DataFrame, at) -> DataFrame:
    """State updates: one per final response (R3, R4), records as written."""
    return outcomes(
        resolved.filter(F.col("outcome").isin("ok", "failed")),
        provider=F.col("provider"), interval=F.col("interval"),
        location_name=F.col("location.name"),
        success=F.col("outcome") == "ok", error=F.col("error"),
        records=F.col("n_good"), forecast_end_date=F.col("forecast_end_date"),
        at=F.lit(at) if at is not None else F.current_timestamp(),
        order=F.struct("ingestion_timestamp_utc", "attempt", "rid"),
    )


def run_batch(spark: SparkSession, responses: DataFrame, *, interval: str, base_path: str,
              provider: str = DEFAULT_PROVIDER, max_attempts: int = DEFAULT_MAX_ATTEMPTS,
              run_id: str | None = None, **options) -> RunResult:
    """Run one ingestion over a responses DataFrame (any size, any source).

    The landing zone is read once, into a staging table in the shared scratch
    folder. ``options`` are those of ``run_staged``.
    """
    require_interval(interval)
    run_id = run_id or str(uuid.uuid4())
    path = scratch_path(spark, "staged")
    stage_responses(responses, interval=interval, provider=provider, max_attempts=max_attempts).write.parquet(path)
    return run_staged(spark, spark.read.parquet(path), interval=interval, base_path=base_path, provider=provider,
                      max_attempts=max_attempts, run_id=run_id, **options)


def run_staged(spark: SparkSession, staged: DataFrame, *, interval: str, base_path: str, provider: str,
               run_id: str, carried: DataFrame | None = None, closed: DataFrame | None = None,
               seen: DataFrame | None = None, state_root: str | None = None,
               compression: str = "zstd", layout: str = DEFAULT_LAYOUT, quarantine_path: str | None = None,
               table_name: str | None = None, max_attempts: int = DEFAULT_MAX_ATTEMPTS,
               close_cycles: bool = False, now=None) -> RunResult:
    """Resolve, write and report staged responses.

    Work that earlier runs left: ``carried`` has the envelopes of cycles that are still
    pending, ``closed`` the keys of cycles whose outcome is settled (their late attempts
    change nothing), ``seen`` the latest daily fetch written for a location and day
    (``_name``, ``_day``, ``_seen``; an older one isn't written over it). Rejected rows
    always go to ``quarantine_path`` (below the lake unless given) and are counted. The
    series are read twice, for the lake and for the rejected rows; raw bodies are gone.
    """
    run_start = now or datetime.now(timezone.utc)
    envelopes = staged.select(*ENVELOPE)
    if closed is not None:
        keys = closed.select(*CYCLE_KEY)
        envelopes = envelopes.join(keys, _same(envelopes, keys, CYCLE_KEY), "left_anti")
    if carried is not None:
        envelopes = envelopes.unionByName(carried.select(*ENVELOPE))
    resolved = resolve_cycles(envelopes, max_attempts=max_attempts, close=close_cycles)
    if seen is not None and interval == "daily":
        resolved = _not_older(resolved, seen)
    resolved = _staged(spark, resolved, "resolved")

    # Usable responses that aren't written are few (superseded or replaced): the join's small side.
    usable = staged.filter(F.col("error").isNull())
    dropped = usable.select("rid").join(resolved.filter("written").select("rid"), "rid", "left_anti")
    rows = flatten_series(usable.join(dropped, "rid", "left_anti"), interval, run_id=run_id)
    good, bad = check_rows(rows)
    options = dict(interval=interval, provider=provider, compression=compression, layout=layout,
                   manifest=run_manifest(resolved, run_id))
    if table_name:
        write_lake_table(spark, table_name, good, base_path, **options)
    else:
        write_forecasts(good, base_path, latest_run_only=False, **options)
    target = quarantine_path or rejected_root(base_path, provider, interval)
    (bad.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("run_id").parquet(target))
    rejected = spark.read.schema(bad.schema).parquet(target).filter(F.col("run_id") == run_id)

    report = (resolved.filter("n_good > 0").groupBy(F.col("location.name").alias("location_name"))
              .agg(F.sum("n_good").alias("records_written"), F.min("ingestion_timestamp_utc").alias("first_ingest"))
              .select("location_name", F.lit(run_id).alias("run_id"),
                      partition_path(F.lit(provider), "location_name", F.lit(interval), F.lit(run_id),
                                     "first_ingest").alias("path"),
                      "records_written", F.lit("parquet").alias("format")).orderBy("location_name"))
    failed = resolved.filter("outcome = 'failed'").select(
        "location", "error", F.lit("failed").alias("status"), "provider", "interval", "attempt",
        "error_class", "ingestion_timestamp_utc", "cycle")
    pending = resolved.filter("outcome = 'pending'").select(*CYCLE_KEY, "attempt", "error", "error_class")

    state_path = None
    if state_root:
        # State is updated after the lake write, so a crash between the two
        # leaves the state pointing at the previous run (never ahead of data).
        updates = response_outcomes(resolved, run_start)
        state_path = save_state(update_buckets(spark, state_root, updates), state_root)
    run_end = datetime.now(timezone.utc) if now is None else now
    rr = run_report(resolved, run_id=run_id, run_start=run_start, run_end=run_end)
    return RunResult(run_id, report, failed, pending, rejected, resolved, rr, state_path)


def _staged(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _same(left: DataFrame, right: DataFrame, cols: list[str]):
    """Equal by value, nulls included (an equi-join for Spark)."""
    cond = F.lit(True)
    for c in cols:
        cond = cond & left[c].eqNullSafe(right[c])
    return cond


def _not_older(resolved: DataFrame, seen: DataFrame) -> DataFrame:
    """Daily: leave out what an earlier run has replaced already."""
    before = seen.groupBy("_name", "_day").agg(F.max("_seen").alias("_seen"))
    cond = resolved["location.name"].eqNullSafe(before["_name"]) & F.to_date(resolved["ingestion_timestamp_utc"]).eqNullSafe(before["_day"])
    joined = resolved.join(before, cond, "left")
    newer = F.col("_seen").isNull() | (F.col("ingestion_timestamp_utc") >= F.col("_seen"))
    rows = joined.withColumn("written", F.col("written") & newer).drop("_name", "_day", "_seen")
    return rows.withColumns({c: F.when(F.col("written"), F.col(c)).otherwise(F.lit(0).cast("long"))
                             for c in ("n_good", "n_bad")})
