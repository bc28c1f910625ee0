"""Partitioned lake writes.

The default layout partitions by ingestion date and run and sorts by location
inside the files, so the number of files follows the data, not the number of
locations. Runs only add directories, and a retry of a run is idempotent. Daily
replace is resolved when the lake is read, from the run manifest (``sources.manifest``):
the latest run of each location and day, so locations that a run lacks keep their rows.
``by_location`` (few locations) has a directory for each location; there a later
daily run overwrites the location's day (dynamic partition overwrite).
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forecastlake.schemas import INTERVAL_SCHEMA, require_interval
from forecastlake.session import path_exists
from forecastlake.sources.manifest import has_manifest, manifest_rows, write_manifest

SAFE_NAME = re.compile(r"^[A-Za-z0-9_.-]+$")
# Parquet codecs accepted by the writer.
CODECS = ("snappy", "gzip", "zstd")
LAYOUTS = ("by_location", "by_date")
DEFAULT_LAYOUT = "by_date"


def infer_interval(df: DataFrame) -> str:
    """Interval of a flattened frame: daily frames have a ``date`` column."""
    return "daily" if "date" in df.columns else "hourly"


def partition_columns(interval: str, layout: str = DEFAULT_LAYOUT) -> list[str]:
    """Partition levels below ``{base}/provider=…/interval=…``."""
    if layout not in LAYOUTS:
        raise ValueError(f"layout must be one of {LAYOUTS}")
    cols = ["location_name"] if layout == "by_location" else []
    cols.append("ingest_date")
    if interval == "hourly" or layout == "by_date":
        cols.append("run_id")
    return cols


def interval_root(base_path: str, provider: str, interval: str) -> str:
    """Directory of one provider and interval: ``{base}/provider=…/interval=…``."""
    if not SAFE_NAME.match(provider):
        raise ValueError(f"provider must match {SAFE_NAME.pattern}: {provider!r}")
    return f"{base_path.rstrip('/')}/provider={provider}/interval={require_interval(interval)}"


def rejected_root(base_path: str, provider: str, interval: str) -> str:
    """Where a run's rejected rows go by default; lake reads skip the folder."""
    return f"{base_path.rstrip('/')}/_rejected/provider={provider}/interval={require_interval(interval)}"


def keep_latest_run(df: DataFrame, keys: list[str]) -> DataFrame:
    """Within one batch, keep only the latest run of each key (daily replace).

    The per-key winner table is one row per (location, day); the semi join is
    planned by Catalyst (broadcast only under the measured size threshold,
    otherwise sort-merge with AQE skew splitting).
    """
    # Distinct runs first (hash aggregate on the keys, combined map-side), so
    # the struct max only sees one row per (key, run), not one per data row.
    runs = df.select(*keys, "ingestion_timestamp_utc", "run_id").distinct()
    winner = (runs.groupBy(*keys)
              .agg(F.max(F.struct("ingestion_timestamp_utc", "run_id"))["run_id"].alias("run_id")))
    return df.join(winner, [*keys, "run_id"], "left_semi")


def with_lake_columns(df: DataFrame, *, interval: str) -> DataFrame:
    """Interval columns plus ``ingest_date``; ``run_id`` is required on write.

    A NULL run id would silently land in Hive's default partition; the check
    is a JVM-side expression that only fires for such a row.
    """
    cols = [F.coalesce(F.col("run_id"), F.raise_error(F.lit("run_id is required when writing the lake")))
            .alias("run_id") if f.name == "run_id" else F.col(f.name)
            for f in INTERVAL_SCHEMA[interval].fields]
    return df.select(*cols, F.to_date("ingestion_timestamp_utc").alias("ingest_date"))


def write_forecasts(df: DataFrame, base_path: str, *, interval: str | None, provider: str,
                    compression: str = "zstd", layout: str = DEFAULT_LAYOUT,
                    latest_run_only: bool | None = None, manifest: DataFrame | None = None) -> list[str]:
    """Write flattened rows into the lake in one job (K2-K6).

    One shuffle replaces the per-location filter loop: rows are rebalanced on
    the partition columns, and AQE splits a partition that holds a hot
    location (several files in that directory) and merges tiny ones.
    ``interval=None`` infers it from the columns. Daily writes by date add the run's
    manifest rows after the data: ``manifest``, or counted from ``df`` by one narrow
    aggregation. Returns the partition levels of the layout.
    """
    interval = require_interval(interval or infer_interval(df))
    if compression not in CODECS:
        raise ValueError(f"compression must be one of {CODECS}")
    target = interval_root(base_path, provider, interval)
    parts = partition_columns(interval, layout)
    out = arranged(df, interval=interval, layout=layout, latest_run_only=latest_run_only)
    adopt = _manifest_state(df.sparkSession, base_path, provider, interval, layout)
    (out.write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic")
     .option("compression", compression)
     .partitionBy(*parts)
     .parquet(target))
    if layout == "by_date" and interval == "daily":
        add_manifest(df, base_path, provider=provider, interval=interval, manifest=manifest, adopt=adopt)
    return ["provider", "interval", *parts]


def _manifest_state(spark, base_path: str, provider: str, interval: str, layout: str) -> bool:
    """True where the lake has data but no manifest, which the write must then make for all of it."""
    known = has_manifest(spark, base_path, provider, interval)
    if known and layout == "by_location":
        raise ValueError(f"the lake at {base_path} is laid out by date")
    return not known and path_exists(spark, interval_root(base_path, provider, interval))


def add_manifest(df: DataFrame, base_path: str, *, provider: str, interval: str, manifest: DataFrame | None = None,
                 adopt: bool = False) -> None:
    """Manifest rows of a write; with ``adopt`` of all that the lake holds."""
    time_col = INTERVAL_SCHEMA[interval].fields[5].name
    if adopt:
        from forecastlake.sources.lake import read_lake

        manifest = manifest_rows(read_lake(df.sparkSession, base_path, interval, provider=provider, latest_only=False), time_col)
    write_manifest(manifest_rows(df, time_col) if manifest is None else manifest, base_path, provider, interval)


def arranged(df: DataFrame, *, interval: str, layout: str, latest_run_only: bool | None = None) -> DataFrame:
    """Lake columns, dealt to writers by partition and sorted for them."""
    parts = partition_columns(interval, layout)
    out = with_lake_columns(df, interval=interval)
    if latest_run_only is None:       # by date, reads resolve the latest run
        latest_run_only = interval == "daily" and layout == "by_location"
    if latest_run_only:
        out = keep_latest_run(out, ["location_name", "ingest_date"])
    # Provider and interval are fixed directory levels, not data columns: as
    # constants they would drop out of the sort below, the writer would then
    # re-sort by partition columns only and the time order would be lost.
    out = out.hint("rebalance", *parts)
    # The writer's own sort (partition columns first) with time appended:
    # every file is time-ordered, so row-group min/max statistics let
    # time-range filters skip data, at no extra sort.
    time_col = INTERVAL_SCHEMA[interval].fields[5].name
    inner = ["location_name", time_col] if layout == "by_date" else [time_col]
    return out.sortWithinPartitions(*parts, *inner)


def write_single(df: DataFrame, path: str, *, compression: str = "snappy") -> DataFrame:
    """Single Parquet write (K1): overwrite ``path``; report path and row count.

    The count comes from the written files' footers, not a second pass.
    """
    if compression not in CODECS:
        raise ValueError(f"compression must be one of {CODECS}")
    df.write.mode("overwrite").option("compression", compression).parquet(path)
    back = df.sparkSession.read.parquet(path)
    return back.agg(F.count(F.lit(1)).alias("records_written")).select(
        F.lit(path).alias("path"), "records_written", F.lit("parquet").alias("format"),
        F.lit(compression).alias("compression"))
