"""Run manifest of a lake: what each run wrote for a location and ingestion day.

One row per (location, ingestion day, run) with its ingestion time, row count and least
and greatest data time, below ``{base}/_manifest/provider=…/interval=…`` and partitioned
like the data (``ingest_date``, ``run_id``). Each daily write by date adds its rows after its data, so a run counts once
its manifest is there. Daily reads resolve "the latest run of a location and day" (K4)
from these rows and scan the data once; runs that win nowhere are pruned.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from forecastlake.schemas import require_interval
from forecastlake.session import path_exists

MANIFEST = T.StructType([
    T.StructField("location_name", T.StringType()),
    T.StructField("ingestion_timestamp_utc", T.TimestampNTZType()),
    T.StructField("n_rows", T.LongType()),
    T.StructField("n_times", T.LongType()),           # rows with a time
    T.StructField("first_time", T.TimestampNTZType()),
    T.StructField("last_time", T.TimestampNTZType()),
    T.StructField("ingest_date", T.DateType()),
    T.StructField("run_id", T.StringType()),
])
PARTS = ["ingest_date", "run_id"]


def manifest_root(base_path: str, provider: str, interval: str) -> str:
    return f"{base_path.rstrip('/')}/_manifest/provider={provider}/interval={require_interval(interval)}"


def has_manifest(spark: SparkSession, base_path: str, provider: str, interval: str) -> bool:
    return path_exists(spark, manifest_root(base_path, provider, interval))


def manifest_rows(rows: DataFrame, time_col: str) -> DataFrame:
    """Manifest of lake rows: one aggregation over four narrow columns, combined before its shuffle."""
    day = F.to_date("ingestion_timestamp_utc")
    return rows.groupBy("location_name", day.alias("ingest_date"), "run_id").agg(
        F.max("ingestion_timestamp_utc").alias("ingestion_timestamp_utc"), F.count(F.lit(1)).alias("n_rows"),
        F.count(time_col).alias("n_times"), F.min(time_col).alias("first_time"), F.max(time_col).alias("last_time"))


def write_manifest(manifest: DataFrame, base_path: str, provider: str, interval: str) -> None:
    """Add a run's rows; a retry of the run replaces them."""
    (manifest.select(*MANIFEST.fieldNames()).repartition(*PARTS).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy(*PARTS).parquet(manifest_root(base_path, provider, interval)))


def read_manifest(spark: SparkSession, base_path: str, interval: str, provider: str | None = None) -> DataFrame:
    """Manifest rows with their provider."""
    schema = T.StructType([*MANIFEST.fields, T.StructField("provider", T.StringType())])
    return (spark.read.schema(schema).option("basePath", f"{base_path.rstrip('/')}/_manifest")
            .parquet(manifest_root(base_path, provider or "*", interval)))


def winning_runs(manifest: DataFrame) -> DataFrame:
    """(provider, location, day, run): the latest run of each location and ingestion day.

    The filter also tells the planner that these rows select, so that the lake's
    partitions are pruned by them at run time.
    """
    keys = ["provider", "location_name", "ingest_date"]
    return (manifest.filter("n_rows > 0").groupBy(*keys)
            .agg(F.max(F.struct("ingestion_timestamp_utc", "run_id"))["run_id"].alias("run_id")))


def latest_by_manifest(lake: DataFrame, manifest: DataFrame) -> DataFrame:
    """Rows of the winning runs: one scan of the data, no aggregation of its rows."""
    return lake.join(winning_runs(manifest), ["provider", "location_name", "ingest_date", "run_id"], "left_semi")
