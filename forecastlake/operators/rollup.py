"""Exact, mergeable rollups of a lake's times.

A time on the interval's grid (whole hours or days) is a position in a bitmap of 32,768
positions, so distinct times of any set of runs are counted from their bitmaps by
OR, without the rows. Times off the grid stay rows of their own, so counts are exact
for any data. A rollup row holds one fetch of a location: what a run wrote with one
ingestion time, by bitmap bucket.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from forecastlake.operators.flatten import TIME_COLUMN
from forecastlake.schemas import require_interval
from forecastlake.session import empty_frame, path_exists
from forecastlake.sources.lake import read_lake
from forecastlake.sources.manifest import PARTS, read_manifest, winning_runs

ROLLUP = T.StructType([
    T.StructField("location_name", T.StringType()),
    T.StructField("ingestion_timestamp_utc", T.TimestampNTZType()),
    T.StructField("bucket", T.LongType()),            # null: the time is off the grid, or null
    T.StructField("odd_time", T.TimestampNTZType()),
    T.StructField("n_rows", T.LongType()),
    T.StructField("times", T.BinaryType()),
    T.StructField("ingest_date", T.DateType()),
    T.StructField("run_id", T.StringType()),
])


def time_position(time_col: str, interval: str) -> Column:
    """Number of the hour or day since 1970, NULL off the grid; independent of the session's zone."""
    t = F.col(time_col)
    day = F.unix_date(F.to_date(t)).cast("long")
    whole = (F.minute(t) == 0) & (F.extract(F.lit("SECOND"), t) == 0)
    if require_interval(interval) == "daily":
        return F.when(whole & (F.hour(t) == 0), day)
    return F.when(whole, day * 24 + F.hour(t))


def time_rollup(rows: DataFrame, interval: str, keys: list[str], *, time_col: str | None = None) -> DataFrame:
    """``keys``, bucket, odd_time, n_rows, times: the rows' times as bitmaps, one aggregation."""
    time_col = time_col or TIME_COLUMN[interval]
    at = time_position(time_col, interval)
    return (rows.withColumn("_at", at)
            .groupBy(*keys, F.bitmap_bucket_number("_at").alias("bucket"),
                     F.when(F.col("_at").isNull(), F.col(time_col)).alias("odd_time"))
            .agg(F.count(F.lit(1)).alias("n_rows"),
                 F.bitmap_construct_agg(F.bitmap_bit_position("_at")).alias("times")))


def rollup_root(base_path: str, provider: str, interval: str) -> str:
    return f"{base_path.rstrip('/')}/_rollup/provider={provider}/interval={require_interval(interval)}"


def read_rollup(spark: SparkSession, base_path: str, interval: str, provider: str) -> DataFrame:
    """Rollup rows with their provider; none if nothing is rolled up yet."""
    schema = T.StructType([*ROLLUP.fields, T.StructField("provider", T.StringType())])
    root = rollup_root(base_path, provider, interval)
    if not path_exists(spark, root):
        return empty_frame(spark, schema)
    return spark.read.schema(schema).option("basePath", f"{base_path.rstrip('/')}/_rollup").parquet(root)


def refresh_rollup(spark: SparkSession, base_path: str, *, interval: str = "daily", provider: str) -> int:
    """Roll up the runs that aren't, or were written again since; returns how many (day, run) partitions.

    Runs are those of the manifest. Only their partitions of the lake are read, three
    columns of them, so the cost follows the new runs.
    """
    def written(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy(*PARTS).agg(F.max("_metadata.file_modification_time").alias(name))

    runs = written(read_manifest(spark, base_path, interval, provider), "_written")
    if path_exists(spark, rollup_root(base_path, provider, interval)):
        rolled = written(read_rollup(spark, base_path, interval, provider), "_rolled")
        runs = runs.join(rolled, PARTS, "left").filter("_rolled is null or _rolled < _written")
    todo = runs.select(*PARTS).cache()      # one row a (day, run)
    n = todo.count()
    if n:
        lake = read_lake(spark, base_path, interval, provider=provider, with_partitions=True, latest_only=False)
        fresh = lake.join(todo, PARTS, "left_semi")
        rows = time_rollup(fresh, interval, ["location_name", "ingestion_timestamp_utc", *PARTS])
        (rows.select(*ROLLUP.fieldNames()).repartition(*PARTS).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy(*PARTS)
         .parquet(rollup_root(base_path, provider, interval)))
    todo.unpersist()
    return n


def current_rollup(spark: SparkSession, base_path: str, *, interval: str = "daily", provider: str) -> DataFrame:
    """Rollup rows of what a read of the lake shows: daily, the winning run of each location and day."""
    rollup = read_rollup(spark, base_path, interval, provider)
    if interval != "daily":
        return rollup
    winners = winning_runs(read_manifest(spark, base_path, interval, provider))
    return rollup.join(winners, ["provider", "location_name", *PARTS], "left_semi")


def distinct_times(rollup: DataFrame, keys: list[str]) -> DataFrame:
    """``keys``, record_count, unique_dates: rows and distinct times, from bitmaps alone."""
    parts = rollup.groupBy(*keys, "bucket", "odd_time").agg(
        F.sum("n_rows").alias("n"), F.bitmap_count(F.bitmap_or_agg("times")).alias("c"))
    unique = F.when(F.col("bucket").isNotNull(), F.col("c")).otherwise(F.col("odd_time").isNotNull().cast("long"))
    return parts.groupBy(*keys).agg(F.sum("n").alias("record_count"), F.sum(unique).cast("long").alias("unique_dates"))


def completeness_from_rollup(rollup: DataFrame) -> DataFrame:
    """A1 from rollup rows: the numbers of ``quality.completeness`` over the lake's rows."""
    return distinct_times(rollup, ["location_name"]).orderBy(F.col("location_name").asc_nulls_last())


def ingestion_span_from_rollup(rollup: DataFrame) -> DataFrame:
    """A4 from rollup rows: the numbers of ``quality.ingestion_span``."""
    c = F.col("ingestion_timestamp_utc")
    return rollup.agg(F.min(c).alias("earliest_ingest"), F.max(c).alias("latest_ingest"),
                      F.count_distinct(c).alias("unique_ingest_times"))


def duplicates_by_elimination(df: DataFrame, interval: str, *, location_col: str = "location_name",
                              time_col: str | None = None) -> DataFrame:
    """(location, time, dup_count) of keys that occur more than once.

    First one aggregation by location and bitmap bucket: where the bitmap has as many
    positions as there are rows, no key repeats. Only rows of the other groups, and of
    off-grid or null times that repeat, are grouped by the full key.
    """
    time_col = time_col or TIME_COLUMN[interval]
    at = time_position(time_col, interval)
    rows = df.withColumn("_bucket", F.bitmap_bucket_number(at)).withColumn("_odd", F.when(at.isNull(), F.col(time_col)))
    rolled = time_rollup(df, interval, [location_col], time_col=time_col)
    full = F.when(F.col("bucket").isNotNull(), F.bitmap_count("times")).otherwise(F.lit(1))
    suspects = rolled.filter(F.col("n_rows") > full).select(
        F.col(location_col).alias("_l"), F.col("bucket").alias("_b"), F.col("odd_time").alias("_o"))
    same = (F.col(location_col).eqNullSafe(F.col("_l")) & F.col("_bucket").eqNullSafe(F.col("_b"))
            & F.col("_odd").eqNullSafe(F.col("_o")))
    return (rows.join(suspects, same, "left_semi").groupBy(location_col, time_col)
            .agg(F.count(F.lit(1)).alias("dup_count")).filter("dup_count > 1"))
