"""Raw-response and location sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forecastlake.schemas import LOCATION, RESPONSE, require_interval


def read_responses(spark: SparkSession, path: str, *, fmt: str = "json") -> DataFrame:
    """Landed responses, one row per attempt, with the RESPONSE schema.

    The schema is always given: no inference pass over the landing zone.
    """
    reader = spark.read.schema(RESPONSE)
    return reader.json(path) if fmt == "json" else reader.format(fmt).load(path)


def read_bodies(spark: SparkSession, path: str, *, glob: str | None = None) -> DataFrame:
    """Untouched API bodies, one file each (S1): path, body_bytes, modified, body.

    For folders that a fetcher filled with the bodies as it got them. Files are read
    whole, whatever their names, in folders of any depth; a body that isn't UTF-8 is
    null (an empty body for ``parse_responses``), its size is not. Spark makes no task
    for a file of no bytes, so an empty file gives no row.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    files = (reader.option("pathGlobFilter", glob) if glob else reader).load(path)
    text = F.col("content").cast("string")
    return files.select(F.url_decode(F.replace("path", F.lit("+"), F.lit("%2B"))).alias("path"),
                        F.col("length").alias("body_bytes"), F.col("modificationTime").alias("modified"),
                        F.try_validate_utf8(text).alias("body"))


def _in_utc(instant: str):
    """The instant's wall clock in UTC, whatever the session's zone."""
    micros = F.unix_micros(instant)
    return (F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
            + F.make_dt_interval(secs=(micros.cast("decimal(20,0)") / 1_000_000).cast("decimal(18,6)")))


def bodies_to_responses(bodies: DataFrame, locations: DataFrame, *, interval: str, provider: str,
                        path_pattern: str = "([^/=]+)/[^/]+$") -> DataFrame:
    """Envelope rows (RESPONSE) of ``read_bodies``: what the folder tells about each fetch.

    The pattern's first group in the path is the location's name, which is looked up in
    ``locations``; one that isn't there keeps its name without coordinates. A file is a
    fetch cycle of its own that landed when the file was last written; attempts, elapsed
    time and status aren't known.
    """
    require_interval(interval)
    dim = locations.select(F.col("name").alias("_name"), F.struct("name", "latitude", "longitude").alias("_location"))
    named = bodies.withColumn("_name", F.regexp_extract("path", path_pattern, 1)).join(dim, "_name", "left")
    unknown = F.struct(F.col("_name").alias("name"), F.lit(None).cast("double").alias("latitude"),
                       F.lit(None).cast("double").alias("longitude"))
    known = {"location": F.coalesce("_location", unknown), "provider": F.lit(provider), "interval": F.lit(interval),
             "body": F.col("body"), "run_id": F.col("path"), "request_url": F.col("path"),
             "ingestion_timestamp_utc": _in_utc("modified")}
    return named.select(*[known.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in RESPONSE.fields])


def locations_df(spark: SparkSession, rows) -> DataFrame:
    """Location dimension from configuration rows.

    Only dimension rows pass through the driver, never series data.
    """
    return spark.createDataFrame([tuple(r) for r in rows], LOCATION)


def read_locations(spark: SparkSession, path: str, *, fmt: str = "json") -> DataFrame:
    """Location dimension from a JSON or CSV file (S6), with the LOCATION schema."""
    reader = spark.read.schema(LOCATION)
    return reader.option("header", "true").csv(path) if fmt == "csv" else reader.format(fmt).load(path)


def request_manifest(locations: DataFrame, *, interval: str, variables: list[str],
                     forecast_days: int = 7, timezone: str = "GMT",
                     base_url: str = "https://api.open-meteo.com/v1/forecast",
                     name_col: str = "name", lat_col: str = "latitude",
                     lon_col: str = "longitude") -> DataFrame:
    """One request per location.

    ``hourly``/``daily`` hold the comma-joined variable list only for the
    active interval and only when the list is non-empty.
    """
    require_interval(interval)
    joined = F.concat_ws(",", F.array(*[F.lit(v) for v in variables])) if variables else None
    active = F.lit(joined is not None)
    hourly = F.when(active & F.lit(interval == "hourly"), joined) if joined is not None else F.lit(None)
    daily = F.when(active & F.lit(interval == "daily"), joined) if joined is not None else F.lit(None)
    df = locations.select(
        F.col(name_col).alias("location_name"),
        F.col(lat_col).cast("double").alias("latitude"),
        F.col(lon_col).cast("double").alias("longitude"),
        F.lit(forecast_days).alias("forecast_days"),
        F.lit(timezone).alias("timezone"),
        hourly.cast("string").alias("hourly"),
        daily.cast("string").alias("daily"),
    )
    params = F.concat_ws(
        "&",
        F.concat(F.lit("latitude="), F.col("latitude").cast("string")),
        F.concat(F.lit("longitude="), F.col("longitude").cast("string")),
        F.concat(F.lit("forecast_days="), F.col("forecast_days").cast("string")),
        F.concat(F.lit("timezone="), F.col("timezone")),
        F.when(F.col("hourly").isNotNull(), F.concat(F.lit("hourly="), F.col("hourly"))),
        F.when(F.col("daily").isNotNull(), F.concat(F.lit("daily="), F.col("daily"))),
    )
    return df.withColumn("request_url", F.concat(F.lit(base_url + "?"), params))


def schema_rows(spark: SparkSession, df: DataFrame) -> DataFrame:
    """Schema of a frame as rows (name, type, ordinal) (S9: ``LIMIT 0`` → schema)."""
    rows = [(f.name, f.dataType.simpleString(), i) for i, f in enumerate(df.schema.fields)]
    return spark.createDataFrame(rows, "column_name string, data_type string, ordinal int")


def attach_locations(responses: DataFrame, locations: DataFrame, *,
                     name_col: str = "location_name") -> DataFrame:
    """Attach the location dimension to responses that carry only a name.

    An inner equi-join on the name. The dimension is one row per configured
    location; Catalyst broadcasts it only when its measured size is under the
    broadcast threshold and otherwise plans a sort-merge join, so no size is
    assumed here.
    """
    dim = locations.select(
        F.col("name").alias(name_col),
        F.struct("name", "latitude", "longitude").alias("location"))
    return responses.drop("location").join(dim, name_col, "inner")
