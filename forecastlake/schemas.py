"""Spark schemas of every table the library reads or writes."""

from pyspark.sql import types as T

LOCATION = T.StructType([
    T.StructField("name", T.StringType()),
    T.StructField("latitude", T.DoubleType()),
    T.StructField("longitude", T.DoubleType()),
])

# One row per fetch attempt; the body is the raw response text.
RESPONSE = T.StructType([
    T.StructField("location", LOCATION),
    T.StructField("provider", T.StringType()),
    T.StructField("interval", T.StringType()),
    T.StructField("attempt", T.IntegerType()),
    T.StructField("body", T.StringType()),
    T.StructField("transport_error", T.StringType()),
    T.StructField("error_class", T.StringType()),
    T.StructField("ingestion_timestamp_utc", T.TimestampNTZType()),
    T.StructField("request_url", T.StringType()),
    T.StructField("elapsed_ms", T.DoubleType()),
    T.StructField("status_code", T.IntegerType()),
    T.StructField("run_id", T.StringType()),
])

_SERIES = T.MapType(T.StringType(), T.ArrayType(T.StringType()))
_UNITS = T.MapType(T.StringType(), T.StringType())

# Every scalar is read as text and typed later with try_cast, so one bad cell
# never nulls a whole array or a whole document.
BODY = T.StructType([
    T.StructField("latitude", T.StringType()),
    T.StructField("longitude", T.StringType()),
    T.StructField("elevation", T.StringType()),
    T.StructField("generationtime_ms", T.StringType()),
    T.StructField("utc_offset_seconds", T.StringType()),
    T.StructField("timezone", T.StringType()),
    T.StructField("timezone_abbreviation", T.StringType()),
    T.StructField("hourly", _SERIES),
    T.StructField("daily", _SERIES),
    T.StructField("hourly_units", _UNITS),
    T.StructField("daily_units", _UNITS),
    T.StructField("current", _UNITS),
    T.StructField("current_units", _UNITS),
    T.StructField("error", T.StringType()),
    T.StructField("reason", T.StringType()),
])
BODY_LIST = T.ArrayType(BODY)

HOURLY = T.StructType([
    T.StructField("location_name", T.StringType()),
    T.StructField("requested_latitude", T.DoubleType()),
    T.StructField("requested_longitude", T.DoubleType()),
    T.StructField("api_latitude", T.DoubleType()),
    T.StructField("api_longitude", T.DoubleType()),
    T.StructField("timestamp", T.TimestampNTZType()),
    T.StructField("temperature_2m", T.DoubleType()),
    T.StructField("precipitation", T.DoubleType()),
    T.StructField("relative_humidity_2m", T.DoubleType()),
    T.StructField("windspeed_10m", T.DoubleType()),
    T.StructField("wind_direction_10m", T.DoubleType()),
    T.StructField("cloud_cover", T.DoubleType()),
    T.StructField("weather_code", T.IntegerType()),
    T.StructField("source_api", T.StringType()),
    T.StructField("ingestion_timestamp_utc", T.TimestampNTZType()),
    T.StructField("run_id", T.StringType()),
])

DAILY = T.StructType([
    T.StructField("location_name", T.StringType()),
    T.StructField("requested_latitude", T.DoubleType()),
    T.StructField("requested_longitude", T.DoubleType()),
    T.StructField("api_latitude", T.DoubleType()),
    T.StructField("api_longitude", T.DoubleType()),
    T.StructField("date", T.TimestampNTZType()),
    T.StructField("temperature_2m_max", T.DoubleType()),
    T.StructField("temperature_2m_min", T.DoubleType()),
    T.StructField("precipitation_sum", T.DoubleType()),
    T.StructField("source_api", T.StringType()),
    T.StructField("ingestion_timestamp_utc", T.TimestampNTZType()),
    T.StructField("run_id", T.StringType()),
])

INTERVAL_SCHEMA = {"hourly": HOURLY, "daily": DAILY}
INTERVALS = ("hourly", "daily")

STATE = T.StructType([
    T.StructField("provider", T.StringType()),
    T.StructField("interval", T.StringType()),
    T.StructField("location_name", T.StringType()),
    T.StructField("last_fetch_timestamp", T.TimestampType()),
    T.StructField("last_fetch_status", T.StringType()),
    T.StructField("last_fetch_error", T.StringType()),
    T.StructField("records_fetched", T.IntegerType()),
    T.StructField("forecast_end_date", T.StringType()),
])
STATE_KEY = ["provider", "interval", "location_name"]
STATE_STATUSES = ("success", "failure", "partial")

FAILED = T.StructType([
    T.StructField("location", LOCATION),
    T.StructField("error", T.StringType()),
    T.StructField("status", T.StringType()),
])

WRITE_REPORT = T.StructType([
    T.StructField("path", T.StringType()),
    T.StructField("records_written", T.LongType()),
    T.StructField("format", T.StringType()),
])

RUN_REPORT = T.StructType([
    T.StructField("success", T.BooleanType()),
    T.StructField("run_id", T.StringType()),
    T.StructField("run_start", T.TimestampType()),
    T.StructField("run_end", T.TimestampType()),
    T.StructField("records_processed", T.LongType()),
    T.StructField("files", T.ArrayType(WRITE_REPORT)),
    T.StructField("failed", T.ArrayType(FAILED)),
    T.StructField("error", T.StringType()),
])


def require_interval(interval: str) -> str:
    """Domain check for the interval argument (hourly | daily)."""
    if interval not in INTERVALS:
        raise ValueError(f"interval must be one of {INTERVALS}, got {interval!r}")
    return interval
