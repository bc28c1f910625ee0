"""Parse raw responses once and classify them as usable or failed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forecastlake.functions.scalars import (
    as_double,
    as_int_strict,
    is_truthy_text,
    iso_format,
    normalise_tz,
    size_or_null,
)
from forecastlake.schemas import BODY_LIST

# The API metadata fields a usable body must carry, in body order.
METADATA_KEYS = ("latitude", "longitude", "elevation", "generationtime_ms",
                 "utc_offset_seconds", "timezone", "timezone_abbreviation")
# Failure texts.
ERR_EMPTY_BODY = "Empty response body"
ERR_INVALID_JSON = "Invalid JSON body"
ERR_LIST_BODY = "'list' object has no attribute 'get'"
ERR_EMPTY_LIST = "Empty list body"
ERR_NO_LOCATION = "No location for list element"
ERR_MISSING_OFFSET = "'utc_offset_seconds'"
ERR_BAD_METADATA = "Invalid API metadata: "
ERR_MISSING_BLOCK = "Missing block: "


def _api_columns(doc: Column) -> dict[str, Column]:
    return {
        "api_latitude": as_double(doc["latitude"]),
        "api_longitude": as_double(doc["longitude"]),
        "api_elevation": as_double(doc["elevation"]),
        "api_generationtime_ms": as_double(doc["generationtime_ms"]),
        "api_timezone": normalise_tz(doc["timezone"]),
        "api_utc_offset_seconds": as_int_strict(doc["utc_offset_seconds"]),
    }


def parse_responses(responses: DataFrame, *, multi_location: bool = False,
                    locations_col: str = "locations") -> DataFrame:
    """Parse ``body`` once and attach ``doc``, typed API metadata and ``error``.

    Single-location mode (the default) treats a list body as a failure, like a
    client that expects an object. ``multi_location=True`` explodes a list body
    into one row per element and pairs element *i* with ``locations[i]`` when the
    envelope carries a ``locations`` array (else with ``location``); an element past
    that array's end fails, since nothing says which location it is.
    ``error`` is NULL for usable rows and the failure text otherwise.
    """
    docs = F.from_json(F.col("body"), BODY_LIST)
    is_list = F.col("body").rlike(r"^\s*\[")
    # Parse behind a generator: the optimizer never inlines a generated column
    # into later filters, so each body is parsed exactly once even though the
    # usable and failed branches both test the parsed document.
    df = (responses.select("*", F.inline_outer(F.array(F.struct(docs.alias("_docs")))))
          .withColumn("n_docs", size_or_null("_docs")))
    if multi_location:
        df = df.select("*", F.posexplode_outer("_docs").alias("doc_index", "doc"))
        unknown = F.lit(False)
        if locations_col in responses.columns:
            listed = F.col(locations_col).isNotNull()
            unknown = listed & (F.col("doc_index") >= F.size(locations_col))
            df = df.withColumn("location", F.when(unknown, F.lit(None)).when(
                listed, F.get(F.col(locations_col), F.col("doc_index"))).otherwise(F.col("location")))
        list_body = F.lit(False)
    else:
        unknown = F.lit(False)
        df = df.withColumn("doc_index", F.lit(0)).withColumn("doc", F.get("_docs", 0))
        list_body = is_list
    doc = F.col("doc")
    df = df.withColumns(_api_columns(doc))

    missing = F.array_compact(F.array(*[
        F.when(F.col(c).isNull(), F.lit(k)) for c, k in (
            ("api_latitude", "latitude"), ("api_longitude", "longitude"),
            ("api_elevation", "elevation"), ("api_generationtime_ms", "generationtime_ms"),
            ("api_utc_offset_seconds", "utc_offset_seconds"))
    ]))
    block = doc.getField("hourly")
    block = F.when(F.col("interval") == "daily", doc.getField("daily")).otherwise(block)
    error = (
        F.when(F.col("transport_error").isNotNull(), F.col("transport_error"))
        .when(F.col("body").isNull(), F.lit(ERR_EMPTY_BODY))
        .when(F.col("_docs").isNull(), F.lit(ERR_INVALID_JSON))
        .when(list_body, F.lit(ERR_LIST_BODY))
        .when((F.col("n_docs") == 0) & is_list, F.lit(ERR_EMPTY_LIST))
        .when(F.col("n_docs") == 0, F.lit(ERR_INVALID_JSON))
        .when(unknown, F.lit(ERR_NO_LOCATION))
        .when(is_truthy_text(doc["error"]),
              F.concat(F.lit("API Error: "), F.coalesce(doc["reason"], F.lit("None"))))
        .when(doc["utc_offset_seconds"].isNull(), F.lit(ERR_MISSING_OFFSET))
        .when(F.size(missing) > 0, F.concat(F.lit(ERR_BAD_METADATA), F.array_join(missing, ",")))
        .when(block.isNull() | block["time"].isNull(),
              F.concat(F.lit(ERR_MISSING_BLOCK), F.col("interval")))
    )
    return df.withColumn("error", error).drop("_docs")


def split_ok_failed(parsed: DataFrame, keep: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame]:
    """Two filters over one parsed frame: (usable rows, failed rows).

    The failed side has the FAILED columns (location, error, status='failed')
    plus the envelope keys needed for state updates and reports.
    """
    ok = parsed.filter(F.col("error").isNull())
    failed = parsed.filter(F.col("error").isNotNull()).select(
        "location", "error", F.lit("failed").alias("status"),
        "provider", "interval", "attempt", "error_class",
        "ingestion_timestamp_utc", "run_id", *keep,
    )
    return ok, failed


def api_metadata(parsed: DataFrame) -> DataFrame:
    """API metadata projection, one row per usable response."""
    return parsed.select(
        F.col("location.name").alias("location_name"),
        "api_latitude", "api_longitude", "api_elevation", "api_generationtime_ms",
        "api_timezone", "api_utc_offset_seconds",
    )


def ingestion_metadata(parsed: DataFrame) -> DataFrame:
    """Client-side metadata projection (P9): time, URL, elapsed ms, status, bytes."""
    return parsed.select(
        F.col("location.name").alias("location_name"),
        "ingestion_timestamp_utc", "request_url", "elapsed_ms", "status_code",
        F.octet_length("body").alias("response_size_bytes"),
    )


def metadata_record(parsed: DataFrame, run_id: Column | str | None = None,
                    keep: tuple[str, ...] = ()) -> DataFrame:
    """Combined per-ingestion metadata record (P10)."""
    rid = F.col("run_id") if run_id is None else (
        F.lit(run_id) if isinstance(run_id, str) else run_id)
    return parsed.select(
        F.col("location.name").alias("location_name"), *keep,
        rid.alias("run_id"),
        iso_format("ingestion_timestamp_utc").alias("ingestion_timestamp"),
        "request_url", "elapsed_ms", "status_code",
        F.col("api_generationtime_ms").alias("api_generation_time_ms"),
        "api_latitude", "api_longitude", "api_elevation", "api_timezone",
        "api_utc_offset_seconds",
    )
