"""Column-level helpers (all JVM-side expressions; no Python UDFs)."""

from forecastlake.functions.scalars import (  # noqa: F401
    as_double,
    as_int_strict,
    backoff_seconds,
    duck_round,
    hours_between,
    iso_format,
    is_truthy_text,
    normalise_tz,
    parse_date,
    parse_time,
    partition_path,
    prototype_partition_path,
    size_or_null,
    strip_offset,
)
