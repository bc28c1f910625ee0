"""Scalar column expressions.

Each returns a ``Column`` built only from ``pyspark.sql.functions`` so that it
stays inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str

# Formats of the lake layout and of ISO strings.
TS_FORMAT_MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
TS_FORMAT_SECONDS = "yyyy-MM-dd'T'HH:mm:ss"
# A trailing UTC offset (Z, +02:00, +0200, -05:30) after a time of day.
OFFSET_PATTERN = r"(T[0-9:.]+)(Z|[+-][0-9]{2}:?[0-9]{2})$"
# JSON texts that Python treats as false when read from an "error" field.
FALSY_TEXTS = ("", "false", "0", "0.0", "-0", "-0.0", "[]", "{}", "null")


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def duck_round(c: ColumnOrName, n: int) -> Column:
    """ROUND(x, n) with DuckDB's double semantics: scale, round half away, unscale.

    Spark's ``round(x, n)`` rounds the exact decimal expansion of the double,
    which differs from DuckDB on values such as 2.675; the scaled form matches.
    """
    scale = float(10 ** n)
    return F.round(_col(c) * F.lit(scale), 0) / F.lit(scale)


def strip_offset(c: ColumnOrName) -> Column:
    """Drop a trailing UTC offset and keep the wall clock (no conversion)."""
    return F.regexp_replace(_col(c), OFFSET_PATTERN, "$1")


def parse_time(c: ColumnOrName) -> Column:
    """ISO-8601 text -> timestamp_ntz; offsets are dropped; bad text -> NULL."""
    return strip_offset(c).try_cast("timestamp_ntz")


def parse_date(c: ColumnOrName) -> Column:
    """ISO-8601 date text -> date; bad text -> NULL."""
    return strip_offset(c).try_cast("date")


def normalise_tz(c: ColumnOrName) -> Column:
    """Absent time zone -> 'GMT'; every 'UTC' substring -> 'GMT'."""
    return F.replace(F.coalesce(_col(c), F.lit("GMT")), F.lit("UTC"), F.lit("GMT"))


def as_double(c: ColumnOrName) -> Column:
    """Numeric text (or number rendered as text) -> double; anything else NULL."""
    return _col(c).try_cast("double")


def as_int_strict(c: ColumnOrName) -> Column:
    """Integral numeric text -> int ('61' and '61.0' accepted, '61.5' -> NULL)."""
    d = as_double(c)
    return F.when(d == F.floor(d), d.try_cast("int"))


def is_truthy_text(c: ColumnOrName) -> Column:
    """Truthiness of a JSON value that was read as text."""
    v = F.lower(F.trim(_col(c)))
    return v.isNotNull() & ~v.isin(*FALSY_TEXTS)


def iso_format(c: ColumnOrName) -> Column:
    """Timestamp -> ISO text; the fraction is omitted when it is zero."""
    ts = _col(c)
    whole = F.date_format(ts, TS_FORMAT_SECONDS)
    return F.when(ts.isNull(), F.lit(None)).when(
        F.date_format(ts, "SSSSSS") == "000000", whole
    ).otherwise(F.date_format(ts, TS_FORMAT_MICROS))


def hours_between(later: ColumnOrName, earlier: ColumnOrName) -> Column:
    """Elapsed hours as a double (microsecond precision)."""
    return F.timestamp_diff("MICROSECOND", _col(earlier), _col(later)) / F.lit(3.6e9)


def backoff_seconds(factor: float, attempt: ColumnOrName, max_attempts: int) -> Column:
    """Wait after a failed attempt (1-based): factor^(attempt-1); none after the last."""
    a = _col(attempt)
    return F.when(a < F.lit(max_attempts), F.pow(F.lit(float(factor)), a - F.lit(1)))


def partition_path(provider: ColumnOrName, location_name: ColumnOrName,
                   interval: ColumnOrName, run_id: ColumnOrName,
                   ingestion_ts: ColumnOrName) -> Column:
    """Report path of one location's file in one run.

    ``{provider}/{interval}/{location}/{YYYY}/{MM}/{DD}/forecast_{YYYYMMDD}.parquet``
    for daily runs (one canonical file per day) and
    ``…/forecast_{YYYYMMDD}_{HH}h_{run}.parquet`` for hourly runs.
    """
    ts = _col(ingestion_ts)
    ymd = F.date_format(ts, "yyyyMMdd")
    daily_name = F.concat(F.lit("forecast_"), ymd, F.lit(".parquet"))
    hourly_name = F.concat(F.lit("forecast_"), ymd, F.lit("_"), F.date_format(ts, "HH"),
                           F.lit("h_"), _col(run_id), F.lit(".parquet"))
    name = F.when(_col(interval) == "daily", daily_name).otherwise(hourly_name)
    return F.concat_ws("/", _col(provider), _col(interval), _col(location_name),
                       F.date_format(ts, "yyyy"), F.date_format(ts, "MM"),
                       F.date_format(ts, "dd"), name)


def prototype_partition_path(interval: ColumnOrName, location_name: ColumnOrName,
                             ingestion_ts: ColumnOrName) -> Column:
    """Prototype layout ``{interval}/location={name}/{YYYY-MM-DD}``."""
    return F.concat(_col(interval), F.lit("/location="), _col(location_name), F.lit("/"),
                    F.date_format(_col(ingestion_ts), "yyyy-MM-dd"))


def size_or_null(c: ColumnOrName) -> Column:
    """Array length, NULL for a NULL array whatever ``spark.sql.legacy.sizeOfNull`` says."""
    a = _col(c)
    return F.when(a.isNotNull(), F.size(a))
