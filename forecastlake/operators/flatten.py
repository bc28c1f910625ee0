"""Flatten parallel-array series blocks into typed rows.

A block is ``map<string, array<string>>``: ``time`` plus one array per
variable, all indexed together. ``posexplode`` over ``time`` yields the index,
and every variable is read with ``get(array, index)``, which is NULL past the
end, so absent or short arrays become NULL cells (flagged for validation).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forecastlake.functions.scalars import (
    size_or_null,
    as_double,
    as_int_strict,
    iso_format,
    parse_date,
    parse_time,
)
from forecastlake.operators.parse import METADATA_KEYS
from forecastlake.schemas import INTERVAL_SCHEMA, require_interval

# Output column -> accepted source spellings (older name first).
HOURLY_VARIABLES = {
    "temperature_2m": ("temperature_2m",),
    "precipitation": ("precipitation",),
    "relative_humidity_2m": ("relative_humidity_2m",),
    "windspeed_10m": ("windspeed_10m", "wind_speed_10m"),
    "wind_direction_10m": ("wind_direction_10m",),
    "cloud_cover": ("cloudcover", "cloud_cover"),
    "weather_code": ("weathercode", "weather_code"),
}
DAILY_VARIABLES = {
    "temperature_2m_max": ("temperature_2m_max",),
    "temperature_2m_min": ("temperature_2m_min",),
    "precipitation_sum": ("precipitation_sum",),
}
INTEGER_VARIABLES = frozenset({"weather_code"})
# Source name written to every row, and the interval's time column.
SOURCE_API = "open-meteo"
TIME_COLUMN = {"hourly": "timestamp", "daily": "date"}
ERRORS = "_errors"


def _block(interval: str) -> Column:
    return F.col("doc").getField(interval)


def _arr(spelling: str) -> str:
    return f"_arr_{spelling}"


def _cell_at(spellings: tuple[str, ...], i: Column) -> Column:
    cells = [F.get(F.col(_arr(s)), i) for s in spellings]
    return cells[0] if len(cells) == 1 else F.coalesce(*cells)


def _cells(variables: dict) -> Column:
    """Per-index structs built in one pass over ``time``.

    Exploding this array gives each row only its own cells; exploding
    ``time`` and reading the document per row would copy the whole document
    into every row (quadratic in the response length). The variable arrays
    are looked up in the block once per response (``_arr_*`` columns).
    """
    def build(t: Column, i: Column) -> Column:
        fields = [i.alias("_pos"), t.alias("_time_text")]
        short = []
        for out, spellings in variables.items():
            fields.append(_cell_at(spellings, i).alias(f"_text_{out}"))
            short += [F.when(F.col(f"_size_{s}") <= i, F.lit(f"short_array:{s}")) for s in spellings]
        fields.append(F.array_compact(F.array(*short)).alias("_short"))
        return F.struct(*fields)

    return F.transform(F.col("_time_arr"), build)


def _series_arrays(ok: DataFrame, interval: str, variables: dict, *columns) -> DataFrame:
    """``columns`` and the block's arrays with their sizes, looked up once per response."""
    block = _block(interval)
    spellings = [s for sp in variables.values() for s in sp]
    arrays = ok.select(*columns, block["time"].alias("_time_arr"), *[block[s].alias(_arr(s)) for s in spellings])
    return arrays.select("*", *[size_or_null(_arr(s)).alias(f"_size_{s}") for s in spellings])


def _variables(interval: str) -> dict:
    return HOURLY_VARIABLES if require_interval(interval) == "hourly" else DAILY_VARIABLES


def _typed(name: str, text: Column) -> Column:
    return as_int_strict(text) if name in INTEGER_VARIABLES else as_double(text)


def _cell_errors(variables: dict, get, ts: Column, typed: dict) -> Column:
    """Problems of one index; ``get`` gives a field of its struct."""
    checks = [F.when(get("_time_text").isNotNull() & ts.isNull(), F.lit("bad_time"))]
    for out in variables:
        bad = "bad_weather_code" if out in INTEGER_VARIABLES else f"bad_value:{out}"
        checks.append(F.when(get(f"_text_{out}").isNotNull() & typed[out].isNull(), F.lit(bad)))
    return F.concat(F.array_compact(F.array(*checks)), get("_short"))


def series_counts(parsed: DataFrame, interval: str, *, required: Column | None = None) -> DataFrame:
    """Each response with n_good, n_bad, n_times, first_time and last_time of its series, counted inside its row.

    The same rules as ``flatten_series`` and ``check_rows``, by higher-order functions over
    the arrays: no explode, no shuffle. Where ``required`` (the location's name) is null all
    points are bad. Without a series all counts are 0; times (n_times of them aren't null)
    are those of good points.
    """
    variables = _variables(interval)
    required = F.col("location.name") if required is None else required
    arrays = _series_arrays(parsed, interval, variables, *[F.col(c) for c in parsed.columns], required.alias("_required"))

    def judge(c: Column) -> Column:
        ts = parse_time(c["_time_text"])
        typed = {out: _typed(out, c[f"_text_{out}"]) for out in variables}
        return F.when(F.size(_cell_errors(variables, lambda f: c[f], ts, typed)) == 0, F.struct(ts.alias("t")))

    points = arrays.select("*", F.transform(_cells(variables), judge).alias("_points"))
    # A good point is a struct (its time may be null), a bad one is null.
    good = F.filter("_points", lambda p: p.isNotNull())
    good = F.when(F.col("_required").isNotNull(), good)
    counted = points.select(*parsed.columns, F.coalesce(F.size("_time_arr"), F.lit(0)).alias("_n"), good.alias("_good"))
    n_good = F.coalesce(size_or_null("_good"), F.lit(0))
    times = F.transform("_good", lambda p: p["t"])
    return counted.select(
        *parsed.columns, n_good.cast("long").alias("n_good"),
        (F.greatest(F.col("_n"), F.lit(0)) - n_good).cast("long").alias("n_bad"),
        F.coalesce(size_or_null(F.array_compact(times)), F.lit(0)).cast("long").alias("n_times"),
        F.array_min(times).alias("first_time"), F.array_max(times).alias("last_time"))


def flatten_series(ok: DataFrame, interval: str, *, run_id: Column | str | None = None,
                   with_errors: bool = True, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per ``time[i]`` of each usable response, in the interval's schema.

    Columns follow ``HOURLY``/``DAILY`` exactly; with ``with_errors`` an
    ``_errors array<string>`` column lists cell-level problems (see
    ``operators.validate.check_rows``). ``keep`` columns of the response come last.
    Narrow transformation: no shuffle.
    """
    variables = _variables(interval)
    rid = F.col("run_id") if run_id is None else (
        F.lit(run_id) if isinstance(run_id, str) else run_id)
    arrays = _series_arrays(
        ok, interval, variables,
        F.col("location.name").alias("location_name"),
        F.col("location.latitude").alias("requested_latitude"),
        F.col("location.longitude").alias("requested_longitude"),
        "api_latitude", "api_longitude", "ingestion_timestamp_utc",
        rid.alias("run_id"), *keep)
    base = arrays.select(
        "location_name", "requested_latitude", "requested_longitude", "api_latitude",
        "api_longitude", "ingestion_timestamp_utc", "run_id", *keep, F.inline(_cells(variables)),
    ).withColumn("_ts", parse_time("_time_text"))
    typed = {out: _typed(out, F.col(f"_text_{out}")) for out in variables}
    exprs = []
    for f in INTERVAL_SCHEMA[interval].fields:
        name = f.name
        if name == TIME_COLUMN[interval]:
            exprs.append(F.col("_ts").alias(name))
        elif name in typed:
            exprs.append(typed[name].alias(name))
        elif name == "source_api":
            exprs.append(F.lit(SOURCE_API).alias(name))
        else:
            exprs.append(F.col(name))
    if with_errors:
        exprs.append(_cell_errors(variables, F.col, F.col("_ts"), typed).alias(ERRORS))
    return base.select(*exprs, *keep)


def flatten_hourly(ok: DataFrame, **kw) -> DataFrame:
    """Hourly rows."""
    return flatten_series(ok, "hourly", **kw)


def flatten_daily(ok: DataFrame, **kw) -> DataFrame:
    """Daily rows."""
    return flatten_series(ok, "daily", **kw)


def discover_variables(ok: DataFrame, interval: str) -> DataFrame:
    """Distinct variable names in the interval's blocks (one column ``variable``).

    A full pass over the responses, aggregated before the shuffle; names come from
    the bodies, so nothing bounds them and they stay a table.
    """
    return (ok.select(F.explode(F.map_keys(_block(interval))).alias("variable"))
            .filter(F.col("variable") != "time").distinct())


def flatten_dynamic(ok: DataFrame, interval: str, variables: list[str]) -> DataFrame:
    """Prototype flatten (P4): every requested variable becomes a column.

    Missing location names fall back to ``"lat,lon"``; hourly time is ``time``
    (timestamp), daily time is ``date`` (date type); metadata columns carry the
    prototype names. ``discover_variables`` lists the names that bodies hold.
    """
    require_interval(interval)
    block = _block(interval)
    loc = F.col("location")
    name = F.coalesce(loc["name"], F.concat_ws(",", loc["latitude"].cast("string"),
                                               loc["longitude"].cast("string")))
    # Arrays are looked up in the block once per response, not once per cell.
    ok = ok.select("*", *[block[v].alias(_arr(v)) for v in variables])
    cells = F.transform(block["time"], lambda t, i: F.struct(
        t.alias("_time_text"), *[F.get(F.col(_arr(v)), i).alias(f"_text_{v}") for v in variables]))
    if interval == "hourly":
        first = [parse_time("_time_text").alias("time")]
        elapsed = F.col("elapsed_ms").alias("ingest_elapsed_ms")
    else:
        first = [parse_date("_time_text").alias("date")]
        elapsed = F.col("elapsed_ms").alias("request_elapsed_ms")
    exploded = ok.select(
        name.alias("location_name"),
        loc["latitude"].alias("requested_latitude"),
        loc["longitude"].alias("requested_longitude"),
        "api_latitude", "api_longitude", "api_elevation", "api_timezone",
        "api_generationtime_ms",
        iso_format("ingestion_timestamp_utc").alias("ingestion_timestamp_utc"),
        elapsed, "request_url", F.inline(cells))
    values = [as_double(F.col(f"_text_{v}")).alias(v) for v in variables]
    return exploded.select(
        *first, *values, "location_name", "requested_latitude", "requested_longitude",
        "api_latitude", "api_longitude", "api_elevation", "api_timezone",
        "api_generationtime_ms", "ingestion_timestamp_utc",
        "ingest_elapsed_ms" if interval == "hourly" else "request_elapsed_ms",
        "request_url",
    )


def flatten_current(ok: DataFrame, variables: list[str], keep: tuple[str, ...] = ()) -> DataFrame:
    """Point block (P13): one row per response with the ``current`` scalars."""
    cur = F.col("doc")["current"]
    return ok.select(
        F.col("location.name").alias("location_name"),
        "ingestion_timestamp_utc", *keep,
        parse_time(cur["time"]).alias("current_time"),
        as_int_strict(cur["interval"]).alias("current_interval_seconds"),
        *[as_double(cur[v]).alias(f"current_{v}") for v in variables],
    )


def variable_profile(ok: DataFrame, interval: str, key_cols: list[str]) -> DataFrame:
    """Per variable except ``time``: first value and unit, default 'N/A' (P14, J4)."""
    block = _block(interval)
    units = F.col("doc").getField(f"{interval}_units")
    firsts = F.map_filter(F.transform_values(block, lambda k, v: F.get(v, 0)),
                          lambda k, v: k != "time")
    return (ok.select(*key_cols, units.alias("_units"), F.explode(firsts).alias("variable", "_first"))
            .select(*key_cols, "variable", as_double(F.col("_first")).alias("first_value"),
                    F.coalesce(F.col("_units")[F.col("variable")], F.lit("N/A")).alias("unit")))


def payload_shape(parsed: DataFrame, interval: str, key_cols: list[str]) -> DataFrame:
    """Shape of each body (P15, P18): keys, variables, points, bytes, locations,
    present metadata keys."""
    block = _block(interval)
    top = F.json_object_keys("body")
    return parsed.select(
        *key_cols,
        F.array_join(F.sort_array(top), ",").alias("top_keys"),
        size_or_null(top).alias("n_top_keys"),
        F.array_join(F.sort_array(F.map_keys(block)), ",").alias("block_keys"),
        (size_or_null(F.map_keys(block)) - 1).alias("n_variables"),
        size_or_null(block["time"]).alias("n_points"),
        F.octet_length("body").alias("body_bytes"),
        F.col("n_docs").alias("n_locations"),
        present_keys_expr().alias("present_keys"),
    )


def present_keys_expr() -> Column:
    """Metadata keys present in the body, in metadata order, comma-joined."""
    wanted = F.array(*[F.lit(k) for k in METADATA_KEYS])
    return F.array_join(F.array_intersect(wanted, F.json_object_keys("body")), ",")


def present_keys(parsed: DataFrame, key_cols: list[str]) -> DataFrame:
    """Metadata keys present in each body."""
    return parsed.select(*key_cols, present_keys_expr().alias("present_keys"))


def leading_pairs(ok: DataFrame, interval: str, variable: str, k: int,
                  key_cols: list[str]) -> DataFrame:
    """First ``k`` (time, value) pairs of each response."""
    block = _block(interval)
    zipped = F.arrays_zip(F.coalesce(block["time"], F.array()).alias("t"),
                          F.coalesce(block[variable], F.array()).alias("v"))
    return (ok.select(*key_cols, F.posexplode(F.slice(zipped, 1, k)).alias("idx", "pair"))
            .select(*key_cols, "idx", F.col("pair.t").alias("time_text"),
                    as_double(F.col("pair.v")).alias("value")))


def forecast_end_expr() -> Column:
    """Last forecast time of a parsed document: daily wins whenever non-empty."""
    daily = F.col("doc")["daily"]
    hourly = F.col("doc")["hourly"]
    last_daily = F.get(daily["time"], size_or_null(daily["time"]) - 1)
    last_hourly = F.get(hourly["time"], size_or_null(hourly["time"]) - 1)
    return F.when(size_or_null(F.map_keys(daily)) > 0, last_daily).otherwise(last_hourly)


def forecast_end(ok: DataFrame, key_cols: list[str]) -> DataFrame:
    """Last forecast time of each response."""
    return ok.select(*key_cols, forecast_end_expr().alias("forecast_end_date"))


def coordinate_snap(df: DataFrame) -> DataFrame:
    """Distance between requested and returned coordinates."""
    return df.withColumns({
        "lat_snap": F.abs(F.col("requested_latitude") - F.col("api_latitude")),
        "lon_snap": F.abs(F.col("requested_longitude") - F.col("api_longitude")),
    })


def prefix_struct(df: DataFrame, struct_col: str, prefix: str) -> DataFrame:
    """Unnest a struct column with its fields renamed ``prefix + field``."""
    fields = df.schema[struct_col].dataType.fieldNames()
    keep = [c for c in df.columns if c != struct_col]
    return df.select(*keep, *[F.col(struct_col)[f].alias(prefix + f) for f in fields])
