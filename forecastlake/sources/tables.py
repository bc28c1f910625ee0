"""Forecast-shaped inputs derived from the driver's tables.

Roles on ``events(event_id, ts, user_id, event_type, value, props)``:
location = ``event_type``; time = ``ts``; temperature = ``value``;
precipitation = ``k / 10`` and cloud cover / weather code = ``k`` where ``k``
is ``props.$.k``; ingestion time = the day of ``ts``; run = that day.

Responses are packed per (location, day, ``event_id div 256``): every body
holds at most 256 points whatever the key skew, so no group, task or row
grows with the data. ``orders`` gives daily series (one body per priority and
year, at most 366 points); ``lineitem`` gives a daily lake frame with one
location per supplier.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forecastlake.operators.flatten import SOURCE_API

# Fixed values of the binding.
POINTS_PER_RESPONSE = 256
TS_TEXT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
ERROR_TYPE = "error"
PROVIDER = "open_meteo"


def _day(ts: Column) -> Column:
    """Midnight of a timestamp_ntz, computed without the session time zone."""
    return F.to_date(ts).cast("timestamp_ntz")


def _k(props: str = "props") -> Column:
    return F.get_json_object(F.col(props), "$.k").cast("int")


def event_latitude(t: Column) -> Column:
    return (F.ascii(t) - F.lit(100)) * F.lit(1.5) + F.length(t) * F.lit(0.25)


def event_longitude(t: Column) -> Column:
    return F.length(t) * F.lit(10.125) - F.lit(50.0)


def grid(c: Column) -> Column:
    """API grid snap of a coordinate: down to the 0.5 degree below."""
    return F.floor(c * F.lit(2.0)) / F.lit(2.0)


def event_locations(events: DataFrame) -> DataFrame:
    """Location dimension: one row per event type."""
    t = F.col("event_type")
    return events.select(t.alias("name")).distinct().select(
        "name", event_latitude(F.col("name")).alias("latitude"),
        event_longitude(F.col("name")).alias("longitude"))


def _time_suffix(t: Column) -> Column:
    return F.when(t == "click", F.lit("+00:00")).when(t == "signup", F.lit("Z")).otherwise(F.lit(""))


def _timezone(t: Column) -> Column:
    return F.when(t == "click", F.lit("UTC")).when(t == "view", F.lit(None)).otherwise(F.lit("Etc/UTC"))


def events_points(events: DataFrame) -> DataFrame:
    """Events with the response key columns (no shuffle)."""
    day = _day(F.col("ts"))
    return events.select(
        "event_id", "ts", "event_type", "value", "user_id", _k().alias("k"),
        day.alias("day"), F.floor(F.col("event_id") / POINTS_PER_RESPONSE).alias("chunk"))


def events_responses(events: DataFrame, *, bad_cells: bool = False,
                     include_locations_list: bool = False) -> DataFrame:
    """Landed hourly responses built from ``events`` (RESPONSE schema + key columns).

    ``error`` events become API error bodies. With ``bad_cells`` a value of 300
    or more is written as the text ``err`` and a ``k`` of 98 or more as a
    non-integral weather code, which validation must quarantine.
    """
    pts = events_points(events)
    g = pts.groupBy("event_type", "day", "chunk").agg(
        F.sort_array(F.collect_list(F.struct("ts", "event_id", "value", "k"))).alias("p"),
        F.count(F.lit(1)).alias("n"))
    t = F.col("event_type")
    p = F.col("p")
    times = F.transform(p, lambda x: F.concat(F.date_format(x["ts"], TS_TEXT), _time_suffix(t)))
    if bad_cells:
        temps = F.transform(p, lambda x: F.when(x["value"] >= 300, F.lit("err"))
                            .otherwise(x["value"].cast("string")))
        codes = F.transform(p, lambda x: F.when(x["k"] >= 98, x["k"] + F.lit(0.5))
                            .otherwise(x["k"].cast("double")))
    else:
        temps = F.transform(p, lambda x: x["value"])
        codes = F.transform(p, lambda x: x["k"])
    precip = F.transform(p, lambda x: x["k"] / F.lit(10.0))
    cover = F.transform(p, lambda x: x["k"])
    lat, lon = event_latitude(t), event_longitude(t)
    hourly = F.struct(
        times.alias("time"), temps.alias("temperature_2m"), precip.alias("precipitation"),
        F.when(t != "purchase", cover).alias("cloudcover"),
        F.when(t == "purchase", cover).alias("cloud_cover"),
        codes.alias("weathercode"))
    last = F.get(p, F.col("n") - 1)
    current = F.create_map(
        F.lit("time"), F.concat(F.date_format(last["ts"], TS_TEXT), _time_suffix(t)),
        F.lit("interval"), F.lit("900"),
        F.lit("temperature_2m"), last["value"].cast("string"))
    ok_body = F.to_json(F.struct(
        grid(lat).alias("latitude"), grid(lon).alias("longitude"),
        (F.length(t) * F.lit(3.0)).alias("elevation"),
        (F.col("n") * F.lit(0.25)).alias("generationtime_ms"),
        F.lit(0).alias("utc_offset_seconds"),
        _timezone(t).alias("timezone"),
        hourly.alias("hourly"),
        F.create_map(F.lit("temperature_2m"), F.lit("°C"),
                     F.lit("precipitation"), F.lit("mm")).alias("hourly_units"),
        current.alias("current")))
    err_body = F.to_json(F.struct(
        F.lit(True).alias("error"),
        F.concat(F.lit("rate limit exceeded after "), F.col("n").cast("string"),
                 F.lit(" points")).alias("reason")))
    cols = [
        F.struct(t.alias("name"), lat.alias("latitude"), lon.alias("longitude")).alias("location"),
        F.lit(PROVIDER).alias("provider"), F.lit("hourly").alias("interval"),
        F.lit(1).alias("attempt"),
        F.when(t == ERROR_TYPE, err_body).otherwise(ok_body).alias("body"),
        F.lit(None).cast("string").alias("transport_error"),
        F.lit(None).cast("string").alias("error_class"),
        F.col("day").alias("ingestion_timestamp_utc"),
        F.concat(F.lit("events://"), t, F.lit("/"), F.col("chunk").cast("string")).alias("request_url"),
        (F.col("n") * F.lit(1.5)).alias("elapsed_ms"),
        F.when(t == ERROR_TYPE, F.lit(400)).otherwise(F.lit(200)).alias("status_code"),
        F.concat(F.lit("run-"), F.date_format("day", "yyyyMMdd")).alias("run_id"),
        "chunk",
    ]
    return g.select(*cols)


def events_cycle_attempts(events: DataFrame) -> DataFrame:
    """``events`` as landed attempts of many fetch cycles (R1 in a run).

    One cycle per (location, day, chunk), fetched ``chunk`` seconds into the day. By
    chunk modulo 4: a timeout and then a body; a body at once; a timeout so far
    (pending); three timeouts (failed). ``signup`` has no location name.
    """
    t = F.col("location.name")
    loc = F.col("location")
    base = events_responses(events).withColumns({
        "run_id": F.concat_ws("-", "run_id", "chunk"),
        "ingestion_timestamp_utc": F.col("ingestion_timestamp_utc") + F.make_dt_interval(secs=F.col("chunk")),
        "location": F.when(t == "signup", F.struct(F.lit(None).cast("string").alias("name"), loc["latitude"].alias("latitude"),
                                                   loc["longitude"].alias("longitude"))).otherwise(loc)})
    kind = F.col("chunk") % 4
    n = F.when(kind == 0, 2).when(kind == 3, 3).otherwise(1)
    rows = base.withColumn("attempt", F.explode(F.sequence(F.lit(1), n)))
    lands = (kind == 1) | ((kind == 0) & (F.col("attempt") == 2))
    return rows.withColumns({
        "body": F.when(lands, F.col("body")),
        "transport_error": F.when(~lands, F.concat(F.lit("timeout "), F.col("attempt").cast("string"))),
        "error_class": F.when(~lands, F.lit("timeout"))}).drop("chunk")


def events_multi_location_responses(events: DataFrame) -> DataFrame:
    """One list body per (day, chunk) holding every location's object.

    The envelope's ``locations`` array is in the same order as the body list;
    locations whose fetch failed have an error object as their element.
    """
    single = events_responses(events)
    g = single.groupBy("ingestion_timestamp_utc", "chunk")
    packed = g.agg(F.sort_array(F.collect_list(F.struct(
        F.col("location.name").alias("_n"), "location", "body"))).alias("items"))
    return packed.select(
        F.get(F.col("items"), 0)["location"].alias("location"),
        F.transform("items", lambda x: x["location"]).alias("locations"),
        F.lit(PROVIDER).alias("provider"), F.lit("hourly").alias("interval"), F.lit(1).alias("attempt"),
        F.concat(F.lit("["), F.array_join(F.transform("items", lambda x: x["body"]), ","), F.lit("]")).alias("body"),
        F.lit(None).cast("string").alias("transport_error"),
        F.lit(None).cast("string").alias("error_class"),
        "ingestion_timestamp_utc",
        F.lit("events://multi").alias("request_url"), F.lit(1.0).alias("elapsed_ms"),
        F.lit(200).alias("status_code"),
        F.concat(F.lit("run-"), F.date_format("ingestion_timestamp_utc", "yyyyMMdd")).alias("run_id"),
        "chunk")


def orders_daily_responses(orders: DataFrame) -> DataFrame:
    """Daily responses from ``orders``: one body per (priority, year) (P2 input).

    Per (priority, day): max / min total price in thousands and the order
    count; pre-aggregated before packing, so the pack shuffle moves one row
    per location-day.
    """
    pri = F.col("o_orderpriority")
    per_day = orders.groupBy("o_orderpriority", "o_orderdate").agg(
        (F.max("o_totalprice") / F.lit(1000.0)).alias("tmax"),
        (F.min("o_totalprice") / F.lit(1000.0)).alias("tmin"),
        F.count(F.lit(1)).cast("double").alias("n"))
    year = F.year("o_orderdate")
    g = per_day.groupBy(pri, year.alias("yr")).agg(
        F.sort_array(F.collect_list(F.struct("o_orderdate", "tmax", "tmin", "n"))).alias("p"))
    lat = F.substring(pri, 1, 1).cast("double") * F.lit(10.0)
    lon = F.substring(pri, 1, 1).cast("double") * F.lit(-5.0)
    p = F.col("p")
    daily = F.struct(
        F.transform(p, lambda x: F.date_format(x["o_orderdate"], "yyyy-MM-dd")).alias("time"),
        F.transform(p, lambda x: x["tmax"]).alias("temperature_2m_max"),
        F.transform(p, lambda x: x["tmin"]).alias("temperature_2m_min"),
        F.transform(p, lambda x: x["n"]).alias("precipitation_sum"))
    body = F.to_json(F.struct(
        grid(lat).alias("latitude"), grid(lon).alias("longitude"), F.lit(11.0).alias("elevation"),
        F.lit(0.05).alias("generationtime_ms"), F.lit(0).alias("utc_offset_seconds"),
        F.lit("GMT").alias("timezone"), daily.alias("daily"),
        F.create_map(F.lit("temperature_2m_max"), F.lit("°C")).alias("daily_units")))
    ingest = F.make_timestamp_ntz(F.col("yr"), F.lit(1), F.lit(1), F.lit(0), F.lit(0), F.lit(0))
    return g.select(
        F.struct(pri.alias("name"), lat.alias("latitude"), lon.alias("longitude")).alias("location"),
        F.lit(PROVIDER).alias("provider"), F.lit("daily").alias("interval"), F.lit(1).alias("attempt"),
        body.alias("body"), F.lit(None).cast("string").alias("transport_error"),
        F.lit(None).cast("string").alias("error_class"),
        ingest.alias("ingestion_timestamp_utc"),
        F.concat(F.lit("orders://"), pri, F.lit("/"), F.col("yr").cast("string")).alias("request_url"),
        F.lit(2.0).alias("elapsed_ms"), F.lit(200).alias("status_code"),
        F.concat(F.lit("run-"), F.col("yr").cast("string")).alias("run_id"),
        F.col("yr").alias("chunk"))


def events_hourly_frame(events: DataFrame) -> DataFrame:
    """``events`` read directly as an hourly lake frame (HOURLY columns)."""
    t = F.col("event_type")
    k = _k()
    day = _day(F.col("ts"))
    lat, lon = event_latitude(t), event_longitude(t)
    return events.select(
        t.alias("location_name"), lat.alias("requested_latitude"), lon.alias("requested_longitude"),
        grid(lat).alias("api_latitude"), grid(lon).alias("api_longitude"),
        F.col("ts").alias("timestamp"), F.col("value").alias("temperature_2m"),
        (k / F.lit(10.0)).alias("precipitation"),
        F.lit(None).cast("double").alias("relative_humidity_2m"),
        F.lit(None).cast("double").alias("windspeed_10m"),
        F.lit(None).cast("double").alias("wind_direction_10m"),
        k.cast("double").alias("cloud_cover"), k.alias("weather_code"),
        F.lit(SOURCE_API).alias("source_api"), day.alias("ingestion_timestamp_utc"),
        F.concat(F.lit("run-"), F.date_format(day, "yyyyMMdd")).alias("run_id"),
        "event_id")


def lineitem_daily_frame(lineitem: DataFrame, *, by_flag: bool = False) -> DataFrame:
    """``lineitem`` read as a daily lake frame.

    One location per supplier with monthly ingestion; ``by_flag`` instead uses
    one location per return flag with yearly ingestion (a fixed set of
    locations whose partitions fill up as the table grows, as in a lake).
    """
    s = F.col("l_suppkey")
    lat = (s % 160).cast("double") - F.lit(80.0)
    lon = (s % 360).cast("double") - F.lit(180.0)
    if by_flag:
        name = F.concat(F.lit("F"), F.col("l_returnflag"))
        ingest = F.trunc(F.to_date("l_shipdate"), "year").cast("timestamp_ntz")
        run = F.concat(F.lit("run-"), F.date_format(ingest, "yyyy"))
    else:
        name = F.concat(F.lit("S"), s.cast("string"))
        ingest = F.trunc(F.to_date("l_shipdate"), "month").cast("timestamp_ntz")
        run = F.concat(F.lit("run-"), F.date_format(ingest, "yyyyMM"))
    return lineitem.select(
        name.alias("location_name"),
        lat.alias("requested_latitude"), lon.alias("requested_longitude"),
        grid(lat).alias("api_latitude"), grid(lon).alias("api_longitude"),
        F.col("l_shipdate").alias("date"),
        F.col("l_quantity").alias("temperature_2m_max"),
        F.col("l_linenumber").cast("double").alias("temperature_2m_min"),
        F.round(F.col("l_discount") * F.lit(100.0)).alias("precipitation_sum"),
        F.lit(SOURCE_API).alias("source_api"), ingest.alias("ingestion_timestamp_utc"),
        run.alias("run_id"), "l_orderkey", "l_linenumber")


def orders_forecasts(orders: DataFrame) -> DataFrame:
    """``orders`` as forecasts of one target from many fetches.

    Location = priority, target = order date, fetched up to nine days before it at an
    hour that the customer gives; each order is a run of its own.
    """
    target = F.col("o_orderdate").cast("timestamp_ntz")
    ahead = F.make_dt_interval(days=(F.col("o_orderkey") % 10).cast("int"), hours=(F.col("o_custkey") % 24).cast("int"))
    return orders.select(
        F.col("o_orderpriority").alias("location_name"), target.alias("date"),
        (F.col("o_totalprice") / F.lit(1000.0)).alias("temperature_2m_max"),
        (target - ahead).alias("ingestion_timestamp_utc"),
        F.concat(F.lit("run-"), F.lpad(F.col("o_orderkey").cast("string"), 12, "0")).alias("run_id"))


def events_attempt_log(events: DataFrame) -> DataFrame:
    """``events`` as a fetch-attempt log.

    Key = (user, day as a midnight timestamp); attempt = 1 + k mod 3; class by event type:
    click -> timeout (retryable), error -> http_error (not retryable),
    view -> connect (retryable), others -> success.
    """
    t = F.col("event_type")
    cls = (F.when(t == "click", F.lit("timeout")).when(t == "error", F.lit("http_error"))
           .when(t == "view", F.lit("connect")).otherwise(F.lit(None)))
    return events.select(
        F.concat(F.lit("user-"), F.col("user_id").cast("string")).alias("location_name"),
        _day(F.col("ts")).alias("request_date"),
        (F.lit(1) + _k() % 3).alias("attempt"),
        cls.alias("error_class"), "event_id", "ts")


def events_outcomes(events: DataFrame) -> DataFrame:
    """``events`` as fetch outcomes per user location (input of the state upsert).

    success unless the type is ``error``; records = floor(value); the end
    date is the day seven days after ``ts``, except ``view`` which reports
    an empty end date; ``ord`` = (ts, event_id).
    """
    from forecastlake.operators.state import outcomes

    t = F.col("event_type")
    end = F.when(t == "view", F.lit("")).otherwise(
        F.date_format(F.date_add(F.to_date("ts"), 7), "yyyy-MM-dd"))
    return outcomes(
        events,
        provider=F.lit(PROVIDER), interval=F.lit("hourly"),
        location_name=F.concat(F.lit("user-"), F.col("user_id").cast("string")),
        success=t != ERROR_TYPE,
        error=F.concat(F.lit("API Error: failure "), F.col("event_id").cast("string")),
        records=F.floor("value").cast("int"), forecast_end_date=end,
        at=F.col("ts"), order=F.struct("ts", "event_id"))
