"""Registered queries: every operator bound to the driver's tables.

Each builder takes ``(spark, sf_dir)`` and returns a DataFrame over the whole
tables (no id subsets, no row caps; ``limit`` only where top-k is the
feature). Builders that exercise sinks write to a fresh folder under the
shared checkpoint root and return the read-back.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from forecastlake.operators import dynamic as dy
from forecastlake.operators import flatten as fl
from forecastlake.operators import forecast as fc
from forecastlake.operators import quality as q
from forecastlake.operators import rollup as ro
from forecastlake.operators import state as st
from forecastlake.operators.parse import ingestion_metadata, metadata_record, parse_responses, split_ok_failed
from forecastlake.operators.validate import check_rows
from forecastlake.functions.scalars import size_or_null
from forecastlake.plans.run import run_batch
from forecastlake.session import scratch_path, table_path
from forecastlake.sinks.bodies import small_files, write_bodies
from forecastlake.sinks.lake import infer_interval, write_forecasts, write_single
from forecastlake.sinks.reports import prototype_paths, report_totals, write_report
from forecastlake.sources import tables as tb
from forecastlake.sources.lake import lake_path_columns, read_lake, read_lake_end
from forecastlake.sources.responses import attach_locations, read_bodies, read_locations, read_responses, request_manifest
from forecastlake.sources.state_store import empty_state, read_state, save_state, update_buckets
from forecastlake.streaming.incremental import run_available_now

PROVIDER = tb.PROVIDER
KEYS = ["location_name", "ingestion_timestamp_utc", "chunk"]
AS_OF = "2024-01-30 12:00:00"
SPLIT_AT = "2024-01-15 00:00:00"


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def _ok_hourly(spark, sf_dir, **kw) -> DataFrame:
    parsed = parse_responses(tb.events_responses(_t(spark, sf_dir, "events"), **kw))
    ok, _ = split_ok_failed(parsed)
    return ok


def _keyed(ok: DataFrame) -> DataFrame:
    return ok.withColumn("location_name", F.col("location.name"))


def _ts_lit(text: str) -> Column:
    # Wall-clock text -> session-zone instant, the same way NTZ event times are cast.
    return F.lit(text).cast("timestamp_ntz").cast("timestamp")


# ---- flattening ---------------------------------------------------------

def q_flatten_hourly(spark, sf_dir):
    good, _ = check_rows(fl.flatten_hourly(_ok_hourly(spark, sf_dir)))
    return good


def q_flatten_daily(spark, sf_dir):
    parsed = parse_responses(tb.orders_daily_responses(_t(spark, sf_dir, "orders")))
    ok, _ = split_ok_failed(parsed)
    good, _ = check_rows(fl.flatten_daily(ok))
    return good


def q_flatten_dynamic(spark, sf_dir):
    resp = tb.events_responses(_t(spark, sf_dir, "events"))
    loc = F.col("location")
    resp = resp.withColumn("location", F.when(
        loc["name"] == "view",
        F.struct(F.lit(None).cast("string").alias("name"), loc["latitude"].alias("latitude"),
                 loc["longitude"].alias("longitude"))).otherwise(loc))
    ok, _ = split_ok_failed(parse_responses(resp))
    return fl.flatten_dynamic(ok, "hourly", ["cloud_cover", "cloudcover", "precipitation", "temperature_2m", "weathercode"])


def _staged_variants(spark, sf_dir):
    resp = tb.events_responses(_t(spark, sf_dir, "events"))
    loc = F.col("location")
    resp = resp.withColumn("location", F.when(
        loc["name"] == "view",
        F.struct(F.lit(None).cast("string").alias("name"), loc["latitude"].alias("latitude"),
                 loc["longitude"].alias("longitude"))).otherwise(loc))
    return dy.stage_variants(resp, scratch_path(spark, "variants"))


def q_flatten_discovered(spark, sf_dir):
    """P4 without a declared list: variables and types come from the bodies."""
    return dy.flatten_discovered(_staged_variants(spark, sf_dir), "hourly")


def q_body_keys(spark, sf_dir):
    """P15, P18 from the variants: top-level keys of all bodies and what they hold."""
    return dy.top_level_shape(_staged_variants(spark, sf_dir))


def q_raw_bodies(spark, sf_dir):
    """Every document's text landed as a file of its own comes back whole, with its size and path."""
    docs = _t(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("body"))
    digests = scratch_path(spark, "body-digests")
    with small_files(spark):
        for folder in write_bodies(docs, scratch_path(spark, "bodies"), key="doc_id"):
            read_bodies(spark, folder, glob="*.txt").select(
                F.regexp_extract("path", "/doc_id=([0-9]+)[./]", 1).cast("long").alias("doc_id"),
                "body_bytes", F.md5(F.col("body").cast("binary")).alias("body_md5")).write.mode("append").parquet(digests)
    return spark.read.schema("doc_id long, body_bytes long, body_md5 string").parquet(digests)


def q_discover_variables(spark, sf_dir):
    ok = _ok_hourly(spark, sf_dir)
    return fl.discover_variables(ok, "hourly")


def q_location_file(spark, sf_dir):
    """The location dimension from a file, in either format."""
    locations = tb.event_locations(_t(spark, sf_dir, "events"))
    out = None
    for fmt in ("json", "csv"):
        path = scratch_path(spark, f"locations-{fmt}")
        locations.write.format(fmt).option("header", "true").save(path)
        rows = read_locations(spark, path, fmt=fmt).withColumn("format", F.lit(fmt))
        out = rows if out is None else out.unionByName(rows)
    return out


def q_multi_location_body(spark, sf_dir):
    resp = tb.events_multi_location_responses(_t(spark, sf_dir, "events"))
    ok, _ = split_ok_failed(parse_responses(resp, multi_location=True))
    good, _ = check_rows(fl.flatten_hourly(ok))
    return good


def q_flatten_dynamic_daily(spark, sf_dir):
    ok, _ = split_ok_failed(parse_responses(tb.orders_daily_responses(_t(spark, sf_dir, "orders"))))
    rows = fl.flatten_dynamic(ok, "daily", ["temperature_2m_max", "temperature_2m_min", "precipitation_sum"])
    return rows.select(F.col("date").cast("timestamp_ntz").alias("date"), "temperature_2m_max", "temperature_2m_min",
                       "precipitation_sum", "location_name")


def q_payload_bytes(spark, sf_dir):
    """P15 bytes and F2 of bodies of known content: every document's text as a body."""
    docs = _t(spark, sf_dir, "documents").select(
        "doc_id", F.col("text").alias("body"), F.lit("hourly").alias("interval"), F.lit(None).cast("string").alias("transport_error"))
    shape = fl.payload_shape(parse_responses(docs), "hourly", ["doc_id", "error"])
    return shape.select("doc_id", "error", "body_bytes")


def q_list_bodies(spark, sf_dir):
    """Every order as a one-element, empty or plain body, in either mode."""
    k = F.col("o_orderkey") % 3
    empty = F.lit('  []')
    one = F.lit('{"error": true, "reason": "r"}')
    body = F.when(k == 0, empty).when(k == 1, F.concat(F.lit(" ["), one, F.lit("]"))).otherwise(one)
    rows = _t(spark, sf_dir, "orders").select(
        "o_orderkey", body.alias("body"), F.lit("hourly").alias("interval"), F.lit(None).cast("string").alias("transport_error"),
        F.struct(F.lit("X").alias("name")).alias("location"), F.array().cast("array<struct<name:string>>").alias("locations"))
    single = parse_responses(rows).select("o_orderkey", F.lit("single").alias("mode"), "error")
    multi = parse_responses(rows, multi_location=True).select("o_orderkey", F.lit("multi").alias("mode"), "error")
    return single.unionByName(multi)


def q_ingestion_metadata(spark, sf_dir):
    """P9 over every document's text as a body."""
    docs = _t(spark, sf_dir, "documents").select(
        F.struct(F.col("source").alias("name")).alias("location"), F.col("text").alias("body"),
        F.lit("hourly").alias("interval"), F.lit(None).cast("string").alias("transport_error"),
        F.lit(AS_OF).cast("timestamp_ntz").alias("ingestion_timestamp_utc"),
        F.concat(F.lit("docs://"), F.col("doc_id").cast("string")).alias("request_url"),
        F.col("n_chars").cast("double").alias("elapsed_ms"), F.lit(200).alias("status_code"))
    return ingestion_metadata(parse_responses(docs))


def q_row_validation(spark, sf_dir):
    _, bad = check_rows(fl.flatten_hourly(_ok_hourly(spark, sf_dir, bad_cells=True)))
    return bad.select("location_name", "timestamp", F.array_join("errors", ",").alias("errors"))


def q_current_block(spark, sf_dir):
    return fl.flatten_current(_ok_hourly(spark, sf_dir), ["temperature_2m"], keep=("chunk",))


def q_variable_profile(spark, sf_dir):
    return fl.variable_profile(_keyed(_ok_hourly(spark, sf_dir)), "hourly", KEYS)


def q_leading_pairs(spark, sf_dir):
    return fl.leading_pairs(_keyed(_ok_hourly(spark, sf_dir)), "hourly", "temperature_2m", 3, KEYS)


def q_forecast_end(spark, sf_dir):
    return fl.forecast_end(_keyed(_ok_hourly(spark, sf_dir)), KEYS)


def q_payload_shape(spark, sf_dir):
    parsed = _keyed(parse_responses(tb.events_responses(_t(spark, sf_dir, "events"))))
    # Body bytes depend on the JSON writer's formatting; ``payload_bytes`` checks them
    # on bodies that the tables hold.
    return fl.payload_shape(parsed, "hourly", KEYS).drop("body_bytes")


# ---- classification and metadata ----------------------------------------

def q_split_ok(spark, sf_dir):
    ok = _keyed(_ok_hourly(spark, sf_dir))
    return ok.select(*KEYS, "api_latitude", "api_longitude", "api_elevation",
                     "api_generationtime_ms", "api_timezone", "api_utc_offset_seconds",
                     size_or_null(F.col("doc")["hourly"]["time"]).alias("n_points"))


def q_split_failed(spark, sf_dir):
    parsed = parse_responses(tb.events_responses(_t(spark, sf_dir, "events")))
    _, failed = split_ok_failed(parsed, keep=("chunk",))
    return failed.select(F.col("location.name").alias("location_name"),
                         "ingestion_timestamp_utc", "chunk", "error", "status")


def q_metadata_record(spark, sf_dir):
    return metadata_record(_ok_hourly(spark, sf_dir), keep=("ingestion_timestamp_utc", "chunk"))


def q_coordinate_snap(spark, sf_dir):
    ok = _ok_hourly(spark, sf_dir)
    df = ok.select(*[F.col("location.name").alias("location_name"), "ingestion_timestamp_utc", "chunk",
                     F.col("location.latitude").alias("requested_latitude"),
                     F.col("location.longitude").alias("requested_longitude"),
                     "api_latitude", "api_longitude"])
    return fl.coordinate_snap(df)


def q_attach_location(spark, sf_dir):
    events = _t(spark, sf_dir, "events")
    named = tb.events_responses(events).withColumn("location_name", F.col("location.name"))
    ok, _ = split_ok_failed(parse_responses(attach_locations(named, tb.event_locations(events))))
    return ok.select(F.col("location.name").alias("location_name"),
                     F.col("location.latitude").alias("requested_latitude"),
                     F.col("location.longitude").alias("requested_longitude"),
                     "ingestion_timestamp_utc", "chunk", "api_latitude", "api_longitude")


def q_request_manifest(spark, sf_dir):
    cust = _t(spark, sf_dir, "customer").select(
        F.col("c_name").alias("name"),
        (F.col("c_nationkey") * F.lit(3.5) - F.lit(40.0)).alias("latitude"),
        ((F.col("c_custkey") % 360).cast("double") - F.lit(180.0)).alias("longitude"))
    return request_manifest(cust, interval="hourly",
                            variables=["temperature_2m", "precipitation", "weather_code"])


def q_struct_prefix(spark, sf_dir):
    cust = _t(spark, sf_dir, "customer").select(
        F.struct("c_custkey", "c_name", "c_nationkey").alias("data"), "c_mktsegment")
    return fl.prefix_struct(cust, "data", "loc_")


# ---- quality queries ----------------------------------------------------

def _hourly(spark, sf_dir):
    return tb.events_hourly_frame(_t(spark, sf_dir, "events"))


def _daily(spark, sf_dir):
    return tb.lineitem_daily_frame(_t(spark, sf_dir, "lineitem"))


def q_completeness(spark, sf_dir):
    return q.completeness(_hourly(spark, sf_dir))


def q_completeness_daily(spark, sf_dir):
    return q.completeness(_daily(spark, sf_dir), date_col="date")


def q_ranges_hourly(spark, sf_dir):
    return q.ranges(_hourly(spark, sf_dir), "hourly")


def q_ranges_daily(spark, sf_dir):
    return q.ranges(_daily(spark, sf_dir), "daily")


def q_comparison_hourly(spark, sf_dir):
    return q.comparison(_hourly(spark, sf_dir), "hourly")


def q_comparison_daily(spark, sf_dir):
    return q.comparison(_daily(spark, sf_dir), "daily")


def q_ingestion_span(spark, sf_dir):
    return q.ingestion_span(_hourly(spark, sf_dir))


def q_rows_per_location(spark, sf_dir):
    return q.rows_per_location(_daily(spark, sf_dir))


def q_temp_range(spark, sf_dir):
    return q.temp_range(_daily(spark, sf_dir))


def q_duplicates(spark, sf_dir):
    return q.duplicates(_daily(spark, sf_dir), ["location_name", "date"])


def _rolled_lake(spark, sf_dir):
    """A daily lake of two runs, rolled up run by run; the rollup of what a read shows."""
    base = scratch_path(spark, "lake-rolled")
    for run in _two_daily_runs(spark, sf_dir):
        write_forecasts(run, base, interval="daily", provider=PROVIDER)
        ro.refresh_rollup(spark, base, interval="daily", provider=PROVIDER)
    return ro.current_rollup(spark, base, interval="daily", provider=PROVIDER)


def q_completeness_rollup(spark, sf_dir):
    """A1 over a lake of several runs, from its rollup only."""
    return ro.completeness_from_rollup(_rolled_lake(spark, sf_dir))


def q_ingestion_span_rollup(spark, sf_dir):
    """A4 over a lake of several runs, from its rollup only."""
    return ro.ingestion_span_from_rollup(_rolled_lake(spark, sf_dir))


def q_completeness_bitmaps(spark, sf_dir):
    """A1 of hourly rows whose times are off the grid: exact all the same."""
    return ro.completeness_from_rollup(ro.time_rollup(_hourly(spark, sf_dir), "hourly", ["location_name"]))


def q_duplicates_eliminated(spark, sf_dir):
    """A9 by candidate elimination: only rows of suspect groups are grouped by key."""
    return ro.duplicates_by_elimination(_daily(spark, sf_dir), "daily")


def _docs_labels(spark, sf_dir):
    return _t(spark, sf_dir, "documents").join(_t(spark, sf_dir, "labels"), "doc_id", "left")


def q_null_counts(spark, sf_dir):
    return q.null_counts(_docs_labels(spark, sf_dir))


def q_null_total(spark, sf_dir):
    return q.null_total(q.null_counts_long(_docs_labels(spark, sf_dir)))


def q_sample_rows(spark, sf_dir):
    return q.sample(_hourly(spark, sf_dir), "hourly",
                    tie_breakers=("ingestion_timestamp_utc", "run_id", "event_id"))


def q_location_summary(spark, sf_dir):
    return q.location_summary(_daily(spark, sf_dir), "daily")


def q_head_rows(spark, sf_dir):
    return q.head(_hourly(spark, sf_dir), ["timestamp", "event_id"], 1).select(
        "location_name", "timestamp", "temperature_2m", "event_id")


def q_tail_rows(spark, sf_dir):
    return q.tail(_hourly(spark, sf_dir), ["timestamp", "event_id"], 3).select(
        "location_name", "timestamp", "temperature_2m", "event_id")


def q_coordinates_distinct(spark, sf_dir):
    return q.coordinates(_hourly(spark, sf_dir))


def q_distinct_pairs(spark, sf_dir):
    return q.distinct_pairs(_hourly(spark, sf_dir), ["location_name", "run_id"])


def q_sql_ranges_hourly(spark, sf_dir):
    """The hourly ranges check written as SQL over an ``hourly`` view."""
    from forecastlake.plans.sql import register_frames

    register_frames(spark, hourly=_hourly(spark, sf_dir))
    return spark.sql("""
        SELECT location_name,
               duck_round(MIN(temperature_2m), 1) AS min_temp,
               duck_round(MAX(temperature_2m), 1) AS max_temp,
               duck_round(AVG(temperature_2m), 1) AS avg_temp,
               duck_round(MAX(precipitation), 2) AS max_precip_mm,
               COUNT(CASE WHEN temperature_2m IS NULL THEN 1 END) AS null_count
        FROM hourly
        GROUP BY location_name
        ORDER BY avg_temp DESC NULLS LAST""")


def q_ranges_from_responses(spark, sf_dir):
    """Flagship: landed responses -> parse -> flatten -> validate -> ranges."""
    good, _ = check_rows(fl.flatten_hourly(_ok_hourly(spark, sf_dir)))
    return q.ranges(good, "hourly")


def _forecasts(spark, sf_dir):
    return tb.orders_forecasts(_t(spark, sf_dir, "orders"))


def q_latest_forecast(spark, sf_dir):
    """The latest forecast of each location and target time."""
    return fc.latest_forecast(_forecasts(spark, sf_dir), "daily")


def q_forecast_as_of(spark, sf_dir):
    """What the forecasts said at the start of 1995."""
    return fc.latest_forecast(_forecasts(spark, sf_dir), "daily", as_of=F.lit("1995-01-01 00:00:00").cast("timestamp_ntz"))


def q_lead_time_accuracy(spark, sf_dir):
    """How far forecasts were off, by days ahead."""
    return fc.lead_time_accuracy(_forecasts(spark, sf_dir), "daily", "temperature_2m_max")


# ---- layout, sinks and reports ------------------------------------------

def q_partition_paths(spark, sf_dir):
    from forecastlake.functions.scalars import partition_path

    g = _hourly(spark, sf_dir).groupBy("location_name", "run_id").agg(
        F.min("ingestion_timestamp_utc").alias("first_ingest"))
    return g.select("location_name", "run_id", partition_path(
        F.lit(PROVIDER), "location_name", F.lit("hourly"), "run_id", "first_ingest").alias("path"))


def q_prototype_paths(spark, sf_dir):
    return prototype_paths(_hourly(spark, sf_dir), "hourly")


def _two_hourly_runs(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    h = _hourly(spark, sf_dir).drop("event_id")
    day = F.date_format("ingestion_timestamp_utc", "yyyyMMdd")
    am = F.hour("timestamp") < 12
    run = h.withColumns({
        "run_id": F.concat(F.lit("run-"), day, F.when(am, F.lit("-am")).otherwise(F.lit("-pm"))),
        "ingestion_timestamp_utc": F.when(am, F.col("ingestion_timestamp_utc")).otherwise(
            F.col("ingestion_timestamp_utc") + F.expr("INTERVAL 12 HOURS")),
    })
    return run.filter(am), run.filter(~am)


def _write_hourly(spark, sf_dir, layout):
    base = scratch_path(spark, "lake-hourly")
    for run in _two_hourly_runs(spark, sf_dir):
        write_forecasts(run, base, interval="hourly", provider=PROVIDER, layout=layout)
    return read_lake(spark, base, "hourly", provider=PROVIDER)


def q_partitioned_write_hourly(spark, sf_dir):
    return _write_hourly(spark, sf_dir, "by_date")


def q_partitioned_write_hourly_by_location(spark, sf_dir):
    return _write_hourly(spark, sf_dir, "by_location")


def _daily_runs(spark, sf_dir) -> tuple[DataFrame, Column]:
    """Daily rows of two runs, told apart by an expression (one scan)."""
    d = tb.lineitem_daily_frame(_t(spark, sf_dir, "lineitem"), by_flag=True).drop(
        "l_orderkey", "l_linenumber")
    month = F.date_format("ingestion_timestamp_utc", "yyyy")
    early = F.dayofmonth("date") <= 15
    run = d.withColumns({
        "run_id": F.concat(F.lit("run-"), month, F.when(early, F.lit("-early")).otherwise(F.lit("-late"))),
        "ingestion_timestamp_utc": F.when(early, F.col("ingestion_timestamp_utc")).otherwise(
            F.col("ingestion_timestamp_utc") + F.expr("INTERVAL 6 HOURS")),
    })
    return run, early


def _two_daily_runs(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    run, early = _daily_runs(spark, sf_dir)
    return run.filter(early), run.filter(~early)


def _write_daily(spark, runs, layout):
    base = scratch_path(spark, "lake-daily")
    for run in runs:  # one run per write: no in-batch winner needed
        write_forecasts(run, base, interval="daily", provider=PROVIDER, compression="snappy",
                        layout=layout, latest_run_only=False)
    return read_lake(spark, base, "daily", provider=PROVIDER)


def q_partitioned_write_daily(spark, sf_dir):
    return _write_daily(spark, _two_daily_runs(spark, sf_dir), "by_date")


def q_partitioned_write_daily_by_location(spark, sf_dir):
    return _write_daily(spark, _two_daily_runs(spark, sf_dir), "by_location")


def q_daily_replace_missing_location(spark, sf_dir):
    """The later run lacks a location: that location keeps its earlier rows."""
    early, late = _two_daily_runs(spark, sf_dir)
    return _write_daily(spark, (early, late.filter("location_name <> 'FR'")), "by_date")


def q_daily_replace_single_batch(spark, sf_dir):
    """Both daily runs in one batch: the later run of each location-day wins."""
    base = scratch_path(spark, "lake-daily-batch")
    write_forecasts(_daily_runs(spark, sf_dir)[0], base, interval="daily", provider=PROVIDER, layout="by_location")
    return read_lake(spark, base, "daily", provider=PROVIDER)


def q_write_report(spark, sf_dir):
    base = scratch_path(spark, "lake-report")
    for run in _two_hourly_runs(spark, sf_dir):
        write_forecasts(run, base, interval="hourly", provider=PROVIDER, compression="gzip")
    return write_report(spark, base, interval="hourly", provider=PROVIDER)


def q_write_totals(spark, sf_dir):
    base = scratch_path(spark, "lake-totals")
    for run in _two_hourly_runs(spark, sf_dir):
        write_forecasts(run, base, interval="hourly", provider=PROVIDER)
    return report_totals(write_report(spark, base, interval="hourly", provider=PROVIDER))


def q_write_report_escaped_ids(spark, sf_dir):
    """Run ids that need escaping in paths (an ISO time, and characters that globs read)."""
    base = scratch_path(spark, "lake-escaped")
    for run in _two_hourly_runs(spark, sf_dir):
        odd = F.concat(F.date_format("ingestion_timestamp_utc", "yyyy-MM-dd'T'HH:mm"), F.lit(" #{a,b}"))
        write_forecasts(run.withColumn("run_id", odd), base, interval="hourly", provider=PROVIDER)
    ids = [r[0] for r in read_lake(spark, base, "hourly", provider=PROVIDER).select("run_id").distinct()
           .orderBy("run_id").limit(2).collect()]
    every = write_report(spark, base, interval="hourly", provider=PROVIDER)
    some = write_report(spark, base, interval="hourly", provider=PROVIDER, run_ids=ids)
    return every.select("location_name", "run_id", "records_written", F.lit("all").alias("scope")).unionByName(
        some.select("location_name", "run_id", "records_written", F.lit("first two").alias("scope")))


def q_single_write_report(spark, sf_dir):
    """One file set, interval inferred from the columns, codec in the result."""
    frame = _daily(spark, sf_dir).drop("l_orderkey", "l_linenumber")
    path = scratch_path(spark, "single") + f"/open_meteo/{infer_interval(frame)}/forecast.parquet"
    rep = write_single(frame, path, compression="zstd")
    return rep.select("records_written", "format", "compression",
                      F.regexp_extract("path", "/open_meteo/([^/]+)/", 1).alias("interval"))


def q_lake_tail(spark, sf_dir):
    """O4 over a daily lake: the 25 latest and the 25 earliest rows, by a threshold scan of the manifest."""
    base = scratch_path(spark, "lake-tail")
    for run in _two_daily_runs(spark, sf_dir):
        write_forecasts(run, base, interval="daily", provider=PROVIDER)
    order = ["date", "location_name", "temperature_2m_max", "temperature_2m_min", "precipitation_sum"]
    ends = [cut(read_lake_end(spark, base, "daily", provider=PROVIDER, n=25, last=last), order, 25)
            .select(*order, F.lit(name).alias("part")) for last, cut, name in ((True, q.tail, "tail"), (False, q.head, "head"))]
    return ends[0].unionByName(ends[1])


def q_inferred_interval_write(spark, sf_dir):
    """The grouped write of either frame finds its own interval."""
    base = scratch_path(spark, "lake-inferred")
    write_forecasts(_hourly(spark, sf_dir).drop("event_id"), base, interval=None, provider=PROVIDER)
    for run in _two_daily_runs(spark, sf_dir):
        write_forecasts(run, base, interval=None, provider=PROVIDER)
    parts = [read_lake(spark, base, i, provider=PROVIDER, with_partitions=True, latest_only=False).groupBy("interval", "location_name")
             .agg(F.count(F.lit(1)).alias("records")) for i in ("hourly", "daily")]
    return parts[0].unionByName(parts[1])


def q_lake_path_columns(spark, sf_dir):
    base = scratch_path(spark, "lake-paths")
    write_forecasts(_hourly(spark, sf_dir).drop("event_id"), base, interval="hourly", provider=PROVIDER,
                    layout="by_location")
    lake = spark.read.schema(
        read_lake(spark, base, "hourly", provider=PROVIDER, with_partitions=True).schema
    ).option("basePath", base).parquet(base)
    paths = lake_path_columns(lake).withColumn("path_date", F.col("path_date").cast("timestamp_ntz"))
    return (paths.groupBy("path_provider", "path_interval", "path_location", "path_date")
            .agg(F.count(F.lit(1)).alias("records")))


def q_lake_location_filter(spark, sf_dir):
    base = scratch_path(spark, "lake-filter")
    write_forecasts(_hourly(spark, sf_dir).drop("event_id"), base, interval="hourly", provider=PROVIDER,
                    layout="by_location")
    return read_lake(spark, base, "hourly", provider=PROVIDER).filter(F.col("location_name") == "click")


def q_catalog_lake_filter(spark, sf_dir):
    """Lake written through a partitioned catalog table; the filter prunes by catalog."""
    from forecastlake.sinks.catalog import read_lake_table, write_lake_table

    name = "forecastlake_checked_lake"       # one table, replaced on each call; its files are external
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    write_lake_table(spark, name, _hourly(spark, sf_dir).drop("event_id"), scratch_path(spark, "lake-catalog"),
                     interval="hourly", provider=PROVIDER, layout="by_location")
    return read_lake_table(spark, name, "hourly").filter(F.col("location_name") == "click")


def _landed(spark, responses: DataFrame) -> DataFrame:
    """Land the responses first, as a fetcher would, and read the landing zone."""
    landing = scratch_path(spark, "run-landing")
    responses.write.json(landing)
    return read_responses(spark, landing)


def _cycles(responses: DataFrame) -> DataFrame:
    """Each packed response is a fetch cycle of its own."""
    return responses.withColumn("run_id", F.concat_ws("-", "run_id", "chunk")).drop("chunk")


def q_run_report(spark, sf_dir):
    landed = _landed(spark, _cycles(tb.events_responses(_t(spark, sf_dir, "events"))))
    res = run_batch(spark, landed, interval="hourly",
                    base_path=scratch_path(spark, "run-lake"),
                    state_root=scratch_path(spark, "run-state"), run_id="run-events")
    return res.run_report.drop("run_start", "run_end")


def q_run_cycles(spark, sf_dir):
    """Many cycles with retries, pending ones and responses without a location name:
    outcomes with their rows, the lake's rows and the state."""
    landed = _landed(spark, tb.events_cycle_attempts(_t(spark, sf_dir, "events")))
    base, root = scratch_path(spark, "run-lake"), scratch_path(spark, "run-state")
    res = run_batch(spark, landed, interval="hourly", base_path=base, state_root=root, run_id="run-cycles")
    by = res.resolved.groupBy(F.col("location.name").alias("location_name"), "outcome").agg(
        F.count(F.lit(1)).alias("n"), F.sum("n_good").alias("good"), F.sum("n_bad").alias("bad"))
    lake = read_lake(spark, base, "hourly", provider=PROVIDER).groupBy("location_name").agg(
        F.count(F.lit(1)).alias("good"))
    state = read_state(spark, root)
    zero = F.lit(0).cast("long")
    return by.select(F.lit("responses").alias("part"), "location_name", "outcome", "n", "good", "bad").unionByName(
        lake.select(F.lit("lake").alias("part"), "location_name", F.lit(None).cast("string").alias("outcome"),
                    F.lit(1).cast("long").alias("n"), "good", zero.alias("bad"))).unionByName(
        state.select(F.lit("state").alias("part"), "location_name", F.col("last_fetch_status").alias("outcome"),
                     F.lit(1).cast("long").alias("n"), F.col("records_fetched").cast("long").alias("good"),
                     zero.alias("bad")))


def q_run_daily_refetch(spark, sf_dir):
    """Two fetches of a location on one day in one run: the later one is the day's."""
    first = tb.orders_daily_responses(_t(spark, sf_dir, "orders")).drop("chunk")
    later = first.filter(F.col("location.name") != "1-URGENT").withColumns({
        "run_id": F.concat("run_id", F.lit("-b")),
        "ingestion_timestamp_utc": F.col("ingestion_timestamp_utc") + F.expr("INTERVAL 6 HOURS")})
    base = scratch_path(spark, "run-lake")
    run_batch(spark, _landed(spark, first.unionByName(later)), interval="daily", base_path=base, run_id="run-daily")
    return read_lake(spark, base, "daily", provider=PROVIDER).drop("run_id")


def q_run_quarantine_report(spark, sf_dir):
    """Rejected rows of a run, written below the lake and counted in its report."""
    landed = _landed(spark, _cycles(tb.events_responses(_t(spark, sf_dir, "events"), bad_cells=True)))
    res = run_batch(spark, landed, interval="hourly", base_path=scratch_path(spark, "run-lake"), run_id="run-bad")
    rows = res.quarantined.groupBy("location_name").agg(F.count(F.lit(1)).alias("records"))
    report = res.run_report.select(F.lit("report").alias("part"), F.lit(None).cast("string").alias("location_name"),
                                   F.col("rejected_count").alias("records"), F.col("records_processed").alias("written"))
    return report.unionByName(rows.select(F.lit("rejected").alias("part"), "location_name", "records",
                                          F.lit(0).cast("long").alias("written")))


def _incremental(spark, sf_dir, streams: int = 1, max_files: int = 100_000):
    events = _t(spark, sf_dir, "events")
    base = scratch_path(spark, "stream-lake")
    resp = _cycles(tb.events_responses(events))
    first = F.col("ingestion_timestamp_utc") < F.lit(SPLIT_AT).cast("timestamp_ntz")
    zones = [(scratch_path(spark, "landing"), scratch_path(spark, "stream-ckpt")) for _ in range(streams)]
    for i, part in enumerate((resp.filter(first), resp.filter(~first))):
        for k, (landing, ckpt) in enumerate(zones):
            own = part.filter(F.pmod(F.xxhash64("location"), F.lit(streams)) == k) if streams > 1 else part
            own.repartition(3).write.mode("overwrite").json(f"{landing}/drop={i}")
            run_available_now(spark, f"{landing}/drop=*", checkpoint=ckpt, interval="hourly",
                              base_path=base, provider=PROVIDER, max_files_per_trigger=max_files)
    return read_lake(spark, base, "hourly", provider=PROVIDER).drop("run_id")


def q_incremental_ingest(spark, sf_dir):
    return _incremental(spark, sf_dir)


def q_incremental_small_batches(spark, sf_dir):
    """One file in each micro-batch: the same rows."""
    return _incremental(spark, sf_dir, max_files=1)


def q_incremental_two_streams(spark, sf_dir):
    """Two landing zones into one lake: neither replaces the other's rows."""
    return _incremental(spark, sf_dir, streams=2)


def q_incremental_cycles(spark, sf_dir):
    """Attempts that land run by run: pending cycles are carried, settled ones stay as they are.

    Run k sees the k-th attempts; run 4 sees late attempts of cycles that are settled.
    """
    rows = tb.events_cycle_attempts(_t(spark, sf_dir, "events"))
    attempt = F.col("attempt")
    late = rows.filter((attempt == 2) & F.col("transport_error").isNull()).withColumn("attempt", F.lit(3))
    landing, ckpt, base = (scratch_path(spark, x) for x in ("landing", "stream-ckpt", "stream-lake"))
    out = None
    for k, part in enumerate((rows.filter(attempt == 1), rows.filter(attempt == 2), rows.filter(attempt == 3), late), 1):
        part.write.json(f"{landing}/drop={k}")
        res = run_available_now(spark, f"{landing}/drop=*", checkpoint=ckpt, interval="hourly", base_path=base,
                                provider=PROVIDER)
        now = res.resolved.groupBy(F.col("location.name").alias("location_name"), "outcome").agg(
            F.count(F.lit(1)).alias("n"), F.sum("n_good").alias("good")).withColumn("run", F.lit(k))
        out = now if out is None else out.unionByName(now)
    return out


# ---- state --------------------------------------------------------------

def _outcomes(spark, sf_dir):
    return tb.events_outcomes(_t(spark, sf_dir, "events"))


def _full_state(spark, sf_dir):
    return st.apply_outcomes(empty_state(spark), _outcomes(spark, sf_dir))


def q_state_after_run(spark, sf_dir):
    root = scratch_path(spark, "state")
    upd = _outcomes(spark, sf_dir)
    before = F.col("at") < _ts_lit(SPLIT_AT)
    save_state(st.apply_outcomes(read_state(spark, root), upd.filter(before)), root, buckets=16)
    save_state(update_buckets(spark, root, upd.filter(~before)), root)
    return read_state(spark, root).withColumn("last_fetch_timestamp", F.col("last_fetch_timestamp").cast("timestamp_ntz"))


def q_state_freshness(spark, sf_dir):
    s = st.with_freshness(_full_state(spark, sf_dir), as_of=_ts_lit(AS_OF))
    return s.select("location_name", "last_fetch_status", "is_fresh")


def q_stale_locations(spark, sf_dir):
    locs = _t(spark, sf_dir, "events").select(
        F.concat(F.lit("user-"), F.col("user_id").cast("string")).alias("name")).distinct()
    return st.stale_locations(locs, _full_state(spark, sf_dir), provider=PROVIDER,
                              interval="hourly", as_of=_ts_lit(AS_OF))


def q_records_gate_total(spark, sf_dir):
    return st.records_total(_full_state(spark, sf_dir))


def q_get_or_create_state(spark, sf_dir):
    """The state of known and unknown locations."""
    users = _t(spark, sf_dir, "events").select(F.concat(F.lit("user-"), F.col("user_id").cast("string")).alias("location_name"))
    wanted = users.union(users.select(F.concat("location_name", F.lit("-new")))).distinct().select(
        F.lit(PROVIDER).alias("provider"), F.lit("hourly").alias("interval"), "location_name")
    got = st.get_locations(_full_state(spark, sf_dir), wanted, as_of=_ts_lit(AS_OF))
    return got.select("location_name", "last_fetch_status", "records_fetched", "is_new")


def q_gates(spark, sf_dir):
    """The gates' figures and whether they pass."""
    nulls = q.null_total(q.null_counts_long(_hourly(spark, sf_dir).select("location_name", "timestamp", "relative_humidity_2m")))
    total = st.records_total(_full_state(spark, sf_dir))
    return nulls.select(F.lit("nulls").alias("gate"), F.col("null_total").alias("figure"), (F.col("null_total") == 0).alias("passed")) \
        .unionByName(total.select(F.lit("records").alias("gate"), F.col("total_records").alias("figure"),
                                  (F.col("total_records") > 0).alias("passed")))


def q_attempt_resolution(spark, sf_dir):
    log = tb.events_attempt_log(_t(spark, sf_dir, "events"))
    return st.resolve_attempts(log, ["location_name", "request_date"], order_cols=("event_id",))


def q_backoff_schedule(spark, sf_dir):
    log = tb.events_attempt_log(_t(spark, sf_dir, "events"))
    return st.backoff_schedule(log).select("location_name", "event_id", "attempt", "wait_seconds")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "ranges_from_responses": q_ranges_from_responses,
    "latest_forecast": q_latest_forecast,
    "forecast_as_of": q_forecast_as_of,
    "lead_time_accuracy": q_lead_time_accuracy,
    "flatten_hourly": q_flatten_hourly,
    "flatten_daily": q_flatten_daily,
    "flatten_dynamic": q_flatten_dynamic,
    "multi_location_body": q_multi_location_body,
    "row_validation": q_row_validation,
    "current_block": q_current_block,
    "variable_profile": q_variable_profile,
    "leading_pairs": q_leading_pairs,
    "forecast_end": q_forecast_end,
    "payload_shape": q_payload_shape,
    "split_ok": q_split_ok,
    "split_failed": q_split_failed,
    "metadata_record": q_metadata_record,
    "coordinate_snap": q_coordinate_snap,
    "attach_location": q_attach_location,
    "request_manifest": q_request_manifest,
    "struct_prefix": q_struct_prefix,
    "completeness": q_completeness,
    "completeness_daily": q_completeness_daily,
    "ranges_hourly": q_ranges_hourly,
    "sql_ranges_hourly": q_sql_ranges_hourly,
    "ranges_daily": q_ranges_daily,
    "comparison_hourly": q_comparison_hourly,
    "comparison_daily": q_comparison_daily,
    "ingestion_span": q_ingestion_span,
    "rows_per_location": q_rows_per_location,
    "temp_range": q_temp_range,
    "duplicates": q_duplicates,
    "duplicates_eliminated": q_duplicates_eliminated,
    "completeness_rollup": q_completeness_rollup,
    "completeness_bitmaps": q_completeness_bitmaps,
    "ingestion_span_rollup": q_ingestion_span_rollup,
    "null_counts": q_null_counts,
    "null_total": q_null_total,
    "sample_rows": q_sample_rows,
    "tail_rows": q_tail_rows,
    "head_rows": q_head_rows,
    "location_summary": q_location_summary,
    "coordinates_distinct": q_coordinates_distinct,
    "distinct_pairs": q_distinct_pairs,
    "partition_paths": q_partition_paths,
    "prototype_paths": q_prototype_paths,
    "partitioned_write_hourly": q_partitioned_write_hourly,
    "partitioned_write_daily": q_partitioned_write_daily,
    "daily_replace_single_batch": q_daily_replace_single_batch,
    "write_report": q_write_report,
    "write_totals": q_write_totals,
    "single_write_report": q_single_write_report,
    "lake_path_columns": q_lake_path_columns,
    "lake_location_filter": q_lake_location_filter,
    "catalog_lake_filter": q_catalog_lake_filter,
    "run_report": q_run_report,
    "incremental_ingest": q_incremental_ingest,
    "state_after_run": q_state_after_run,
    "state_freshness": q_state_freshness,
    "stale_locations": q_stale_locations,
    "records_gate_total": q_records_gate_total,
    "attempt_resolution": q_attempt_resolution,
    "backoff_schedule": q_backoff_schedule,
    "partitioned_write_hourly_by_location": q_partitioned_write_hourly_by_location,
    "partitioned_write_daily_by_location": q_partitioned_write_daily_by_location,
    "daily_replace_missing_location": q_daily_replace_missing_location,
    "write_report_escaped_ids": q_write_report_escaped_ids,
    "inferred_interval_write": q_inferred_interval_write,
    "lake_tail": q_lake_tail,
    "run_cycles": q_run_cycles,
    "run_daily_refetch": q_run_daily_refetch,
    "run_quarantine_report": q_run_quarantine_report,
    "incremental_small_batches": q_incremental_small_batches,
    "incremental_two_streams": q_incremental_two_streams,
    "incremental_cycles": q_incremental_cycles,
    "get_or_create_state": q_get_or_create_state,
    "gates": q_gates,
    "flatten_dynamic_daily": q_flatten_dynamic_daily,
    "payload_bytes": q_payload_bytes,
    "list_bodies": q_list_bodies,
    "ingestion_metadata": q_ingestion_metadata,
    "discover_variables": q_discover_variables,
    "flatten_discovered": q_flatten_discovered,
    "body_keys": q_body_keys,
    "raw_bodies": q_raw_bodies,
    "location_file": q_location_file,
}
