"""DuckDB SQL equivalents of the registered queries (correctness oracle).

Each string runs on the driver's pre-registered views and must return the
same columns and values as the Spark query of the same name.
"""

from __future__ import annotations

# Shared fragments (fixed values of the binding, see sources/tables.py).
D = "CAST({} AS DOUBLE)"
K = "CAST(json_extract_string(props, '$.k') AS INTEGER)"
LAT = f"((ascii(event_type) - 100) * {D.format(1.5)} + length(event_type) * {D.format(0.25)})"
LON = f"(length(event_type) * {D.format(10.125)} - {D.format(50.0)})"


def GRID(x: str) -> str:
    return f"(floor({x} * {D.format(2.0)}) / {D.format(2.0)})"


DAY = "CAST(date_trunc('day', ts) AS TIMESTAMP)"
CHUNK = "(event_id // 256)"
RUN = "('run-' || strftime(ts, '%Y%m%d'))"
SUFFIX = "(CASE event_type WHEN 'click' THEN '+00:00' WHEN 'signup' THEN 'Z' ELSE '' END)"
TS_TEXT = "strftime(ts, '%Y-%m-%dT%H:%M:%S.%f')"
TZ = "(CASE event_type WHEN 'click' THEN 'GMT' WHEN 'view' THEN 'GMT' ELSE 'Etc/GMT' END)"
N_GROUP = f"count(*) OVER (PARTITION BY event_type, {DAY}, {CHUNK})"


def hourly_cols(ingest: str = DAY, run: str = RUN, with_run: bool = True) -> str:
    cols = f"""event_type AS location_name, {LAT} AS requested_latitude, {LON} AS requested_longitude,
  {GRID(LAT)} AS api_latitude, {GRID(LON)} AS api_longitude, ts AS "timestamp",
  value AS temperature_2m, {K} / {D.format(10.0)} AS precipitation,
  CAST(NULL AS DOUBLE) AS relative_humidity_2m, CAST(NULL AS DOUBLE) AS windspeed_10m,
  CAST(NULL AS DOUBLE) AS wind_direction_10m, CAST({K} AS DOUBLE) AS cloud_cover,
  {K} AS weather_code, 'open-meteo' AS source_api, {ingest} AS ingestion_timestamp_utc"""
    if with_run:
        cols += f", {run} AS run_id"
    return cols


FLAT_HOURLY = f"SELECT {hourly_cols()} FROM events WHERE event_type <> 'error'"

# lineitem as a daily frame (per supplier, monthly ingestion).
L_LOC = "('S' || CAST(l_suppkey AS VARCHAR))"
L_PRECIP = f"round(l_discount * {D.format(100.0)})"
L_LAT = f"(CAST(l_suppkey % 160 AS DOUBLE) - {D.format(80.0)})"
L_LON = f"(CAST(l_suppkey % 360 AS DOUBLE) - {D.format(180.0)})"


def _daily_flag_runs() -> str:
    ing = "CAST(date_trunc('year', l_shipdate) AS TIMESTAMP)"
    early = "(dayofmonth(l_shipdate) <= 15)"
    return f"""WITH f AS (
  SELECT ('F' || l_returnflag) AS location_name, {L_LAT} AS requested_latitude,
    {L_LON} AS requested_longitude, {GRID(L_LAT)} AS api_latitude, {GRID(L_LON)} AS api_longitude,
    l_shipdate AS "date", l_quantity AS temperature_2m_max,
    CAST(l_linenumber AS DOUBLE) AS temperature_2m_min, {L_PRECIP} AS precipitation_sum,
    'open-meteo' AS source_api,
    CASE WHEN {early} THEN {ing} ELSE {ing} + INTERVAL 6 HOUR END AS ingestion_timestamp_utc,
    'run-' || strftime({ing}, '%Y') || CASE WHEN {early} THEN '-early' ELSE '-late' END AS run_id,
    {early} AS early, {ing} AS ing
  FROM lineitem)
SELECT location_name, requested_latitude, requested_longitude, api_latitude, api_longitude, "date",
  temperature_2m_max, temperature_2m_min, precipitation_sum, source_api, ingestion_timestamp_utc, run_id
FROM f WHERE NOT early OR NOT EXISTS (
  SELECT 1 FROM f g WHERE g.location_name = f.location_name AND g.ing = f.ing AND NOT g.early)"""


def _hourly_two_runs() -> str:
    am = "(hour(ts) < 12)"
    ing = f"CASE WHEN {am} THEN {DAY} ELSE {DAY} + INTERVAL 12 HOUR END"
    run = f"{RUN} || CASE WHEN {am} THEN '-am' ELSE '-pm' END"
    return hourly_cols(ingest=ing, run=run)


_O = f"""o AS (
  SELECT 'user-' || CAST(user_id AS VARCHAR) AS location_name, ts, event_id,
    event_type <> 'error' AS ok,
    CASE WHEN event_type = 'view' THEN '' ELSE strftime(CAST(ts AS DATE) + INTERVAL 7 DAY, '%Y-%m-%d') END AS endd,
    CAST(floor(value) AS INTEGER) AS rec
  FROM events),
last AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY location_name ORDER BY ts DESC, event_id DESC) AS rn
                 FROM o) WHERE rn = 1)"""
FRESH = "(ok AND ts > TIMESTAMP '2024-01-30 06:00:00')"

_ATTEMPTS = f"""l AS (
  SELECT 'user-' || CAST(user_id AS VARCHAR) AS location_name,
    CAST(CAST(ts AS DATE) AS TIMESTAMP) AS request_date,
    1 + {K} % 3 AS attempt, event_id,
    CASE event_type WHEN 'click' THEN 'timeout' WHEN 'error' THEN 'http_error'
                    WHEN 'view' THEN 'connect' END AS cls
  FROM events),
t AS (
  SELECT *, (cls IS NULL OR cls NOT IN ('timeout', 'connect', 'read', 'write') OR attempt >= 3) AS term
  FROM l)"""

_FIRST = f"""f AS (
  SELECT *, {K} AS k, row_number() OVER (PARTITION BY event_type, {DAY}, {CHUNK} ORDER BY ts, event_id) AS rn
  FROM events WHERE event_type <> 'error')"""

_KEYS = f"event_type AS location_name, {DAY} AS ingestion_timestamp_utc, {CHUNK} AS chunk"

ORACLES: dict[str, str] = {
    "ranges_from_responses": f"""
SELECT event_type AS location_name, ROUND(MIN(value), 1) AS min_temp, ROUND(MAX(value), 1) AS max_temp,
  ROUND(AVG(value), 1) AS avg_temp, ROUND(MAX({K} / {D.format(10.0)}), 2) AS max_precip_mm,
  COUNT(CASE WHEN value IS NULL THEN 1 END) AS null_count
FROM events WHERE event_type <> 'error' GROUP BY event_type""",

    "flatten_hourly": FLAT_HOURLY,

    "flatten_daily": f"""
SELECT location_name, {D.format('lat0')} * {D.format(10.0)} AS requested_latitude,
  {D.format('lat0')} * {D.format(-5.0)} AS requested_longitude,
  {GRID(D.format('lat0') + ' * ' + D.format(10.0))} AS api_latitude,
  {GRID(D.format('lat0') + ' * ' + D.format(-5.0))} AS api_longitude,
  "date", temperature_2m_max, temperature_2m_min, precipitation_sum, 'open-meteo' AS source_api,
  make_timestamp(year("date"), 1, 1, 0, 0, 0) AS ingestion_timestamp_utc,
  'run-' || CAST(year("date") AS VARCHAR) AS run_id
FROM (SELECT o_orderpriority AS location_name, substr(o_orderpriority, 1, 1) AS lat0,
        o_orderdate AS "date", max(o_totalprice) / {D.format(1000.0)} AS temperature_2m_max,
        min(o_totalprice) / {D.format(1000.0)} AS temperature_2m_min,
        CAST(count(*) AS DOUBLE) AS precipitation_sum
      FROM orders GROUP BY o_orderpriority, o_orderdate)""",

    "flatten_dynamic": f"""
SELECT ts AS "time",
  CASE WHEN event_type = 'purchase' THEN CAST({K} AS DOUBLE) END AS cloud_cover,
  CASE WHEN event_type <> 'purchase' THEN CAST({K} AS DOUBLE) END AS cloudcover,
  {K} / {D.format(10.0)} AS precipitation, value AS temperature_2m, CAST({K} AS DOUBLE) AS weathercode,
  CASE WHEN event_type = 'view' THEN CAST({LAT} AS VARCHAR) || ',' || CAST({LON} AS VARCHAR)
       ELSE event_type END AS location_name,
  {LAT} AS requested_latitude, {LON} AS requested_longitude,
  {GRID(LAT)} AS api_latitude, {GRID(LON)} AS api_longitude,
  length(event_type) * {D.format(3.0)} AS api_elevation, {TZ} AS api_timezone,
  {N_GROUP} * {D.format(0.25)} AS api_generationtime_ms,
  strftime({DAY}, '%Y-%m-%dT%H:%M:%S') AS ingestion_timestamp_utc,
  {N_GROUP} * {D.format(1.5)} AS ingest_elapsed_ms,
  'events://' || event_type || '/' || CAST({CHUNK} AS VARCHAR) AS request_url
FROM events WHERE event_type <> 'error'""",

    "multi_location_body": FLAT_HOURLY,

    "row_validation": f"""
SELECT event_type AS location_name, ts AS "timestamp",
  concat_ws(',', CASE WHEN value >= 300 THEN 'bad_value:temperature_2m' END,
                 CASE WHEN {K} >= 98 THEN 'bad_weather_code' END) AS errors
FROM events WHERE event_type <> 'error' AND (value >= 300 OR {K} >= 98)""",

    "current_block": f"""
SELECT location_name, ingestion_timestamp_utc, chunk, ts AS current_time,
  900 AS current_interval_seconds, value AS current_temperature_2m
FROM (SELECT {_KEYS}, ts, value,
        row_number() OVER (PARTITION BY event_type, {DAY}, {CHUNK} ORDER BY ts DESC, event_id DESC) AS rn
      FROM events WHERE event_type <> 'error') WHERE rn = 1""",

    "variable_profile": f"""
WITH {_FIRST}, r AS (SELECT * FROM f WHERE rn = 1)
SELECT {_KEYS}, 'temperature_2m' AS variable, value AS first_value, '°C' AS unit FROM r
UNION ALL SELECT {_KEYS}, 'precipitation', k / {D.format(10.0)}, 'mm' FROM r
UNION ALL SELECT {_KEYS}, CASE WHEN event_type = 'purchase' THEN 'cloud_cover' ELSE 'cloudcover' END,
  CAST(k AS DOUBLE), 'N/A' FROM r
UNION ALL SELECT {_KEYS}, 'weathercode', CAST(k AS DOUBLE), 'N/A' FROM r""",

    "leading_pairs": f"""
WITH {_FIRST}
SELECT {_KEYS}, CAST(rn - 1 AS INTEGER) AS idx, {TS_TEXT} || {SUFFIX} AS time_text, value
FROM f WHERE rn <= 3""",

    "forecast_end": f"""
SELECT {_KEYS}, strftime(max(ts), '%Y-%m-%dT%H:%M:%S.%f') || {SUFFIX} AS forecast_end_date
FROM events WHERE event_type <> 'error' GROUP BY event_type, {DAY}, {CHUNK}""",

    "payload_shape": f"""
SELECT {_KEYS},
  CASE WHEN event_type = 'error' THEN 'error,reason'
       WHEN event_type = 'view' THEN 'current,elevation,generationtime_ms,hourly,hourly_units,latitude,longitude,utc_offset_seconds'
       ELSE 'current,elevation,generationtime_ms,hourly,hourly_units,latitude,longitude,timezone,utc_offset_seconds' END AS top_keys,
  CAST(CASE WHEN event_type = 'error' THEN 2 WHEN event_type = 'view' THEN 8 ELSE 9 END AS INTEGER) AS n_top_keys,
  CASE WHEN event_type = 'error' THEN NULL
       WHEN event_type = 'purchase' THEN 'cloud_cover,precipitation,temperature_2m,time,weathercode'
       ELSE 'cloudcover,precipitation,temperature_2m,time,weathercode' END AS block_keys,
  CAST(CASE WHEN event_type = 'error' THEN NULL ELSE 4 END AS INTEGER) AS n_variables,
  CAST(CASE WHEN event_type = 'error' THEN NULL ELSE count(*) END AS INTEGER) AS n_points,
  CAST(1 AS INTEGER) AS n_locations,
  CASE WHEN event_type = 'error' THEN ''
       WHEN event_type = 'view' THEN 'latitude,longitude,elevation,generationtime_ms,utc_offset_seconds'
       ELSE 'latitude,longitude,elevation,generationtime_ms,utc_offset_seconds,timezone' END AS present_keys
FROM events GROUP BY event_type, {DAY}, {CHUNK}""",

    "split_ok": f"""
SELECT {_KEYS}, {GRID(LAT)} AS api_latitude, {GRID(LON)} AS api_longitude,
  length(event_type) * {D.format(3.0)} AS api_elevation,
  count(*) * {D.format(0.25)} AS api_generationtime_ms, {TZ} AS api_timezone,
  CAST(0 AS INTEGER) AS api_utc_offset_seconds, CAST(count(*) AS INTEGER) AS n_points
FROM events WHERE event_type <> 'error' GROUP BY event_type, {DAY}, {CHUNK}""",

    "split_failed": f"""
SELECT {_KEYS}, 'API Error: rate limit exceeded after ' || CAST(count(*) AS VARCHAR) || ' points' AS error,
  'failed' AS status
FROM events WHERE event_type = 'error' GROUP BY event_type, {DAY}, {CHUNK}""",

    "metadata_record": f"""
SELECT event_type AS location_name, {DAY} AS ingestion_timestamp_utc, {CHUNK} AS chunk,
  'run-' || strftime({DAY}, '%Y%m%d') AS run_id,
  strftime({DAY}, '%Y-%m-%dT%H:%M:%S') AS ingestion_timestamp,
  'events://' || event_type || '/' || CAST({CHUNK} AS VARCHAR) AS request_url,
  count(*) * {D.format(1.5)} AS elapsed_ms, CAST(200 AS INTEGER) AS status_code,
  count(*) * {D.format(0.25)} AS api_generation_time_ms,
  {GRID(LAT)} AS api_latitude, {GRID(LON)} AS api_longitude,
  length(event_type) * {D.format(3.0)} AS api_elevation, {TZ} AS api_timezone,
  CAST(0 AS INTEGER) AS api_utc_offset_seconds
FROM events WHERE event_type <> 'error' GROUP BY event_type, {DAY}, {CHUNK}""",

    "coordinate_snap": f"""
SELECT DISTINCT {_KEYS}, {LAT} AS requested_latitude, {LON} AS requested_longitude,
  {GRID(LAT)} AS api_latitude, {GRID(LON)} AS api_longitude,
  abs({LAT} - {GRID(LAT)}) AS lat_snap, abs({LON} - {GRID(LON)}) AS lon_snap
FROM events WHERE event_type <> 'error'""",

    "attach_location": f"""
SELECT DISTINCT event_type AS location_name, {LAT} AS requested_latitude, {LON} AS requested_longitude,
  {DAY} AS ingestion_timestamp_utc, {CHUNK} AS chunk, {GRID(LAT)} AS api_latitude, {GRID(LON)} AS api_longitude
FROM events WHERE event_type <> 'error'""",

    "request_manifest": f"""
SELECT location_name, latitude, longitude, CAST(7 AS INTEGER) AS forecast_days, 'GMT' AS timezone,
  'temperature_2m,precipitation,weather_code' AS hourly, CAST(NULL AS VARCHAR) AS daily,
  'https://api.open-meteo.com/v1/forecast?latitude=' || CAST(latitude AS VARCHAR)
    || '&longitude=' || CAST(longitude AS VARCHAR)
    || '&forecast_days=7&timezone=GMT&hourly=temperature_2m,precipitation,weather_code' AS request_url
FROM (SELECT c_name AS location_name, c_nationkey * {D.format(3.5)} - {D.format(40.0)} AS latitude,
        CAST(c_custkey % 360 AS DOUBLE) - {D.format(180.0)} AS longitude FROM customer)""",

    "struct_prefix": """
SELECT c_mktsegment, c_custkey AS loc_c_custkey, c_name AS loc_c_name, c_nationkey AS loc_c_nationkey
FROM customer""",

    "completeness": """
SELECT event_type AS location_name, COUNT(*) AS record_count, COUNT(DISTINCT ts) AS unique_dates
FROM events GROUP BY event_type ORDER BY location_name""",

    "completeness_daily": f"""
SELECT {L_LOC} AS location_name, COUNT(*) AS record_count, COUNT(DISTINCT l_shipdate) AS unique_dates
FROM lineitem GROUP BY 1 ORDER BY 1""",

    "ranges_hourly": f"""
SELECT event_type AS location_name, ROUND(MIN(value), 1) AS min_temp, ROUND(MAX(value), 1) AS max_temp,
  ROUND(AVG(value), 1) AS avg_temp, ROUND(MAX({K} / {D.format(10.0)}), 2) AS max_precip_mm,
  COUNT(CASE WHEN value IS NULL THEN 1 END) AS null_count
FROM events GROUP BY event_type ORDER BY avg_temp DESC""",

    "sql_ranges_hourly": f"""
SELECT event_type AS location_name, ROUND(MIN(value), 1) AS min_temp, ROUND(MAX(value), 1) AS max_temp,
  ROUND(AVG(value), 1) AS avg_temp, ROUND(MAX({K} / {D.format(10.0)}), 2) AS max_precip_mm,
  COUNT(CASE WHEN value IS NULL THEN 1 END) AS null_count
FROM events GROUP BY event_type""",

    "ranges_daily": f"""
SELECT {L_LOC} AS location_name, ROUND(MIN(l_quantity), 1) AS min_temp, ROUND(MAX(l_quantity), 1) AS max_temp,
  ROUND(AVG(l_quantity), 1) AS avg_temp, ROUND(MIN(CAST(l_linenumber AS DOUBLE)), 1) AS min_temp_min,
  ROUND(MAX({L_PRECIP}), 2) AS max_precip_mm,
  COUNT(CASE WHEN l_quantity IS NULL THEN 1 END) AS null_count
FROM lineitem GROUP BY 1 ORDER BY avg_temp DESC""",

    "comparison_hourly": f"""
SELECT event_type AS location_name, ROUND(AVG(value), 1) AS avg_temp_c,
  ROUND(MAX({K} / {D.format(10.0)}), 2) AS max_precip_mm, COUNT(*) AS record_count
FROM events GROUP BY event_type ORDER BY avg_temp_c DESC""",

    "comparison_daily": f"""
SELECT {L_LOC} AS location_name, ROUND(AVG(l_quantity), 1) AS avg_max_temp_c,
  ROUND(AVG(CAST(l_linenumber AS DOUBLE)), 1) AS avg_min_temp_c, ROUND(SUM({L_PRECIP}), 1) AS total_precip_mm
FROM lineitem GROUP BY 1 ORDER BY avg_max_temp_c DESC""",

    "ingestion_span": f"""
SELECT MIN({DAY}) AS earliest_ingest, MAX({DAY}) AS latest_ingest, COUNT(DISTINCT {DAY}) AS unique_ingest_times
FROM events""",

    "rows_per_location": f"SELECT {L_LOC} AS location_name, COUNT(*) AS record_count FROM lineitem GROUP BY 1",

    "temp_range": f"""
SELECT {L_LOC} AS location_name, ROUND(MIN(l_quantity), 1) AS min_temp, ROUND(MAX(l_quantity), 1) AS max_temp
FROM lineitem GROUP BY 1""",

    "duplicates": f"""
SELECT {L_LOC} AS location_name, l_shipdate AS "date", COUNT(*) AS dup_count
FROM lineitem GROUP BY 1, 2 HAVING COUNT(*) > 1""",

    "null_counts": """
SELECT COUNT(*) - COUNT(d.doc_id) AS doc_id, COUNT(*) - COUNT(d.text) AS text, COUNT(*) - COUNT(d.lang) AS lang,
  COUNT(*) - COUNT(d.source) AS source, COUNT(*) - COUNT(d.n_chars) AS n_chars,
  COUNT(*) - COUNT(l.quality) AS quality, COUNT(*) - COUNT(l.toxic) AS toxic
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""",

    "null_total": """
SELECT CAST(7 * COUNT(*) - COUNT(d.doc_id) - COUNT(d.text) - COUNT(d.lang) - COUNT(d.source) - COUNT(d.n_chars)
  - COUNT(l.quality) - COUNT(l.toxic) AS BIGINT) AS null_total
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""",

    "sample_rows": f"""
SELECT event_type AS location_name, ts AS "timestamp", value AS temperature_2m,
  {K} / {D.format(10.0)} AS precipitation, {K} AS weather_code, {DAY} AS ingestion_timestamp_utc
FROM events ORDER BY event_type, ts, {DAY}, {RUN}, event_id LIMIT 10""",

    "tail_rows": """
SELECT event_type AS location_name, ts AS "timestamp", value AS temperature_2m, event_id
FROM events ORDER BY ts DESC, event_id DESC LIMIT 3""",

    "head_rows": """
SELECT event_type AS location_name, ts AS "timestamp", value AS temperature_2m, event_id
FROM events ORDER BY ts, event_id LIMIT 1""",

    "location_summary": f"""
SELECT {L_LOC} AS location_name, COUNT(*) AS record_count, COUNT(DISTINCT l_shipdate) AS unique_dates,
  ROUND(MIN(l_quantity), 1) AS min_temp, ROUND(MAX(l_quantity), 1) AS max_temp,
  ROUND(AVG(l_quantity), 1) AS avg_temp, ROUND(MAX({L_PRECIP}), 2) AS max_precip_mm,
  COUNT(CASE WHEN l_quantity IS NULL THEN 1 END) AS null_count,
  ROUND(MIN(CAST(l_linenumber AS DOUBLE)), 1) AS min_temp_min,
  ROUND(AVG(CAST(l_linenumber AS DOUBLE)), 1) AS avg_min_temp_c,
  ROUND(SUM({L_PRECIP}), 1) AS total_precip_mm
FROM lineitem GROUP BY 1""",

    "coordinates_distinct": f"""
SELECT DISTINCT event_type AS location_name, {LAT} AS requested_latitude, {LON} AS requested_longitude,
  {GRID(LAT)} AS api_latitude, {GRID(LON)} AS api_longitude
FROM events ORDER BY location_name""",

    "distinct_pairs": f"SELECT DISTINCT event_type AS location_name, {RUN} AS run_id FROM events",

    "partition_paths": f"""
SELECT location_name, run_id,
  'open_meteo/hourly/' || location_name || '/' || strftime(d, '%Y') || '/' || strftime(d, '%m') || '/'
    || strftime(d, '%d') || '/forecast_' || strftime(d, '%Y%m%d') || '_' || strftime(d, '%H') || 'h_'
    || run_id || '.parquet' AS path
FROM (SELECT event_type AS location_name, {RUN} AS run_id, MIN({DAY}) AS d FROM events GROUP BY 1, 2)""",

    "prototype_paths": f"""
SELECT DISTINCT event_type AS location_name, {DAY} AS ingestion_timestamp_utc,
  'hourly/location=' || event_type || '/' || strftime({DAY}, '%Y-%m-%d') AS path
FROM events""",

    "partitioned_write_hourly": f"SELECT {_hourly_two_runs()} FROM events",

    "partitioned_write_daily": _daily_flag_runs(),

    "daily_replace_single_batch": _daily_flag_runs(),

    "write_report": f"""
SELECT location_name, run_id,
  'open_meteo/hourly/' || location_name || '/' || strftime(d, '%Y') || '/' || strftime(d, '%m') || '/'
    || strftime(d, '%d') || '/forecast_' || strftime(d, '%Y%m%d') || '_' || strftime(d, '%H') || 'h_'
    || run_id || '.parquet' AS path,
  records_written, 'parquet' AS format
FROM (SELECT location_name, run_id, COUNT(*) AS records_written, MIN(ingestion_timestamp_utc) AS d
      FROM (SELECT {_hourly_two_runs()} FROM events) GROUP BY 1, 2)""",

    "write_totals": f"""
SELECT CAST(COUNT(*) AS BIGINT) AS records_processed,
  COUNT(DISTINCT event_type || '|' || strftime(ts, '%Y%m%d') || CASE WHEN hour(ts) < 12 THEN 'am' ELSE 'pm' END)
    AS files_written
FROM events""",

    "single_write_report": """
SELECT COUNT(*) AS records_written, 'parquet' AS format, 'zstd' AS compression, 'daily' AS interval FROM lineitem""",

    "lake_path_columns": f"""
SELECT 'open_meteo' AS path_provider, 'hourly' AS path_interval, event_type AS path_location,
  {DAY} AS path_date, COUNT(*) AS records
FROM events GROUP BY 3, 4""",

    "lake_location_filter": f"SELECT {hourly_cols()} FROM events WHERE event_type = 'click'",

    "catalog_lake_filter": f"SELECT {hourly_cols()} FROM events WHERE event_type = 'click'",

    "run_report": f"""
WITH g AS (SELECT event_type, {DAY} AS d, {CHUNK} AS c, count(*) AS n FROM events GROUP BY ALL)
SELECT true AS success, 'run-events' AS run_id,
  CAST(sum(n) FILTER (event_type <> 'error') AS BIGINT) AS records_processed, CAST(0 AS BIGINT) AS rejected_count,
  count(DISTINCT event_type) FILTER (event_type <> 'error') AS files_written, count(*) AS responses,
  count(*) FILTER (event_type <> 'error') AS ok_count, count(*) FILTER (event_type = 'error') AS failed_count,
  CAST(0 AS BIGINT) AS pending_count, CAST(0 AS BIGINT) AS superseded_count, CAST(NULL AS VARCHAR) AS error
FROM g""",

    "run_cycles": f"""
WITH g AS (SELECT event_type, {DAY} AS d, {CHUNK} AS c, count(*) AS n, CAST({CHUNK} % 4 AS INTEGER) AS kind
           FROM events GROUP BY event_type, {DAY}, {CHUNK}),
f AS (SELECT *, CASE WHEN event_type = 'signup' THEN NULL ELSE event_type END AS name,
        CASE WHEN kind = 2 THEN 'pending' WHEN kind = 3 OR event_type = 'error' THEN 'failed' ELSE 'ok' END AS outcome FROM g),
r AS (SELECT name, outcome, n, event_type, d, c FROM f
      UNION ALL SELECT name, 'superseded', 0, event_type, d, c FROM f WHERE kind IN (0, 3)
      UNION ALL SELECT name, 'superseded', 0, event_type, d, c FROM f WHERE kind = 3),
w AS (SELECT *, CASE WHEN outcome = 'ok' AND name IS NOT NULL THEN n ELSE 0 END AS good,
        CASE WHEN outcome = 'ok' AND name IS NULL THEN n ELSE 0 END AS bad FROM r),
last AS (SELECT *, row_number() OVER (PARTITION BY name ORDER BY d + to_seconds(c) DESC) AS rn
         FROM w WHERE outcome IN ('ok', 'failed'))
SELECT 'responses' AS part, name AS location_name, outcome, count(*) AS n, CAST(sum(good) AS BIGINT) AS good,
  CAST(sum(bad) AS BIGINT) AS bad FROM w GROUP BY name, outcome
UNION ALL SELECT 'lake', name, NULL, 1, CAST(sum(good) AS BIGINT), 0 FROM w GROUP BY name HAVING sum(good) > 0
UNION ALL SELECT 'state', name, CASE outcome WHEN 'ok' THEN 'success' ELSE 'failure' END, 1, good, 0 FROM last WHERE rn = 1""",

    "incremental_cycles": f"""
WITH g AS (SELECT event_type, {DAY} AS d, {CHUNK} AS c, count(*) AS n, CAST({CHUNK} % 4 AS INTEGER) AS kind
           FROM events GROUP BY event_type, {DAY}, {CHUNK}),
f AS (SELECT *, CASE WHEN event_type = 'signup' THEN NULL ELSE event_type END AS name,
        CASE WHEN event_type = 'error' THEN 'failed' ELSE 'ok' END AS body FROM g),
r AS (SELECT 1 AS run, name, n, CASE WHEN kind = 1 THEN body ELSE 'pending' END AS outcome FROM f
      UNION ALL SELECT 2, name, n, CASE WHEN kind = 0 THEN body ELSE 'pending' END FROM f WHERE kind <> 1
      UNION ALL SELECT 2, name, n, 'superseded' FROM f WHERE kind IN (0, 3)
      UNION ALL SELECT 3, name, n, CASE WHEN kind = 3 THEN 'failed' ELSE 'pending' END FROM f WHERE kind IN (2, 3)
      UNION ALL SELECT 3, name, n, 'superseded' FROM f WHERE kind = 3
      UNION ALL SELECT 4, name, n, 'pending' FROM f WHERE kind = 2)
SELECT name AS location_name, outcome, count(*) AS n,
  CAST(sum(CASE WHEN outcome = 'ok' AND name IS NOT NULL THEN n ELSE 0 END) AS BIGINT) AS good, CAST(run AS INTEGER) AS run
FROM r GROUP BY ALL""",

    "run_quarantine_report": f"""
WITH x AS (SELECT event_type AS t, (value >= 300 OR {K} >= 98) AS bad FROM events WHERE event_type <> 'error')
SELECT 'report' AS part, CAST(NULL AS VARCHAR) AS location_name, count(*) FILTER (coalesce(bad, false)) AS records,
  count(*) FILTER (NOT coalesce(bad, false)) AS written FROM x
UNION ALL SELECT 'rejected', t, count(*), 0 FROM x WHERE bad GROUP BY t""",

    "payload_bytes": """
SELECT doc_id, CASE WHEN text IS NULL THEN 'Empty response body'
  WHEN regexp_matches(text, '^[ \\t\\n\\x0B\\f\\r]*\\[') THEN chr(39) || 'list' || chr(39) || ' object has no attribute ' || chr(39) || 'get' || chr(39)
  ELSE 'Invalid JSON body' END AS error, CAST(strlen(text) AS INTEGER) AS body_bytes FROM documents""",

    "list_bodies": """
SELECT o_orderkey, 'single' AS mode, CASE WHEN o_orderkey % 3 < 2 THEN chr(39) || 'list' || chr(39) || ' object has no attribute ' || chr(39) || 'get' || chr(39)
  ELSE 'API Error: r' END AS error FROM orders
UNION ALL SELECT o_orderkey, 'multi', CASE WHEN o_orderkey % 3 = 0 THEN 'Empty list body'
  ELSE 'No location for list element' END FROM orders""",

    "ingestion_metadata": """
SELECT source AS location_name, TIMESTAMP '2024-01-30 12:00:00' AS ingestion_timestamp_utc,
  'docs://' || CAST(doc_id AS VARCHAR) AS request_url, CAST(n_chars AS DOUBLE) AS elapsed_ms,
  CAST(200 AS INTEGER) AS status_code, CAST(strlen(text) AS INTEGER) AS response_size_bytes FROM documents""",

    "partitioned_write_hourly_by_location": f"SELECT {_hourly_two_runs()} FROM events",

    "partitioned_write_daily_by_location": _daily_flag_runs(),

    "daily_replace_missing_location": _daily_flag_runs().replace(
        "WHERE NOT early OR NOT EXISTS (",
        "WHERE CASE WHEN location_name = 'FR' THEN early ELSE NOT early OR NOT EXISTS (") + " END",

    "write_report_escaped_ids": f"""
WITH r AS (SELECT event_type AS location_name, strftime({DAY}, '%Y-%m-%d') || CASE WHEN hour(ts) < 12 THEN 'T00:00' ELSE 'T12:00' END
    || ' #{{a,b}}' AS run_id FROM events),
g AS (SELECT location_name, run_id, count(*) AS records_written FROM r GROUP BY ALL)
SELECT *, 'all' AS scope FROM g
UNION ALL SELECT *, 'first two' FROM g WHERE run_id IN (SELECT DISTINCT run_id FROM r ORDER BY 1 LIMIT 2)""",

    "inferred_interval_write": """
SELECT 'hourly' AS interval, event_type AS location_name, count(*) AS records FROM events GROUP BY ALL
UNION ALL SELECT 'daily', 'F' || l_returnflag, count(*) FROM lineitem GROUP BY ALL""",

    "get_or_create_state": """
WITH u AS (SELECT 'user-' || CAST(user_id AS VARCHAR) AS name, event_type, value,
    row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events)
SELECT name AS location_name, CASE WHEN event_type = 'error' THEN 'failure' ELSE 'success' END AS last_fetch_status,
  CAST(CASE WHEN event_type = 'error' THEN 0 ELSE floor(value) END AS INTEGER) AS records_fetched, false AS is_new
FROM u WHERE rn = 1
UNION ALL SELECT name || '-new', 'success', 0, true FROM u WHERE rn = 1""",

    "gates": """
WITH u AS (SELECT user_id, event_type, value, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events),
t AS (SELECT CAST(sum(CASE WHEN event_type = 'error' THEN 0 ELSE floor(value) END) AS BIGINT) AS n FROM u WHERE rn = 1)
SELECT 'nulls' AS gate, CAST(2 * count(*) - count(event_type) - count(ts) + count(*) AS BIGINT) AS figure,
  3 * count(*) - count(event_type) - count(ts) = 0 AS passed FROM events
UNION ALL SELECT 'records', n, n > 0 FROM t""",

    "discover_variables": """
SELECT DISTINCT unnest(['precipitation', 'temperature_2m', 'weathercode',
  CASE WHEN event_type = 'purchase' THEN 'cloud_cover' ELSE 'cloudcover' END]) AS variable
FROM events WHERE event_type <> 'error'""",

    "location_file": f"""
WITH l AS (SELECT DISTINCT event_type AS name, {LAT} AS latitude, {LON} AS longitude FROM events)
SELECT *, 'json' AS format FROM l UNION ALL SELECT *, 'csv' FROM l""",

    "flatten_dynamic_daily": f"""
SELECT CAST(o_orderdate AS TIMESTAMP) AS "date", max(o_totalprice) / {D.format(1000.0)} AS temperature_2m_max,
  min(o_totalprice) / {D.format(1000.0)} AS temperature_2m_min, CAST(count(*) AS DOUBLE) AS precipitation_sum,
  o_orderpriority AS location_name
FROM orders GROUP BY o_orderpriority, o_orderdate""",

    "incremental_small_batches": f"SELECT {hourly_cols(with_run=False)} FROM events WHERE event_type <> 'error'",

    "incremental_two_streams": f"SELECT {hourly_cols(with_run=False)} FROM events WHERE event_type <> 'error'",

    "incremental_ingest": f"SELECT {hourly_cols(with_run=False)} FROM events WHERE event_type <> 'error'",

    "state_after_run": f"""
WITH {_O},
ends AS (
  SELECT location_name, endd FROM (
    SELECT *, row_number() OVER (PARTITION BY location_name ORDER BY ts DESC, event_id DESC) AS rn
    FROM o WHERE ok AND endd <> '') WHERE rn = 1)
SELECT 'open_meteo' AS provider, 'hourly' AS "interval", last.location_name,
  last.ts AS last_fetch_timestamp,
  CASE WHEN ok THEN 'success' ELSE 'failure' END AS last_fetch_status,
  CASE WHEN ok THEN NULL ELSE 'API Error: failure ' || CAST(event_id AS VARCHAR) END AS last_fetch_error,
  CASE WHEN ok THEN rec ELSE 0 END AS records_fetched, ends.endd AS forecast_end_date
FROM last LEFT JOIN ends ON last.location_name = ends.location_name""",

    "state_freshness": f"""
WITH {_O}
SELECT location_name, CASE WHEN ok THEN 'success' ELSE 'failure' END AS last_fetch_status,
  {FRESH} AS is_fresh
FROM last""",

    "stale_locations": f"""
WITH {_O}
SELECT location_name AS name FROM last WHERE NOT {FRESH}""",

    "records_gate_total": f"""
WITH {_O}
SELECT CAST(COALESCE(SUM(CASE WHEN ok THEN rec ELSE 0 END), 0) AS BIGINT) AS total_records FROM last""",

    "attempt_resolution": f"""
WITH {_ATTEMPTS},
g AS (
  SELECT location_name, request_date, COUNT(*) AS attempts_seen,
    MIN(CASE WHEN term THEN attempt * 1000000000000 + event_id END) AS best
  FROM t GROUP BY 1, 2)
SELECT g.location_name, g.request_date, t.attempt AS final_attempt,
  CASE WHEN g.best IS NULL THEN 'pending' WHEN t.cls IS NULL THEN 'success' ELSE 'failed' END AS final_status,
  t.cls AS error_class, g.attempts_seen
FROM g LEFT JOIN t ON t.location_name = g.location_name AND t.request_date = g.request_date
  AND t.attempt * 1000000000000 + t.event_id = g.best""",

    "backoff_schedule": f"""
WITH {_ATTEMPTS}
SELECT location_name, event_id, attempt,
  CASE WHEN attempt < 3 THEN power({D.format(2.0)}, attempt - 1) END AS wait_seconds
FROM l""",
}

ORACLES["run_daily_refetch"] = (
    ORACLES["flatten_daily"]
    .replace("make_timestamp(year(\"date\"), 1, 1, 0, 0, 0) AS ingestion_timestamp_utc",
             "make_timestamp(year(\"date\"), 1, 1, CASE WHEN location_name = '1-URGENT' THEN 0 ELSE 6 END, 0, 0)"
             " AS ingestion_timestamp_utc")
    .replace(",\n  'run-' || CAST(year(\"date\") AS VARCHAR) AS run_id", ""))

ORACLES["duplicates_eliminated"] = ORACLES["duplicates"]
ORACLES["completeness_bitmaps"] = ORACLES["completeness"]
ORACLES["completeness_rollup"] = (
    "SELECT location_name, count(*) AS record_count, count(DISTINCT \"date\") AS unique_dates FROM ("
    + _daily_flag_runs() + ") GROUP BY location_name")
ORACLES["ingestion_span_rollup"] = (
    "SELECT min(ingestion_timestamp_utc) AS earliest_ingest, max(ingestion_timestamp_utc) AS latest_ingest, "
    "count(DISTINCT ingestion_timestamp_utc) AS unique_ingest_times FROM (" + _daily_flag_runs() + ")")

ORACLES["flatten_discovered"] = ORACLES["flatten_dynamic"]
ORACLES["raw_bodies"] = """
SELECT doc_id, CAST(strlen(coalesce(text, '')) + 1 AS BIGINT) AS body_bytes, md5(coalesce(text, '') || chr(10)) AS body_md5
FROM documents"""
ORACLES["body_keys"] = f"""
WITH g AS (SELECT DISTINCT event_type AS t, {DAY} AS d, {CHUNK} AS c FROM events WHERE event_type <> 'error'),
k AS (SELECT unnest([{{'key': 'latitude', 'kind': 'NUMBER'}}, {{'key': 'longitude', 'kind': 'NUMBER'}}, {{'key': 'elevation', 'kind': 'NUMBER'}},
  {{'key': 'generationtime_ms', 'kind': 'NUMBER'}}, {{'key': 'utc_offset_seconds', 'kind': 'NUMBER'}}, {{'key': 'timezone', 'kind': 'STRING'}},
  {{'key': 'hourly', 'kind': 'OBJECT'}}, {{'key': 'hourly_units', 'kind': 'OBJECT'}}, {{'key': 'current', 'kind': 'OBJECT'}}]) AS e)
SELECT e.key AS key, e.kind AS kind, count(*) AS bodies FROM g, k
WHERE e.key <> 'timezone' OR t <> 'view' GROUP BY ALL"""

_ENDS = '"date", location_name, temperature_2m_max, temperature_2m_min, precipitation_sum'
ORACLES["lake_tail"] = (
    f"WITH lake AS ({_daily_flag_runs()}) SELECT * FROM (SELECT {_ENDS}, 'tail' AS part FROM lake ORDER BY "
    + ", ".join(f"{c.strip()} DESC NULLS LAST" for c in _ENDS.split(",")) + " LIMIT 25) "
    f"UNION ALL SELECT * FROM (SELECT {_ENDS}, 'head' AS part FROM lake ORDER BY "
    + ", ".join(f"{c.strip()} NULLS LAST" for c in _ENDS.split(",")) + " LIMIT 25)")

_FORECASTS = """f AS (
  SELECT o_orderpriority AS location_name, CAST(o_orderdate AS TIMESTAMP) AS "date", o_totalprice / CAST(1000 AS DOUBLE) AS temperature_2m_max,
    CAST(o_orderdate AS TIMESTAMP) - to_days(CAST(o_orderkey % 10 AS INTEGER)) - to_hours(o_custkey % 24) AS ingestion_timestamp_utc,
    'run-' || lpad(CAST(o_orderkey AS VARCHAR), 12, '0') AS run_id FROM orders)"""
_LATEST = 'QUALIFY row_number() OVER (PARTITION BY location_name, "date" ORDER BY ingestion_timestamp_utc DESC, run_id DESC) = 1'
ORACLES["latest_forecast"] = f"WITH {_FORECASTS} SELECT * FROM f {_LATEST}"
ORACLES["forecast_as_of"] = f"WITH {_FORECASTS} SELECT * FROM f WHERE ingestion_timestamp_utc <= TIMESTAMP '1995-01-01' {_LATEST}"
ORACLES["lead_time_accuracy"] = f"""
WITH {_FORECASTS}, t AS (SELECT * FROM f {_LATEST}),
e AS (
  SELECT CAST(floor((epoch(f."date") - epoch(f.ingestion_timestamp_utc)) / 86400) * 24 AS BIGINT) AS lead_hours,
    CAST(f.temperature_2m_max AS DECIMAL(18,6)) - CAST(t.temperature_2m_max AS DECIMAL(18,6)) AS e
  FROM f JOIN t USING (location_name, "date") WHERE f.run_id <> t.run_id)
SELECT lead_hours, count(*) AS n, CAST(sum(e) AS DOUBLE) / count(*) AS bias, CAST(sum(abs(e)) AS DOUBLE) / count(*) AS mae,
  sqrt(CAST(sum(CAST(e AS DECIMAL(18,6)) * CAST(e AS DECIMAL(18,6))) AS DOUBLE) / count(*)) AS rmse
FROM e GROUP BY lead_hours"""
