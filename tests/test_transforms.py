"""Flattening and classification."""

import copy
from datetime import datetime

from pyspark.sql import functions as F

from forecastlake.operators import flatten as fl
from forecastlake.operators.parse import parse_responses, split_ok_failed
from forecastlake.operators.validate import check_rows
from forecastlake.schemas import DAILY, HOURLY
from tests.conftest import SAMPLE_BODY, response_row, responses


def _types(schema):
    return [(f.name, f.dataType) for f in schema.fields]


def _flat(spark, body, interval="hourly", **kw):
    ok, failed = split_ok_failed(parse_responses(responses(spark, [response_row(body, interval=interval, **kw)])))
    return fl.flatten_series(ok, interval), failed


def test_transform_daily(spark):
    rows, failed = _flat(spark, SAMPLE_BODY, "daily")
    good, bad = check_rows(rows)
    assert failed.count() == 0 and bad.count() == 0
    assert _types(good.schema) == _types(DAILY)
    got = good.orderBy("date").collect()
    assert len(got) == 2
    assert got[0]["date"] == datetime(2031, 3, 7) and got[1]["temperature_2m_max"] == 19.75
    assert all(r["location_name"] == "Harbour" and r["run_id"] == "test-1" for r in got)
    assert got[0]["api_latitude"] == 47.25 and got[0]["source_api"] == "open-meteo"


def test_transform_hourly(spark):
    good, _ = check_rows(_flat(spark, SAMPLE_BODY)[0])
    assert _types(good.schema) == _types(HOURLY)
    got = good.orderBy("timestamp").collect()
    assert len(got) == 2
    assert got[1]["timestamp"] == datetime(2031, 3, 7, 1, 0) and got[1]["precipitation"] == 0.1
    # absent variables are typed NULLs
    assert got[0]["relative_humidity_2m"] is None and got[0]["weather_code"] is None


def _hourly_body(**series):
    b = copy.deepcopy(SAMPLE_BODY)
    b.pop("daily")
    b["hourly"] = {"time": ["2031-03-07T00:00", "2031-03-07T01:00", "2031-03-07T02:00"], **series}
    return b


def test_short_and_long_arrays(spark):
    rows, _ = _flat(spark, _hourly_body(temperature_2m=[1.0, 2.0], precipitation=[0.0, 0.1, 0.2, 9.9]))
    good, bad = check_rows(rows)
    assert good.count() == 2 and bad.count() == 1
    b = bad.collect()[0]
    assert b["temperature_2m"] is None and b["precipitation"] == 0.2
    assert b["errors"] == ["short_array:temperature_2m"]


def test_absent_and_null_arrays_and_bad_cell(spark):
    body = _hourly_body(temperature_2m=None, precipitation=[0.0, "x", 1.0])
    good, bad = check_rows(_flat(spark, body)[0])
    assert good.count() == 2
    assert [r["errors"] for r in bad.collect()] == [["bad_value:precipitation"]]
    assert all(r["temperature_2m"] is None for r in good.collect())


def test_weather_code_integrality_and_spellings(spark):
    body = _hourly_body(weathercode=[61.0, 61.5, "3"], cloud_cover=[10, 20, 30],
                        wind_speed_10m=[1.5, 2.5, 3.5])
    good, bad = check_rows(_flat(spark, body)[0])
    g = good.orderBy("timestamp").collect()
    assert [r["weather_code"] for r in g] == [61, 3]
    assert [r["cloud_cover"] for r in g] == [10.0, 30.0]
    assert g[0]["windspeed_10m"] == 1.5
    assert bad.collect()[0]["errors"] == ["bad_weather_code"]
    # older spelling wins when both are present
    both = _hourly_body(cloudcover=[1, 1, 1], cloud_cover=[2, 2, 2])
    assert {r["cloud_cover"] for r in _flat(spark, both)[0].collect()} == {1.0}


def test_offsets_dropped_without_conversion(spark):
    b = copy.deepcopy(SAMPLE_BODY)
    b["hourly"] = {"time": ["2031-03-07T01:00+02:00", "2031-03-07T02:00:30Z", "2031-03-07T03:00:00-0530",
                            "20310307"],
                   "temperature_2m": [1, 2, 3, 4]}
    good, bad = check_rows(_flat(spark, b)[0])
    ts = sorted(r["timestamp"] for r in good.collect())
    assert ts == [datetime(2031, 3, 7, 1, 0), datetime(2031, 3, 7, 2, 0, 30), datetime(2031, 3, 7, 3, 0)]
    assert bad.collect()[0]["errors"] == ["bad_time"]


def test_empty_time_gives_no_rows(spark):
    rows, failed = _flat(spark, _hourly_body())
    b = _hourly_body()
    b["hourly"] = {"time": []}
    rows, failed = _flat(spark, b)
    assert rows.count() == 0 and failed.count() == 0


def test_failure_classification(spark):
    ok_body = _hourly_body(temperature_2m=[1, 2, 3])
    no_offset = copy.deepcopy(ok_body)
    no_offset.pop("utc_offset_seconds")
    bad_meta = copy.deepcopy(ok_body)
    bad_meta["latitude"] = "north"
    no_block = copy.deepcopy(ok_body)
    no_block.pop("hourly")
    rows = [
        response_row({"error": True, "reason": "Invalid lat"}, location=("A", 1.0, 1.0)),
        response_row("not json", location=("B", 1.0, 1.0)),
        response_row(None, location=("C", 1.0, 1.0), transport_error="ConnectTimeout", error_class="timeout"),
        response_row(no_offset, location=("D", 1.0, 1.0)),
        response_row(bad_meta, location=("E", 1.0, 1.0)),
        response_row(no_block, location=("F", 1.0, 1.0)),
        response_row([ok_body, ok_body], location=("G", 1.0, 1.0)),
        response_row({**ok_body, "error": False}, location=("H", 1.0, 1.0)),
        response_row({**ok_body, "timezone": "UTC"}, location=("I", 1.0, 1.0)),
    ]
    parsed = parse_responses(responses(spark, rows))
    ok, failed = split_ok_failed(parsed)
    errs = {r["location"]["name"]: r["error"] for r in failed.collect()}
    assert errs == {
        "A": "API Error: Invalid lat",
        "B": "Invalid JSON body",
        "C": "ConnectTimeout",
        "D": "'utc_offset_seconds'",
        "E": "Invalid API metadata: latitude",
        "F": "Missing block: hourly",
        "G": "'list' object has no attribute 'get'",
    }
    okr = {r["location"]["name"]: r for r in ok.collect()}
    assert set(okr) == {"H", "I"}
    assert okr["I"]["api_timezone"] == "GMT" and okr["H"]["api_timezone"] == "GMT"
    assert all(r["status"] == "failed" for r in failed.collect())


def test_multi_location_body(spark):
    a = _hourly_body(temperature_2m=[1, 2, 3])
    b = copy.deepcopy(a)
    b["latitude"] = 35.6
    row = list(response_row([a, b]))
    df = responses(spark, [tuple(row)]).withColumn("locations", F.array(
        F.struct(F.lit("Harbour").alias("name"), F.lit(51.5).alias("latitude"), F.lit(-0.1).alias("longitude")),
        F.struct(F.lit("Ridge").alias("name"), F.lit(35.7).alias("latitude"), F.lit(139.7).alias("longitude"))))
    ok, failed = split_ok_failed(parse_responses(df, multi_location=True))
    assert failed.count() == 0
    flat = fl.flatten_hourly(ok)
    counts = {r["location_name"]: r["count"] for r in flat.groupBy("location_name").count().collect()}
    assert counts == {"Harbour": 3, "Ridge": 3}
    tokyo = flat.filter("location_name = 'Ridge'").select("api_latitude", "requested_latitude").first()
    assert tokyo["api_latitude"] == 35.6 and tokyo["requested_latitude"] == 35.7


def test_dynamic_flatten_name_fallback(spark):
    body = _hourly_body(temperature_2m=[1, 2, 3], uv_index=[0, 1, 2])
    df = responses(spark, [response_row(body, location=(None, 51.5, -0.12))])
    ok, _ = split_ok_failed(parse_responses(df))
    out = fl.flatten_dynamic(ok, "hourly", ["temperature_2m", "uv_index"])
    assert out.columns[:3] == ["time", "temperature_2m", "uv_index"]
    r = out.first()
    assert r["location_name"] == "51.5,-0.12" and r["ingestion_timestamp_utc"] == "2031-03-07T12:00:00"
    daily = fl.flatten_dynamic(split_ok_failed(parse_responses(responses(
        spark, [response_row(SAMPLE_BODY, interval="daily")])))[0], "daily", ["temperature_2m_max"])
    assert "date" in daily.columns and "request_elapsed_ms" in daily.columns


def test_profile_shape_and_end(spark):
    body = _hourly_body(temperature_2m=[5, 6, 7], cloud_cover=[1, 2, 3])
    body["hourly_units"] = {"temperature_2m": "°C"}
    df = responses(spark, [response_row(body)])
    parsed = parse_responses(df).withColumn("location_name", F.col("location.name"))
    ok, _ = split_ok_failed(parsed)
    prof = {r["variable"]: (r["first_value"], r["unit"]) for r in
            fl.variable_profile(ok, "hourly", ["location_name"]).collect()}
    assert prof == {"temperature_2m": (5.0, "°C"), "cloud_cover": (1.0, "N/A")}
    shape = fl.payload_shape(parsed, "hourly", ["location_name"]).first()
    assert shape["n_points"] == 3 and shape["n_variables"] == 2 and shape["n_locations"] == 1
    assert shape["body_bytes"] > 0
    # daily wins whenever it is non-empty, even in an hourly run
    both = responses(spark, [response_row(SAMPLE_BODY)])
    ok2, _ = split_ok_failed(parse_responses(both).withColumn("location_name", F.col("location.name")))
    assert fl.forecast_end(ok2, ["location_name"]).first()["forecast_end_date"] == "2031-03-08"
    pairs = fl.leading_pairs(ok2, "daily", "temperature_2m_max", 1, ["location_name"]).collect()
    assert [(p["time_text"], p["value"]) for p in pairs] == [("2031-03-07", 21.5)]


def test_sources_dimension_schema_and_landed_json(spark, tmp_dir):
    from forecastlake.sources.responses import (
        attach_locations, locations_df, read_responses, schema_rows,
    )
    locs = locations_df(spark, [("Harbour", 47.25, 8.625), ("Ridge", -12.5, 130.875)])
    rows = schema_rows(spark, locs).collect()
    assert [(r["column_name"], r["data_type"], r["ordinal"]) for r in rows] == [
        ("name", "string", 0), ("latitude", "double", 1), ("longitude", "double", 2)]
    responses(spark, [response_row(SAMPLE_BODY, location=("Ridge", 0.0, 0.0))]).write.json(tmp_dir)
    landed = read_responses(spark, tmp_dir)
    named = landed.withColumn("location_name", F.col("location.name"))
    got = attach_locations(named, locs).select("location.latitude").first()[0]
    assert got == -12.5


def test_locations_from_files(spark, tmp_dir):
    from forecastlake.sources.responses import locations_df, read_locations

    rows = locations_df(spark, [("Harbour", 47.25, 8.625), ("Ridge", -12.5, 130.875)])
    for fmt in ("json", "csv"):
        rows.write.format(fmt).option("header", "true").save(f"{tmp_dir}/{fmt}")
        assert sorted(map(tuple, read_locations(spark, f"{tmp_dir}/{fmt}", fmt=fmt).collect())) == sorted(map(tuple, rows.collect()))


def test_list_bodies(spark):
    one = '[{"error": true, "reason": "r"}]'
    df = responses(spark, [response_row(one), response_row(" \n []"), response_row("[")])
    assert sorted(str(r["error"]) for r in parse_responses(df).collect()) == [
        "'list' object has no attribute 'get'", "'list' object has no attribute 'get'", "Invalid JSON body"]
    multi = parse_responses(df, multi_location=True)
    assert sorted(str(r["error"]) for r in multi.collect()) == ["API Error: r", "Empty list body", "Invalid JSON body"]
