"""Dynamic flatten that discovers its variables, and raw body files."""

import json
import os
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from forecastlake.operators import dynamic as dy
from forecastlake.plans.run import run_batch
from forecastlake.sources.lake import read_lake
from forecastlake.sources.responses import bodies_to_responses, locations_df, read_bodies
from tests.conftest import SAMPLE_BODY, response_row, responses


def _body(**hourly):
    return {**{k: v for k, v in SAMPLE_BODY.items() if k != "hourly"}, "hourly": hourly}


TIMES = ["2031-03-07T00:00", "2031-03-07T01:00", "2031-03-07T02:00+02:00"]


def test_variables_and_types_come_from_all_bodies(spark, tmp_dir):
    rows = [
        response_row(_body(time=TIMES, rain=[1, 2.5, None], day=[True, False, True], sky=["clear", "fog", None])),
        response_row(_body(time=TIMES[:2], rain=[3], soil_0cm=[None, None, None]), location=("Ridge", 1.0, 2.0)),
        response_row(_body(time=TIMES[:1], rain=["4.5"], **{"it's \"odd\".x": [7]}), location=(None, 3.0, 4.0)),
        response_row(_body(time=TIMES[:1], flag=5, mixed=[1]), location=("Dunes", 5.0, 6.0)),
        response_row(_body(time=TIMES[:1], mixed=["a"]), location=("Cape", 7.0, 8.0)),
        response_row("garbage", location=("bad", 0.0, 0.0)),
    ]
    staged = dy.stage_variants(responses(spark, rows), f"{tmp_dir}/staged")
    found = dy.discovered_variables(staged, "hourly")
    # Arrays only: ``flag`` is a number. Text that reads as a number makes the column text.
    assert found == {"day": "boolean", "it's \"odd\".x": "double", "mixed": "string", "rain": "string", "sky": "string",
                     "soil_0cm": "double"}
    flat = dy.flatten_discovered(staged, "hourly")
    assert flat.columns[:7] == ["time", *found]
    got = {(r["location_name"], r["time"].hour): r for r in flat.collect()}
    assert len(got) == 8, sorted(got)
    assert (got["Harbour", 2]["day"], got["Harbour", 1]["sky"], got["Harbour", 1]["rain"], got["Harbour", 2]["rain"]) == (True, "fog", "2.5", None)
    assert got["Ridge", 1]["rain"] is None and got["Ridge", 0]["rain"] == "3"       # past its array's end
    assert got["3.0,4.0", 0]["it's \"odd\".x"] == 7.0
    assert (got["Dunes", 0]["mixed"], got["Cape", 0]["mixed"]) == ("1", "a")
    # A declared type: what doesn't fit is null, the row stays.
    typed = dy.flatten_discovered(staged, "hourly", {"rain": "double", "flag": "double"})
    got = {(r["location_name"], r["time"].hour): (r["rain"], r["flag"]) for r in typed.collect()}
    assert got["Harbour", 1] == (2.5, None) and got["3.0,4.0", 0] == (4.5, None) and got["Dunes", 0] == (None, None)


def test_staging_keeps_every_block(spark, tmp_dir):
    body = {**SAMPLE_BODY, "minutely_15": {"time": ["2031-03-07T00:00"], "gust": [3]}}
    staged = dy.stage_variants(responses(spark, [response_row(body)]), f"{tmp_dir}/staged")
    assert [f.name for f in dy.block_schema(staged, "minutely_15").fields] == ["gust", "time"]
    keys = {r["key"]: r["kind"] for r in dy.top_level_shape(staged).collect()}
    assert keys["minutely_15"] == "OBJECT" and keys["latitude"] == "NUMBER" and keys["timezone"] == "STRING"
    plan = dy.flatten_discovered(staged, "hourly")._jdf.queryExecution().executedPlan().toString()
    assert "json" not in plan and "Exchange" not in plan         # parsed once, before


def test_no_bodies_and_too_many_variables(spark, tmp_dir, monkeypatch):
    staged = dy.stage_variants(responses(spark, [response_row("garbage")]), f"{tmp_dir}/none")
    assert dy.discovered_variables(staged, "hourly") == {} and dy.flatten_discovered(staged, "hourly").count() == 0
    staged = dy.stage_variants(responses(spark, [response_row(_body(time=TIMES[:1], a=[1], b=[2]))]), f"{tmp_dir}/some")
    monkeypatch.setattr(dy, "MAX_VARIABLES", 2)
    with pytest.raises(ValueError):
        dy.discovered_variables(staged, "hourly")


def test_raw_body_files_become_responses(spark, tmp_dir):
    local = tmp_dir.replace("file://", "").replace("file:", "")
    texts = {"Harbour/2031-03-07.json": json.dumps(SAMPLE_BODY).encode(), "Ridge+1 é/a b.json": json.dumps(SAMPLE_BODY, indent=1).encode(),
             "Dunes/x.json": b"{\"error\": true, \"reason\": \"r\"}", "Cape/y.json": b"\xff\xfe{", "Reef/empty.json": b"",
             "Harbour/notes.txt": b"not a body"}
    for name, data in texts.items():
        os.makedirs(os.path.dirname(f"{local}/land/{name}"), exist_ok=True)
        with open(f"{local}/land/{name}", "wb") as f:
            f.write(data)
        os.utime(f"{local}/land/{name}", (1_930_000_000, 1_930_000_000))
    bodies = read_bodies(spark, f"{tmp_dir}/land", glob="*.json")
    got = {r["path"].split("/land/")[1]: (r["body_bytes"], r["body"]) for r in bodies.collect()}
    assert set(got) == {n for n in texts if n.endswith(".json") and texts[n]}
    for name, (size, body) in got.items():
        assert size == len(texts[name]) and body == (None if name.startswith("Cape") else texts[name].decode())
    locations = locations_df(spark, [("Harbour", 47.25, 8.625), ("Ridge+1 é", 1.0, 2.0), ("Dunes", 3.0, 4.0)])
    rows = bodies_to_responses(bodies, locations, interval="daily", provider="open_meteo")
    zone = spark.conf.get("spark.sql.session.timeZone")
    for other in ("America/Los_Angeles", zone):
        spark.conf.set("spark.sql.session.timeZone", other)
        assert {r["ingestion_timestamp_utc"] for r in rows.collect()} == {datetime(1970, 1, 1) + timedelta(seconds=1_930_000_000)}
    res = run_batch(spark, rows, interval="daily", base_path=f"{tmp_dir}/lake")
    outcome = {r["location"]["name"]: (r["outcome"], r["error"]) for r in res.resolved.collect()}
    assert outcome == {"Harbour": ("ok", None), "Ridge+1 é": ("ok", None), "Dunes": ("failed", "API Error: r"),
                       "Cape": ("failed", "Empty response body")}
    lake = read_lake(spark, f"{tmp_dir}/lake", "daily", provider="open_meteo")
    assert {(r["location_name"], r["requested_latitude"]) for r in lake.collect()} == {("Harbour", 47.25), ("Ridge+1 é", 1.0)}
    assert lake.filter(F.col("temperature_2m_max").isNotNull()).count() == 4
