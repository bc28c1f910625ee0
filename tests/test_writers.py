"""Lake sinks and scans."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from forecastlake.schemas import DAILY, HOURLY
from forecastlake.sinks.lake import write_forecasts, write_single
from forecastlake.sinks.reports import write_report
from forecastlake.sources.lake import lake_path_columns, read_lake


def _daily_rows(spark, names, run_id, ingest, tmax=10.5):
    rows = [(n, 51.5, -0.12, 51.5, -0.12, datetime(2031, 3, 7), tmax, 5.2, 0.0, "open-meteo", ingest, run_id)
            for n in names]
    return spark.createDataFrame(rows, DAILY)


def _hourly_rows(spark, names, run_id, ingest):
    rows = [(n, 1.0, 2.0, 1.0, 2.0, datetime(2031, 3, 7, h), 5.0 + h, 0.1, None, None, None, None, 3,
             "open-meteo", ingest, run_id) for n in names for h in range(3)]
    return spark.createDataFrame(rows, HOURLY)


def test_single_write_round_trip(spark, tmp_dir):
    df = spark.createDataFrame([("Harbour", "2031-03-07", 10.5, 5.2, "test-1")],
                               "location_name string, date string, temperature_2m_max double, "
                               "temperature_2m_min double, run_id string")
    rep = write_single(df, f"{tmp_dir}/open_meteo/daily/x.parquet", compression="zstd").first()
    assert rep["records_written"] == 1 and rep["format"] == "parquet"
    assert "open_meteo" in rep["path"] and "daily" in rep["path"]
    back = spark.read.parquet(rep["path"]).collect()
    assert [tuple(r) for r in back] == [("Harbour", "2031-03-07", 10.5, 5.2, "test-1")]


def test_daily_replace_keeps_other_locations(spark, tmp_dir):
    i1, i2 = datetime(2031, 3, 7, 2), datetime(2031, 3, 7, 14)
    write_forecasts(_daily_rows(spark, ["Harbour", "North Pier", "A/B", "123"], "r1", i1), tmp_dir,
                    interval="daily", provider="open_meteo")
    write_forecasts(_daily_rows(spark, ["Harbour"], "r2", i2, tmax=99.0), tmp_dir,
                    interval="daily", provider="open_meteo")
    lake = read_lake(spark, tmp_dir, "daily", provider="open_meteo")
    got = {r["location_name"]: (r["run_id"], r["temperature_2m_max"]) for r in lake.collect()}
    assert got == {"Harbour": ("r2", 99.0), "North Pier": ("r1", 10.5), "A/B": ("r1", 10.5), "123": ("r1", 10.5)}
    assert dict(lake.dtypes)["location_name"] == "string"
    assert lake.columns == DAILY.fieldNames()


def test_hourly_runs_append_and_retry_is_idempotent(spark, tmp_dir):
    i1, i2 = datetime(2031, 3, 7, 3), datetime(2031, 3, 7, 6)
    for run, ing in (("r1", i1), ("r2", i2), ("r2", i2)):
        write_forecasts(_hourly_rows(spark, ["Harbour", "Ridge"], run, ing), tmp_dir,
                        interval="hourly", provider="open_meteo", compression="gzip")
    lake = read_lake(spark, tmp_dir, "hourly", provider="open_meteo")
    assert lake.count() == 12
    rep = {(r["location_name"], r["run_id"]): (r["path"], r["records_written"])
           for r in write_report(spark, tmp_dir, interval="hourly", provider="open_meteo").collect()}
    assert rep[("Harbour", "r2")] == ("open_meteo/hourly/Harbour/2031/03/07/forecast_20310307_06h_r2.parquet", 3)
    paths = lake_path_columns(spark.read.schema(
        read_lake(spark, tmp_dir, "hourly", provider="open_meteo", with_partitions=True).schema)
        .option("basePath", tmp_dir).parquet(tmp_dir))
    assert {(r["path_provider"], str(r["path_date"])) for r in paths.collect()} == {("open_meteo", "2031-03-07")}


def test_single_batch_daily_latest_run_wins(spark, tmp_dir):
    early = _daily_rows(spark, ["Harbour", "Dunes"], "r1", datetime(2031, 3, 7, 1))
    late = _daily_rows(spark, ["Harbour"], "r2", datetime(2031, 3, 7, 9), tmax=1.0)
    write_forecasts(early.unionByName(late), tmp_dir, interval="daily", provider="p")
    got = {(r["location_name"], r["run_id"]) for r in read_lake(spark, tmp_dir, "daily", provider="p").collect()}
    assert got == {("Harbour", "r2"), ("Dunes", "r1")}


def test_location_filter_prunes_partitions(spark, tmp_dir):
    write_forecasts(_daily_rows(spark, ["Harbour", "Ridge"], "r1", datetime(2031, 3, 7)), tmp_dir,
                    interval="daily", provider="open_meteo", layout="by_location")
    df = read_lake(spark, tmp_dir, "daily", provider="open_meteo").filter(F.col("location_name") == "Ridge")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(location_name" in plan
    assert df.count() == 1


def test_by_date_layout(spark, tmp_dir):
    write_forecasts(_daily_rows(spark, ["Harbour", "Ridge"], "r1", datetime(2031, 3, 7)), tmp_dir,
                    interval="daily", provider="p", layout="by_date")
    df = spark.read.parquet(f"{tmp_dir}/provider=p/interval=daily")
    assert "location_name" in df.columns and df.count() == 2


def test_interval_inferred_from_columns(spark, tmp_dir):
    from forecastlake.sinks.lake import infer_interval
    df = _daily_rows(spark, ["Harbour"], "r1", datetime(2031, 3, 7))
    assert infer_interval(df) == "daily"
    write_forecasts(df, tmp_dir, interval=None, provider="p")
    assert read_lake(spark, tmp_dir, "daily", provider="p").count() == 1


def test_run_scoped_read_lists_only_its_partitions(spark, tmp_dir):
    for day, run in ((7, "r1"), (8, "r2")):
        write_forecasts(_hourly_rows(spark, ["Harbour", "Ridge"], run, datetime(2031, 3, day, 3)), tmp_dir,
                        interval="hourly", provider="p")
    from datetime import date
    df = read_lake(spark, tmp_dir, "hourly", provider="p", ingest_dates=[date(2031, 3, 8)], run_ids=["r2"])
    assert {r["run_id"] for r in df.collect()} == {"r2"} and df.count() == 6
    assert "PartitionFilters: [ingest_date" in df._jdf.queryExecution().executedPlan().toString().replace("isnotnull(", "")
    none = read_lake(spark, tmp_dir, "hourly", provider="p", ingest_dates=[date(2030, 1, 1)])
    assert none.count() == 0


def test_read_legacy_tree(spark, tmp_dir):
    import os
    from datetime import date

    import pyarrow as pa
    import pyarrow.parquet as pq

    from forecastlake.sources.lake import read_legacy_tree

    root = tmp_dir.replace("file:", "")
    d = f"{root}/open_meteo/hourly/North Pier/2031/03/07"
    os.makedirs(d)
    t = pa.table({
        "location_name": ["North Pier"] * 2, "requested_latitude": [40.7, 40.7],
        "requested_longitude": [-74.0, -74.0], "api_latitude": [40.7, 40.7], "api_longitude": [-74.0, -74.0],
        "timestamp": pa.array([1736899200000000, 1736902800000000], pa.timestamp("us")),
        "temperature_2m": [1.5, 2.5], "precipitation": [0.0, 0.1], "relative_humidity_2m": pa.nulls(2),
        "windspeed_10m": pa.nulls(2), "wind_direction_10m": pa.nulls(2), "cloud_cover": pa.nulls(2),
        "weather_code": pa.array([61, None], pa.int64()), "source_api": ["open-meteo"] * 2,
        "ingestion_timestamp_utc": pa.array([1736910000000000] * 2, pa.timestamp("us")), "run_id": ["r1"] * 2})
    pq.write_table(t, f"{d}/forecast_20310307_03h_r1.parquet", compression="zstd")
    df = read_legacy_tree(spark, root, "hourly")
    rows = df.orderBy("timestamp").collect()
    assert [r["weather_code"] for r in rows] == [61, None]
    assert rows[0]["relative_humidity_2m"] is None and rows[1]["temperature_2m"] == 2.5
    assert rows[0]["path_location"] == "North Pier" and rows[0]["path_date"] == date(2031, 3, 7)
    assert dict(df.dtypes)["weather_code"] == "int"


def test_run_id_required_on_write(spark, tmp_dir):
    import pytest
    df = _hourly_rows(spark, ["Harbour"], None, datetime(2031, 3, 7))
    with pytest.raises(Exception, match="run_id is required"):
        write_forecasts(df, tmp_dir, interval="hourly", provider="p")


def test_catalog_table_registers_run_partitions_and_prunes(spark, tmp_dir):
    import uuid

    from forecastlake.plans.run import run_batch
    from forecastlake.sinks.catalog import read_lake_table
    from tests.conftest import SAMPLE_BODY, response_row, responses

    name = f"t_{uuid.uuid4().hex[:10]}"
    df = responses(spark, [response_row(SAMPLE_BODY), response_row(SAMPLE_BODY, location=("Ridge", 1.0, 2.0))])
    run_batch(spark, df, interval="hourly", base_path=tmp_dir, run_id="r1", table_name=name, layout="by_location")
    parts = sorted(r[0] for r in spark.sql(f"SHOW PARTITIONS {name}").collect())
    assert parts == ["location_name=Harbour/ingest_date=2031-03-07/run_id=r1",
                     "location_name=Ridge/ingest_date=2031-03-07/run_id=r1"]
    q = read_lake_table(spark, name, "hourly").filter(F.col("location_name") == "Ridge")
    assert q.count() == 2
    scan = [ln for ln in q._jdf.queryExecution().executedPlan().toString().splitlines() if "FileScan" in ln][0]
    assert "(1 paths)" in scan


def test_read_all_providers_of_one_interval(spark, tmp_dir):
    write_forecasts(_daily_rows(spark, ["Harbour"], "r1", datetime(2031, 3, 7)), tmp_dir,
                    interval="daily", provider="a")
    write_forecasts(_daily_rows(spark, ["Ridge"], "r1", datetime(2031, 3, 7)), tmp_dir,
                    interval="daily", provider="b")
    write_forecasts(_hourly_rows(spark, ["Dunes"], "r1", datetime(2031, 3, 7)), tmp_dir,
                    interval="hourly", provider="a")
    daily = read_lake(spark, tmp_dir, "daily", with_partitions=True)
    assert sorted((r["provider"], r["location_name"]) for r in daily.collect()) == [("a", "Harbour"), ("b", "Ridge")]
    assert read_lake(spark, tmp_dir + "/nothing", "daily").count() == 0


@pytest.mark.parametrize("layout", ["by_date", "by_location"])
def test_daily_run_that_lacks_a_location_keeps_it(spark, tmp_dir, layout):
    kw = dict(interval="daily", provider="p", layout=layout)
    write_forecasts(_daily_rows(spark, ["Harbour", "Ridge"], "r1", datetime(2031, 3, 7, 1)), tmp_dir, **kw)
    write_forecasts(_daily_rows(spark, ["Harbour"], "r2", datetime(2031, 3, 7, 9)), tmp_dir, **kw)
    got = {(r["location_name"], r["run_id"]) for r in read_lake(spark, tmp_dir, "daily", provider="p").collect()}
    assert got == {("Harbour", "r2"), ("Ridge", "r1")}


@pytest.mark.parametrize("run_id", ["nightly#1", "2031-03-07T00:00", "a,b {c} *", "50%"])
def test_report_of_run_ids_that_paths_escape(spark, tmp_dir, run_id):
    write_forecasts(_hourly_rows(spark, ["Harbour"], run_id, datetime(2031, 3, 7)), tmp_dir, interval="hourly", provider="p")
    rep = write_report(spark, tmp_dir, interval="hourly", provider="p", run_ids=[run_id]).collect()
    assert [(r["run_id"], r["records_written"]) for r in rep] == [(run_id, 3)]
