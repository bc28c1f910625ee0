"""The run manifest: daily replace resolved without aggregating the lake."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from forecastlake.plans.run import run_batch
from forecastlake.schemas import DAILY
from forecastlake.sinks.lake import write_forecasts
from forecastlake.sources.lake import latest_runs, read_lake
from forecastlake.sources.manifest import manifest_root, manifest_rows, read_manifest
from tests.conftest import SAMPLE_BODY, response_row, responses


def _rows(spark, names, run_id, ingest, days=2):
    return spark.createDataFrame(
        [(n, 1.0, 2.0, 1.0, 2.0, datetime(2031, 3, 7) + timedelta(days=d), 9.0, 1.0, 0.0, "open-meteo", ingest, run_id)
         for n in names for d in range(days)], DAILY)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _put(spark, base, *runs):
    for names, run, ingest in runs:
        write_forecasts(_rows(spark, names, run, ingest), base, interval="daily", provider="open_meteo")


DAY = datetime(2031, 3, 7)


def test_daily_read_scans_the_data_once_and_prunes(spark, tmp_dir):
    _put(spark, tmp_dir, ("AB", "r1", DAY + timedelta(hours=1)), ("AB", "r2", DAY + timedelta(hours=2)),
         ("B", "r3", DAY + timedelta(hours=3)), ("A", "r4", DAY + timedelta(days=1)))
    lake = read_lake(spark, tmp_dir, "daily", provider="open_meteo")
    plan = _plan(lake)
    data = [x for x in plan.splitlines() if "FileScan" in x and "temperature_2m_max" in x]
    assert len(data) == 1 and "HashAggregate" not in data[0]
    assert "dynamicpruning" in data[0] and "run_id" in data[0].split("PartitionFilters")[1].split("PushedFilters")[0]
    got = sorted((r["location_name"], r["run_id"]) for r in lake.distinct().collect())
    assert got == [("A", "r2")] * 2 + [("A", "r4")] * 2 + [("B", "r3")] * 2
    every = read_lake(spark, tmp_dir, "daily", provider="open_meteo", latest_only=False, with_partitions=True)
    assert every.count() == 12
    assert sorted(map(tuple, latest_runs(every).select(*lake.columns).collect())) == sorted(map(tuple, lake.collect()))
    one = read_lake(spark, tmp_dir, "daily", provider="open_meteo", ingest_dates=["2031-03-08"])
    assert {(r["location_name"], r["run_id"]) for r in one.collect()} == {("A", "r4")}
    assert read_lake(spark, tmp_dir, "daily").count() == lake.count()


def test_pruned_runs_are_not_read(spark, tmp_dir):
    """Files of runs that win nowhere are gone; the read doesn't notice."""
    import shutil

    _put(spark, tmp_dir, ("AB", "r1", DAY + timedelta(hours=1)), ("AB", "r2", DAY + timedelta(hours=2)))
    lake = read_lake(spark, tmp_dir, "daily", provider="open_meteo")
    lake.inputFiles()                                          # listed before they go
    local = tmp_dir.replace("file://", "").replace("file:", "")
    shutil.rmtree(f"{local}/provider=open_meteo/interval=daily/ingest_date=2031-03-07/run_id=r1")
    assert lake.count() == 4


def test_a_run_counts_once_its_manifest_is_there(spark, tmp_dir, monkeypatch):
    """A write that fails between data and manifest leaves the earlier run; its retry replaces it."""
    import forecastlake.sinks.lake as sink

    _put(spark, tmp_dir, ("A", "r1", DAY))
    real = sink.write_manifest
    monkeypatch.setattr(sink, "write_manifest", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        _put(spark, tmp_dir, ("A", "r2", DAY + timedelta(hours=1)))
    runs = lambda: {r["run_id"] for r in read_lake(spark, tmp_dir, "daily", provider="open_meteo").collect()}
    assert runs() == {"r1"}
    monkeypatch.setattr(sink, "write_manifest", real)
    _put(spark, tmp_dir, ("A", "r2", DAY + timedelta(hours=1)), ("A", "r2", DAY + timedelta(hours=1)))
    assert runs() == {"r2"}
    assert read_manifest(spark, tmp_dir, "daily", "open_meteo").count() == 2


def test_a_lake_without_a_manifest_is_adopted(spark, tmp_dir):
    """The first write to an older lake makes the manifest of all that it holds."""
    old = _rows(spark, "AB", "r1", DAY)
    old.withColumn("ingest_date", F.to_date("ingestion_timestamp_utc")).write.partitionBy("ingest_date", "run_id") \
        .parquet(f"{tmp_dir}/provider=open_meteo/interval=daily")
    assert read_lake(spark, tmp_dir, "daily", provider="open_meteo").count() == 4
    _put(spark, tmp_dir, ("B", "r2", DAY + timedelta(hours=1)))
    got = {(r["location_name"], r["run_id"]) for r in read_lake(spark, tmp_dir, "daily", provider="open_meteo").collect()}
    assert got == {("A", "r1"), ("B", "r2")}
    with pytest.raises(ValueError):
        write_forecasts(old, tmp_dir, interval="daily", provider="open_meteo", layout="by_location")


def test_a_runs_manifest_comes_from_its_responses(spark, tmp_dir):
    """``run_batch`` writes the rows that an aggregation over the lake would give."""
    rows = [response_row(SAMPLE_BODY, interval="daily", location=(n, 1.0, 2.0), run_id=c, ingest=DAY + timedelta(hours=h))
            for n, c, h in (("A", "c1", 1), ("A", "c2", 2), ("B", "c1", 1), ("C", "c3", 30))]
    run_batch(spark, responses(spark, rows), interval="daily", base_path=tmp_dir, run_id="r")
    lake = read_lake(spark, tmp_dir, "daily", provider="open_meteo", latest_only=False)
    want = manifest_rows(lake, "date")
    got = read_manifest(spark, tmp_dir, "daily", "open_meteo").select(*want.columns)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) and got.count() == 3
    assert manifest_root(tmp_dir, "open_meteo", "daily").endswith("/_manifest/provider=open_meteo/interval=daily")


def test_catalog_reads_use_the_manifest(spark, tmp_dir):
    from forecastlake.sinks.catalog import read_lake_table, write_lake_table

    spark.sql("DROP TABLE IF EXISTS manifest_lake")
    for run, h in (("r1", 1), ("r2", 2)):
        write_lake_table(spark, "manifest_lake", _rows(spark, "AB" if run == "r1" else "A", run, DAY + timedelta(hours=h)),
                         tmp_dir, interval="daily", provider="open_meteo")
    lake = read_lake_table(spark, "manifest_lake", "daily")
    assert sum("temperature_2m_max" in x for x in _plan(lake).splitlines() if "FileScan" in x) == 1
    assert {(r["location_name"], r["run_id"]) for r in lake.collect()} == {("A", "r2"), ("B", "r1")}
    spark.sql("DROP TABLE manifest_lake")


def test_tail_of_200_days_reads_the_last_ones(spark, tmp_dir):
    """One run a day, each reaching three days ahead: head and tail read a few runs, ties included."""
    from forecastlake.operators import quality as q
    from forecastlake.sources.lake import read_lake_end

    rows = [(n, 1.0, 2.0, 1.0, 2.0, DAY + timedelta(days=d + k), float(d), 1.0, 0.0, "open-meteo", DAY + timedelta(days=d), f"r{d:03d}")
            for d in range(200) for n in "AB" for k in range(3)]
    rows.append(("C", 1.0, 2.0, 1.0, 2.0, None, 0.0, 1.0, 0.0, "open-meteo", DAY + timedelta(days=300), "late"))
    write_forecasts(spark.createDataFrame(rows, DAILY), tmp_dir, interval="daily", provider="open_meteo")
    lake = read_lake(spark, tmp_dir, "daily", provider="open_meteo", with_partitions=True)
    order = ["date", "location_name", "run_id"]
    for last, cut in ((True, q.tail), (False, q.head)):
        for n in (1, 2, 5, 7, 1200, 5000):
            end = read_lake_end(spark, tmp_dir, "daily", provider="open_meteo", n=n, last=last)
            assert [tuple(r) for r in cut(end, order, n).collect()] == [tuple(r) for r in cut(lake, order, n).collect()], (last, n)
        end = read_lake_end(spark, tmp_dir, "daily", provider="open_meteo", n=5, last=last)
        days = {r["ingest_date"].isoformat() for r in end.select("ingest_date").distinct().collect()}
        assert len(days) <= 5 and end.count() < 30
        # Files of other days aren't needed.
        assert "dynamicpruning" in _plan(end)
