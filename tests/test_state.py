"""State table."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from forecastlake.operators import state as st
from forecastlake.sources.state_store import (
    committed_versions, empty_state, read_state, save_state,
)

UPD = ("provider string, interval string, location_name string, status string, error string, "
       "records int, forecast_end_date string, at timestamp, ord int")


def _upd(spark, rows):
    return spark.createDataFrame(rows, UPD)


def test_success_and_failure_round_trip(spark, tmp_dir):
    t = datetime(2031, 3, 7, 12)
    u = _upd(spark, [("open_meteo", "daily", "Harbour", "success", None, 42, "2025-01-21", t, 1),
                     ("open_meteo", "daily", "Ridge", "failure", "Connection timeout", 0, None, t, 2)])
    path = save_state(st.apply_outcomes(read_state(spark, tmp_dir), u), tmp_dir)
    assert committed_versions(spark, tmp_dir) == [1] and path.endswith("v=0000000001")
    got = {r["location_name"]: r for r in read_state(spark, tmp_dir).collect()}
    assert got["Harbour"]["last_fetch_status"] == "success" and got["Harbour"]["records_fetched"] == 42
    assert got["Ridge"]["last_fetch_status"] == "failure"
    assert got["Ridge"]["last_fetch_error"] == "Connection timeout" and got["Ridge"]["records_fetched"] == 0


def test_missing_state_is_empty(spark, tmp_dir):
    assert read_state(spark, tmp_dir + "/nothing").count() == 0


def test_sequential_semantics_of_updates(spark):
    t = datetime(2031, 3, 7)
    prev = st.apply_outcomes(empty_state(spark), _upd(spark, [
        ("p", "hourly", "X", "success", None, 5, "2025-01-20", t, 1)]))
    new = st.apply_outcomes(prev, _upd(spark, [
        ("p", "hourly", "X", "success", None, 7, "2025-01-22", t, 2),
        ("p", "hourly", "X", "failure", "boom", 0, None, t, 3),
        ("p", "hourly", "Y", "success", None, 1, "", t, 1),
    ])).collect()
    got = {r["location_name"]: r for r in new}
    x = got["X"]
    assert (x["last_fetch_status"], x["last_fetch_error"], x["records_fetched"], x["forecast_end_date"]) == \
        ("failure", "boom", 0, "2025-01-22")
    assert got["Y"]["forecast_end_date"] is None


def test_freshness_boundary_and_stale(spark):
    t = datetime(2031, 3, 7, 6)
    state = st.apply_outcomes(empty_state(spark), _upd(spark, [
        ("p", "hourly", "A", "success", None, 1, None, t, 1),
        ("p", "hourly", "B", "success", None, 1, None, datetime(2031, 3, 7, 7), 1),
        ("p", "hourly", "C", "failure", "x", 0, None, datetime(2031, 3, 7, 11), 1)]))
    as_of = F.lit("2031-03-07 12:00:00").cast("timestamp")
    fresh = {r["location_name"]: r["is_fresh"] for r in st.with_freshness(state, as_of=as_of).collect()}
    assert fresh == {"A": False, "B": True, "C": False}   # exactly 6 h is not fresh
    locs = spark.createDataFrame([("A",), ("B",), ("C",), ("D",)], "name string")
    stale = {r["name"] for r in st.stale_locations(locs, state, provider="p", interval="hourly",
                                                    as_of=as_of).collect()}
    assert stale == {"A", "C", "D"}


def test_attempt_resolution_cases(spark):
    log = spark.createDataFrame([
        ("ok3", 1, "timeout"), ("ok3", 2, "connect"), ("ok3", 3, None),
        ("fatal", 1, "http_error"), ("fatal", 2, None),
        ("exhausted", 1, "timeout"), ("exhausted", 2, "read"), ("exhausted", 3, "timeout"),
        ("pending", 1, "timeout"),
    ], "location_name string, attempt int, error_class string")
    got = {r["location_name"]: (r["final_attempt"], r["final_status"], r["error_class"])
           for r in st.resolve_attempts(log, ["location_name"]).collect()}
    assert got == {"ok3": (3, "success", None), "fatal": (1, "failed", "http_error"),
                   "exhausted": (3, "failed", "timeout"), "pending": (None, "pending", None)}
    waits = [r["wait_seconds"] for r in st.backoff_schedule(log.filter("location_name = 'ok3'"))
             .orderBy("attempt").collect()]
    assert waits == [1.0, 2.0, None]


def test_records_gate(spark):
    assert st.records_total(empty_state(spark)).first()["total_records"] == 0
    with pytest.raises(ValueError):
        st.records_gate(empty_state(spark))


def test_get_or_create_and_single_marks(spark):
    t = datetime(2031, 3, 7, 12)
    state = st.apply_outcomes(empty_state(spark), st.single_update(
        spark, provider="open_meteo", interval="daily", location_name="Harbour", success=True,
        records=42, forecast_end_date="2025-01-21", at=F.lit(t).cast("timestamp")))
    state = st.apply_outcomes(state, st.single_update(
        spark, provider="open_meteo", interval="daily", location_name="Ridge", success=False,
        error="Connection timeout"))
    keys = spark.createDataFrame([("open_meteo", "daily", "Harbour"), ("open_meteo", "daily", "Ridge"),
                                  ("open_meteo", "daily", "Dunes")], "provider string, interval string, "
                                 "location_name string")
    got = {r["location_name"]: r for r in st.get_locations(state, keys).collect()}
    assert got["Harbour"]["records_fetched"] == 42 and not got["Harbour"]["is_new"]
    assert got["Ridge"]["last_fetch_status"] == "failure" and got["Ridge"]["last_fetch_error"] == "Connection timeout"
    assert got["Dunes"]["is_new"] and got["Dunes"]["last_fetch_status"] == "success"
    assert got["Dunes"]["records_fetched"] == 0 and got["Dunes"]["last_fetch_timestamp"] is not None


def test_damaged_versions_fall_back_and_expire(spark, tmp_dir, caplog):
    import os

    from forecastlake.sources.state_store import expire_versions, version_path

    t = datetime(2031, 3, 7)
    root = f"{tmp_dir}/state"
    for k in (1, 2, 3):
        save_state(st.apply_outcomes(read_state(spark, root), _upd(spark, [("p", "hourly", f"L{k}", "success", None, k, None, t, 1)])), root)
    local = root.replace("file://", "").replace("file:", "")
    for name in os.listdir(version_path(local, 3)):
        if name.endswith(".parquet"):
            with open(f"{version_path(local, 3)}/{name}", "wb") as f:
                f.write(b"junk")
            crc = f"{version_path(local, 3)}/.{name}.crc"
            if os.path.exists(crc):
                os.remove(crc)
    assert {r["location_name"] for r in read_state(spark, root).collect()} == {"L1", "L2"}
    assert any("could not read state" in r.message for r in caplog.records)
    assert expire_versions(spark, root, keep=2) == [1] and committed_versions(spark, root) == [2, 3]


def test_listing_error_is_not_an_empty_state(spark, tmp_dir, monkeypatch):
    import forecastlake.sources.state_store as store

    def fail(*a):
        raise OSError("listing failed")

    monkeypatch.setattr(store, "_version_dirs", fail)
    with pytest.raises(OSError):
        read_state(spark, tmp_dir)
