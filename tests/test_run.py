"""End-to-end run, reports and incremental streaming."""

import copy
from datetime import datetime

from forecastlake.plans.run import run_batch
from forecastlake.sources.lake import read_lake
from forecastlake.sources.state_store import read_state
from forecastlake.streaming.incremental import run_available_now
from tests.conftest import SAMPLE_BODY, response_row, responses


def _resp(spark):
    tokyo = copy.deepcopy(SAMPLE_BODY)
    tokyo["latitude"] = 35.7
    return responses(spark, [
        response_row(SAMPLE_BODY, interval="daily"),
        response_row(tokyo, interval="daily", location=("Ridge", -12.5, 130.875)),
        response_row({"error": True, "reason": "bad"}, interval="daily", location=("Dunes", 30.0, 31.2)),
    ])


def test_run_batch_end_to_end(spark, tmp_dir):
    res = run_batch(spark, _resp(spark), interval="daily", base_path=f"{tmp_dir}/lake",
                    state_root=f"{tmp_dir}/state", run_id="run-a")
    rr = res.run_report.first()
    assert rr["success"] and rr["records_processed"] == 4 and rr["files_written"] == 2
    assert rr["failed_count"] == 1 and rr["error"] is None
    assert [f["path"] for f in res.report.collect()] == [
        "open_meteo/daily/Harbour/2031/03/07/forecast_20310307.parquet",
        "open_meteo/daily/Ridge/2031/03/07/forecast_20310307.parquet"]
    assert [r["error"] for r in res.failed.collect()] == ["API Error: bad"]
    assert (rr["responses"], rr["ok_count"], rr["pending_count"], rr["superseded_count"]) == (3, 2, 0, 0)
    st = {r["location_name"]: r for r in read_state(spark, f"{tmp_dir}/state").collect()}
    assert st["Harbour"]["records_fetched"] == 2 and st["Harbour"]["forecast_end_date"] == "2031-03-08"
    assert st["Dunes"]["last_fetch_status"] == "failure"
    assert read_lake(spark, f"{tmp_dir}/lake", "daily", provider="open_meteo").count() == 4


def test_all_failed_run(spark, tmp_dir):
    df = responses(spark, [response_row("garbage", interval="daily")])
    rr = run_batch(spark, df, interval="daily", base_path=f"{tmp_dir}/lake").run_report.first()
    assert not rr["success"] and rr["records_processed"] == 0
    assert rr["error"] == "All locations failed to fetch data."


def test_incremental_available_now(spark, tmp_dir):
    land, lake, ck = f"{tmp_dir}/landing", f"{tmp_dir}/lake", f"{tmp_dir}/ckpt"
    hourly = responses(spark, [response_row(SAMPLE_BODY)])
    hourly.write.json(f"{land}/drop=0")
    kw = dict(checkpoint=ck, interval="hourly", base_path=lake, state_root=f"{tmp_dir}/state")
    run_available_now(spark, f"{land}/drop=*", **kw)
    assert read_lake(spark, lake, "hourly", provider="open_meteo").count() == 2
    run_available_now(spark, f"{land}/drop=*", **kw)      # nothing new: nothing added
    assert read_lake(spark, lake, "hourly", provider="open_meteo").count() == 2
    responses(spark, [response_row(SAMPLE_BODY, location=("Ridge", 1.0, 2.0))]).write.json(f"{land}/drop=1")
    run_available_now(spark, f"{land}/drop=*", **kw)
    assert read_lake(spark, lake, "hourly", provider="open_meteo").count() == 4
    assert read_state(spark, f"{tmp_dir}/state").count() == 2


def test_quarantine_sink_and_fail_mode(spark, tmp_dir):
    import pytest
    from forecastlake.operators import flatten as fl
    from forecastlake.operators.parse import ingestion_metadata, parse_responses, split_ok_failed
    from forecastlake.operators.validate import check_rows

    body = copy.deepcopy(SAMPLE_BODY)
    body["hourly"]["temperature_2m"] = [11.25, "oops"]
    df = responses(spark, [response_row(body)])
    res = run_batch(spark, df, interval="hourly", base_path=f"{tmp_dir}/lake",
                    quarantine_path=f"{tmp_dir}/quarantine", run_id="run-q")
    q = spark.read.parquet(f"{tmp_dir}/quarantine")
    assert [r["errors"] for r in q.collect()] == [["bad_value:temperature_2m"]]
    rr = res.run_report.first()
    assert rr["records_processed"] == 1 and rr["rejected_count"] == 1 and res.quarantined.count() == 1
    plain = run_batch(spark, df, interval="hourly", base_path=f"{tmp_dir}/lake2", run_id="run-q",
                      state_root=f"{tmp_dir}/state")
    assert plain.quarantined.count() == 1          # below the lake when no path is given
    assert read_lake(spark, f"{tmp_dir}/lake2", "hourly").count() == 1
    assert read_state(spark, f"{tmp_dir}/state").first()["records_fetched"] == 1
    ok, _ = split_ok_failed(parse_responses(df))
    with pytest.raises(ValueError):
        check_rows(fl.flatten_hourly(ok), on_bad="fail")
    meta = ingestion_metadata(parse_responses(df)).first()
    assert meta["response_size_bytes"] == len(df.first()["body"].encode()) and meta["status_code"] == 200


def test_job_entry_point_exit_codes(spark, tmp_dir):
    from forecastlake.plans.job import main
    from forecastlake.sources.state_store import state_info

    land = f"{tmp_dir}/landing"
    responses(spark, [response_row(SAMPLE_BODY, interval="daily")]).write.json(land)
    args = ["--landing", land, "--interval", "daily", "--lake", f"{tmp_dir}/lake", "--state", f"{tmp_dir}/state"]
    assert main(args, spark=spark) == 0
    info = state_info(spark, f"{tmp_dir}/state").first()
    assert info["version"] == 1 and info["format_version"] == "1.0" and info["last_updated"] is not None
    bad = f"{tmp_dir}/bad"
    responses(spark, [response_row("garbage", interval="daily")]).write.json(bad)
    assert main(["--landing", bad, "--interval", "daily", "--lake", f"{tmp_dir}/lake2"], spark=spark) == 1
    assert main(["--landing", f"{tmp_dir}/missing", "--interval", "daily", "--lake", f"{tmp_dir}/l3"],
                spark=spark) == 1


def test_failed_micro_batch_is_retried_exactly_once(spark, tmp_dir, monkeypatch):
    import pytest
    import forecastlake.streaming.incremental as inc

    land, lake, ck = f"{tmp_dir}/landing", f"{tmp_dir}/lake", f"{tmp_dir}/ckpt"
    responses(spark, [response_row(SAMPLE_BODY)]).write.json(f"{land}/drop=0")
    real = inc.run_staged
    seen = []

    def flaky(spark_, staged, **kw):
        seen.append(kw["run_id"])
        result = real(spark_, staged, **kw)      # the lake write happens ...
        if len(seen) == 1:
            raise RuntimeError("executor lost")  # ... then the run fails before it is marked done
        return result

    monkeypatch.setattr(inc, "run_staged", flaky)
    with pytest.raises(Exception):
        inc.run_available_now(spark, f"{land}/drop=*", checkpoint=ck, interval="hourly", base_path=lake)
    # More lands before the retry: the failed run is repeated first, under its own run id.
    responses(spark, [response_row(SAMPLE_BODY, location=("Ridge", 1.0, 2.0))]).write.json(f"{land}/drop=1")
    inc.run_available_now(spark, f"{land}/drop=*", checkpoint=ck, interval="hourly", base_path=lake)
    assert len(seen) == 3 and seen[0] == seen[1] != seen[2]
    assert read_lake(spark, lake, "hourly", provider="open_meteo").count() == 4   # not 6


def test_rerun_after_failure_between_lake_and_state(spark, tmp_dir, monkeypatch):
    import pytest
    import forecastlake.plans.run as run_mod

    df = _resp(spark)
    kw = dict(interval="daily", base_path=f"{tmp_dir}/lake", state_root=f"{tmp_dir}/state", run_id="run-x")
    real_save = run_mod.save_state
    monkeypatch.setattr(run_mod, "save_state", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        run_batch(spark, df, **kw)
    assert read_state(spark, f"{tmp_dir}/state").count() == 0          # state never ahead of the lake
    monkeypatch.setattr(run_mod, "save_state", real_save)
    res = run_batch(spark, df, **kw)
    assert res.run_report.first()["records_processed"] == 4
    assert read_lake(spark, f"{tmp_dir}/lake", "daily", provider="open_meteo").count() == 4
    assert read_state(spark, f"{tmp_dir}/state").count() == 3


def test_success_with_empty_series_writes_nothing(spark, tmp_dir):
    body = copy.deepcopy(SAMPLE_BODY)
    body["daily"] = {"time": []}
    rr = run_batch(spark, responses(spark, [response_row(body, interval="daily")]), interval="daily",
                   base_path=f"{tmp_dir}/lake").run_report.first()
    assert rr["success"] and rr["records_processed"] == 0 and rr["files_written"] == 0 and rr["error"] is None


def test_only_final_attempts_are_processed(spark, tmp_dir):
    t = dict(interval="daily")
    rows = [
        response_row(None, location=("A", 1.0, 1.0), attempt=1, transport_error="ReadTimeout",
                     error_class="timeout", **t),
        response_row(SAMPLE_BODY, location=("A", 1.0, 1.0), attempt=2, **t),
        response_row(None, location=("B", 1.0, 1.0), attempt=1, transport_error="TLS failure",
                     error_class="ssl", **t),
        response_row(None, location=("C", 1.0, 1.0), attempt=1, transport_error="t1", error_class="timeout", **t),
        response_row(None, location=("C", 1.0, 1.0), attempt=2, transport_error="t2", error_class="connect", **t),
        response_row(None, location=("C", 1.0, 1.0), attempt=3, transport_error="t3", error_class="timeout", **t),
        response_row(None, location=("D", 1.0, 1.0), attempt=1, transport_error="t", error_class="timeout", **t),
    ]
    res = run_batch(spark, responses(spark, rows), interval="daily", base_path=f"{tmp_dir}/lake",
                    state_root=f"{tmp_dir}/state", run_id="r")
    rr = res.run_report.first()
    assert rr["success"] and rr["records_processed"] == 2 and rr["files_written"] == 1
    assert sorted((f["location"]["name"], f["error"]) for f in res.failed.collect()) == [("B", "TLS failure"), ("C", "t3")]
    assert [p["location"]["name"] for p in res.pending.collect()] == ["D"]
    assert rr["responses"] == 7 == rr["ok_count"] + rr["failed_count"] + rr["pending_count"] + rr["superseded_count"]
    st = {r["location_name"]: r["last_fetch_status"] for r in read_state(spark, f"{tmp_dir}/state").collect()}
    assert st == {"A": "success", "B": "failure", "C": "failure"}      # D is still in flight


def _attempt(n, body=None, loc=("A", 1.0, 1.0), cycle="c1", hour=12, cls="timeout", **kw):
    failed = {} if body else dict(transport_error=f"t{n}", error_class=cls)
    return response_row(body, location=loc, attempt=n, run_id=cycle, interval="daily",
                        ingest=datetime(2031, 3, 7, hour), **failed, **kw)


def test_cycles_are_resolved_one_by_one(spark, tmp_dir):
    rows = [_attempt(1), _attempt(2, SAMPLE_BODY), _attempt(1, SAMPLE_BODY, cycle="c2", hour=15),
            _attempt(1, SAMPLE_BODY, loc=(None, 3.0, 4.0)), _attempt(1, loc=("B", 1.0, 1.0)),
            _attempt(None, loc=("C", 1.0, 1.0))]
    res = run_batch(spark, responses(spark, rows), interval="daily", base_path=f"{tmp_dir}/lake",
                    state_root=f"{tmp_dir}/state", run_id="r")
    got = sorted((r["location"]["name"] or "", r["cycle"], r["attempt"], r["outcome"], r["written"], r["n_good"], r["n_bad"])
                 for r in res.resolved.collect())
    assert got == [("", "c1", 1, "ok", True, 0, 2), ("A", "c1", 1, "superseded", False, 0, 0),
                   ("A", "c1", 2, "ok", False, 0, 0), ("A", "c2", 1, "ok", True, 2, 0),
                   ("B", "c1", 1, "pending", False, 0, 0), ("C", "c1", 3, "failed", False, 0, 0)]
    lake = read_lake(spark, f"{tmp_dir}/lake", "daily", provider="open_meteo")
    assert {(r["location_name"], r["ingestion_timestamp_utc"].hour) for r in lake.collect()} == {("A", 15)} and lake.count() == 2
    state = {r["location_name"]: (r["last_fetch_status"], r["records_fetched"]) for r in read_state(spark, f"{tmp_dir}/state").collect()}
    assert state == {"A": ("success", 2), None: ("success", 0), "C": ("failure", 0)}
    again = run_batch(spark, responses(spark, rows[3:4]), interval="daily", base_path=f"{tmp_dir}/lake",
                      state_root=f"{tmp_dir}/state", run_id="r2")
    assert again.run_report.first()["rejected_count"] == 2
    assert read_state(spark, f"{tmp_dir}/state").count() == 3      # the location without a name has one row


def test_only_pending_is_not_all_failed(spark, tmp_dir):
    df = responses(spark, [_attempt(1)])
    rr = run_batch(spark, df, interval="daily", base_path=f"{tmp_dir}/lake").run_report.first()
    assert (rr["success"], rr["pending_count"], rr["failed_count"], rr["error"]) == (False, 1, 0, None)
    closed = run_batch(spark, df, interval="daily", base_path=f"{tmp_dir}/lake", close_cycles=True,
                       state_root=f"{tmp_dir}/state")
    rr = closed.run_report.first()
    assert rr["failed_count"] == 1 and rr["error"] == "All locations failed to fetch data."
    assert read_state(spark, f"{tmp_dir}/state").first()["last_fetch_error"] == "t1"


def test_other_providers_are_left_alone(spark, tmp_dir):
    df = responses(spark, [response_row(SAMPLE_BODY), response_row(SAMPLE_BODY, provider="other_api")])
    res = run_batch(spark, df, interval="hourly", base_path=f"{tmp_dir}/lake")
    assert res.run_report.first()["responses"] == 1
    assert read_lake(spark, f"{tmp_dir}/lake", "hourly", provider="other_api").count() == 0


def test_landing_is_scanned_once_and_parsed_once(spark, tmp_dir):
    from forecastlake.plans.run import stage_responses
    from forecastlake.sources.responses import read_responses

    responses(spark, [response_row(SAMPLE_BODY)]).write.json(f"{tmp_dir}/landing")
    plan = stage_responses(read_responses(spark, f"{tmp_dir}/landing"), interval="hourly",
                           provider="open_meteo")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan json") == 1 and plan.count("from_json(") == 1 and "Exchange" not in plan


def test_stream_does_not_depend_on_micro_batches(spark, tmp_dir):
    rows = [_attempt(1), _attempt(2, SAMPLE_BODY), _attempt(1, SAMPLE_BODY, cycle="c2", hour=15),
            _attempt(1, loc=("B", 1.0, 1.0), cls="ssl"), _attempt(2, SAMPLE_BODY, loc=("B", 1.0, 1.0)),
            _attempt(1, loc=("C", 1.0, 1.0))]
    seen = []
    for files in (1, 100):
        top = f"{tmp_dir}/{files}"
        for k, row in enumerate(rows):
            responses(spark, [row]).coalesce(1).write.json(f"{top}/land/drop={k}")
        kw = dict(checkpoint=f"{top}/ckpt", interval="daily", base_path=f"{top}/lake", state_root=f"{top}/state",
                  max_files_per_trigger=files, quarantine_path=f"{top}/q")
        res = run_available_now(spark, f"{top}/land/drop=*", **kw)
        rr = res.run_report.first()
        # The pending cycle's next attempt lands later; a late second attempt of a closed cycle changes nothing.
        responses(spark, [_attempt(2, SAMPLE_BODY, loc=("C", 1.0, 1.0)), _attempt(3, SAMPLE_BODY, loc=("B", 1.0, 1.0)),
                          _attempt(1, SAMPLE_BODY, cycle="c0", hour=3)]).write.json(f"{top}/land/drop=9")
        late = run_available_now(spark, f"{top}/land/drop=*", **kw).run_report.first()
        assert run_available_now(spark, f"{top}/land/drop=*", **kw) is None
        lake = sorted((r["location_name"], r["date"].day, r["ingestion_timestamp_utc"].hour)
                      for r in read_lake(spark, f"{top}/lake", "daily", provider="open_meteo").collect())
        seen.append((lake, rr["ok_count"], rr["failed_count"], rr["pending_count"], late["ok_count"], late["failed_count"]))
    assert seen[0] == seen[1]
    assert seen[0] == ([("A", 7, 15), ("A", 8, 15), ("C", 7, 12), ("C", 8, 12)], 2, 1, 1, 2, 0)


def test_stream_job_exit_code(spark, tmp_dir):
    from forecastlake.plans.job import main

    responses(spark, [response_row("garbage")]).write.json(f"{tmp_dir}/landing")
    args = ["--landing", f"{tmp_dir}/landing", "--interval", "hourly", "--lake", f"{tmp_dir}/lake", "--stream",
            "--checkpoint", f"{tmp_dir}/ckpt", "--layout", "by_location", "--quarantine", f"{tmp_dir}/q"]
    assert main(args, spark=spark) == 1      # every location failed
    assert main(args, spark=spark) == 0      # nothing new
