"""State in hash buckets: what an update reads and writes."""

import os
import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from forecastlake.operators import state as st
from forecastlake.sources import state_store as store
from forecastlake.sources.state_store import committed_versions, expire_versions, read_state, save_state, update_buckets

UPD = ("provider string, interval string, location_name string, status string, error string, "
       "records int, forecast_end_date string, at timestamp, ord int")
T = datetime(2031, 3, 7)


def _upd(spark, names, records, ord=1):
    return spark.createDataFrame([("p", "hourly", n, "success", None, records, "2031-03-09", T, ord) for n in names], UPD)


def _local(path):
    return path.replace("file://", "").replace("file:", "")


def _files(root):
    return {os.path.join(d, f) for d, _, fs in os.walk(_local(root)) for f in fs if f.endswith(".parquet")}


def test_hundred_updates_write_the_touched_buckets_only(spark, tmp_dir):
    """10^6 keys: an update of 100 of them rewrites their buckets, and reads no other one."""
    n, root = 1_000_000, f"{tmp_dir}/state"
    ids = spark.range(n)
    state = ids.select(
        F.lit("p").alias("provider"), F.lit("hourly").alias("interval"), F.concat(F.lit("L"), "id").alias("location_name"),
        F.lit(T).alias("last_fetch_timestamp"), F.lit("success").alias("last_fetch_status"),
        F.lit(None).cast("string").alias("last_fetch_error"), F.lit(1).alias("records_fetched"),
        F.lit(None).cast("string").alias("forecast_end_date"))
    save_state(state, root, buckets=512)
    before = _files(root)
    names = [f"L{i}" for i in range(0, n, n // 90)][:90] + [f"new{i}" for i in range(10)]
    change = update_buckets(spark, root, _upd(spark, names, 7))
    assert len(change.touched) <= 100 and len(change.rows.inputFiles()) <= 101
    plan = change.rows._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    # Exchanges stand below broadcasts only: the state's rows stay where they are.
    assert "Exchange hashpartitioning" not in plan
    save_state(change, root)
    added = {f for f in _files(root) - before if "_buckets" in f}
    assert {int(f.split("bucket=")[1].split("/")[0]) for f in added} == set(change.touched)
    assert sum(map(os.path.getsize, added)) < 0.25 * sum(os.path.getsize(f) for f in before if "_buckets" in f)
    after = read_state(spark, root)
    assert after.count() == n + 10
    assert after.filter("records_fetched = 7").count() == 100 == after.filter("forecast_end_date = '2031-03-09'").count()


def test_updates_of_buckets_match_updates_of_the_whole(spark, tmp_dir, monkeypatch):
    rng = random.Random(3)
    names = [None] + [f"L{i}" for i in range(40)]
    whole = store.empty_state(spark)
    for step in range(5):
        rows = [(rng.choice(["p", "q", None]), rng.choice(["hourly", "daily"]), rng.choice(names),
                 *rng.choice([("success", None, 5, "2031-03-09"), ("success", None, 3, ""), ("failure", "boom", 0, None)]), T, k)
                for k in range(60)]
        upd = spark.createDataFrame(rows, UPD)
        monkeypatch.setattr(store, "BROADCAST_UPDATES", 0 if step % 2 else 10**6)
        whole = spark.createDataFrame(st.apply_outcomes(whole, upd).collect(), whole.schema)
        change = update_buckets(spark, tmp_dir, upd)
        save_state(change, tmp_dir, **({} if step else {"buckets": 8}))
        got = sorted(map(str, read_state(spark, tmp_dir).collect()))
        assert got == sorted(map(str, whole.collect()))
    assert committed_versions(spark, tmp_dir) == [1, 2, 3, 4, 5]
    assert expire_versions(spark, tmp_dir, keep=1) == [1, 2, 3, 4]
    assert sorted(map(str, read_state(spark, tmp_dir).collect())) == got


def test_crashed_and_concurrent_saves(spark, tmp_dir, monkeypatch):
    save_state(st.apply_outcomes(store.empty_state(spark), _upd(spark, ["A", "B"], 1)), tmp_dir, buckets=4)
    one, two = (update_buckets(spark, tmp_dir, _upd(spark, ["A"], k)) for k in (2, 3))
    # A save that dies between its buckets and its manifest leaves the version before.
    monkeypatch.setattr(store, "version_path", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        save_state(one, tmp_dir)
    monkeypatch.undo()
    assert committed_versions(spark, tmp_dir) == [1]
    assert {r["records_fetched"] for r in read_state(spark, tmp_dir).collect()} == {1}
    assert save_state(one, tmp_dir).endswith("v=0000000003")
    with pytest.raises(RuntimeError, match="has changed"):      # prepared on version 1
        save_state(two, tmp_dir)
    save_state(update_buckets(spark, tmp_dir, _upd(spark, ["A"], 3)), tmp_dir)
    assert {r["location_name"]: r["records_fetched"] for r in read_state(spark, tmp_dir).collect()} == {"A": 3, "B": 1}


def test_damaged_buckets_fall_back(spark, tmp_dir):
    for k in (1, 2):
        save_state(update_buckets(spark, tmp_dir, _upd(spark, ["A"], k)), tmp_dir)
    for f in [f for f in _files(tmp_dir) if "_buckets/v=0000000002" in f]:
        os.remove(f)
    assert [r["records_fetched"] for r in read_state(spark, tmp_dir).collect()] == [1]
    save_state(update_buckets(spark, tmp_dir, _upd(spark, ["A"], 5)), tmp_dir)
    assert [r["records_fetched"] for r in read_state(spark, tmp_dir).collect()] == [5]


def test_a_store_without_buckets_is_read_and_dealt_anew(spark, tmp_dir):
    old = st.apply_outcomes(store.empty_state(spark), _upd(spark, ["A", "B"], 1))
    old.write.parquet(store.version_path(tmp_dir, 1))
    assert read_state(spark, tmp_dir).count() == 2
    save_state(update_buckets(spark, tmp_dir, _upd(spark, ["B"], 2)), tmp_dir)
    assert {r["location_name"]: r["records_fetched"] for r in read_state(spark, tmp_dir).collect()} == {"A": 1, "B": 2}
