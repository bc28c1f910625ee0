"""Incremental runs over a long history (T1): what a run reads, and what it carries."""

import copy
from datetime import datetime, timedelta

from forecastlake.sources.lake import read_lake
from forecastlake.streaming.incremental import run_available_now
from tests.conftest import SAMPLE_BODY, response_row, responses


def _bytes_read(spark) -> int:
    """Bytes that this JVM has read from files so far."""
    stats = spark.sparkContext._jvm.org.apache.hadoop.fs.FileSystem.getAllStatistics()
    return sum(s.getBytesRead() for s in stats)


def _drop(spark, k: int, locations: int = 40):
    """One fetch cycle: every location at once, one timeout that the next drop retries, one late attempt."""
    at = datetime(2031, 3, 1) + timedelta(hours=3 * k)
    rows = [response_row(SAMPLE_BODY, location=(f"L{i:03d}", 1.0, float(i)), run_id=f"cycle-{k:04d}", ingest=at)
            for i in range(locations)]
    rows.append(response_row(None, location=("retried", 1.0, 1.0), run_id=f"cycle-{k:04d}", ingest=at,
                             transport_error="t", error_class="timeout"))
    if k:
        rows.append(response_row(SAMPLE_BODY, location=("retried", 1.0, 1.0), run_id=f"cycle-{k - 1:04d}", ingest=at, attempt=2))
        rows.append(response_row(SAMPLE_BODY, location=("L000", 1.0, 0.0), run_id=f"cycle-{k - 1:04d}", ingest=at, attempt=2))
    return responses(spark, rows).coalesce(1)


def test_run_twenty_reads_what_run_two_reads(spark, tmp_dir):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    kw = dict(checkpoint=f"{tmp_dir}/ckpt", interval="hourly", base_path=f"{tmp_dir}/lake", state_root=f"{tmp_dir}/state")
    try:
        read, reports = [], []
        for k in range(20):
            _drop(spark, k).write.json(f"{tmp_dir}/land/drop={k}")
            start = _bytes_read(spark)
            result = run_available_now(spark, f"{tmp_dir}/land/drop=*", **kw)
            read.append(_bytes_read(spark) - start)
            reports.append(result.run_report.first())
        # The retried location's cycle is settled one run later; late attempts of settled cycles change nothing.
        for k, r in enumerate(reports):
            assert (r["ok_count"], r["pending_count"], r["superseded_count"]) == (40 + (k > 0), 1, 1 if k else 0)
        assert read_lake(spark, f"{tmp_dir}/lake", "hourly", provider="open_meteo").count() == 2 * (20 * 40 + 19)
        # Flat but for the stream's own log of files; reading the history would make it tenfold.
        assert max(read[17:]) < 1.25 * max(read[1:4]), read
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_daily_fetches_are_compared_with_those_written_before(spark, tmp_dir):
    """An older fetch of a day that lands later isn't written; a newer one is; other days don't matter."""
    kw = dict(checkpoint=f"{tmp_dir}/ckpt", interval="daily", base_path=f"{tmp_dir}/lake")

    def land(k, *fetches):
        responses(spark, [response_row(SAMPLE_BODY, interval="daily", run_id=f"c{k}-{i}", ingest=at)
                          for i, at in enumerate(fetches)]).coalesce(1).write.json(f"{tmp_dir}/land/drop={k}")
        return run_available_now(spark, f"{tmp_dir}/land/drop=*", **kw).run_report.first()["records_processed"]

    assert land(0, datetime(2031, 3, 7, 12)) == 2
    assert land(1, datetime(2031, 3, 7, 9)) == 0          # older than what is written
    assert land(2, datetime(2031, 3, 7, 15)) == 2
    assert land(3, datetime(2031, 3, 7, 13), datetime(2031, 3, 8, 1)) == 2
    got = {(r["ingestion_timestamp_utc"].day, r["ingestion_timestamp_utc"].hour)
           for r in read_lake(spark, f"{tmp_dir}/lake", "daily", provider="open_meteo").collect()}
    assert got == {(7, 15), (8, 1)}


def test_carried_tables_of_a_failed_run_are_not_read(spark, tmp_dir, monkeypatch):
    """A run that fails after it wrote its carried tables, but before its commit, is repeated as if they weren't there."""
    import pytest

    import forecastlake.streaming.incremental as inc

    kw = dict(checkpoint=f"{tmp_dir}/ckpt", interval="hourly", base_path=f"{tmp_dir}/lake")
    body = copy.deepcopy(SAMPLE_BODY)
    responses(spark, [response_row(body), response_row(None, location=("Ridge", 1.0, 2.0), transport_error="t",
                                                       error_class="timeout")]).write.json(f"{tmp_dir}/land/drop=0")
    real = inc.CarriedWork.leave

    class NoCommit:
        """The resolved table can't be written; the others can."""
        def __init__(self, df):
            self.df = df

        def __getattr__(self, name):
            return getattr(self.df, name)

        @property
        def write(self):
            raise RuntimeError("driver lost")

    def flaky(self, result, interval, epoch):
        result.resolved = NoCommit(result.resolved)
        return real(self, result, interval, epoch)

    monkeypatch.setattr(inc.CarriedWork, "leave", flaky)
    with pytest.raises(RuntimeError):
        run_available_now(spark, f"{tmp_dir}/land/drop=*", **kw)
    monkeypatch.setattr(inc.CarriedWork, "leave", real)
    responses(spark, [response_row(body, location=("Ridge", 1.0, 2.0), attempt=2)]).write.json(f"{tmp_dir}/land/drop=1")
    last = run_available_now(spark, f"{tmp_dir}/land/drop=*", **kw).run_report.first()
    assert (last["ok_count"], last["pending_count"]) == (1, 0)
    lake = read_lake(spark, f"{tmp_dir}/lake", "hourly", provider="open_meteo")
    assert sorted(r["location_name"] for r in lake.collect()) == ["Harbour"] * 2 + ["Ridge"] * 2
