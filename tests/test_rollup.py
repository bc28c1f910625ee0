"""Rollups of a lake's times against counts over its rows."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from forecastlake.operators import quality as q
from forecastlake.operators import rollup as ro
from forecastlake.schemas import DAILY, HOURLY
from forecastlake.sinks.lake import write_forecasts
from forecastlake.sources.lake import read_lake

T0 = datetime(2031, 3, 7)


def _random_rows(rng, n):
    """(location, time): grid times around bucket edges and before 1970, repeated ones, off-grid ones, nulls."""
    out = []
    for _ in range(n):
        loc = rng.choice(["A", "B", "C", None])
        kind = rng.random()
        if kind < 0.05:
            t = None
        elif kind < 0.15:
            t = T0 + timedelta(hours=rng.randrange(5), minutes=rng.choice([0, 30]), microseconds=rng.choice([0, 1]))
        elif kind < 0.3:
            t = datetime(1969, 12, 30) + timedelta(hours=rng.randrange(120))
        else:
            t = rng.choice([T0, datetime(2059, 9, 18)]) + timedelta(hours=rng.randrange(400), days=rng.randrange(3) * 700)
        out.append((loc, t))
    return out


@pytest.mark.parametrize("interval", ["hourly", "daily"])
@pytest.mark.parametrize("zone", ["UTC", "America/Los_Angeles"])
def test_bitmaps_count_as_count_distinct_does(spark, interval, zone):
    rng = random.Random(len(interval))
    df = spark.createDataFrame(_random_rows(rng, 1500), "location_name string, t timestamp_ntz")
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        want = [tuple(r) for r in q.completeness(df, date_col="t").collect()]
        rolled = ro.time_rollup(df, interval, ["location_name"], time_col="t")
        assert [tuple(r) for r in ro.completeness_from_rollup(rolled).collect()] == want
        dup = {(r[0], r[1]): r[2] for r in q.duplicates(df, ["location_name", "t"]).collect()}
        got = {(r[0], r[1]): r[2] for r in ro.duplicates_by_elimination(df, interval, time_col="t").collect()}
        assert got == dup and len(dup) > 20
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_only_suspect_rows_are_grouped_by_key(spark):
    """One location of 50 repeats a day: the key-level shuffle holds its rows alone."""
    rows = [(f"L{i:02d}", T0 + timedelta(days=d)) for i in range(50) for d in range(200)] + [("L07", T0)]
    df = spark.createDataFrame(rows, "location_name string, date timestamp_ntz")
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(len(b))
            yield b

    at = ro.time_position("date", "daily")
    marked = df.withColumn("_bucket", F.bitmap_bucket_number(at))
    rolled = ro.time_rollup(df, "daily", ["location_name"])
    suspects = rolled.filter(F.col("n_rows") > F.bitmap_count("times")).select("location_name", F.col("bucket").alias("_bucket"))
    marked.join(suspects, ["location_name", "_bucket"], "left_semi").mapInPandas(count, "location_name string, _bucket long, date timestamp_ntz").count()
    assert seen.value == 201
    assert [tuple(r) for r in ro.duplicates_by_elimination(df, "daily").collect()] == [("L07", T0, 2)]


def _daily(spark, names, run, ingest, days):
    return spark.createDataFrame([(n, 1.0, 2.0, 1.0, 2.0, T0 + timedelta(days=d), 9.0, 1.0, 0.0, "open-meteo", ingest, run)
                                  for n in names for d in days], DAILY)


def test_rollup_of_many_runs_follows_the_lake(spark, tmp_dir, monkeypatch):
    rng = random.Random(4)
    kw = dict(interval="daily", provider="open_meteo")
    read = []
    real = ro.time_rollup
    monkeypatch.setattr(ro, "time_rollup", lambda rows, *a: read.append(rows.select("run_id").distinct().count()) or real(rows, *a))
    for k in range(6):
        names = rng.sample("ABCDE", 3)
        write_forecasts(_daily(spark, names, f"r{k}", T0 + timedelta(hours=9 * k), range(k % 3, 5 + k)), tmp_dir, **kw)
        assert ro.refresh_rollup(spark, tmp_dir, **kw) == 1
        lake = read_lake(spark, tmp_dir, "daily", provider="open_meteo")
        rolled = ro.current_rollup(spark, tmp_dir, **kw)
        assert "_rollup" in str(rolled.inputFiles()) and not any("/provider=open_meteo/interval=daily" in f and "_rollup" not in f and "_manifest" not in f
                                                                 for f in rolled.inputFiles())
        want = [tuple(r) for r in q.completeness(lake, date_col="date").collect()]
        assert [tuple(r) for r in ro.completeness_from_rollup(rolled).collect()] == want
        assert tuple(ro.ingestion_span_from_rollup(rolled).first()) == tuple(q.ingestion_span(lake).first())
    assert read == [1] * 6                       # each refresh read its own run only
    assert ro.refresh_rollup(spark, tmp_dir, **kw) == 0
    # A run that is written again is rolled up again.
    write_forecasts(_daily(spark, "A", "r5", T0 + timedelta(hours=45), range(2)), tmp_dir, **kw)
    assert ro.refresh_rollup(spark, tmp_dir, **kw) == 1
    want = q.completeness(read_lake(spark, tmp_dir, "daily", provider="open_meteo"), date_col="date").collect()
    assert ro.completeness_from_rollup(ro.current_rollup(spark, tmp_dir, **kw)).collect() == want


def test_empty_inputs(spark, tmp_dir):
    hourly = spark.createDataFrame([], HOURLY)
    assert ro.duplicates_by_elimination(hourly, "hourly").collect() == []
    assert ro.completeness_from_rollup(ro.read_rollup(spark, tmp_dir, "daily", "open_meteo")).collect() == []
