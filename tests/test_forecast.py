"""Latest forecast and accuracy by lead time against a plain model."""

import math
import random
from datetime import datetime, timedelta
from decimal import Decimal

import pytest

from forecastlake.operators import forecast as fc

SCHEMA = "location_name string, timestamp timestamp_ntz, v double, ingestion_timestamp_utc timestamp_ntz, run_id string"
T0 = datetime(2031, 3, 7)


def _rows(rng, n=400):
    return [(rng.choice(["A", "B"]), T0 + timedelta(hours=rng.randrange(12)), rng.choice([None, round(rng.uniform(-9, 9), 3)]),
             T0 - timedelta(minutes=30 * rng.randrange(-8, 200)), f"r{i:04d}") for i in range(n)]


@pytest.mark.parametrize("zone", ["UTC", "Europe/Berlin"])
def test_accuracy_matches_a_plain_model(spark, zone):
    rows = _rows(random.Random(2))
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        got = {r["lead_hours"]: r for r in fc.lead_time_accuracy(spark.createDataFrame(rows, SCHEMA), "hourly", "v", bucket_hours=6).collect()}
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    latest = {}
    for r in rows:
        latest[r[:2]] = max(latest.get(r[:2], r), r, key=lambda x: (x[3], x[4]))
    errors = {}
    for r in rows:
        truth = latest[r[:2]]
        if r is not truth and r[2] is not None and truth[2] is not None:
            lead = math.floor((r[1] - r[3]).total_seconds() / 3600)
            errors.setdefault(lead // 6 * 6, []).append(Decimal(str(r[2])) - Decimal(str(truth[2])))
    assert set(got) == set(errors) and min(errors) < 0
    for lead, e in errors.items():
        g = got[lead]
        assert g["n"] == len(e)
        assert g["bias"] == pytest.approx(float(sum(e)) / len(e)) and g["mae"] == pytest.approx(float(sum(map(abs, e))) / len(e))
        assert g["rmse"] == pytest.approx(math.sqrt(float(sum(x * x for x in e)) / len(e)))


def test_latest_forecast_and_as_of(spark):
    rows = _rows(random.Random(3))
    df = spark.createDataFrame(rows, SCHEMA)
    for as_of in (None, T0 - timedelta(hours=20)):
        want = {}
        for r in rows:
            if as_of is None or r[3] <= as_of:
                want[r[:2]] = max(want.get(r[:2], r), r, key=lambda x: (x[3], x[4]))
        got = fc.latest_forecast(df, "hourly", as_of=as_of)
        assert got.columns == df.columns
        assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want.values()))


def test_empty(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert fc.latest_forecast(df, "hourly").collect() == [] and fc.lead_time_accuracy(df, "hourly", "v").collect() == []
