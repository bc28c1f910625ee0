"""Quality queries and scalar functions (A*, O*, U*, G1, X*)."""

import random
from datetime import datetime

import duckdb
import pytest
from pyspark.sql import functions as F

from forecastlake.functions import duck_round, iso_format, partition_path
from forecastlake.operators import quality as q
from forecastlake.schemas import HOURLY


def test_duck_round_matches_duckdb(spark):
    rnd = random.Random(7)
    vals = [round(rnd.uniform(-500, 500), rnd.choice([2, 3, 4])) for _ in range(3000)] + [2.675, 1.005, -0.125]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    got = [(r[0], r[1]) for r in df.select(duck_round("x", 1), duck_round("x", 2)).collect()]
    con = duckdb.connect()
    con.execute("CREATE TABLE t (i INTEGER, x DOUBLE)")
    con.executemany("INSERT INTO t VALUES (?, ?)", list(enumerate(vals)))
    want = [tuple(r) for r in con.execute("SELECT ROUND(x, 1), ROUND(x, 2) FROM t ORDER BY i").fetchall()]
    assert got == want


def test_empty_ingestion_span_is_one_row(spark):
    r = q.ingestion_span(spark.createDataFrame([], HOURLY)).collect()
    assert len(r) == 1 and r[0]["earliest_ingest"] is None and r[0]["unique_ingest_times"] == 0


def test_null_gate(spark):
    summary = spark.createDataFrame([("a", 0), ("b", 2)], "location_name string, null_count long")
    assert q.null_total(summary).first()["null_total"] == 2
    with pytest.raises(AssertionError):
        q.assert_no_nulls(summary)
    assert q.assert_no_nulls(summary.filter("null_count = 0")) == 0


def test_null_counts_long(spark):
    df = spark.createDataFrame([(1, None), (None, None)], "a int, b string")
    assert {tuple(r) for r in q.null_counts_long(df).collect()} == {("a", 1), ("b", 2)}


def test_formats(spark):
    df = spark.createDataFrame([(datetime(2031, 3, 7, 9, 5, 0),), (datetime(2031, 3, 7, 9, 5, 0, 120),)],
                               "t timestamp_ntz")
    assert [r[0] for r in df.select(iso_format("t")).collect()] == \
        ["2031-03-07T09:05:00", "2031-03-07T09:05:00.000120"]
    p = df.limit(1).select(partition_path(F.lit("open_meteo"), F.lit("Harbour"), F.lit("daily"),
                                          F.lit("r"), "t")).first()[0]
    assert p == "open_meteo/daily/Harbour/2031/03/07/forecast_20310307.parquet"


def test_sample_breaks_ties(spark):
    t = datetime(2031, 3, 7)
    rows = [("L", 1.0, 2.0, 1.0, 2.0, t, float(i), 0.0, None, None, None, None, 1, "s", datetime(2025, 1, i + 1),
             f"r{i}") for i in range(12)]
    df = spark.createDataFrame(rows, HOURLY)
    got = [r["temperature_2m"] for r in q.sample(df, "hourly").collect()]
    assert got == [float(i) for i in range(10)]


def test_location_summary_equals_separate_checks(spark):
    from forecastlake.plans.queries import _daily
    from tests.conftest import SF_SMALL

    d = _daily(spark, SF_SMALL)
    summary = {r["location_name"]: r for r in q.location_summary(d, "daily").collect()}
    for r in q.ranges(d, "daily").collect():
        s = summary[r["location_name"]]
        assert (s["min_temp"], s["max_temp"], s["avg_temp"], s["min_temp_min"], s["max_precip_mm"],
                s["null_count"]) == (r["min_temp"], r["max_temp"], r["avg_temp"], r["min_temp_min"],
                                     r["max_precip_mm"], r["null_count"])
    for r in q.completeness(d, date_col="date").collect():
        assert (summary[r["location_name"]]["record_count"], summary[r["location_name"]]["unique_dates"]) == \
            (r["record_count"], r["unique_dates"])
    for r in q.comparison(d, "daily").collect():
        assert summary[r["location_name"]]["total_precip_mm"] == r["total_precip_mm"]


def test_lake_files_are_time_ordered(spark, tmp_dir):
    from pyspark.sql import functions as F
    from forecastlake.plans.queries import _hourly
    from forecastlake.sinks.lake import write_forecasts
    from tests.conftest import SF_SMALL

    shuffled = _hourly(spark, SF_SMALL).drop("event_id").orderBy(F.rand(7)).repartition(4)
    write_forecasts(shuffled, tmp_dir, interval="hourly", provider="p")
    df = spark.read.parquet(tmp_dir).select(F.input_file_name().alias("f"), F.struct("location_name", "timestamp").alias("at"))
    rows = df.collect()
    by_file = {}
    for r in rows:
        by_file.setdefault(r["f"], []).append(tuple(r["at"]))
    assert all(v == sorted(v) for v in by_file.values())


def test_sql_views_over_the_lake(spark, tmp_dir):
    from forecastlake.plans.sql import register_lake_views
    from forecastlake.sinks.lake import write_forecasts
    from forecastlake.plans.queries import _hourly
    from tests.conftest import SF_SMALL

    frame = _hourly(spark, SF_SMALL).drop("event_id")
    write_forecasts(frame, tmp_dir, interval="hourly", provider="open_meteo")
    assert register_lake_views(spark, tmp_dir) == ["daily", "hourly"]
    got = {r[0]: r[1] for r in spark.sql(
        "SELECT location_name, COUNT(*) FROM hourly GROUP BY location_name").collect()}
    want = {r["location_name"]: r["record_count"] for r in q.rows_per_location(frame).collect()}
    assert got == want
    assert spark.sql("SELECT COUNT(*) FROM daily").first()[0] == 0
    for v in (2.675, 1.005, -0.125, 48.45):
        want = duckdb.sql(f"SELECT ROUND(CAST({v} AS DOUBLE), 2), ROUND(CAST({v} AS DOUBLE), 1)").fetchall()[0]
        got = spark.sql(f"SELECT duck_round(CAST({v} AS DOUBLE), 2), duck_round(CAST({v} AS DOUBLE), 1)").first()
        assert tuple(got) == tuple(want), v
