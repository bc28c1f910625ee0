"""Physical-plan properties that matter at scale."""

from forecastlake.plans.queries import QUERIES
from tests.conftest import SF_SMALL


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_python_in_any_query_plan(spark):
    for name in ("ranges_from_responses", "flatten_hourly", "row_validation", "attempt_resolution",
                 "state_freshness", "completeness"):
        p = _plan(QUERIES[name](spark, SF_SMALL))
        assert "Python" not in p and "ArrowEval" not in p, name


def test_scan_is_pruned(spark):
    p = _plan(QUERIES["completeness"](spark, SF_SMALL))
    assert "ReadSchema: struct<ts:timestamp_ntz,event_type:string>" in p


def test_exploded_rows_do_not_carry_the_document(spark):
    df = QUERIES["flatten_hourly"](spark, SF_SMALL)
    gen = [ln for ln in _plan(df).splitlines() if "Generate" in ln]
    assert gen and not any("doc" in ln and "inline(" in ln and "_docs" not in ln for ln in gen)


def test_body_parsed_once(spark):
    p = _plan(QUERIES["flatten_hourly"](spark, SF_SMALL))
    assert p.count("from_json(") == 1


def test_attempt_resolution_is_one_aggregation(spark):
    p = _plan(QUERIES["attempt_resolution"](spark, SF_SMALL))
    assert "Window" not in p and "SortMergeJoin" not in p


def test_quality_aggregations_are_partial_before_the_shuffle(spark):
    for name in ("completeness", "ranges_daily", "duplicates", "attempt_resolution"):
        p = _plan(QUERIES[name](spark, SF_SMALL))
        first_exchange = p.index("Exchange")
        assert "partial_" in p[first_exchange:], name   # map-side partial aggregate below the shuffle


def test_hot_location_is_split_across_writers(spark, tmp_dir):
    """One location with ~90% of the rows is written by several tasks (AQE rebalance)."""
    import os
    from pyspark.sql import functions as F
    from forecastlake.sinks.lake import write_forecasts
    from forecastlake.schemas import DAILY

    n = 400_000
    df = (spark.range(n).select(
        F.when(F.col("id") % 10 == 0, F.concat(F.lit("L"), (F.col("id") % 7).cast("string")))
         .otherwise(F.lit("HOT")).alias("location_name"),
        F.lit(1.0).alias("requested_latitude"), F.lit(2.0).alias("requested_longitude"),
        F.lit(1.0).alias("api_latitude"), F.lit(2.0).alias("api_longitude"),
        F.lit("2031-03-07").cast("timestamp_ntz").alias("date"),
        F.rand(1).alias("temperature_2m_max"), F.rand(2).alias("temperature_2m_min"),
        F.rand(3).alias("precipitation_sum"), F.lit("open-meteo").alias("source_api"),
        F.lit("2031-03-07 06:00:00").cast("timestamp_ntz").alias("ingestion_timestamp_utc"),
        F.lit("r1").alias("run_id")))
    assert df.columns == DAILY.fieldNames()
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(size, "1m")        # in proportion to this small table
    try:
        write_forecasts(df, tmp_dir, interval="daily", provider="p", compression="snappy",
                        layout="by_location", latest_run_only=False)
    finally:
        spark.conf.unset(size)
    hot = f"{tmp_dir.replace('file:', '')}/provider=p/interval=daily/location_name=HOT/ingest_date=2031-03-07"
    files = [f for f in os.listdir(hot) if f.endswith(".parquet")]
    assert len(files) > 1


def test_lake_write_sorts_once_with_time(spark, tmp_dir):
    """The writer's sort already carries the time column: no second sort."""
    from forecastlake.plans.queries import _hourly
    from forecastlake.sinks.lake import partition_columns, with_lake_columns

    h = with_lake_columns(_hourly(spark, SF_SMALL).drop("event_id"), interval="hourly")
    parts = partition_columns("hourly")
    h.hint("rebalance", *parts).sortWithinPartitions(*parts, "timestamp").createOrReplaceTempView("fl_src")
    cols = ", ".join([c for c in h.columns if c not in parts] + parts)
    spark.sql(f"CREATE TABLE fl_sorted USING parquet PARTITIONED BY ({', '.join(parts)}) "
              f"LOCATION '{tmp_dir}' AS SELECT {cols} FROM fl_src WHERE false")
    try:
        plan = "\n".join(r[0] for r in spark.sql(
            f"EXPLAIN INSERT OVERWRITE TABLE fl_sorted SELECT {cols} FROM fl_src").collect())
    finally:
        spark.sql("DROP TABLE IF EXISTS fl_sorted")
    sorts = [ln for ln in plan.splitlines() if "Sort [" in ln]
    assert len(sorts) == 1 and "timestamp" in sorts[0]
