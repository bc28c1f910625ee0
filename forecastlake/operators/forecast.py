"""Forecasts of one target time from many fetches: the latest one, and accuracy by lead time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forecastlake.operators.flatten import TIME_COLUMN

#: Decimal places that errors are added up in: sums don't depend on the order of rows.
ERROR_SCALE = 6


def _key(interval: str, time_col: str | None) -> list[str]:
    return ["location_name", time_col or TIME_COLUMN[interval]]


def latest_forecast(lake: DataFrame, interval: str, *, time_col: str | None = None, as_of=None) -> DataFrame:
    """The row of the latest fetch of each location and target time.

    With ``as_of`` (a column, or a value that compares with the ingestion time) only what
    was fetched by then counts: what the forecast said at that moment. Fetches of one
    moment go by run id. One aggregation, combined before its shuffle, so a target that
    a hundred fetches cover costs one row a task.
    """
    if as_of is not None:
        bound = as_of if isinstance(as_of, Column) else F.lit(as_of)
        lake = lake.filter(F.col("ingestion_timestamp_utc") <= bound)
    key = _key(interval, time_col)
    rest = [c for c in lake.columns if c not in key]
    last = F.max_by(F.struct(*rest), F.struct("ingestion_timestamp_utc", "run_id"))
    return lake.groupBy(*key).agg(last.alias("_last")).select(*[F.col(c) if c in key else F.col(f"_last.{c}") for c in lake.columns])


def lead_hours(time_col: str) -> Column:
    """Whole hours from the fetch to the target time, rounded down; negative once it has passed."""
    # Both are wall clocks in UTC: days and times of day are taken apart, so no session zone comes in.
    def seconds(c: str) -> Column:
        return F.unix_date(F.to_date(c)).cast("long") * 86400 + F.hour(c) * 3600 + F.minute(c) * 60 + F.second(c)

    return F.floor((seconds(time_col) - seconds("ingestion_timestamp_utc")) / 3600)


def lead_time_accuracy(lake: DataFrame, interval: str, variable: str, *, time_col: str | None = None,
                       bucket_hours: int = 24) -> DataFrame:
    """Accuracy of ``variable`` by lead time: lead_hours, n, bias, mae, rmse.

    Every forecast of a location and target time is held against the latest one of that
    target, which stands for the truth and is left out itself. Lead times are grouped by
    ``bucket_hours`` and named by their least hour. Forecasts or truths without a
    value don't count. Errors are taken at ``ERROR_SCALE`` decimals and added up exactly.
    """
    key = _key(interval, time_col)
    truth = latest_forecast(lake, interval, time_col=time_col).select(
        *key, F.col(variable).alias("_truth"), F.col("ingestion_timestamp_utc").alias("_at"), F.col("run_id").alias("_run"))
    other = (F.col("ingestion_timestamp_utc") != F.col("_at")) | (F.col("run_id") != F.col("_run"))
    exact = f"decimal(18,{ERROR_SCALE})"
    rows = lake.join(truth, key).filter(other).select(
        (F.floor(lead_hours(key[1]) / bucket_hours) * bucket_hours).alias("lead_hours"),
        (F.col(variable).cast(exact) - F.col("_truth").cast(exact)).alias("e")).filter("e is not null")
    n = F.count(F.lit(1))
    sums = rows.groupBy("lead_hours").agg(n.alias("n"), F.sum("e").alias("s"), F.sum(F.abs("e")).alias("a"),
                                          F.sum((F.col("e") * F.col("e")).cast("decimal(38,12)")).alias("q"))
    return sums.select("lead_hours", "n", (F.col("s").cast("double") / F.col("n")).alias("bias"),
                       (F.col("a").cast("double") / F.col("n")).alias("mae"),
                       F.sqrt(F.col("q").cast("double") / F.col("n")).alias("rmse")).orderBy("lead_hours")
