"""Data-quality queries over the lake.

Each function takes column names as arguments, with the weather names as
defaults, so the same operators run on any table with the same roles. All are
one ``groupBy`` (partial aggregation before the shuffle, so a hot location is
pre-reduced map-side) or a single projection.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forecastlake.functions.scalars import duck_round
from forecastlake.operators.flatten import DAILY_VARIABLES, HOURLY_VARIABLES, INTEGER_VARIABLES, TIME_COLUMN
from forecastlake.schemas import require_interval

def roles(interval: str, **overrides) -> dict:
    """Column roles of an interval, read off its schema and variable map.

    Temperatures are the variables named so, the warmest first; rain is the
    precipitation variable. Any role can be overridden by keyword.
    """
    variables = list(HOURLY_VARIABLES if require_interval(interval) == "hourly" else DAILY_VARIABLES)
    temps = sorted(v for v in variables if v.startswith("temperature"))
    rain = next(v for v in variables if v.startswith("precipitation"))
    shown = [v for v in variables if v in (*temps, rain) or v in INTEGER_VARIABLES]
    time = TIME_COLUMN[interval]
    return {"date_col": time, "temp_col": temps[0], "temp_col_min": temps[1] if len(temps) > 1 else None,
            "precip_col": rain, "sample_cols": [time, *shown], **overrides}


def completeness(df: DataFrame, *, location_col: str = "location_name",
                 date_col: str = "timestamp") -> DataFrame:
    """Rows and distinct times per location, by location (A1, O1)."""
    return (df.groupBy(location_col)
            .agg(F.count(F.lit(1)).alias("record_count"),
                 F.count_distinct(date_col).alias("unique_dates"))
            .orderBy(F.col(location_col).asc_nulls_last()))


def ranges(df: DataFrame, interval: str, *, location_col: str = "location_name",
           **role_overrides) -> DataFrame:
    """Temperature / precipitation ranges per location, by avg desc."""
    r = roles(interval, **role_overrides)
    t, p = F.col(r["temp_col"]), F.col(r["precip_col"])
    aggs = [duck_round(F.min(t), 1).alias("min_temp"),
            duck_round(F.max(t), 1).alias("max_temp"),
            duck_round(F.avg(t), 1).alias("avg_temp")]
    if r["temp_col_min"]:
        aggs.append(duck_round(F.min(r["temp_col_min"]), 1).alias("min_temp_min"))
    aggs += [duck_round(F.max(p), 2).alias("max_precip_mm"),
             F.count_if(t.isNull()).alias("null_count")]
    return df.groupBy(location_col).agg(*aggs).orderBy(F.col("avg_temp").desc_nulls_last())


def comparison(df: DataFrame, interval: str, *, location_col: str = "location_name",
               **role_overrides) -> DataFrame:
    """Cross-location comparison (A5 daily, A6 hourly)."""
    r = roles(interval, **role_overrides)
    t, p = F.col(r["temp_col"]), F.col(r["precip_col"])
    if r["temp_col_min"]:
        aggs = [duck_round(F.avg(t), 1).alias("avg_max_temp_c"),
                duck_round(F.avg(r["temp_col_min"]), 1).alias("avg_min_temp_c"),
                duck_round(F.sum(p), 1).alias("total_precip_mm")]
        order = "avg_max_temp_c"
    else:
        aggs = [duck_round(F.avg(t), 1).alias("avg_temp_c"),
                duck_round(F.max(p), 2).alias("max_precip_mm"),
                F.count(F.lit(1)).alias("record_count")]
        order = "avg_temp_c"
    return df.groupBy(location_col).agg(*aggs).orderBy(F.col(order).desc_nulls_last())


def location_summary(df: DataFrame, interval: str, *, location_col: str = "location_name",
                     **role_overrides) -> DataFrame:
    """Completeness, range and comparison columns per location in one aggregation.

    The same numbers as ``completeness`` + ``ranges`` + ``comparison`` (A1-A3,
    A5, A6), from one scan and one shuffle instead of one per check.
    """
    r = roles(interval, **role_overrides)
    t, p = F.col(r["temp_col"]), F.col(r["precip_col"])
    aggs = [F.count(F.lit(1)).alias("record_count"),
            F.count_distinct(r["date_col"]).alias("unique_dates"),
            duck_round(F.min(t), 1).alias("min_temp"), duck_round(F.max(t), 1).alias("max_temp"),
            duck_round(F.avg(t), 1).alias("avg_temp"),
            duck_round(F.max(p), 2).alias("max_precip_mm"),
            F.count_if(t.isNull()).alias("null_count")]
    if r["temp_col_min"]:
        aggs += [duck_round(F.min(r["temp_col_min"]), 1).alias("min_temp_min"),
                 duck_round(F.avg(r["temp_col_min"]), 1).alias("avg_min_temp_c"),
                 duck_round(F.sum(p), 1).alias("total_precip_mm")]
    return df.groupBy(location_col).agg(*aggs).orderBy(F.col(location_col).asc_nulls_last())


def ingestion_span(df: DataFrame, *, ingestion_col: str = "ingestion_timestamp_utc") -> DataFrame:
    """Earliest, latest and distinct ingestion times; one row even when empty (A4)."""
    c = F.col(ingestion_col)
    return df.agg(F.min(c).alias("earliest_ingest"), F.max(c).alias("latest_ingest"),
                  F.count_distinct(c).alias("unique_ingest_times"))


def rows_per_location(df: DataFrame, *, location_col: str = "location_name") -> DataFrame:
    """Row count per location."""
    return df.groupBy(location_col).agg(F.count(F.lit(1)).alias("record_count"))


def temp_range(df: DataFrame, *, location_col: str = "location_name",
               temp_col: str = "temperature_2m_max") -> DataFrame:
    """Min / max temperature per location, 1 dp."""
    return df.groupBy(location_col).agg(duck_round(F.min(temp_col), 1).alias("min_temp"),
                                        duck_round(F.max(temp_col), 1).alias("max_temp"))


def duplicates(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with their count (A9, F7 HAVING)."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("dup_count"))
            .filter(F.col("dup_count") > 1))


def null_counts(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """NULL count of every column in one pass: one row, one column each (A10)."""
    cols = columns or df.columns
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])


def null_counts_long(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """A10 in long form: (column_name, null_count)."""
    cols = columns or df.columns
    wide = null_counts(df, cols)
    pairs = ", ".join(f"'{c}', `{c}`" for c in cols)
    return wide.selectExpr(f"stack({len(cols)}, {pairs}) as (column_name, null_count)")


def null_total(summary: DataFrame, col: str = "null_count") -> DataFrame:
    """Sum of a per-location null-count column; 0 when empty."""
    return summary.agg(F.coalesce(F.sum(col), F.lit(0)).cast("long").alias("null_total"))


def assert_no_nulls(summary: DataFrame, col: str = "null_count") -> int:
    """Gate G1: raise when the summed null count is not zero. Returns the total."""
    total = null_total(summary, col).head()["null_total"]
    if total != 0:
        raise AssertionError(f"null gate failed: {total} nulls")
    return total


def sample(df: DataFrame, interval: str, *, n: int = 10, location_col: str = "location_name",
           tie_breakers: tuple[str, ...] = ("ingestion_timestamp_utc", "run_id"),
           **role_overrides) -> DataFrame:
    """Top-n sample ordered by location and time (O3); ties broken explicitly.

    ``orderBy(...).limit(n)`` plans as TakeOrderedAndProject: each task keeps
    its own top n, so only n rows per task reach the final merge.
    """
    r = roles(interval, **role_overrides)
    cols = [location_col, *r["sample_cols"], "ingestion_timestamp_utc"]
    order = [F.col(location_col).asc_nulls_last(), F.col(r["date_col"]).asc_nulls_last(),
             *[F.col(c).asc_nulls_last() for c in tie_breakers]]
    return df.orderBy(*order).limit(n).select(*dict.fromkeys(cols))


def head(df: DataFrame, order: list[str], n: int = 1) -> DataFrame:
    """First n rows by an explicit order."""
    return df.orderBy(*[F.col(c).asc_nulls_last() for c in order]).limit(n)


def tail(df: DataFrame, order: list[str], n: int = 3) -> DataFrame:
    """Last n rows by an explicit order: descending top-n."""
    return df.orderBy(*[F.col(c).desc_nulls_last() for c in order]).limit(n)


def coordinates(df: DataFrame, *, location_col: str = "location_name") -> DataFrame:
    """Distinct requested vs API coordinates per location."""
    return (df.select(location_col, "requested_latitude", "requested_longitude",
                      "api_latitude", "api_longitude").distinct()
            .orderBy(F.col(location_col).asc_nulls_last()))


def distinct_pairs(df: DataFrame, cols: list[str]) -> DataFrame:
    """Distinct combinations of the given columns."""
    return df.select(*cols).distinct()
