"""SQL access: the lake as ``hourly`` / ``daily`` views plus a ``duck_round`` function.

Quality questions written as SQL run unchanged through ``spark.sql`` once the
views exist; use ``duck_round(x, n)`` where DuckDB-style ``ROUND`` on doubles
is required (Spark's ``round`` rounds the exact decimal value of the double).
The function is SQL-bodied, so it is inlined into generated code like any
built-in expression.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from forecastlake.sources.lake import read_lake

DUCK_ROUND_SQL = ("CREATE OR REPLACE TEMPORARY FUNCTION duck_round(x DOUBLE, n INT) RETURNS DOUBLE "
                  "RETURN round(x * power(10, n), 0) / power(10, n)")


def register_functions(spark: SparkSession) -> None:
    spark.sql(DUCK_ROUND_SQL)


def register_frames(spark: SparkSession, **frames: DataFrame) -> list[str]:
    """Register DataFrames as temp views by keyword name, plus the SQL functions."""
    register_functions(spark)
    for name, df in frames.items():
        df.createOrReplaceTempView(name)
    return sorted(frames)


def register_lake_views(spark: SparkSession, base_path: str, *, provider: str = "open_meteo",
                        intervals: tuple[str, ...] = ("hourly", "daily")) -> list[str]:
    """``hourly`` / ``daily`` temp views over the lake (explicit schema, pruned listing)."""
    return register_frames(spark, **{i: read_lake(spark, base_path, i, provider=provider) for i in intervals})
