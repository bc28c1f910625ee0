"""Row validation and quarantine split."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forecastlake.operators.flatten import ERRORS


def row_errors(required: tuple[str, ...] = ("location_name",), errors_col: str = ERRORS) -> Column:
    """All problems of a flattened row: its cells' and its missing required columns."""
    checks = [F.when(F.col(c).isNull(), F.lit(f"missing:{c}")) for c in required]
    return F.array_compact(F.concat(F.col(errors_col), F.array(*checks))) if checks else F.col(errors_col)


def check_rows(df: DataFrame, *, required: tuple[str, ...] = ("location_name",),
               errors_col: str = ERRORS, on_bad: str = "quarantine") -> tuple[DataFrame, DataFrame]:
    """Split flattened rows into (good, quarantined).

    ``errors_col`` holds cell-level problems found while flattening; required
    columns that are NULL add ``missing:<col>``. Good rows drop the errors
    column; quarantined rows keep it as ``errors`` (array<string>).
    ``on_bad='fail'`` restores abort-on-first-bad-row behaviour: the caller
    gets an exception when any row is quarantined.
    """
    tagged = df.withColumn(errors_col, row_errors(required, errors_col))
    good = tagged.filter(F.size(errors_col) == 0).drop(errors_col)
    bad = tagged.filter(F.size(errors_col) > 0).withColumnRenamed(errors_col, "errors")
    if on_bad == "fail":
        first = bad.select("errors").head(1)
        if first:
            raise ValueError(f"row validation failed: {first[0]['errors']}")
    elif on_bad != "quarantine":
        raise ValueError("on_bad must be 'quarantine' or 'fail'")
    return good, bad
