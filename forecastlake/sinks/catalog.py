"""The lake as partitioned catalog tables.

A path-based read lists every file under the interval directory before it
prunes partitions; on a lake with millions of partition directories that
listing dominates every query. Registering the interval directory as a
partitioned table lets queries prune from the catalog's partition list and
list only the matching directories. Runs write through the table, whose commit
registers the partitions they wrote, so nothing is collected or listed for it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forecastlake.schemas import INTERVAL_SCHEMA, require_interval
from forecastlake.sources.lake import latest_runs
from forecastlake.sources.manifest import has_manifest, latest_by_manifest, read_manifest
from forecastlake.sinks.lake import (
    DEFAULT_LAYOUT,
    _manifest_state,
    add_manifest,
    arranged,
    interval_root,
    partition_columns,
)

_PART_TYPES = {"location_name": "string", "ingest_date": "date", "run_id": "string"}


def _quote(v) -> str:
    return "'" + str(v).replace("\\", "\\\\").replace("'", "\\'") + "'"


def register_lake_table(spark: SparkSession, name: str, base_path: str, *, interval: str,
                        provider: str, layout: str = DEFAULT_LAYOUT, recover: bool = True) -> str:
    """Create (if absent) a partitioned table over one provider/interval directory.

    ``recover`` runs one full partition discovery (use it once, when adopting
    an existing lake); afterwards write through the table (``write_lake_table``).
    """
    require_interval(interval)
    parts = partition_columns(interval, layout)
    data_cols = [f for f in INTERVAL_SCHEMA[interval].fields if f.name not in parts]
    cols = [f"`{f.name}` {f.dataType.simpleString()}" for f in data_cols]
    cols += [f"`{p}` {_PART_TYPES[p]}" for p in parts]
    # An insert into a catalog table takes its overwrite mode from the table (or the session), not
    # from the writer's options: without it a second run would replace the first one.
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({', '.join(cols)}) USING parquet "
              "OPTIONS ('partitionOverwriteMode' = 'dynamic') "
              f"PARTITIONED BY ({', '.join(parts)}) "
              f"LOCATION {_quote(interval_root(base_path, provider, interval))} "
              f"TBLPROPERTIES ('forecastlake.base' = {_quote(base_path)}, 'forecastlake.provider' = {_quote(provider)})")
    if recover:
        spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")
    return name


def write_lake_table(spark: SparkSession, name: str, df: DataFrame, base_path: str, *, interval: str,
                     provider: str, compression: str = "zstd", layout: str = DEFAULT_LAYOUT,
                     manifest: DataFrame | None = None) -> str:
    """Write a run's rows through the catalog table (created if absent).

    A dynamic partition overwrite: the commit adds the partitions it wrote to the
    catalog and replaces those that a retry writes again. Daily writes by date add
    their manifest rows as ``write_forecasts`` does.
    """
    register_lake_table(spark, name, base_path, interval=interval, provider=provider, layout=layout, recover=False)
    out = arranged(df, interval=interval, layout=layout, latest_run_only=False)
    adopt = _manifest_state(spark, base_path, provider, interval, layout)
    (out.select(*spark.table(name).columns).write.mode("overwrite")
     .option("compression", compression).insertInto(name))
    if interval == "daily" and layout == "by_date":
        add_manifest(df, base_path, provider=provider, interval=interval, manifest=manifest, adopt=adopt)
    return name


def read_lake_table(spark: SparkSession, name: str, interval: str) -> DataFrame:
    """The table's rows in the interval's column order (partition-pruned by the catalog).

    Daily: the latest run of each location and day, from the manifest where there is one.
    """
    table = spark.table(name)
    if interval == "daily":
        known = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}
        base, provider = known.get("forecastlake.base"), known.get("forecastlake.provider")
        if base and has_manifest(spark, base, provider, interval):
            table = latest_by_manifest(table.withColumn("provider", F.lit(provider)),
                                       read_manifest(spark, base, interval, provider))
        else:
            table = latest_runs(table)
    return table.select(*[F.col(f.name) for f in INTERVAL_SCHEMA[interval].fields])
