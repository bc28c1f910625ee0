"""Lake scans (S4, S5, S8) over the Hive-partitioned forecast lake.

Layout written by ``sinks.lake.write_forecasts``:
``{base}/provider=…/interval=…/ingest_date=…/run_id=…/part-*.parquet`` or, by location,
``{base}/provider=…/interval=…/location_name=…/ingest_date=…[/run_id=…]/part-*.parquet``.
Reads always pass the full schema, so partition values are never re-inferred
(a location called ``123`` stays a string) and Null-typed files cannot break
the scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from forecastlake.schemas import INTERVAL_SCHEMA, require_interval
from forecastlake.session import empty_frame, path_exists
from forecastlake.sources.manifest import has_manifest, latest_by_manifest, read_manifest, winning_runs

PARTITION_FIELDS = {
    "provider": T.StringType(),
    "interval": T.StringType(),
    "ingest_date": T.DateType(),
}


def lake_schema(interval: str) -> T.StructType:
    """Interval schema plus the partition-only columns."""
    fields = list(INTERVAL_SCHEMA[require_interval(interval)].fields)
    fields += [T.StructField(n, t) for n, t in PARTITION_FIELDS.items()]
    return T.StructType(fields)


def latest_runs(lake: DataFrame) -> DataFrame:
    """The latest run of each provider, location and ingestion day, from the rows themselves.

    For lakes without a manifest (by location, or written elsewhere): aggregates all rows.
    """
    keys = [c for c in ("provider", "location_name", "ingest_date") if c in lake.columns]
    runs = lake.select(*keys, "ingestion_timestamp_utc", "run_id").distinct()
    last = runs.groupBy(*keys).agg(F.max(F.struct("ingestion_timestamp_utc", "run_id"))["run_id"].alias("run_id"))
    return lake.join(last, [*keys, "run_id"], "left_semi")


def read_lake(spark: SparkSession, base_path: str, interval: str, *,
              provider: str | None = None, with_partitions: bool = False,
              ingest_dates=None, run_ids=None, latest_only: bool | None = None) -> DataFrame:
    """Whole-tree read of one interval (S4); columns in the interval's order.

    Works on either layout. With a provider the scan starts at that
    provider/interval directory, so the file listing never walks other intervals or
    providers. ``ingest_dates`` and ``run_ids`` are filters on partition values: they
    prune, whatever characters the values hold. Daily reads return the latest run of
    each location and day unless ``latest_only`` is false or runs are named; the run
    manifest says which that is (K4).
    """
    schema = lake_schema(interval)
    root = f"{base_path}/provider={provider or '*'}/interval={interval}"
    if provider is not None and not path_exists(spark, root) or provider is None and not _any_provider(spark, base_path):
        df = empty_frame(spark, schema)      # nothing written yet
    else:
        df = spark.read.schema(schema).option("basePath", base_path).parquet(root)
    def chosen(rows):
        if ingest_dates is not None:
            rows = rows.filter(F.col("ingest_date").isin([F.lit(str(d)).cast("date") for d in ingest_dates]))
        return rows if run_ids is None else rows.filter(F.col("run_id").isin(list(run_ids)))

    df = chosen(df)
    if latest_only if latest_only is not None else interval == "daily" and run_ids is None:
        if _all_have_manifests(spark, base_path, interval, provider):
            df = latest_by_manifest(df, chosen(read_manifest(spark, base_path, interval, provider)))
        else:
            df = latest_runs(df)
    cols = [f.name for f in INTERVAL_SCHEMA[interval].fields]
    if with_partitions:
        cols += list(PARTITION_FIELDS)
    return df.select(*cols)


def read_lake_end(spark: SparkSession, base_path: str, interval: str, *, provider: str, n: int, last: bool = True) -> DataFrame:
    """Rows among which the lake's ``n`` latest (or earliest) by time are certain to be.

    A threshold scan over the manifest: taken by their least time, the latest manifest
    rows hold n rows at or after some time, so no earlier row is among the n latest, and
    only runs that reach that time are read. Ties at it are all kept: sort and limit the
    result by any order that begins with the time. Rows without a time come last in
    either order and aren't returned unless the lake has fewer than n with one.
    """
    time_col = INTERVAL_SCHEMA[require_interval(interval)].fields[5].name
    lake = read_lake(spark, base_path, interval, provider=provider, with_partitions=True)
    if not has_manifest(spark, base_path, provider, interval):
        return lake
    manifest = read_manifest(spark, base_path, interval, provider).filter("n_rows > 0")
    if interval == "daily":
        manifest = manifest.join(winning_runs(manifest), ["provider", "location_name", "ingest_date", "run_id"], "left_semi")
    near, far = ("first_time", "last_time") if last else ("last_time", "first_time")
    order = F.desc_nulls_last(near) if last else F.asc_nulls_last(near)
    # n rows at most, each of one row or more: with the nulls of a run left out, enough.
    bounds = manifest.filter(F.col("n_times") > 0).orderBy(order).select(near, "n_times").limit(n).collect()
    total, edge = 0, None
    for r in bounds:
        total, edge = total + r["n_times"], r[near]
        if total >= n:
            break
    if total < n:
        return lake
    reach = (lambda c: F.col(c) >= F.lit(edge)) if last else (lambda c: F.col(c) <= F.lit(edge))
    runs = manifest.filter(reach(far)).select("ingest_date", "run_id").distinct()
    return lake.filter(reach(time_col)).join(runs, ["ingest_date", "run_id"], "left_semi").select(*lake.columns)


def _providers(spark: SparkSession, base_path: str) -> list[str]:
    """One listing of the lake's top folder, which has a folder for each provider."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(base_path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []
    return [n.removeprefix("provider=") for n in names if n.startswith("provider=")]


def _any_provider(spark: SparkSession, base_path: str) -> bool:
    return bool(_providers(spark, base_path))


def _all_have_manifests(spark: SparkSession, base_path: str, interval: str, provider: str | None) -> bool:
    """Whether the manifest covers what is read: every provider that has the interval."""
    wanted = [provider] if provider is not None else [
        p for p in _providers(spark, base_path) if path_exists(spark, f"{base_path}/provider={p}/interval={interval}")]
    return bool(wanted) and all(has_manifest(spark, base_path, p, interval) for p in wanted)


def lake_path_columns(df: DataFrame) -> DataFrame:
    """Partition values recovered from each row's file path."""
    path = F.col("_metadata.file_path")

    def part(name: str):
        return F.url_decode(F.regexp_extract(path, f"/{name}=([^/]+)", 1))

    return df.select("*", part("provider").alias("path_provider"),
                     part("interval").alias("path_interval"),
                     part("location_name").alias("path_location"),
                     part("ingest_date").try_cast("date").alias("path_date"))


def read_parquet(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Read back a written Parquet path."""
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    return r.parquet(path)


def legacy_file_schema(interval: str) -> T.StructType:
    """Column types as found in files of the older one-file-per-location tree.

    Integer codes were written as 64-bit and all-NULL columns as a Null type;
    reading with this schema maps both (a Null column reads as NULLs).
    """
    fields = []
    for f in INTERVAL_SCHEMA[require_interval(interval)].fields:
        t = T.LongType() if isinstance(f.dataType, T.IntegerType) else f.dataType
        fields.append(T.StructField(f.name, t))
    return T.StructType(fields)


def read_legacy_tree(spark: SparkSession, root: str, interval: str, *,
                     provider: str = "open_meteo") -> DataFrame:
    """Read a lake in the older layout.

    Layout: ``{root}/{provider}/{interval}/{location}/{YYYY}/{MM}/{DD}/forecast_*.parquet``
    (no ``key=value`` directories). Recursive file lookup with an explicit
    schema, so no partition inference and no per-file schema merge; columns come
    back in the interval's order and types, plus ``path_location`` and
    ``path_date`` recovered from the path.
    """
    base = f"{root.rstrip('/')}/{provider}/{interval}"
    df = (spark.read.schema(legacy_file_schema(interval))
          .option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
          .parquet(base))
    path = F.url_decode(F.col("_metadata.file_path"))
    pattern = f"/{interval}/([^/]+)/([0-9]{{4}})/([0-9]{{2}})/([0-9]{{2}})/[^/]+$"
    cols = [F.col(f.name).cast(f.dataType).alias(f.name) for f in INTERVAL_SCHEMA[interval].fields]
    return df.select(
        *cols,
        F.regexp_extract(path, pattern, 1).alias("path_location"),
        F.concat_ws("-", F.regexp_extract(path, pattern, 2), F.regexp_extract(path, pattern, 3),
                    F.regexp_extract(path, pattern, 4)).try_cast("date").alias("path_date"),
    )
