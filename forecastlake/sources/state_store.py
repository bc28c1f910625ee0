"""Versioned state table in hash buckets.

Rows are dealt to buckets by a hash of their key. A version ``{root}/v=NNNNNNNNNN`` is a
small manifest that names, for each bucket, the version that wrote it last and its row
count; the rows lie in ``{root}/_buckets/v=N/bucket=B``. An update reads and rewrites the
buckets of its keys only, and the new version keeps pointing at the others. Spark's
commit protocol drops a ``_SUCCESS`` marker when the manifest is complete, and readers
take the highest committed version. A save never overwrites files of another version,
so a failed or concurrent writer cannot corrupt the current state, and a lost
executor only re-runs tasks of the new version.
"""

from __future__ import annotations

import logging
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forecastlake.operators.state import apply_outcomes, merge_reduced, reduce_updates
from forecastlake.schemas import STATE, STATE_KEY
from forecastlake.session import empty_frame, scratch_path

log = logging.getLogger(__name__)

# Fixed value: format version of the state document.
STATE_FORMAT_VERSION = "1.0"
#: Rows that a bucket should hold; buckets at most. A state that outgrows its buckets
#: eightfold is dealt anew by its next save.
BUCKET_ROWS, MAX_BUCKETS = 10_000, 4096
#: Reduced updates that are broadcast at most (some hundred bytes each).
BROADCAST_UPDATES = 200_000
MANIFEST = "bucket int, version int, n_rows long, buckets int"


def _fs(spark: SparkSession, root: str):
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(root)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jvm


def _version_dirs(spark: SparkSession, root: str) -> list[tuple[int, object]]:
    fs, jvm = _fs(spark, root)
    base = jvm.org.apache.hadoop.fs.Path(root)
    if not fs.exists(base):
        return []
    out = []
    for st in fs.listStatus(base):
        name = st.getPath().getName()
        if st.isDirectory() and name.startswith("v="):
            try:
                out.append((int(name[2:]), st.getPath()))
            except ValueError:
                continue
    return sorted(out, key=lambda t: t[0])


def latest_version(spark: SparkSession, root: str) -> int | None:
    """Highest committed version: one listing, then ``_SUCCESS`` probes from the top."""
    fs, jvm = _fs(spark, root)
    for v, path in reversed(_version_dirs(spark, root)):
        if fs.exists(jvm.org.apache.hadoop.fs.Path(path, "_SUCCESS")):
            return v
    return None


def committed_versions(spark: SparkSession, root: str) -> list[int]:
    """All committed version numbers, ascending (for inspection and tests)."""
    fs, jvm = _fs(spark, root)
    return [v for v, p in _version_dirs(spark, root)
            if fs.exists(jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS"))]


def version_path(root: str, version: int) -> str:
    return f"{root.rstrip('/')}/v={version:010d}"


def empty_state(spark: SparkSession) -> DataFrame:
    return empty_frame(spark, STATE)


def _bucket(buckets: int):
    return F.pmod(F.xxhash64(*STATE_KEY), F.lit(buckets)).cast("int")


def _bucket_root(root: str, version: int) -> str:
    return f"{root.rstrip('/')}/_buckets/v={version:010d}"


def _manifest(spark: SparkSession, root: str, version: int) -> list | None:
    """Rows of a version's manifest, MAX_BUCKETS at most; None for a version that holds the rows itself."""
    rows = spark.read.parquet(version_path(root, version))
    if "bucket" not in rows.columns:
        return None
    return sorted(rows.select("bucket", "version", "n_rows", "buckets").collect(), key=lambda r: r["bucket"])


def _rows_of(spark: SparkSession, root: str, manifest: list) -> DataFrame:
    paths = [f"{_bucket_root(root, r['version'])}/bucket={r['bucket']}" for r in manifest]
    return spark.read.schema(STATE).parquet(*paths) if paths else empty_state(spark)


def _current(spark: SparkSession, root: str) -> tuple[int, list | None] | None:
    """The latest committed version that can be read, and its manifest.

    Row counts of its files' footers must be those of the manifest; no rows are read.
    """
    for v in reversed(committed_versions(spark, root)):
        try:
            manifest = _manifest(spark, root, v)
            if manifest is None:
                state = spark.read.schema(STATE).parquet(version_path(root, v))
                state.agg(F.sum(F.hash(*state.columns).cast("long"))).collect()
            elif _rows_of(spark, root, manifest).count() != sum(r["n_rows"] for r in manifest):
                raise ValueError("rows are missing")
            return v, manifest
        except Exception as exc:  # Spark reports damaged files in several classes
            log.warning("could not read state version %s: %s", version_path(root, v), exc)
    return None


def read_state(spark: SparkSession, root: str) -> DataFrame:
    """Latest committed state that can be read; a missing store is empty.

    A version's files are checked by their footers before it is returned, so damaged
    ones show here: they are warned about and the version before is taken, or an empty
    state if none can be read. A store that can't be listed is an error: taking it
    for empty would let the next save drop every key.
    """
    found = _current(spark, root)
    if found is None:
        return empty_state(spark)
    version, manifest = found
    if manifest is None:      # written before there were buckets
        return spark.read.schema(STATE).parquet(version_path(root, version))
    return _rows_of(spark, root, manifest)


@dataclass
class BucketChange:
    """New rows of the buckets that an update touches; the others stay as version ``base`` has them."""

    rows: DataFrame
    touched: list[int]
    base: int
    manifest: list


def update_buckets(spark: SparkSession, root: str, updates: DataFrame) -> BucketChange | DataFrame:
    """What ``save_state`` writes to apply ``updates`` to the stored state.

    Reads the buckets of the updates' keys only and joins them to the reduced updates,
    which are broadcast up to a checked number, so that the state isn't shuffled. A new
    store, one without buckets and one that has outgrown them give the whole state.
    """
    found = _current(spark, root)
    if found is None:
        return apply_outcomes(empty_state(spark), updates)
    version, manifest = found
    if not manifest or sum(r["n_rows"] for r in manifest) > 8 * BUCKET_ROWS * manifest[0]["buckets"] < 8 * BUCKET_ROWS * MAX_BUCKETS:
        return apply_outcomes(read_state(spark, root), updates)
    path = scratch_path(spark, "state-updates")
    reduced = reduce_updates(updates)
    reduced.write.parquet(path)
    reduced = spark.read.schema(reduced.schema).parquet(path)
    buckets = manifest[0]["buckets"]
    touched = sorted(r[0] for r in reduced.select(_bucket(buckets)).distinct().collect())
    held = _rows_of(spark, root, [r for r in manifest if r["bucket"] in set(touched)])
    return BucketChange(merge_reduced(held, reduced, small=reduced.count() <= BROADCAST_UPDATES), touched, version, manifest)


def expire_versions(spark: SparkSession, root: str, keep: int = 10) -> list[int]:
    """Remove all but the newest ``keep`` committed versions; returns those removed.

    Bucket files that no kept version names go with them. For the owner to call when
    no reader still uses an old version.
    """
    if keep < 1:
        raise ValueError("keep must be at least 1")
    fs, jvm = _fs(spark, root)
    committed = committed_versions(spark, root)
    named = set()
    for v in committed[-keep:]:
        try:
            named |= {(r["version"], r["bucket"]) for r in _manifest(spark, root, v) or []}
        except Exception as exc:      # a damaged manifest names nothing that can be read
            log.warning("could not read state version %s: %s", version_path(root, v), exc)
    for v in committed[:-keep]:
        fs.delete(jvm.org.apache.hadoop.fs.Path(version_path(root, v)), True)
    oldest = committed[-keep:][:1]
    for v, path in _version_dirs(spark, f"{root.rstrip('/')}/_buckets"):
        for st in fs.listStatus(path) if oldest and v < oldest[0] else []:
            name = st.getPath().getName()
            if name.startswith("bucket=") and (v, int(name[7:])) not in named:
                fs.delete(st.getPath(), True)
    return committed[:-keep]


def save_state(state: DataFrame | BucketChange, root: str, *, compression: str = "zstd",
               buckets: int | None = None) -> str:
    """Write the next version and return its path (K7).

    ``state`` is the whole state, dealt to ``buckets`` (by its size unless given), or the
    touched buckets of an update. Two runs saving at once pick the same next number; the
    second write fails (``errorifexists``) instead of overwriting, and an update of a
    version that is no longer the latest is an error; either can be retried on top of
    the new current version.
    """
    whole = not isinstance(state, BucketChange)
    rows = state if whole else state.rows
    spark = rows.sparkSession
    # Next number after every existing directory, committed or not, so a
    # half-written version left by a crashed save is never reused.
    used = [v for top in (root, f"{root.rstrip('/')}/_buckets") for v, _ in _version_dirs(spark, top)]
    version = max(used, default=0) + 1
    kept = []
    if whole:
        if buckets is None:
            path = scratch_path(spark, "state")
            rows.select(*STATE.fieldNames()).write.parquet(path)
            rows = spark.read.schema(STATE).parquet(path)
            wanted = max(1, rows.count() // BUCKET_ROWS)
            buckets = min(MAX_BUCKETS, 1 << (wanted - 1).bit_length())
    else:
        if latest_version(spark, root) != state.base and _current(spark, root)[0] != state.base:
            raise RuntimeError(f"the state has changed since version {state.base}")
        buckets = state.manifest[0]["buckets"]
        kept = [tuple(r) for r in state.manifest if r["bucket"] not in set(state.touched)]
    target = _bucket_root(root, version)
    (rows.select(*STATE.fieldNames(), _bucket(buckets).alias("bucket")).repartition("bucket")
     .write.mode("errorifexists").option("compression", compression).partitionBy("bucket").parquet(target))
    written = (spark.read.schema("bucket int").parquet(target).groupBy("bucket")
               .agg(F.count(F.lit(1)).alias("n_rows"))
               .select("bucket", F.lit(version).alias("version"), "n_rows", F.lit(buckets).alias("buckets")))
    path = version_path(root, version)
    manifest = written.unionByName(spark.createDataFrame(kept, MANIFEST)) if kept else written
    manifest.coalesce(1).write.mode("errorifexists").parquet(path)
    return path


def state_info(spark: SparkSession, root: str) -> DataFrame:
    """Document-level metadata of the state: schema version, committed version,
    path and ``last_updated`` (the commit time of that version)."""
    v = latest_version(spark, root)
    schema = "format_version string, version int, path string, last_updated timestamp"
    if v is None:
        return spark.createDataFrame([], schema)
    fs, jvm = _fs(spark, root)
    done = fs.getFileStatus(jvm.org.apache.hadoop.fs.Path(version_path(root, v), "_SUCCESS"))
    from datetime import datetime, timezone
    updated = datetime.fromtimestamp(done.getModificationTime() / 1000.0, tz=timezone.utc)
    return spark.createDataFrame([(STATE_FORMAT_VERSION, v, version_path(root, v), updated)], schema)
