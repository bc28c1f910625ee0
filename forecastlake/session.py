"""Session helpers: sizing defaults and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Defaults for a session this library creates itself (tests, bench). A cluster
# session keeps its own values; nothing here overrides a value already set.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}

def get_spark(master: str | None = None, *, shuffle_partitions: int | None = None,
              app_name: str = "forecastlake", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the library defaults."""
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Read from the session. Only on a local master (tests), where driver and
    executors are one process, is a private folder made when it is unset; on a
    cluster that is an error, as executors couldn't reach such a folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="forecastlake-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
        spark.sparkContext.setCheckpointDir(root)
    elif spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never-reused folder under the shared checkpoint root."""
    return f"{checkpoint_root(spark)}/forecastlake-scratch/{name}-{uuid.uuid4().hex}"


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence check through the cluster's file system (driver metadata call)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def empty_frame(spark: SparkSession, schema) -> "DataFrame":
    """An empty DataFrame the optimizer can see is empty.

    ``createDataFrame([], schema)`` plans as a scan of an RDD, so joins with it
    still shuffle; a filtered-out literal row folds to an empty local relation,
    and joins or unions with it are simplified away.
    """
    from pyspark.sql import functions as F

    return (spark.range(1)
            .select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields])
            .filter(F.lit(False)))
