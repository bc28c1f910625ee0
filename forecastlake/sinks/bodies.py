"""Raw bodies landed as files of their own, as a fetcher leaves them."""

from __future__ import annotations

import contextlib
import itertools
import os
import uuid
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Files of a folder, and of a group of folders, which a reader lists at once (about; keys are dealt by hash).
FOLDER_FILES, GROUP_FILES = 500, 100_000
# What opening a file counts as when files of some kilobytes are dealt to tasks.
OPEN_COST = 16 << 10
# Spark's name for a partition without a value.
NO_KEY = "__HIVE_DEFAULT_PARTITION__"


def _local_path(spark: SparkSession, path: str) -> str | None:
    """The path in the file system that all nodes mount, or None if it lies elsewhere."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return p.toUri().getPath() if fs.getUri().getScheme() == "file" else None


def write_bodies(bodies: DataFrame, path: str, *, key: str, body: str = "body") -> list[str]:
    """Each key's bodies as the lines of a file of its own, ``<key>=<value>``; gives the paths to read, one at a time.

    Tasks write mounted files themselves: Hadoop's local file system starts a process for
    every file it makes, and a partitioned write makes a folder for each besides, which the
    driver moves and lists one by one. Folders hold some hundred files and no path to read
    more than about ``GROUP_FILES``, however many there are. A file appears under its name
    when it is whole, so a task that runs again does no harm. On other file systems Spark's
    partitioned writer makes ``<key>=<value>/part-*``. A null key or body is as there: a
    default name, an empty line.
    """
    spark = bodies.sparkSession
    root = _local_path(spark, path)
    lines = bodies.select(F.col(key).alias(key), F.coalesce(F.col(body), F.lit("")).alias("value"))
    if root is None:
        lines.repartition(key).write.partitionBy(key).text(path)
        return [path]
    text = F.nullif(F.col(key).cast("string"), F.lit(""))
    total, most = lines.groupBy(text.alias("name")).count().agg(F.sum("count"), F.max("count")).first()
    folders = max(1, -(-(total or 0) // FOLDER_FILES))
    in_group = max(1, GROUP_FILES // FOLDER_FILES)
    rows = lines.select(F.pmod(F.xxhash64(text), F.lit(folders)).alias("folder"), F.coalesce(text, F.lit(NO_KEY)).alias("name"),
                        F.col("value").cast("binary").alias("value"))

    def land(batches):
        files = 0
        each = (row for b in batches for row in zip(*(c.to_pylist() for c in b.columns)))
        for (folder, name), own in itertools.groupby(each, key=lambda row: row[:2]):
            at = f"{root}/{folder // in_group}/{folder}"
            os.makedirs(at, exist_ok=True)
            part = f"{at}/.{uuid.uuid4().hex}"
            with open(part, "wb") as out:
                for *_, line in own:
                    out.write(line)
                    out.write(b"\n")
            os.replace(part, f"{at}/{key}={quote(name, safe='')}.txt")
            files += 1
        yield pa.RecordBatch.from_pydict({"files": pa.array([files], pa.int64())})

    # The groups exist even where no key falls into them.
    groups = [f"{root}/{g}" for g in range(-(-folders // in_group))]
    for g in groups:
        os.makedirs(g, exist_ok=True)
    if (most or 0) > 1:       # a file takes rows of one task only
        rows = rows.repartition("folder").sortWithinPartitions("folder", "name")
    rows.mapInArrow(land, "files long").agg(F.sum("files")).collect()
    return [f"{path}/{g}" for g in range(len(groups))]


@contextlib.contextmanager
def small_files(spark: SparkSession):
    """Actions inside read files of some kilobytes by the hundred in a task, not by a handful."""
    name = "spark.sql.files.openCostInBytes"
    before = spark.conf.get(name)
    spark.conf.set(name, str(OPEN_COST))
    try:
        yield
    finally:
        spark.conf.set(name, before)
