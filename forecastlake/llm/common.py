"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import contextlib
import math
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

PACKAGE_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def ship(spark: SparkSession) -> None:
    """Let Python workers import this package from the folder the driver runs it from."""
    env = spark.sparkContext.environment
    known = env.get("PYTHONPATH", "")
    if PACKAGE_ROOT not in known.split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (PACKAGE_ROOT, known) if x)


def materialise(df: DataFrame, name: str, codec: str | None = None) -> DataFrame:
    """Cut the lineage: write to the shared scratch folder (by the session's codec unless given) and read back."""
    path = scratch_path(df.sparkSession, name)
    (df.write.option("compression", codec) if codec else df.write).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextlib.contextmanager
def small_batches(spark: SparkSession, records: int = 1_000):
    """Actions inside send rows to Python in batches of at most ``records`` (long texts: some megabytes, not tens)."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    if 0 < int(before) <= records:
        yield
        return
    spark.conf.set(key, str(records))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def column(name: str):
    """A column by its exact name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def hashable(df: DataFrame) -> list[str]:
    """Columns that Spark's hash functions take (all but maps and variants)."""
    return [f.name for f in df.schema.fields
            if not any(x in f.dataType.simpleString() for x in ("map<", "variant", "interval"))]


def held_out(doc_id: str):
    """True where crc32 of the id as text leaves remainder 1 modulo 3 (null ids: false)."""
    return F.coalesce(F.crc32(column(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def bounded_sample(rows: DataFrame, key: str, n: int, *ties: str) -> DataFrame:
    """The n rows of the smallest hash of ``key`` (all, if fewer), ties by ``ties``.

    A threshold on the hash, a quarter above what n rows need, leaves about n rows
    for the final top n, so what meets in one task doesn't grow with the table.
    """
    total = rows.count()
    share = min(1.0, (1.25 * n + 100) / max(1, total))
    mark = F.xxhash64(column(key))
    small = rows.filter(F.pmod(mark, F.lit(1 << 30)) < F.lit(math.ceil(share * (1 << 30))))
    return small.orderBy(F.pmod(mark, F.lit(1 << 30)), mark, *ties).limit(n)
