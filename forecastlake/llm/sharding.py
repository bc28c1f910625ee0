"""Uniform shuffle into shards of exact sizes by a hypergeometric communication matrix.

1. Rows are dealt into logical partitions by a hash of the whole row, so a
   recomputed task deals them the same way.
2. How many rows of partition i go to shard j is drawn exactly: a multivariate
   hypergeometric matrix whose columns sum to the shard sizes (at most one
   apart). It is drawn as a tree: the driver draws one row for each of about
   sqrt(partitions) super-partitions, tasks draw their partitions' rows.
3. Each partition is permuted locally; consecutive runs of it go to the shards.
4. Each shard is permuted again: its rows are split into cells by the top of a
   second random key and numbered from the cell's offset, so no task holds a
   whole shard.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import column, hashable, ship


def hypergeometric(rng: np.random.Generator, good: int, bad: int, n: int) -> int:
    """Draw n of good + bad without replacement; how many are good.

    numpy's sampler takes populations below 10**9. Beyond, the law's mass within
    14 deviations of its mode is built from the ratio of neighbours and inverted.
    """
    if n == 0 or good == 0:
        return 0
    if bad == 0:
        return n
    total = good + bad
    if total < 10**9:
        return int(rng.hypergeometric(good, bad, n))
    lo, hi = max(0, n - bad), min(n, good)
    mode = (n + 1) * (good + 1) // (total + 2)
    sd = math.sqrt(n * (good / total) * (bad / total) * ((total - n) / max(1, total - 1)))
    a, b = max(lo, mode - int(14 * sd) - 20), min(hi, mode + int(14 * sd) + 20)
    k = np.arange(a, b, dtype=np.float64)
    ratio = np.log(good - k) + np.log(n - k) - np.log(k + 1) - np.log(bad - n + k + 1)
    logp = np.concatenate([[0.0], np.cumsum(ratio)])
    p = np.cumsum(np.exp(logp - logp.max()))
    return a + int(np.searchsorted(p, rng.random() * p[-1]))


def matrix_row(rng: np.random.Generator, room: np.ndarray, n: int) -> np.ndarray:
    """How the n rows of one part fall on shards that still have ``room``."""
    row, left, rest = np.zeros(len(room), dtype=np.int64), n, int(room.sum())
    for j, r in enumerate(room.tolist()):
        rest -= r
        row[j] = hypergeometric(rng, r, rest, left)
        left -= int(row[j])
    return row


def shard_rows(df: DataFrame, n_shards: int, *, seed: int = 17,
               rows_per_part: int = 20_000) -> DataFrame:
    """All rows with ``shard`` (0 to n_shards - 1) and ``slot`` (gapless from 0 in each shard).

    Shard sizes differ by one at most, and every arrangement is equally likely up
    to the quality of the hash. Nulls and empty texts are rows like others; equal
    rows are all kept and interchangeable; fewer rows than shards leave shards
    empty; an empty table gives an empty result. Input columns named ``shard`` or
    ``slot`` are replaced.
    """
    spark = df.sparkSession
    ship(spark)
    keep = [c for c in df.columns if c not in ("shard", "slot")]
    n = df.count()
    parts = max(1, math.ceil(n / rows_per_part))
    group = math.ceil(math.sqrt(parts))
    cells = max(1, math.ceil(n / n_shards / rows_per_part))
    key = F.xxhash64(F.lit(seed), *[column(c) for c in keep if c in hashable(df)])
    rows = df.select(F.struct(*[column(c) for c in keep]).alias("row"), key.alias("key"))
    rows = rows.withColumn("part", F.pmod("key", F.lit(parts)).cast("int"))

    sizes = rows.groupBy("part").count().withColumn("sup", (F.col("part") / group).cast("int"))
    matrix = _matrix(sizes, n, n_shards, seed)

    def dealt(x: DataFrame) -> DataFrame:
        local = Window.partitionBy("part").orderBy(F.xxhash64("key", F.lit(1)), "key")
        x = x.withColumn("rank", F.row_number().over(local) - 1).join(matrix, "part")
        x = x.withColumn("shard", F.size(F.filter("ends", lambda e: e <= F.col("rank"))))
        x = x.withColumn("key2", F.xxhash64("key", F.lit(2)))
        cell = F.shiftrightunsigned("key2", 34) * cells / F.lit(2.0**30)
        return x.withColumn("cell", cell.cast("int"))

    # The cells' sizes need the keys only, not the rows.
    filled = dealt(rows.select("key", "part")).groupBy("shard", "cell").count()
    before = Window.partitionBy("shard").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    offsets = filled.select("shard", "cell",
                            F.coalesce(F.sum("count").over(before), F.lit(0)).alias("offset"))
    again = Window.partitionBy("shard", "cell").orderBy("key2", "key")
    placed = dealt(rows).select("row", "key", "key2", "shard", "cell") \
        .withColumn("at", F.row_number().over(again) - 1).join(offsets, ["shard", "cell"])
    return placed.select(*[F.col("row").getField(c).alias(c) for c in keep],
                         F.col("shard").cast("int").alias("shard"),
                         (F.col("offset") + F.col("at")).cast("long").alias("slot"))


def _matrix(sizes: DataFrame, n: int, n_shards: int, seed: int) -> DataFrame:
    """(part, ends): ends[j] is the local rank at which shard j's run of the part ends."""
    room = np.full(n_shards, n // n_shards, dtype=np.int64)
    room[:n % n_shards] += 1
    rng = np.random.default_rng([seed, 0])
    top = {}
    # One row for each super-partition: about sqrt(partitions) of them.
    for sup, count in sorted((r["sup"], r["n"]) for r in
                             sizes.groupBy("sup").agg(F.sum("count").alias("n")).collect()):
        top[sup] = matrix_row(rng, room, count)
        room = room - top[sup]
    drawn = sizes.sparkSession.createDataFrame(
        [(k, v.tolist()) for k, v in top.items()], "sup int, room array<long>")

    def draw(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("part")
        left, out = np.array(pdf["room"].iloc[0], dtype=np.int64), []
        rng = np.random.default_rng([seed, 1 + int(pdf["sup"].iloc[0])])
        for part, count in zip(pdf["part"], pdf["count"]):
            row = matrix_row(rng, left, int(count))
            left = left - row
            out.append((part, np.cumsum(row).tolist()))
        return pd.DataFrame(out, columns=["part", "ends"])

    return sizes.join(drawn, "sup").groupBy("sup").applyInPandas(draw, "part int, ends array<long>")


def op9_sharding(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    data = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    return shard_rows(docs, 40).select(
        "doc_id", (F.octet_length(data) + 16).cast("long").alias("size"),
        F.crc32(data).alias("text_crc32"), F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))
