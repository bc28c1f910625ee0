"""Incremental re-run (T1): process only responses landed since the last run.

A scheduled "run every N hours" job becomes a file-source stream with
``trigger(availableNow=True)``: micro-batches only parse new files into a staging
table beside the checkpoint; then one run resolves everything staged since the last
one. Attempts of a cycle and daily fetches are thus compared across micro-batches
and invocations, and results don't depend on how files fall into micro-batches.

What earlier runs leave is carried in three tables, so that a run reads its own epochs
and little else, however long the history:

- ``open/epoch=N``: envelopes of the cycles that run N left pending (replaced by each run);
- ``closed/bucket=B/epoch=N``: keys of the cycles that run N settled, by a hash of the
  cycle; a run reads the buckets of the cycles that it meets;
- ``written/day=D/epoch=N``: the latest daily fetch of a location that run N wrote for an
  ingestion day; a run reads the days that it meets.

A run is known by the stream's own id and the last epoch it covers. It is marked
begun before it writes and done by its table of resolved responses, which is written
last, so a run that failed is repeated over the same epochs under the same run id, which
overwrites its own partitions, before newer epochs are looked at. Rows of the carried
tables count only up to the last run that is done.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forecastlake.plans.run import CYCLE_KEY, DEFAULT_PROVIDER, RunResult, run_staged, stage_responses
from forecastlake.operators.state import DEFAULT_MAX_ATTEMPTS
from forecastlake.schemas import RESPONSE, require_interval

#: Folders that settled cycles are dealt to; cycle names that are pushed down to the scan at most.
BUCKETS, NAMES = 256, 1000


def _names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder: one listing; none if it doesn't exist."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []


def _epochs(spark: SparkSession, path: str, after: int = -1) -> list[int]:
    """Committed ``epoch=N`` folders above ``after``, ascending."""
    from forecastlake.session import path_exists

    numbers = sorted(int(n[6:]) for n in _names(spark, path) if n.startswith("epoch="))
    return [n for n in numbers if n > after and path_exists(spark, f"{path}/epoch={n:010d}/_SUCCESS")]


def _last_epoch(spark: SparkSession, path: str) -> int | None:
    """The highest committed epoch: one listing, then probes from the top."""
    from forecastlake.session import path_exists

    for n in sorted((int(n[6:]) for n in _names(spark, path) if n.startswith("epoch=")), reverse=True):
        if path_exists(spark, f"{path}/epoch={n:010d}/_SUCCESS"):
            return n
    return None


def _bucket():
    return F.pmod(F.xxhash64("cycle"), F.lit(BUCKETS)).cast("int")


class CarriedWork:
    """What runs leave for later ones, below one staging folder."""

    def __init__(self, spark: SparkSession, staging: str):
        self.spark, self.staging = spark, staging

    def pending(self, done: int | None) -> DataFrame | None:
        """Envelopes of the cycles that the last run left open."""
        return None if done is None else self.spark.read.parquet(f"{self.staging}/open/epoch={done:010d}")

    def closed(self, staged: DataFrame, done: int | None) -> DataFrame | None:
        """Settled cycles of the buckets that the staged responses' cycles fall in."""
        root = f"{self.staging}/closed"
        held = set(_names(self.spark, root)) if done is not None else set()
        met = [r[0] for r in staged.select(_bucket()).distinct().collect()]        # BUCKETS numbers at most
        paths = [f"{root}/bucket={b}" for b in sorted(met) if f"bucket={b}" in held]
        if not paths:
            return None
        rows = self.spark.read.option("basePath", root).parquet(*paths).filter(F.col("epoch") <= done)
        names = [r[0] for r in staged.select("cycle").distinct().limit(NAMES + 1).collect()]
        if len(names) <= NAMES and None not in names:      # skips files and row groups of other cycles
            rows = rows.filter(F.col("cycle").isin(names))
        return rows

    def seen(self, staged: DataFrame, done: int | None) -> DataFrame | None:
        """(_name, _day, _seen) of the ingestion days that the staged responses have."""
        root = f"{self.staging}/written"
        held = set(_names(self.spark, root)) if done is not None else set()
        met = [str(r[0]) for r in staged.select(F.to_date("ingestion_timestamp_utc")).distinct().collect()]
        paths = [f"{root}/_day={d}" for d in sorted(met) if f"_day={d}" in held]
        if not paths:
            return None
        rows = self.spark.read.option("basePath", root).parquet(*paths).filter(F.col("epoch") <= done)
        return rows.withColumn("_day", F.col("_day").cast("date"))

    def leave(self, result: RunResult, interval: str, epoch: int) -> None:
        """Write a run's tables; the table of resolved responses commits it."""
        resolved, final = result.resolved, F.col("outcome").isin("ok", "failed")
        resolved.filter("outcome = 'pending'").drop("outcome", "written").write.mode("overwrite") \
            .parquet(f"{self.staging}/open/epoch={epoch:010d}")

        def put(df: DataFrame, name: str, part: str, order: str) -> None:
            (df.withColumn("epoch", F.lit(epoch)).repartition(part).sortWithinPartitions(part, order).write
             .mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(part, "epoch")
             .parquet(f"{self.staging}/{name}"))

        put(resolved.filter(final).select(*CYCLE_KEY, _bucket().alias("bucket")), "closed", "bucket", "cycle")
        if interval == "daily":
            day = F.to_date("ingestion_timestamp_utc")
            put(resolved.filter(F.col("written") & day.isNotNull())
                .groupBy(F.col("location.name").alias("_name"), day.alias("_day"))
                .agg(F.max("ingestion_timestamp_utc").alias("_seen")), "written", "_day", "_name")
        resolved.write.mode("overwrite").parquet(f"{self.staging}/resolved/epoch={epoch:010d}")


def run_available_now(spark: SparkSession, landing: str, *, checkpoint: str, interval: str,
                      base_path: str, provider: str = DEFAULT_PROVIDER, run_prefix: str = "batch",
                      max_files_per_trigger: int = 100_000, max_attempts: int = DEFAULT_MAX_ATTEMPTS,
                      fmt: str = "json", **options) -> RunResult | None:
    """Consume all newly landed response files, then stop; None if nothing is new.

    ``options`` are those of ``run_staged`` (state, layout, quarantine, table, codec,
    closing cycles). ``max_files_per_trigger`` bounds a micro-batch's size only. The run's
    responses are the new ones and the still pending one of each open cycle.
    """
    require_interval(interval)
    staging = f"{checkpoint.rstrip('/')}-staged"
    stream = (spark.readStream.schema(RESPONSE).format(fmt)
              .option("maxFilesPerTrigger", max_files_per_trigger).load(landing))

    def on_batch(batch_df, epoch_id: int) -> None:
        (stage_responses(batch_df, interval=interval, provider=provider, max_attempts=max_attempts, epoch=epoch_id)
         .write.mode("overwrite").parquet(f"{staging}/responses/epoch={epoch_id:010d}"))

    q = (stream.writeStream.foreachBatch(on_batch)
         .option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    work = CarriedWork(spark, staging)
    done = _last_epoch(spark, f"{staging}/resolved")
    after = -1 if done is None else done
    staged, begun = _epochs(spark, f"{staging}/responses", after), _epochs(spark, f"{staging}/begun", after)
    result = None
    for last in sorted({*begun, *staged[-1:]}):
        spark.range(1).write.mode("overwrite").parquet(f"{staging}/begun/epoch={last:010d}")
        own = [f"{staging}/responses/epoch={e:010d}" for e in staged if (-1 if done is None else done) < e <= last]
        rows = spark.read.parquet(*own)
        result = run_staged(spark, rows, interval=interval, base_path=base_path, provider=provider,
                            run_id=f"{run_prefix}-{str(q.id)[:8]}-{last:010d}", max_attempts=max_attempts,
                            carried=work.pending(done), closed=work.closed(rows, done),
                            seen=work.seen(rows, done) if interval == "daily" else None, **options)
        work.leave(result, interval, last)
        done = last
    return result
