"""Fetch-state table operators.

The state is an ordinary table keyed by (provider, interval, location_name).
Updates are reduced per key with ``max_by`` (partial aggregation, so a key
with many updates is pre-reduced map-side) and merged with a full outer join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forecastlake.functions.scalars import backoff_seconds, hours_between
from forecastlake.schemas import STATE, STATE_KEY
from forecastlake.session import empty_frame

# Transport failure classes that are retried.
RETRYABLE_CLASSES = ("timeout", "connect", "read", "write")
DEFAULT_MAX_ATTEMPTS = 3
DEFAULT_BACKOFF_FACTOR = 2.0
DEFAULT_FRESH_HOURS = 6


def _ts(value) -> Column:
    if value is None:
        return F.current_timestamp()
    return F.lit(value) if not isinstance(value, Column) else value


def outcomes(df: DataFrame, *, provider: Column, interval: Column, location_name: Column,
             success: Column, error: Column, records: Column, forecast_end_date: Column,
             at: Column, order: Column) -> DataFrame:
    """Normalise any outcome source into the update shape used by ``apply_outcomes``."""
    return df.select(
        provider.alias("provider"), interval.alias("interval"),
        location_name.alias("location_name"),
        F.when(success, F.lit("success")).otherwise(F.lit("failure")).alias("status"),
        F.when(success, F.lit(None).cast("string")).otherwise(error).alias("error"),
        F.when(success, records.cast("int")).otherwise(F.lit(0)).alias("records"),
        F.when(success, forecast_end_date).alias("forecast_end_date"),
        at.cast("timestamp").alias("at"),
        order.alias("ord"),
    )


def reduce_updates(updates: DataFrame) -> DataFrame:
    """Several updates to one key: apply them in ``ord`` order.

    Status, error, records and time come from the last update. The end date is
    the last non-empty one among successes, so a later failure or an empty
    end date keeps the earlier value, as sequential updates would.
    """
    last = F.max_by(F.struct("at", "status", "error", "records"), F.col("ord"))
    has_end = (F.col("status") == "success") & (F.coalesce(F.col("forecast_end_date"), F.lit("")) != "")
    end = F.max_by(F.col("forecast_end_date"), F.when(has_end, F.col("ord")))
    return (updates.groupBy(*STATE_KEY).agg(last.alias("_last"), end.alias("_end"))
            .select(*STATE_KEY, "_last.*", F.col("_end").alias("new_end_date")))


def apply_outcomes(state: DataFrame, updates: DataFrame) -> DataFrame:
    """Upsert updates into the state.

    success: time, status 'success', error NULL, records n, end date replaced
    only by a non-empty value; failure: time, status 'failure', error text,
    records 0, end date kept. Keys without an update pass through unchanged;
    keys seen for the first time are created. Keys are compared by value, so a
    location without a name has one row too.
    """
    return merge_reduced(state, reduce_updates(updates))


def _same_key():
    same = F.lit(True)
    for k in STATE_KEY:
        same = same & F.col(f"s.{k}").eqNullSafe(F.col(f"u.{k}"))
    return same


def merge_reduced(state: DataFrame, reduced: DataFrame, *, small: bool = False) -> DataFrame:
    """Upsert of one update a key (``reduce_updates``).

    One full outer join; with ``small`` (the caller has counted the updates) they are
    broadcast to the state's rows, which then aren't shuffled: a left join gives the
    known keys, and the updates that match none are the new ones.
    """
    u, s = reduced.alias("u"), state.alias("s")
    if not small:
        return _merged(s.join(u, _same_key(), "full_outer"))
    known = _merged(s.join(F.broadcast(u), _same_key(), "left"))
    hit = s.join(F.broadcast(u), _same_key(), "left_semi").select(*[F.col(f"s.{k}") for k in STATE_KEY])
    new = u.join(hit.alias("s"), _same_key(), "left_anti").select("u.*")
    return known.unionByName(_merged(empty_frame(state.sparkSession, STATE).alias("s").join(new.alias("u"), _same_key(), "right")))


def _merged(joined: DataFrame) -> DataFrame:
    has_u = F.col("u.status").isNotNull()
    return joined.select(
        *[F.coalesce(f"s.{k}", f"u.{k}").alias(k) for k in STATE_KEY],
        F.when(has_u, F.col("u.at")).otherwise(F.col("s.last_fetch_timestamp")).alias("last_fetch_timestamp"),
        F.when(has_u, F.col("u.status")).otherwise(F.col("s.last_fetch_status")).alias("last_fetch_status"),
        F.when(has_u, F.col("u.error")).otherwise(F.col("s.last_fetch_error")).alias("last_fetch_error"),
        F.when(has_u, F.col("u.records")).otherwise(F.col("s.records_fetched")).alias("records_fetched"),
        F.coalesce(F.col("u.new_end_date"), F.col("s.forecast_end_date")).alias("forecast_end_date"),
    ).select(*[F.col(f.name).cast(f.dataType) for f in STATE.fields])


def with_freshness(state: DataFrame, *, hours: float = DEFAULT_FRESH_HOURS,
                   as_of=None) -> DataFrame:
    """``is_fresh``: status success and elapsed hours strictly below ``hours``."""
    elapsed = hours_between(_ts(as_of), F.col("last_fetch_timestamp"))
    fresh = (F.col("last_fetch_status") == "success") & (elapsed < F.lit(float(hours)))
    return state.withColumn("is_fresh", F.coalesce(fresh, F.lit(False)))


def stale_locations(locations: DataFrame, state: DataFrame, *, provider: str, interval: str,
                    hours: float = DEFAULT_FRESH_HOURS, as_of=None,
                    name_col: str = "name") -> DataFrame:
    """Locations that need a fetch: no fresh state row for them.

    Unknown locations count as stale. A left anti join; Catalyst broadcasts
    the fresh-key side only when its measured size is under the threshold.
    """
    fresh = (with_freshness(state, hours=hours, as_of=as_of)
             .filter((F.col("provider") == provider) & (F.col("interval") == interval)
                     & F.col("is_fresh"))
             .select(F.col("location_name").alias(name_col)))
    return locations.join(fresh, name_col, "left_anti")


def resolve_attempts(log: DataFrame, key_cols: list[str], *, attempt_col: str = "attempt",
                     class_col: str = "error_class", order_cols: tuple[str, ...] = (),
                     max_attempts: int = DEFAULT_MAX_ATTEMPTS,
                     retryable: tuple[str, ...] = RETRYABLE_CLASSES,
                     carry: tuple[str, ...] = ()) -> DataFrame:
    """Final outcome per key from an attempt log.

    Terminal attempts: success (class NULL or 'success'), a non-retryable
    class, or attempt number ``max_attempts`` (attempts counted in total).
    The outcome is the earliest terminal attempt; keys without one are
    'pending'. One aggregation with ``min_by``, no window; the structs hold
    strings, so Spark plans it as a sort-based aggregation. ``carry`` columns are
    those of the final attempt, or of the latest one of a pending key.
    """
    cls = F.col(class_col)
    ok = cls.isNull() | (cls == "success")
    terminal = ok | ~cls.isin(*retryable) | (F.col(attempt_col) >= F.lit(max_attempts))
    order = F.struct(F.col(attempt_col), *[F.col(c) for c in order_cols])
    pick = F.min_by(F.struct(F.col(attempt_col).alias("final_attempt"),
                             F.col(class_col).alias("final_class"), *carry),
                    F.when(terminal, order))
    aggs = [pick.alias("_p"), F.count(F.lit(1)).alias("attempts_seen")]
    if carry:
        aggs.append(F.max_by(F.struct(*carry), order).alias("_l"))
    res = log.groupBy(*key_cols).agg(*aggs)
    fc = F.col("_p.final_class")
    status = (F.when(F.col("_p").isNull(), F.lit("pending"))
              .when(fc.isNull() | (fc == "success"), F.lit("success"))
              .otherwise(F.lit("failed")))
    return res.select(*key_cols, F.col("_p.final_attempt").alias("final_attempt"),
                      status.alias("final_status"),
                      F.when(status == "failed", fc).alias("error_class"), "attempts_seen",
                      *[F.coalesce(F.col("_p")[c], F.col("_l")[c]).alias(c) for c in carry])


def backoff_schedule(log: DataFrame, *, attempt_col: str = "attempt",
                     factor: float = DEFAULT_BACKOFF_FACTOR,
                     max_attempts: int = DEFAULT_MAX_ATTEMPTS) -> DataFrame:
    """Seconds to wait after each attempt: factor^(k-1), none after the last (R2)."""
    return log.withColumn("wait_seconds", backoff_seconds(factor, attempt_col, max_attempts))


def records_total(state: DataFrame, *, provider: str | None = None,
                  interval: str | None = None, since=None) -> DataFrame:
    """Sum of ``records_fetched`` over the state (A16); optional filters."""
    s = state
    if provider is not None:
        s = s.filter(F.col("provider") == provider)
    if interval is not None:
        s = s.filter(F.col("interval") == interval)
    if since is not None:
        s = s.filter(F.col("last_fetch_timestamp") >= _ts(since))
    return s.agg(F.coalesce(F.sum("records_fetched"), F.lit(0)).cast("long").alias("total_records"))


def records_gate(state: DataFrame, **kw) -> int:
    """Gate G2: raise when the state holds no fetched records."""
    total = records_total(state, **kw).head()["total_records"]
    if total == 0:
        raise ValueError("No records fetched in any location")
    return total


def get_locations(state: DataFrame, keys: DataFrame, *, as_of=None) -> DataFrame:
    """Get-or-create (R6): the state row of each requested key.

    ``keys`` has (provider, interval, location_name). Unknown keys come back
    with the model defaults (status 'success', time ``as_of``, no error, 0
    records) and ``is_new = true``; nothing is written.
    """
    s = state.withColumn("_known", F.lit(True))
    j = keys.select(*STATE_KEY).dropDuplicates().join(s, STATE_KEY, "left")
    new = F.col("_known").isNull()
    return j.select(
        *STATE_KEY,
        F.when(new, _ts(as_of)).otherwise(F.col("last_fetch_timestamp")).alias("last_fetch_timestamp"),
        F.when(new, F.lit("success")).otherwise(F.col("last_fetch_status")).alias("last_fetch_status"),
        F.col("last_fetch_error"),
        F.when(new, F.lit(0)).otherwise(F.col("records_fetched")).alias("records_fetched"),
        F.col("forecast_end_date"),
        new.alias("is_new"),
    )


def single_update(spark, *, provider: str, interval: str, location_name: str, success: bool,
                  records: int = 0, error: str | None = None,
                  forecast_end_date: str | None = None, at=None, ord: int = 0) -> DataFrame:
    """One update row for one key: the per-location mark success / mark failure.

    For many keys build the updates as a DataFrame with ``outcomes``; this is
    for driver-side bookkeeping of a single location.
    """
    row = spark.createDataFrame(
        [(provider, interval, location_name, success, error, records, forecast_end_date, ord)],
        "p string, i string, l string, ok boolean, e string, r int, end string, o int")
    return outcomes(row, provider=F.col("p"), interval=F.col("i"), location_name=F.col("l"),
                    success=F.col("ok"), error=F.col("e"), records=F.col("r"),
                    forecast_end_date=F.col("end"), at=_ts(at), order=F.col("o"))
