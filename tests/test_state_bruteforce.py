"""State upsert and attempt resolution against plain-Python replicas of the
sequential rules, on random inputs (one Spark job per run)."""

import random
from datetime import datetime, timedelta

from forecastlake.operators import state as st
from forecastlake.sources.state_store import empty_state

UPD = ("provider string, interval string, location_name string, status string, error string, "
       "records int, forecast_end_date string, at timestamp, ord int")


def _model_apply(state, updates):
    for (p, i, loc, status, err, rec, end, at, _o) in sorted(updates, key=lambda u: u[-1]):
        cur = state.setdefault((p, i, loc), {"end": None})
        cur.update(ts=at, status=status)
        if status == "success":
            cur.update(error=None, records=rec)
            if end:
                cur["end"] = end
        else:
            cur.update(error=err, records=0)
    return state


def test_upserts_match_sequential_model(spark):
    rnd = random.Random(7)
    t0 = datetime(2025, 1, 1)
    model, df = {}, empty_state(spark)
    order = 0
    for run in range(3):
        ups = []
        for _ in range(60):
            order += 1
            ok = rnd.random() < 0.6
            ups.append(("p", rnd.choice(["hourly", "daily"]), f"L{rnd.randint(0, 11)}",
                        "success" if ok else "failure", None if ok else f"e{order}",
                        rnd.randint(1, 200) if ok else 0,
                        rnd.choice(["", None, f"2025-02-{rnd.randint(10, 28)}"]) if ok else None,
                        t0 + timedelta(minutes=order), order))
        model = _model_apply(model, ups)
        df = st.apply_outcomes(df, spark.createDataFrame(ups, UPD))
    got = {(r["provider"], r["interval"], r["location_name"]): r for r in df.collect()}
    assert set(got) == set(model)
    for k, m in model.items():
        g = got[k]
        assert (g["last_fetch_status"], g["last_fetch_error"], g["records_fetched"], g["forecast_end_date"]) == \
            (m["status"], m["error"], m["records"], m["end"]), k
        assert g["last_fetch_timestamp"] == m["ts"]


def _model_resolve(log, max_attempts=3, retryable=("timeout", "connect", "read", "write")):
    for attempt, cls in sorted(log):
        if cls is None:
            return attempt, "success", None
        if cls not in retryable or attempt >= max_attempts:
            return attempt, "failed", cls
    return None, "pending", None


def test_attempt_resolution_matches_retry_loop(spark):
    rnd = random.Random(11)
    rows, model = [], {}
    for k in range(300):
        log = []
        for attempt in range(1, 4):
            cls = rnd.choice([None, None, "timeout", "connect", "read", "http_error", "decode"])
            log.append((attempt, cls))
            if cls is None or cls in ("http_error", "decode"):
                break
        if rnd.random() < 0.2:            # still in flight: the log stops early
            log = log[:rnd.randint(0, len(log) - 1)] or log[:1]
        rnd.shuffle(log)
        rows += [(f"k{k}", a, c) for a, c in log]
        model[f"k{k}"] = _model_resolve(log)
    df = spark.createDataFrame(rows, "key string, attempt int, error_class string")
    got = {r["key"]: (r["final_attempt"], r["final_status"], r["error_class"])
           for r in st.resolve_attempts(df, ["key"]).collect()}
    assert got == model
