"""Flatten + validate against a plain-Python model of the rules, on random bodies.

One Spark job over a deterministic batch of generated responses; every
output row is compared with what the model says for that (response, index).
"""

import json
import random
from datetime import datetime, timedelta

from forecastlake.operators import flatten as fl
from forecastlake.operators.parse import parse_responses, split_ok_failed
from forecastlake.operators.validate import check_rows
from tests.conftest import SAMPLE_BODY, response_row, responses

VARS = {"temperature_2m": ["temperature_2m"], "precipitation": ["precipitation"],
        "cloud_cover": ["cloudcover", "cloud_cover"], "weather_code": ["weathercode", "weather_code"]}
T0 = datetime(2031, 3, 7)


def _cell(rnd, integral):
    r = rnd.random()
    if r < 0.1:
        return None
    if r < 0.15:
        return "junk"
    if r < 0.18:
        return True
    if r < 0.3:
        return str(rnd.randint(0, 99)) if integral else f"{rnd.uniform(-5, 40):.2f}"
    if integral:
        return rnd.choice([float(rnd.randint(0, 99)), rnd.randint(0, 99), rnd.randint(0, 99) + 0.5])
    return round(rnd.uniform(-5, 40), 3)


def _body(rnd, n):
    times, want_ts = [], []
    for i in range(n):
        t = T0 + timedelta(hours=i)
        kind = rnd.random()
        if kind < 0.08:
            times.append("bad-time")
            want_ts.append(None)
        elif kind < 0.3:
            times.append(t.strftime("%Y-%m-%dT%H:%M") + rnd.choice(["+02:00", "Z", "-0530"]))
            want_ts.append(t)
        else:
            times.append(t.strftime("%Y-%m-%dT%H:%M:%S"))
            want_ts.append(t)
    hourly = {"time": times}
    for out, spellings in VARS.items():
        r = rnd.random()
        if r < 0.15:
            continue                                          # absent
        name = rnd.choice(spellings)
        if r < 0.2:
            hourly[name] = None                               # explicit null array
            continue
        length = max(0, n + rnd.choice([0, 0, 0, -1, -2, 1, 3]))
        hourly[name] = [_cell(rnd, out == "weather_code") for _ in range(length)]
    body = {k: v for k, v in SAMPLE_BODY.items() if k not in ("daily", "hourly")}
    body["hourly"] = hourly
    return body, want_ts


def _typed(v, integral):
    if v is None:
        return None, False
    if isinstance(v, bool):
        return None, True
    try:
        d = float(v)
    except ValueError:
        return None, True
    if integral:
        return (int(d), False) if d == int(d) else (None, True)
    return d, False


def _expect(body, want_ts, i):
    h = body["hourly"]
    row, errs = {"timestamp": want_ts[i]}, []
    if want_ts[i] is None:
        errs.append("bad_time")
    for out, spellings in VARS.items():
        cands = [s for s in spellings if s in h]
        arr = h[cands[0]] if cands else None
        val = arr[i] if (arr is not None and i < len(arr)) else None
        typed, bad = _typed(val, out == "weather_code")
        row[out] = float(typed) if (typed is not None and out != "weather_code") else typed
        if bad:
            errs.append("bad_weather_code" if out == "weather_code" else f"bad_value:{out}")
        if arr is not None and i >= len(arr):
            errs.append(f"short_array:{cands[0]}")
    return row, errs


def test_flatten_matches_model(spark):
    rnd = random.Random(20310307)
    cases = []
    for k in range(150):
        body, want_ts = _body(rnd, rnd.randint(0, 8))
        cases.append((f"loc{k:03d}", body, want_ts))
    rows = [response_row(json.dumps(b), location=(name, 1.0, 2.0)) for name, b, _ in cases]
    ok, failed = split_ok_failed(parse_responses(responses(spark, rows)))
    assert failed.count() == 0
    flat = fl.flatten_hourly(ok)
    good, bad = check_rows(flat)
    got = {}
    for r in good.collect():
        got.setdefault(r["location_name"], []).append((r, []))
    for r in bad.collect():
        got.setdefault(r["location_name"], []).append((r, list(r["errors"])))
    checked = 0
    for name, body, want_ts in cases:
        produced = got.get(name, [])
        assert len(produced) == len(want_ts), name
        # rows of one response are matched by position in time order of the body
        expected = [_expect(body, want_ts, i) for i in range(len(want_ts))]
        exp_sorted = sorted(expected, key=lambda e: (e[0]["timestamp"] is None, e[0]["timestamp"] or T0,
                                                     json.dumps(e[0], default=str), e[1]))
        got_sorted = sorted(produced, key=lambda g: (g[0]["timestamp"] is None, g[0]["timestamp"] or T0,
                                                     json.dumps({k: g[0][k] for k in exp_sorted[0][0]}
                                                                if exp_sorted else {}, default=str), g[1]))
        for (erow, eerr), (grow, gerr) in zip(exp_sorted, got_sorted):
            for k, v in erow.items():
                assert grow[k] == v, (name, k, grow[k], v)
            assert sorted(gerr) == sorted(eerr), (name, gerr, eerr)
            checked += 1
    assert checked > 300


def test_counts_inside_the_row_match_the_rows(spark):
    """``series_counts`` against flattened, checked rows: random bodies, failed ones, no location name."""
    rnd = random.Random(77)
    rows = []
    for k in range(120):
        body, _ = _body(rnd, rnd.randint(0, 8))
        rows.append(response_row(json.dumps(body), location=(None if k % 17 == 0 else f"loc{k:03d}", 1.0, float(k))))
    rows += [response_row("garbage", location=("bad", 1.0, 500.0)), response_row(None, location=("none", 1.0, 501.0))]
    parsed = parse_responses(responses(spark, rows))
    ok, _ = split_ok_failed(parsed)
    want = {}
    good, bad = check_rows(fl.flatten_hourly(ok))
    for r in good.collect():
        n = want.setdefault(r["requested_longitude"], [0, 0, []])
        n[0] += 1
        n[2].append(r["timestamp"])
    for r in bad.collect():
        want.setdefault(r["requested_longitude"], [0, 0, []])[1] += 1
    counted = fl.series_counts(ok, "hourly")
    assert counted.columns == [*ok.columns, "n_good", "n_bad", "n_times", "first_time", "last_time"]
    plan = counted._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and plan.count("from_json(") == 1
    got = {r["location"]["longitude"]: r for r in counted.collect()}
    assert len(got) == 120
    for key, r in got.items():
        g, b, times = want.get(key, [0, 0, []])
        assert (r["n_good"], r["n_bad"]) == (g, b), key
        times = [t for t in times if t is not None]
        assert r["n_times"] == len(times)
        assert (r["first_time"], r["last_time"]) == (min(times, default=None), max(times, default=None))
    failed = fl.series_counts(parsed.filter("error is not null"), "hourly").collect()
    assert [(r["n_good"], r["n_bad"], r["first_time"]) for r in failed] == [(0, 0, None)] * 2
