"""Trailing frames whose work hangs on the rows alone, against plain loops over each frame."""

import datetime as dt
import math
import random
import re

import numpy as np
import pytest

from breathline.operators import trailing

T0 = dt.datetime(2024, 1, 1)
NAN = math.nan


def plan_of(df):
    return df._jdf.queryExecution().analyzed().toString()


def some_lines(seed, n=160):
    """Lines of two devices with bursts, gaps, repeated times, nulls and NaN; some repeat id, some have no time."""
    rng, rows = random.Random(seed), []
    for device in ("a", None):
        t = 0
        for i in range(n):
            t += rng.choice([0, 0, 1, 1, 3, 9, 20, 21, 70]) * 1_000_000
            vs = [rng.choice([400.0, 401.0, 999.5, None, NAN if i > n - 9 else 7.0]) for _ in range(rng.choice([2, 3, 3]))]
            rows.append((device, None if i == 5 else i // 2, None if i == 9 else T0 + dt.timedelta(microseconds=t), vs))
    return rows


def plain_scaled(rows, channels, width):
    """As Spark's least and greatest have it: nulls count for nothing, NaN is above all."""
    order, out = (lambda v: (math.isnan(v), v)), []
    for device, line_id, at, vs in rows:
        if at is None:
            continue
        frame = [r[3] for r in rows if r[0] == device and r[2] is not None and 0 <= (at - r[2]).total_seconds() <= width]
        limits = []
        for c in range(channels):
            there = [f[c] for f in frame if c < len(f) and f[c] is not None]
            limits.append((min(there, key=order), max(there, key=order)) if there else None)
        if any(x and (x[0] == x[1] or math.isnan(x[0])) and not math.isnan(x[1] - x[0]) for x in limits):
            continue
        for c, v in enumerate(vs):
            if v is not None and c < channels:
                out.append((device, line_id, c, 1.0 - (v - limits[c][0]) / (limits[c][1] - limits[c][0])))
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_minmax_scale_equals_loops(spark, seed):
    rows = some_lines(seed)
    lines = spark.createDataFrame(rows, "device_id string, line_id long, arrival_ts timestamp_ntz, values array<double>")
    got = [tuple(r) for r in trailing.trailing_minmax_scale(lines, 3).collect()]
    shown = lambda rs: sorted((str(r[:3]), "nan" if math.isnan(r[3]) else f"{r[3]:.9f}") for r in rs)
    expected = plain_scaled(rows, 3, trailing.WINDOW_S)
    assert shown(got) == shown(expected) and len(expected) > 100


def test_stats_equal_loops(spark):
    rng, rows, t = random.Random(3), [], -90_000_000
    for i in range(300):
        t += rng.choice([0, 1, 1, 3, 9, 20, 70]) * 1_000_000
        rows.append(("a" if i % 3 else None, i % 2, i, dt.datetime(1970, 1, 1) + dt.timedelta(microseconds=t), rng.choice([1e9, 400.25, 400.5, None])))
    arrivals = spark.createDataFrame(rows, "device_id string, sensor_id int, id long, ts timestamp_ntz, v double")
    got = {r["id"]: r for r in trailing.trailing_stats(arrivals).collect()}
    assert len(got) == len(rows)
    for device, sensor, i, at, _ in rows:
        frame = [r[4] for r in rows if r[:2] == (device, sensor) and 0 <= (at - r[3]).total_seconds() <= 20 and r[4] is not None]
        assert got[i]["n"] == len(frame)
        if not frame:
            assert got[i]["mean"] is None and got[i]["sd"] is None
        else:
            assert got[i]["mean"] == pytest.approx(np.mean(frame), abs=1e-3) and got[i]["sd"] == pytest.approx(np.std(frame), rel=1e-9, abs=1e-3)


def test_no_frame_slides(spark):
    """A running frame adds a row once; a sliding one goes through all of its rows at every row."""
    lines = spark.createDataFrame([], "device_id string, line_id long, arrival_ts timestamp_ntz, values array<double>")
    arrivals = spark.createDataFrame([], "device_id string, sensor_id int, id long, ts timestamp_ntz, v double")
    for df in (trailing.trailing_minmax_scale(lines, 3), trailing.trailing_stats(arrivals), trailing.elapsed_seconds(arrivals)):
        bounds = re.findall(r"specifiedwindowframe\(RangeFrame, ([^,]+),", plan_of(df))
        assert set(bounds) == {"unboundedpreceding$()"}
