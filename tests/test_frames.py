"""Linear trailing frames against numpy slices and the window form."""

import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from breathline.operators import trailing
from breathline.plans import frames

T0 = dt.datetime(2024, 1, 1)


@pytest.mark.parametrize("seed,width", [(1, 0), (2, 5), (3, 40), (4, 10_000)])
def test_figures_of_every_frame(seed, width):
    rng = np.random.default_rng(seed)
    times = np.sort(rng.integers(0, 2000, 500))
    values = np.round(rng.normal(500, 100, 500), 2)
    values[100:160] = 7.25
    there = rng.random(500) < 0.9
    first, end = frames.bounds(times, width)
    n, mean, sd = frames.mean_and_sd(values, there, first, end)
    low, high = (frames.extreme(values, first, end, of) for of in (np.fmin, np.fmax))
    for i, (a, b) in enumerate(zip(first, end, strict=True)):
        assert (a, b) == (np.flatnonzero(times >= times[i] - width)[0], np.flatnonzero(times <= times[i])[-1] + 1)
        some = values[a:b][there[a:b]]
        assert n[i] == len(some) and (low[i], high[i]) == (values[a:b].min(), values[a:b].max())
        if len(some):
            assert mean[i] == pytest.approx(some.mean(), abs=1e-10) and sd[i] == pytest.approx(some.std(), abs=1e-7)


def test_missing_and_infinite_values():
    values, there = np.array([1.0, np.inf, np.nan, -np.inf, 2.0, 5.0]), np.array([True] * 4 + [False, True])
    first, end = np.array([0, 0, 2, 3, 4, 4]), np.arange(1, 7)
    n, mean, sd = frames.mean_and_sd(values, there, first, end)
    assert n.tolist() == [1, 2, 1, 1, 0, 1]
    assert str(mean[[0, 1, 2, 3, 5]].tolist()) == "[1.0, inf, nan, -inf, 5.0]" and str(sd[[0, 1, 2, 3, 5]].tolist()) == "[0.0, nan, nan, nan, 0.0]"


def rows_of(df):
    return sorted(map(str, df.collect()))


def test_dense_forms_equal_the_window_forms(spark):
    rng, rows, lines, t = random.Random(9), [], [], 0
    for i in range(3000):
        t += rng.choice([1, 1, 1, 20, 400_000, 9_000_000])
        device, at = rng.choice(["hot", "hot", "b"]), T0 + dt.timedelta(microseconds=t)
        value = rng.choice([None, float("nan"), float("inf")]) if rng.random() < 0.01 else rng.randrange(30000, 90000) / 100
        rows.append((device, i % 2, i, at, value))
        vs = [rng.choice([1.0, 2.5, 9.25, 1.0]) for _ in range(rng.choice([3, 3, 3, 2]))]
        lines.append((device, i, at, vs))
    arrivals = spark.createDataFrame(rows, "device_id string, sensor_id int, id long, ts timestamp_ntz, v double").repartition(3)
    mine = trailing.trailing_stats_dense(arrivals)
    window = trailing.trailing_stats(arrivals)
    assert mine.columns == window.columns and rows_of(mine) == rows_of(window)
    feed = spark.createDataFrame(lines, "device_id string, line_id long, arrival_ts timestamp_ntz, values array<double>").repartition(3)
    mine, window = (x.withColumn("scaled", F.round("scaled", 9)) for x in (
        trailing.trailing_minmax_scale_dense(feed), trailing.trailing_minmax_scale(feed, 3)))
    assert mine.columns == window.columns and rows_of(mine) == rows_of(window) and mine.count() > 1000
