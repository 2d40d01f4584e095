"""Tumbling publishing that loses no row: late ones are returned beside what is published.

Spark's own aggregate drops rows behind the watermark. Here a window's values are counted in
Spark's keyed state, and the same watermark tells whether a row's window is still open. A
reading leaves in one of three ways, as its ``status`` says:

- ``published``: a closed window with enough readings, its median and count;
- ``short``: a closed window with fewer, its count;
- ``late``: one reading whose window had closed when it arrived, with its line and value.

The counts of the first two and the rows of the third add up to the readings of all windows
that the watermark has passed. State is one row per open window and channel with its different
values, which the device's resolution bounds (``median_tenths``). Rows without a time are in
no window and are returned as ``untimed``.
"""

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from breathline.functions.numbers import is_missing
from breathline.functions.times import from_micros, micros
from breathline.operators.publish import CHANNEL, MIN_READINGS, PERIOD_S

UNTIMED = -1
COUNTS = "vs array<double>, ns array<long>, n long, missing boolean"
OUT = {"device_id": "string", "channel": "int", "sensor_id": "int", "end_us": "long", "status": "string", "n": "long", "tenths": "double", "line_id": "long", "us": "long", "v": "double"}


def median_of(values: np.ndarray, counts: np.ndarray) -> float:
    """Median of different values in order, by their counts."""
    upto, n = np.cumsum(counts), int(counts.sum())
    low, high = values[np.searchsorted(upto, [(n + 1) // 2, n // 2 + 1])]
    return float(low) if low == high else (float(low) + float(high)) / 2


class Windows(StatefulProcessor):
    """One window of one channel: its value counts until the watermark passes its end."""

    def __init__(self, min_readings: int):
        self.min_readings = min_readings

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.counts = handle.getValueState("counts", COUNTS)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        arrived = pd.concat(list(rows))
        end_ms = int(key[3]) // 1000
        if key[3] == UNTIMED or end_ms <= timerValues.getCurrentWatermarkInMs():
            yield self._frame(key, arrived, status="untimed" if key[3] == UNTIMED else "late")
            return
        held = self.counts.get()
        vs, ns, n, missing = held or ([], [], 0, False)
        v = arrived["v"].to_numpy(dtype=np.float64, na_value=np.nan)
        there = v[~np.isnan(v)]
        values, at = np.unique(np.concatenate([np.array(vs, dtype=np.float64), there * 10.0]), return_inverse=True)
        weights = np.concatenate([np.array(ns, dtype=np.int64), np.ones(len(there), dtype=np.int64)])
        counts = np.zeros(len(values), dtype=np.int64)
        np.add.at(counts, at, weights)
        self.counts.update((values.tolist(), counts.tolist(), int(n) + len(v), bool(missing) or len(there) < len(v)))
        if held is None:
            # timers strictly before the watermark fire; a window is closed when its end is reached
            self.handle.registerTimer(end_ms - 1)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        vs, ns, n, missing = self.counts.get()
        self.counts.clear()
        enough = n >= self.min_readings
        tenths = median_of(np.array(vs), np.array(ns)) if enough and not missing else None
        yield self._frame(key, None, status="published" if enough else "short", n=n, tenths=tenths)

    def _frame(self, key, rows: pd.DataFrame | None, status: str, n: int = 1, tenths: float | None = None) -> pd.DataFrame:
        size = 1 if rows is None else len(rows)
        columns = dict(zip(("device_id", "channel", "sensor_id", "end_us"), key, strict=True))
        if key[3] == UNTIMED:
            columns["end_us"] = None
        out = pd.DataFrame({c: [x] * size for c, x in {**columns, "status": status, "n": n, "tenths": tenths}.items()})
        for name in ("line_id", "us", "v"):
            out[name] = None if rows is None else rows[name].to_numpy()
        kinds = {"channel": "Int32", "sensor_id": "Int32", "end_us": "Int64", "n": "Int64", "tenths": "Float64", "line_id": "Int64", "us": "Int64", "v": "float64"}
        return out[list(OUT)].astype(kinds)

    def close(self) -> None:
        pass


def stream_publish_accounted(
    long: DataFrame, delay: str, period_s: int = PERIOD_S, min_readings: int = MIN_READINGS, time: str = "arrival_ts",
) -> DataFrame:
    """(channel columns, T, status, n, tenths, line_id, arrival_ts, v) of a stream of readings.

    Append mode; the session must have the state store of ``live.with_state_store``.
    """
    period = period_s * 1_000_000
    timed = long.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, delay)
    us = micros(F.col(time))
    # without the watermark's own column Spark does not drop rows behind it
    rows = timed.select(
        F.col("device_id"), F.col("channel").cast("int"), F.col("sensor_id").cast("int"),
        F.coalesce(us - F.pmod(us, F.lit(period)) + F.lit(period), F.lit(UNTIMED)).cast("long").alias("end_us"), us.alias("us"), "line_id", F.col("v").cast("double"))
    out = rows.groupBy(*CHANNEL, "end_us").transformWithStateInPandas(
        Windows(min_readings), ", ".join(f"{c} {t}" for c, t in OUT.items()), "Append", "EventTime")
    return out.select(
        *CHANNEL, from_micros(F.col("end_us")).alias("T"), "status", "n", "tenths",
        "line_id", from_micros(F.col("us")).alias("arrival_ts"), F.when(~is_missing(F.col("v")), F.col("v")).alias("v"))
