"""The exact live view: a row per drawn line and channel, from state kept per device.

A device's state is what its buffer is: the lines of the trailing window with their times,
and the number of lines held. A line joins the buffer; below ``warmup`` lines nothing is
drawn; else lines older than the window, by event time, are dropped and the frame is drawn.
Rows are those of ``trailing_stats`` and ``trailing_minmax_scale`` at the lines for which
``trailing_warmup_gate`` says so. A micro-batch's frames are worked out together, in time
that hangs on its lines and those of one window, not on the lines of each frame.

The state is kept by Spark, in RocksDB, and is bounded by the lines of a window. A device's
lines of a micro-batch pass through one task, as the view hangs on their order; the source's
rate limit bounds them.

Lines are taken in order of time and line id. One that is not after the device's newest
line of an earlier micro-batch came late: it is returned with ``late`` and without figures,
so that what was drawn and what was late account for every line that the gate let through.
A line with another number of channels than the one before begins a new buffer.
"""

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from breathline.functions.numbers import round_stat
from breathline.functions.times import from_micros, micros
from breathline.operators.trailing import WARMUP, WINDOW_S
from breathline.plans import frames

STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
FRAMES = "device_id string, line_id long, us long, channel int, latest double, mean double, sd double, n long, scaled double, late boolean"


def with_state_store(spark: SparkSession) -> SparkSession:
    """Set the session's state store to one that keeps lists; streams take it when they start."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    return spark


class Buffer:
    """The lines of one device's window, as the live view holds them."""

    def __init__(self, window_us: int, warmup: int, lines: list[tuple[int, list[float]]], held: int):
        self.window_us, self.warmup, self.held = window_us, warmup, held
        self.times = [t for t, _ in lines]
        self.values = [v for _, v in lines]
        self.start = 0

    def begins_anew(self, values: list[float]) -> bool:
        """Whether a line with these values has another number of channels."""
        return bool(self.values) and len(self.values[-1]) != len(values)

    def push(self, us: int, values: list[float]) -> bool:
        """Take up a line; whether its frame, from ``start`` on, is drawn or the buffer still fills up."""
        if self.begins_anew(values):
            self.times, self.values, self.start, self.held = [], [], 0, 0
        self.times.append(us)
        self.values.append(values)
        self.held += 1
        while self.times[self.start] < us - self.window_us:
            self.start += 1
        if self.held < self.warmup:
            return False
        self.held = len(self.times) - self.start
        return True

    def add(self, us: int, values: list[float]) -> np.ndarray | None:
        """The frame to draw, newest line last; None while the buffer fills up."""
        return np.array(self.values[self.start:], dtype=np.float64) if self.push(us, values) else None

    def drawn(self, at: list[int]) -> tuple[np.ndarray, ...]:
        """(latest, mean, sd, rows, scaled) of the frames that end in these lines, a column per channel."""
        values = np.array(self.values, dtype=np.float64)
        rows, mean, sd, low, high = frames.figures(values, np.array(self.times), self.window_us, np.array(at))
        return values[at], mean, sd, rows, scaled_to(values[at], low, high)

    def lines(self) -> list[tuple[int, list[float]]]:
        return list(zip(self.times[self.start:], self.values[self.start:], strict=True))


def scaled_to(latest: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """``latest`` (a row per line, a column per channel), highest = 0; no line is scaled while a channel is constant."""
    span = high - low
    with np.errstate(invalid="ignore", divide="ignore"):
        scaled = 1.0 - (latest - low) / span
    return np.where((span == 0).any(axis=1, keepdims=True), np.nan, scaled)


def frame_rows(device: str, buffer: Buffer, drawn: list[tuple[int, int]]) -> pd.DataFrame:
    """Rows of the drawn lines, given as (place in the buffer, line id)."""
    at, line_ids = [place for place, _ in drawn], [line_id for _, line_id in drawn]
    latest, mean, sd, n, scaled = buffer.drawn(at)
    channels = latest.shape[1]
    return pd.DataFrame({
        "device_id": device, "line_id": np.repeat(line_ids, channels), "us": np.repeat([buffer.times[i] for i in at], channels),
        "channel": np.tile(np.arange(channels), len(at)), "latest": latest.ravel(), "mean": mean.ravel(), "sd": sd.ravel(),
        "n": np.repeat(n, channels), "scaled": scaled.ravel(), "late": False})


class LiveView(StatefulProcessor):
    def __init__(self, window_us: int, warmup: int):
        self.window_us, self.warmup = window_us, warmup

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.lines = handle.getListState("lines", "us long, vs array<double>")
        self.mark = handle.getValueState("mark", "held int, us long, line_id long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        held, newest = 0, None
        if self.mark.exists():
            held, *last = self.mark.get()
            newest = tuple(last)
        kept = [(us, list(vs)) for us, vs in self.lines.get()] if self.lines.exists() else []
        buffer, last_seen, drawn, late, out = Buffer(self.window_us, self.warmup, kept, held), newest, [], [], []
        arrived = pd.concat(list(rows)).sort_values(["us", "line_id"], kind="stable")
        for us, line_id, values in zip(arrived["us"].tolist(), arrived["line_id"].tolist(), arrived["vs"], strict=True):
            if newest is not None and (us, line_id) <= newest:
                late.append((key[0], line_id, us, None, None, None, None, None, None, True))
                continue
            last_seen, values = (us, line_id), [float(v) for v in values]
            if drawn and buffer.begins_anew(values):
                out.append(frame_rows(key[0], buffer, drawn))
                drawn = []
            if buffer.push(us, values) and values:
                drawn.append((len(buffer.times) - 1, line_id))
        if drawn:
            out.append(frame_rows(key[0], buffer, drawn))
        if last_seen is not None:
            self.mark.update((buffer.held, *last_seen))
            if buffer.lines():
                self.lines.put(buffer.lines())
            else:
                self.lines.clear()
        names = [f.split()[0] for f in FRAMES.split(", ")]
        types = {"channel": "Int32", "n": "Int64", "late": "bool"}
        for part in (*out, pd.DataFrame(late, columns=names)):
            if len(part):
                yield part.astype(types)

    def close(self) -> None:
        pass


def stream_trailing_rows(
    lines: DataFrame, window_s: int = WINDOW_S, warmup: int = WARMUP, time: str = "arrival_ts", values: str = "values",
) -> DataFrame:
    """(device_id, line_id, arrival_ts, channel, latest, mean, sd, n, scaled, late) of a stream of accepted lines.

    Append mode; the session must have the state store of ``with_state_store``. Mean and sd
    are rounded to three digits. A null value makes its channel's figures NaN.
    """
    rows = lines.select("device_id", "line_id", micros(F.col(time)).alias("us"), F.col(values).alias("vs"))
    drawn = rows.groupBy("device_id").transformWithStateInPandas(
        LiveView(window_s * 1_000_000, warmup), FRAMES, "Append", "None")
    return drawn.select(
        "device_id", "line_id", from_micros(F.col("us")).alias("arrival_ts"), "channel", "latest",
        round_stat(F.col("mean")).alias("mean"), round_stat(F.col("sd")).alias("sd"), "n", "scaled", "late")
