"""Live publishing: tumbling medians, and the carry form with ticks tied to the last push."""

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from breathline.functions import times as T
from breathline.operators.publish import CHANNEL, MIN_READINGS, PERIOD_S, median_tenths, publish_windows
from breathline.session import frozen
from breathline.sinks import files

WAITING = "device_id string, line_id bigint, us bigint, values array<double>"
PUSHES = "device_id string, last_push bigint"


def stream_publish_tumbling(
    long: DataFrame, delay: str, period_s: int = PERIOD_S, min_readings: int = MIN_READINGS,
    time: str = "arrival_ts",
) -> DataFrame:
    """``publish_median`` on a stream; a window leaves the state once ``delay`` has passed."""
    timed = long.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, delay)
    windows = timed.groupBy(*CHANNEL, F.window(time, f"{period_s} seconds"))
    return publish_windows(windows, min_readings=min_readings)


def push_times(period_s: int, min_readings: int) -> Callable[[pd.DataFrame], pd.DataFrame]:
    """For one device's lines of a batch, by time alone: the push that publishes each.

    A push is due at the first line at least a period after the one before. It publishes
    what is held since the last publish if that is enough, else it keeps it, but the next
    push still counts from it. Lines after the last publish get none; lines with another
    number of values than the due one are from before a change of channels and get -1.
    The last row, without a line, is the device's last push.
    """
    period = period_s * 1_000_000

    def run(lines: pd.DataFrame) -> pd.DataFrame:
        lines = lines.sort_values(["us", "line_id", "row"], ignore_index=True)
        times, sizes = lines["us"].to_numpy(), lines["n_values"].to_numpy()
        part = np.cumsum(np.r_[0, sizes[1:] != sizes[:-1]])
        new = int(lines["is_new"].to_numpy().argmax())  # what waits comes before
        last, held = lines["last_push"].iloc[0], 0
        last = times[new] if pd.isna(last) else int(last)
        publishes = np.full(len(lines), np.nan)
        at = new
        while (due := at + int(np.searchsorted(times[at:], last + period))) < len(times):
            last, at = times[due], due + 1
            first = max(held, int(np.searchsorted(part, part[due])))
            if due + 1 - first >= min_readings:
                publishes[held:first] = -1
                publishes[first:due + 1] = last
                held = due + 1
        whole = {"row": "Int64", "push_us": "Int64"}
        out = pd.DataFrame({"device_id": lines["device_id"], "row": lines["row"], "push_us": publishes})
        own = pd.DataFrame({"device_id": [lines["device_id"].iloc[0]], "row": [None], "push_us": [float(last)]})
        return pd.concat([out.astype(whole), own.astype(whole)])
    return run


def carry_step(
    arrived: DataFrame, waiting: DataFrame, pushes: DataFrame, period_s: int = PERIOD_S, min_readings: int = MIN_READINGS
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """One micro-batch: what is published, the lines still waiting, and each device's last push.

    Python sees times and line numbers only, three numbers per line of the batch, which
    the source's rate limit bounds. Lines meet their push by a number that the frozen
    batch gives each row, as a feed may repeat a line's own number, and medians are grouped
    by push and channel, so a hot device is spread over all tasks.
    """
    both = waiting.withColumn("is_new", F.lit(False)).unionByName(arrived.withColumn("is_new", F.lit(True)))
    lines = frozen(both.withColumn("row", F.monotonically_increasing_id()))
    busy = lines.filter("is_new").select("device_id").distinct()
    timed = lines.join(busy, "device_id", "left_semi").join(pushes, "device_id", "left").select(
        "device_id", "line_id", "row", "us", F.size("values").alias("n_values"), "is_new", "last_push")
    given = frozen(timed.groupBy("device_id").applyInPandas(
        push_times(period_s, min_readings), "device_id string, row bigint, push_us bigint"))
    joined = lines.join(given.filter(F.col("row").isNotNull()), ["device_id", "row"], "left")
    published = (
        joined.filter(F.col("push_us") >= 0)
        .select("device_id", "push_us", F.posexplode_outer("values").alias("channel", "v"))
        .groupBy("device_id", "push_us", "channel").agg(median_tenths("v").alias("tenths"), F.count(F.lit(1)).alias("n"))
        .select("device_id", T.stamp_seconds(T.from_micros(F.col("push_us"))).alias("T"), "channel", "tenths", "n")
    )
    left = joined.filter(F.col("push_us").isNull()).select("device_id", "line_id", "us", "values")
    now = given.filter(F.col("row").isNull()).select("device_id", F.col("push_us").alias("last_push"))
    return published, left, now.unionByName(pushes.join(now, "device_id", "left_anti"))


def carry_sink(
    root: str, publish: Callable[[DataFrame, int], None], period_s: int = PERIOD_S, min_readings: int = MIN_READINGS,
    time: str = "arrival_ts",
) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function for accepted lines: hand what is due to ``publish``.

    Needs lines in arrival order between micro-batches. What waits for the next batch and
    the last pushes are kept in a folder per batch, which a repeat replaces.
    """
    def folder(batch_id: int, name: str) -> str:
        return f"{root}/_carry/batch={batch_id}/{name}"

    def kept(spark: SparkSession, batch_id: int, name: str, schema: str) -> DataFrame:
        path = folder(batch_id, name)
        return spark.read.schema(schema).parquet(path) if files.exists(spark, path) else spark.createDataFrame([], schema)

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        arrived = batch.select("device_id", "line_id", T.micros(F.col(time)).alias("us"), "values")
        published, waiting, pushes = carry_step(
            arrived, kept(spark, batch_id - 1, "waiting", WAITING), kept(spark, batch_id - 1, "pushes", PUSHES),
            period_s, min_readings)
        publish(published, batch_id)
        waiting.write.mode("overwrite").parquet(folder(batch_id, "waiting"))
        pushes.write.mode("overwrite").parquet(folder(batch_id, "pushes"))
        for name in files.names(spark, f"{root}/_carry"):
            if int(name.removeprefix("batch=")) < batch_id - 1:
                files.delete(spark, f"{root}/_carry/{name}")
    return write


def to_folder(path: str) -> Callable[[DataFrame, int], None]:
    """Each batch in a folder of its own, ``batch=<n>``."""
    def write(rows: DataFrame, batch_id: int) -> None:
        rows.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")
    return write
