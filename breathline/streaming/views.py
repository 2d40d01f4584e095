"""Live views: the sliding window and the refreshed summary.

Line ingest and the join to limits need no streaming form of their own: the batch
functions in ``operators.ingest`` and ``operators.enrich`` take a stream as they are.
"""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from breathline.functions.numbers import round_stat
from breathline.operators.enrich import flag_readings
from breathline.operators.filters import filter_local_dates, filter_recent_days
from breathline.operators.summary import device_summary
from breathline.schema import KEY
from breathline.sinks import files
from breathline.sources.readings import scan_readings
from breathline.streaming.store import start_store, sync_sink

REFRESH = "60 seconds"


def stream_trailing(
    arrivals: DataFrame, delay: str, window: str = "20 seconds", slide: str = "1 second",
    time: str = "ts", value: str = "v",
) -> DataFrame:
    """Mean, population sd, newest value and count per sensor for every slide of the window."""
    timed = arrivals.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, delay)
    v = F.col(value)
    return timed.groupBy(*KEY, F.window(time, window, slide)).agg(
        F.avg(v).alias("mean"), F.stddev_pop(v).alias("sd"),
        F.max_by(v, time).alias("latest"), F.count(v).alias("n"),
    ).select(
        *KEY, F.col("window.end").cast("timestamp_ntz").alias("T"),
        round_stat(F.col("mean")).alias("mean"), round_stat(F.col("sd")).alias("sd"), "latest", "n",
    )


def refreshed(store: DataFrame, ranges: DataFrame, as_of: str, dates: tuple[str, str] | None = None) -> DataFrame:
    """The dashboard's summary at one tick: its range and ages are those of ``as_of``.

    Without ``dates`` the range is the default view, the last days and an hour.
    """
    rows = filter_local_dates(store, *dates, as_of) if dates else filter_recent_days(store, as_of)
    return device_summary(flag_readings(rows, ranges), as_of)


def refresh_sink(
    root: str, ranges: DataFrame, path: str, clock: Callable[[], str], dates: tuple[str, str] | None = None
) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function: store the new rows, then write the summary of this tick.

    Every refresh goes to a folder of its own, which a repeat replaces, so a reader of
    ``latest_refresh`` sees a whole one. The store is read by the range's months alone.
    """
    store_rows = sync_sink(root)

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        store_rows(batch, batch_id)
        summary = refreshed(scan_readings(spark, root), ranges, clock(), dates)
        summary.write.mode("overwrite").parquet(f"{path}/refresh={batch_id}")
        for name in files.names(spark, path):
            if name.startswith("refresh=") and int(name.removeprefix("refresh=")) < batch_id - 1:
                files.delete(spark, f"{path}/{name}")
    return write


def latest_refresh(spark: SparkSession, path: str) -> DataFrame:
    """The newest whole summary."""
    done = [n for n in files.names(spark, path) if files.exists(spark, f"{path}/{n}/_SUCCESS")]
    newest = max(done, key=lambda n: int(n.removeprefix("refresh=")))
    return spark.read.parquet(f"{path}/{newest}")


def start_refresh_summary(
    readings: DataFrame, ranges: DataFrame, root: str, path: str, checkpoint: str,
    clock: Callable[[], str], dates: tuple[str, str] | None = None, **trigger,
):
    """Keep a store and its summaries up to date; every minute unless told otherwise."""
    return start_store(
        readings, refresh_sink(root, ranges, path, clock, dates), checkpoint,
        **(trigger or {"processingTime": REFRESH}))
