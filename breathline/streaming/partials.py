"""The refreshed summary from partial counts, so that a tick doesn't read its range again.

Beside a store, ``_counts`` holds what ``value_counts`` makes of each hour: one row per device,
sensor, hour and value, with counts and the first and last row. A micro-batch adds the counts of
its own new rows in a folder ``batch=<n>``, which a repeat replaces; after ``MERGE_EVERY`` of them
they are summed into one, ``upto=<n>``. Counts add up in any order, so a tick sums those of the
whole hours of its range, and reads stored rows for the two hours at its ends alone.
"""

import datetime as dt
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from breathline.functions.times import local_date_bounds
from breathline.operators.enrich import decode_readings
from breathline.operators.filters import filter_newer_than, recent_bounds
from breathline.operators.summary import summary_of_counts, value_counts
from breathline.schema import KEY
from breathline.sinks import files
from breathline.sources.readings import COLUMNS, month_of, scan_readings, time_filter
from breathline.streaming.store import SEED_BATCH, earlier_marks, is_stored, write_batch

MERGE_EVERY = 64
COUNTS = (
    "device_id string, sensor_id int, PPM_10X int, n bigint, n_t bigint, first_id bigint, first_t timestamp_ntz,"
    " last_id bigint, last_t timestamp_ntz, hour timestamp_ntz, month string")
SHORT_OF_HOUR = dt.timedelta(minutes=59, seconds=59, microseconds=999_999)


def hour_of(t: Column) -> Column:
    return F.date_trunc("hour", t).cast("timestamp_ntz")


def merged(counts: DataFrame, *by: str) -> DataFrame:
    """Counts of the same device, sensor and value (and ``by``) in one row."""
    return counts.groupBy(*KEY, "PPM_10X", *by).agg(
        F.sum("n").alias("n"), F.sum("n_t").alias("n_t"),
        F.min("first_id").alias("first_id"), F.min_by("first_t", "first_id").alias("first_t"),
        F.max("last_id").alias("last_id"), F.max_by("last_t", "last_id").alias("last_t"))


def hourly_counts(readings: DataFrame) -> DataFrame:
    """``value_counts`` of every hour; rows without a time are in no range."""
    rows = decode_readings(readings).filter(F.col("T").isNotNull()).withColumn("hour", hour_of(F.col("T")))
    counts = rows.groupBy(*KEY, "hour", "PPM_10X").agg(
        F.count(F.lit(1)).alias("n"), F.count("T").alias("n_t"),
        F.min("id").alias("first_id"), F.min_by("T", "id").alias("first_t"),
        F.max("id").alias("last_id"), F.max_by("T", "id").alias("last_t"))
    return counts.withColumn("month", month_of(F.col("hour")))


def _numbers(spark: SparkSession, root: str) -> tuple[int | None, list[int]]:
    """(newest whole merge, the batches after it)."""
    names = files.names(spark, f"{root}/_counts")
    whole = [n for n in names if files.exists(spark, f"{root}/_counts/{n}/_SUCCESS")]
    upto = max((int(n.removeprefix("upto=")) for n in whole if n.startswith("upto=")), default=None)
    batches = sorted(int(n.removeprefix("batch=")) for n in whole if n.startswith("batch="))
    return upto, [b for b in batches if upto is None or b > upto]


def _read(spark: SparkSession, root: str, upto: int | None, batches: list[int]) -> DataFrame:
    folders = [f"upto={upto}"] * (upto is not None) + [f"batch={b}" for b in batches]
    parts = [spark.read.schema(COUNTS).parquet(f"{root}/_counts/{f}") for f in folders]
    return reduce(DataFrame.unionByName, parts, spark.createDataFrame([], COUNTS))


def stored_counts(spark: SparkSession, root: str) -> DataFrame:
    """Hourly counts of all batches; an hour and value may come in several rows."""
    return _read(spark, root, *_numbers(spark, root))


def write_counts(rows: DataFrame, root: str, batch_id: int, merge_every: int = MERGE_EVERY) -> None:
    """Add the counts of one batch's rows; a repeat replaces them, or finds them merged."""
    spark = rows.sparkSession
    upto, batches = _numbers(spark, root)
    if upto is not None and batch_id <= upto:
        return
    hourly_counts(rows).write.mode("overwrite").partitionBy("month").parquet(f"{root}/_counts/batch={batch_id}")
    # the newest batch may be repeated, so it is not merged
    old = [b for b in batches if b < batch_id]
    if len(old) >= merge_every:
        (
            merged(_read(spark, root, upto, old), "hour").withColumn("month", month_of(F.col("hour"))).hint("rebalance", "month")
            .write.mode("overwrite").partitionBy("month").parquet(f"{root}/_counts/upto={old[-1]}")
        )
        for name in [f"upto={upto}"] * (upto is not None) + [f"batch={b}" for b in old]:
            files.delete(spark, f"{root}/_counts/{name}")


def seed_counts(rows: DataFrame, root: str) -> None:
    """Counts of the rows that ``seed_store`` started the store with."""
    write_counts(rows, root, SEED_BATCH)


def refreshed_from_counts(spark: SparkSession, root: str, ranges: DataFrame, as_of: str, dates: tuple[str, str] | None = None) -> DataFrame:
    """``views.refreshed`` of the store, from its hourly counts and the rows of its range's two ends."""
    start, end = local_date_bounds(*dates, as_of) if dates else recent_bounds(as_of)
    first, last = hour_of(start + F.lit(SHORT_OF_HOUR)), hour_of(end)
    hour, t = F.col("hour"), F.col("T")
    inside = stored_counts(spark, root).filter(
        (hour >= first) & (hour < last) & F.col("month").between(month_of(start), month_of(end)))
    ends = time_filter(scan_readings(spark, root), start, end).filter((t < first) | (t >= last))
    counts = merged(inside.select(*KEY, "PPM_10X", "n", "n_t", "first_id", "first_t", "last_id", "last_t").unionByName(value_counts(decode_readings(ends))))
    # a sensor with several rows of limits counts as often, as in the join
    times = ranges.groupBy("sensor_id").agg(F.count("*").alias("times"))
    counts = counts.join(times, "sensor_id", "left").withColumns({c: F.col(c) * F.coalesce("times", F.lit(1)) for c in ("n", "n_t")})
    return summary_of_counts(counts.drop("times"), as_of)


def refresh_sink(
    root: str, ranges: DataFrame, path: str, clock: Callable[[], str], dates: tuple[str, str] | None = None, merge_every: int = MERGE_EVERY,
) -> Callable[[DataFrame, int], None]:
    """As ``views.refresh_sink``, from counts. A store that was seeded needs ``seed_counts`` too."""
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        marks = earlier_marks(spark, root, batch_id)
        rows = filter_newer_than(batch.select(*COLUMNS), marks)
        if not is_stored(spark, root, batch_id):
            write_batch(rows, marks, root, batch_id)
        write_counts(rows, root, batch_id, merge_every)
        refreshed_from_counts(spark, root, ranges, clock(), dates).write.mode("overwrite").parquet(f"{path}/refresh={batch_id}")
        for name in files.names(spark, path):
            if name.startswith("refresh=") and int(name.removeprefix("refresh=")) < batch_id - 1:
                files.delete(spark, f"{path}/{name}")
    return write
