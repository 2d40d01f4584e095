"""Time and id filters; bounds are literals, so they reach the Parquet scan."""

from pyspark.sql import Column, DataFrame, functions as F

from breathline.functions import times as T
from breathline.plans.sizing import broadcast_if_small
from breathline.sources.readings import time_filter


def filter_time_between(readings: DataFrame, start: str, end: str) -> DataFrame:
    return time_filter(readings, *(F.lit(t).cast("timestamp_ntz") for t in (start, end)))


def filter_local_dates(
    readings: DataFrame, start: str, end: str, as_of: str, zone: str = T.TZONE
) -> DataFrame:
    """Two local dates at the time of day of ``as_of``, plus an hour; no rows if either time was skipped."""
    return time_filter(readings, *T.local_date_bounds(start, end, as_of, zone))


def recent_bounds(as_of: str, days: int = 2, zone: str = T.TZONE) -> tuple[Column, Column]:
    today = T.to_local(F.lit(as_of).cast("timestamp_ntz"), zone).cast("date")
    return T.local_date_bounds(F.date_sub(today, days), today, as_of, zone)


def filter_recent_days(readings: DataFrame, as_of: str, days: int = 2, zone: str = T.TZONE) -> DataFrame:
    """The default view: the last ``days`` local days."""
    return time_filter(readings, *recent_bounds(as_of, days, zone))


def filter_zoom(
    readings: DataFrame, start: str, end: str,
    xmin: float | None = None, xmax: float | None = None,
) -> DataFrame:
    """A brush in epoch seconds where one is set, else the full range."""
    full = (F.lit(t).cast("timestamp_ntz") for t in (start, end))
    brushed = (
        bound if x is None else T.from_micros(F.lit(round(x * 1_000_000)))
        for x, bound in zip((xmin, xmax), full)
    )
    return time_filter(readings, *brushed)


def filter_newer_than(readings: DataFrame, marks: DataFrame) -> DataFrame:
    """Rows whose ``id`` is above their device's ``last_id``; a device without a mark keeps all."""
    return (
        readings.join(broadcast_if_small(marks.select("device_id", "last_id")), "device_id", "left")
        .filter(F.col("id") > F.coalesce("last_id", F.lit(-1)))
        .drop("last_id")
    )
