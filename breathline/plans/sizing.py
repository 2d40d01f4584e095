"""Broadcast only what was counted."""

from pyspark.sql import DataFrame, functions as F

BROADCAST_ROWS = 200_000


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Hint a broadcast when ``df`` holds at most ``max_rows`` rows.

    For frozen results, whose size Catalyst does not know; counting reads them once. A
    larger side gets no hint: the join then shuffles, and AQE splits skewed partitions.
    """
    return F.broadcast(df) if df.count() <= max_rows else df
