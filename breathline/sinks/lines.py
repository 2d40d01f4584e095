"""Writing text lines: the raw log and encoded records."""

from pyspark.sql import DataFrame, functions as F

from breathline.functions.lines import encode_line, log_line
from breathline.functions.times import micros


def log_lines(parsed: DataFrame, time: str = "arrival_ts") -> DataFrame:
    """``epoch,line`` for every parsed line."""
    epoch = micros(F.col(time)) / F.lit(1e6)
    return parsed.select("device_id", log_line(epoch, F.col("text")).alias("line"))


def encoded_lines(wide: DataFrame) -> DataFrame:
    """One text line per wide record."""
    return wide.select("device_id", encode_line(F.col("values")).alias("line"))


def write_lines(lines: DataFrame, path: str) -> None:
    """Text files, one folder per device."""
    lines.select("device_id", "line").write.mode("append").partitionBy("device_id").text(path)
