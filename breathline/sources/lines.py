"""Feeds of device text lines and raw samples, as tables or streams."""

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from breathline.functions.times import from_micros
from breathline.plans.chunks import with_ordinal
from breathline.schema import ADC_SAMPLE, RAW_LINE


def _reader(spark: SparkSession, streaming: bool, files_per_batch: int | None = None):
    if not streaming:
        return spark.read
    reader = spark.readStream
    return reader.option("maxFilesPerTrigger", files_per_batch) if files_per_batch else reader


def scan_raw_lines(
    spark: SparkSession, path: str, streaming: bool = False, files_per_batch: int | None = None
) -> DataFrame:
    """Stored RAW_LINE rows; nothing is dropped, so rejects can still be counted."""
    return _reader(spark, streaming, files_per_batch).schema(RAW_LINE).parquet(path)


# A feed file's lines take the ids after its time in milliseconds, so it holds at most so many.
FILE_LINES = 1 << 20


def scan_text_lines(
    spark: SparkSession, path: str, streaming: bool = False, files_per_batch: int | None = None
) -> DataFrame:
    """RAW_LINE rows of text files under ``device_id=<name>`` folders, empty reads dropped.

    A line arrives with its file: its time is that of the file, a microsecond later for
    each line before it, and its id follows from both, so ids rise in arrival order and
    a repeated read gives the same ones. A file is read as one row to know the places of
    its lines, and files of one device need times of their own. ``feed.scan_text_feed`` has
    neither bound; for a log with times in its lines use ``scan_recorded_log``.
    """
    reader = _reader(spark, streaming, files_per_batch).schema("content string, device_id string")
    files = reader.text(path, wholetext=True).select(
        "device_id", F.unix_millis(F.col("_metadata.file_modification_time")).alias("_ms"),
        F.posexplode(F.split("content", "\n")).alias("_at", "line"),
    )
    too_long = F.raise_error(F.lit(f"a feed file has more than {FILE_LINES} lines")).cast("bigint")
    at = F.when(F.col("_at") < FILE_LINES, F.col("_at").cast("bigint")).otherwise(too_long)
    return drop_empty_reads(files).select(
        "device_id", (F.col("_ms") * FILE_LINES + at).alias("line_id"),
        from_micros(F.col("_ms") * 1000 + at).alias("arrival_ts"), "line",
    )


def drop_empty_reads(lines: DataFrame, line: str = "line") -> DataFrame:
    return lines.filter(F.length(line) > 0)


def scan_recorded_log(spark: SparkSession, path: str) -> DataFrame:
    """RAW_LINE rows of a log written by ``sink_raw_log``: epoch seconds, a comma, the line.

    Times are exact to the microsecond. Lines are numbered per device by time, in cells
    of an hour, so that no task holds a device.
    """
    row = F.col("value")
    comma = F.locate(",", row)
    epoch: Column = F.substring(row, F.lit(1), comma - 1).cast("decimal(20,6)")
    lines = spark.read.schema("value string, device_id string").text(path).select(
        "device_id", from_micros((epoch * 1_000_000).cast("bigint")).alias("arrival_ts"),
        F.substring(row, comma + 1, F.length(row)).alias("line"),
    )
    numbered = with_ordinal(lines, ["device_id"], F.date_trunc("hour", "arrival_ts"), ["arrival_ts", "line"], "line_id")
    return numbered.select(*RAW_LINE.fieldNames())


def scan_adc_samples(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(ADC_SAMPLE).parquet(path)
