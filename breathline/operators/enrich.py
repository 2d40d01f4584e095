"""Readings joined to per-sensor limits, and the flag they give."""

from pyspark.sql import Column, DataFrame, functions as F

from breathline.functions.numbers import decode_tenths


def decode_readings(readings: DataFrame) -> DataFrame:
    """Add ``CO2_ppm`` and the numeric ``sensor_id``.

    A stored table's ``month`` ends here: filter by time first, as it prunes by it.
    """
    return readings.drop("month").withColumns({
        "CO2_ppm": decode_tenths(F.col("PPM_10X")),
        "sensor_id": F.col("SENSOR").cast("int"),
    })


def join_ranges(readings: DataFrame, ranges: DataFrame) -> DataFrame:
    """Keep every reading and add its sensor's limits, NULL where there are none.

    Limits come from a file, whose size Catalyst knows: it broadcasts them below the
    session's threshold, beyond that it shuffles and AQE splits a hot sensor.
    """
    return readings.join(ranges, "sensor_id", "left")


def in_range(value: Column, low: Column, high: Column, null_bounds: str = "unbounded") -> Column:
    """``low <= value <= high``. A NULL bound is open, or with ``"null"`` makes the flag NULL."""
    if null_bounds not in ("unbounded", "null"):
        raise ValueError("null_bounds is 'unbounded' or 'null'")
    above, below = value >= low, value <= high
    if null_bounds == "unbounded":
        above, below = F.coalesce(above, F.lit(True)), F.coalesce(below, F.lit(True))
    return F.when(value.isNotNull(), above & below)


def flag_readings(readings: DataFrame, ranges: DataFrame, null_bounds: str = "unbounded") -> DataFrame:
    """The dashboard table: decoded readings, limits and ``in_range``."""
    joined = join_ranges(decode_readings(readings), ranges)
    return joined.withColumn(
        "in_range", in_range(F.col("CO2_ppm"), F.col("min"), F.col("max"), null_bounds)
    )


def setpoint_overlay(readings: DataFrame, ranges: DataFrame) -> DataFrame:
    """Set-point of every sensor that has readings or limits."""
    seen = readings.select("sensor_id").distinct().withColumn("has_readings", F.lit(True))
    return seen.join(ranges, "sensor_id", "full").select(
        "sensor_id", "set", F.coalesce("has_readings", F.lit(False)).alias("has_readings")
    )
