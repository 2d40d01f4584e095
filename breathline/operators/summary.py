"""Per device and sensor summaries of the dashboard table."""

from pyspark.sql import Column, DataFrame, functions as F

from breathline.functions.times import age_text, seconds_between
from breathline.schema import KEY


def value_counts(readings: DataFrame) -> DataFrame:
    """One row per device, sensor and stored value, with what the summary needs of it.

    A stored value has 65,536 possible tenths, so a sensor that holds a third of all
    rows shrinks to that many rows before its own group is formed.
    """
    return readings.groupBy(*KEY, "PPM_10X").agg(
        F.count(F.lit(1)).alias("n"),
        F.count("T").alias("n_t"),
        F.min("id").alias("first_id"),
        F.min_by("T", "id").alias("first_t"),
        F.max("id").alias("last_id"),
        F.max_by("T", "id").alias("last_t"),
    )


def _sample_sd(x: Column, n: Column) -> Column:
    """Sample standard deviation of a weighted whole number, from exact sums."""
    weight = n.cast("decimal(38,0)")
    squares = F.sum((weight * (x.cast("bigint") * x).cast("decimal(38,0)")).cast("decimal(38,0)"))
    total = F.sum(n * x).cast("decimal(38,0)")
    spread = (F.sum(n).cast("decimal(38,0)") * squares - total * total).cast("double")
    pairs = F.sum(n).cast("double") * (F.sum(n) - 1).cast("double")
    return F.when(F.sum(n) > 1, F.sqrt(spread / F.when(pairs > 0, pairs)))


def device_summary(readings: DataFrame, as_of: str) -> DataFrame:
    """Min, max, mean, sd, median, last row and its age, count and mean gap per sensor.

    A missing value makes the figures of its group NULL, it is not skipped. The last row
    is the one with the highest id, not the latest time.
    """
    return summary_of_counts(value_counts(readings), as_of)


def summary_of_counts(counts: DataFrame, as_of: str) -> DataFrame:
    """The same of ``value_counts``; a value may come in several rows."""
    x, n = F.col("PPM_10X"), F.col("n")
    whole = F.sum(F.when(x.isNull(), n).otherwise(0)) == 0
    ten = F.lit(10.0)
    per_group = counts.groupBy(*KEY).agg(
        F.when(whole, F.min(x) / ten).alias("min"),
        F.when(whole, F.max(x) / ten).alias("max"),
        F.when(whole, F.sum(n * x).cast("double") / F.sum(n) / ten).alias("mean"),
        F.when(whole, _sample_sd(x, n) / ten).alias("sd"),
        F.when(whole, F.percentile(x, F.lit(0.5), n) / ten).alias("median"),
        F.max_by("last_t", "last_id").alias("last_T"),
        F.min_by("first_t", "first_id").alias("_first_T"),
        F.sum(n).alias("N"),
        (F.sum("n_t") == F.sum(n)).alias("_all_timed"),
    )
    span = seconds_between(F.col("last_T"), F.col("_first_T"))
    # The mean of successive gaps telescopes to the span over n - 1.
    gap = F.when(F.col("_all_timed") & (F.col("N") > 1), span / F.nullif(F.col("N") - 1, F.lit(0)))
    return per_group.select(
        *KEY, "min", "max", "mean", "sd", "median", "last_T",
        age_text(F.col("last_T"), as_of).alias("last_point"),
        "N", gap.alias("avg_sampling_period"),
    )


def high_water_mark(devices: DataFrame, readings: DataFrame) -> DataFrame:
    """Highest id stored per device, -1 for a device without rows."""
    highest = readings.groupBy("device_id").agg(F.max("id").alias("last_id"))
    return devices.join(highest, "device_id", "left").select(
        "device_id", F.coalesce("last_id", F.lit(-1)).cast("bigint").alias("last_id")
    )


def first_per_key(readings: DataFrame) -> DataFrame:
    """First stored row of each sensor of a device."""
    return _row_per_key(readings, F.min_by)


def last_per_key(readings: DataFrame) -> DataFrame:
    """Last stored row of each sensor of a device."""
    return _row_per_key(readings, F.max_by)


def _row_per_key(readings: DataFrame, pick) -> DataFrame:
    # Column by column rather than as a struct: fixed-width buffers aggregate by hash.
    return readings.groupBy(*KEY).agg(*[pick(c, "id").alias(c) for c in ("id", "T", "CO2_ppm")])


def distinct_device_sensor(readings: DataFrame) -> DataFrame:
    return readings.select(*KEY).distinct()
