"""Telemetry tables derived from the given ones, row by row or per line.

``events`` gives readings, lines and samples, ``nation`` the channel look-up and
``supplier`` the limits.
"""

from pyspark.sql import DataFrame, SparkSession, functions as F

from breathline.functions.times import stamp_seconds
from breathline.session import utc

AS_OF = "2024-01-31 00:00:00"
OWN = "click"


# Declared, so that no job is spent on inferring them.
SCHEMAS = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
}


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return utc(spark).read.schema(SCHEMAS[name]).parquet(f"{sf}/{name}.parquet")


def events(spark: SparkSession, sf: str, streaming: bool = False) -> DataFrame:
    if not streaming:
        return table(spark, sf, "events")
    # As a pattern the path may be one file or a folder of files; a stream takes no plain file.
    return utc(spark).readStream.schema(SCHEMAS["events"]).parquet(f"{sf}/events.parque[t]")


def readings(spark: SparkSession, sf: str, streaming: bool = False) -> DataFrame:
    """Stored readings of five devices and twelve sensors."""
    tenths = F.bround(F.col("value") * F.lit(8.0) + F.lit(400.0), 0) * F.lit(10.0)
    return events(spark, sf, streaming).select(
        F.col("event_type").alias("device_id"), F.col("event_id").alias("id"),
        stamp_seconds(F.col("ts")).alias("T"),
        (F.col("user_id") % 12 + 1).cast("int").alias("SENSOR"), tenths.cast("int").alias("PPM_10X"),
    )


def arrivals(spark: SparkSession, sf: str, streaming: bool = False) -> DataFrame:
    """The same rows with their time in microseconds."""
    return events(spark, sf, streaming).select(
        F.col("event_type").alias("device_id"), F.col("event_id").alias("id"), "ts",
        (F.col("user_id") % 12 + 1).cast("int").alias("sensor_id"), F.col("value").alias("v"),
    )


def arrival_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Arrivals as lines of a device: line number and time."""
    return arrivals(spark, sf).select(
        "device_id", F.col("id").alias("line_id"), F.col("ts").alias("arrival_ts")
    )


def ranges(spark: SparkSession, sf: str) -> DataFrame:
    """A limits row per supplier, around its account balance; some bounds are open.

    The numbers leave out sensors 11 and 12, which have readings, and go on past the
    sensors that have any.
    """
    key, centre = F.col("s_suppkey"), F.abs("s_acctbal") / 4 + 400
    return table(spark, sf, "supplier").select(
        F.when(key < 11, key).otherwise(key + 2).cast("int").alias("sensor_id"),
        F.round(centre, 2).alias("set"),
        F.when(key % 7 != 3, F.round(centre - 150, 2)).alias("min"),
        F.when(key % 5 != 4, F.round(centre + 250, 2)).alias("max"),
    )


def lut(spark: SparkSession, sf: str) -> DataFrame:
    """Five devices of five channels, sensors 1 to 5 on even and 6 to 10 on odd devices.

    The last two channels of ``dev_4`` share a sensor.
    """
    channel = F.floor(F.col("n_nationkey") / 5)
    shared = (F.col("n_regionkey") == 4) & (channel == 4)
    return table(spark, sf, "nation").select(
        F.concat(F.lit("dev_"), F.col("n_regionkey")).alias("device_id"),
        channel.cast("int").alias("channel"),
        (F.when(shared, 4).otherwise(channel + 1) + F.col("n_regionkey") % 2 * 5).cast("int").alias("sensor_id"),
    )


def raw_lines(spark: SparkSession, sf: str, gain: float = 60.0, base: float = 0.0, clean: bool = False) -> DataFrame:
    """Five consecutive events make one line; unless ``clean``, some lines are broken."""
    x = F.round(F.col("value") * F.lit(gain) + F.lit(base), 2)
    good = (
        events(spark, sf)
        .groupBy(F.expr("event_id div 5").alias("line_id"))
        .agg(
            F.min("ts").alias("arrival_ts"),
            F.sort_array(F.collect_list(F.struct(F.col("event_id"), x.alias("x")))).alias("_vs"),
        )
        .withColumn("_text", F.concat(
            F.array_join(F.transform("_vs", lambda v: F.format_string("%.2f", v["x"])), ","), F.lit(",")
        ))
    )
    line, end = F.col("_text"), F.lit("\r\n")
    kind = F.col("line_id") % 97
    broken = (
        F.when(kind == 3, F.concat(F.lit("#"), line, end))
        .when(kind == 5, F.concat(F.lit("t,1,2"), end))
        .when(kind == 7, F.lit(""))
        .when(kind == 11, F.concat(line, F.lit("9.00,"), end))
        .when(kind == 13, F.concat(line, F.lit("x1"), end))
        .when(kind == 17, F.concat(F.lit(","), line, end))
        .when(kind == 19, F.concat(line, F.lit("1d"), end))
        .otherwise(F.concat(line, end))
    )
    return good.select(
        F.concat(F.lit("dev_"), F.col("line_id") % 5).alias("device_id"), "line_id", "arrival_ts",
        (F.concat(line, end) if clean else broken).alias("line"),
    )


def arriving_files(lines: DataFrame, path: str, count: int = 4, order: str = "arrival_ts") -> None:
    """Write lines as ``count`` files, each after the one before in ``order`` and in its own time stamp."""
    spark = lines.sparkSession
    lines.repartitionByRange(count, order).write.parquet(path)
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    parts = sorted(s.getPath().toString() for s in files.listStatus(folder) if s.getPath().getName().startswith("part-"))
    for number, part in enumerate(parts):
        files.setTimes(spark._jvm.org.apache.hadoop.fs.Path(part), 1_700_000_000_000 + 60_000 * number, -1)


def mostly_valid_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Unbroken lines with only a few values outside 300..5000."""
    return raw_lines(spark, sf, gain=20.0, base=290.0, clean=True)


def adc_samples(spark: SparkSession, sf: str) -> DataFrame:
    """Ten-bit samples of five devices and five channels."""
    return events(spark, sf).select(
        F.concat(F.lit("dev_"), F.expr("event_id div 5") % 5).alias("device_id"),
        (F.col("event_id") % 5).cast("int").alias("channel"),
        F.expr("event_id div 25").alias("sample_no"),
        F.least(F.lit(1023), F.floor(F.col("value") * F.lit(8.0))).cast("int").alias("adc"),
    )


def sync_target(spark: SparkSession, sf: str) -> DataFrame:
    """A store that lags behind: one device missing, two cut short, holes in the rest."""
    cut = (
        F.when(F.col("device_id") == "click", F.lit("2024-01-16"))
        .when(F.col("device_id") == "error", F.lit("2024-01-08"))
        .otherwise(F.lit("2025-01-01"))
    )
    return readings(spark, sf).filter(
        (F.col("device_id") != "view") & (F.col("T") < cut.cast("timestamp_ntz")) & (F.col("id") % 7 != 0)
    )
