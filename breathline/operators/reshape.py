"""Block means of raw samples and gathering channels into one record."""

from pyspark.sql import DataFrame, functions as F

# Samples that make one output value of a channel.
OVERSAMPLE = 32


def oversample_mean(samples: DataFrame, block: int = OVERSAMPLE) -> DataFrame:
    """Mean of each full block of consecutive samples per device and channel."""
    return (
        samples.groupBy("device_id", "channel", F.expr(f"sample_no div {block}L").alias("block"))
        .agg(F.avg("adc").alias("mean_adc"), F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") == block)
        .drop("n")
    )


def long_to_wide(long: DataFrame, record: list[str], value: str, channel: str = "channel") -> DataFrame:
    """Channels of one record gathered in channel order into ``values``.

    A record has one row per channel, so its array stays short.
    """
    gathered = F.sort_array(F.collect_list(F.struct(channel, value)))
    return long.groupBy(*record).agg(F.transform(gathered, lambda x: x[value]).alias("values"))
