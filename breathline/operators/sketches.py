"""Opt-in approximate quantiles from mergeable sketches, stored by hour.

For groups too wide for exact figures at every look. A KLL sketch of ``K`` keeps a bounded
number of values whatever it saw, and sketches of hours add up to that of any range. Its rank
error is below ``RANK_ERROR`` in all but about one look in a hundred; up to ``K`` values it is exact.
The exact figures stay the default (``device_summary``, ``plans.selection``).
"""

from pyspark.sql import DataFrame, functions as F

from breathline.functions.numbers import is_missing
from breathline.schema import KEY
from breathline.sources.readings import month_of

K = 4096
RANK_ERROR = 0.002


def hourly_sketches(readings: DataFrame, value: str = "v", time: str = "T", k: int = K, keys: list[str] = KEY) -> DataFrame:
    """(keys, hour, month, n, n_missing, sketch); rows without a time are in no hour.

    Missing values are counted, not sketched; an hour that has only those has a NULL sketch.
    """
    v = F.col(value).cast("double")
    there = F.when(~is_missing(v), v)
    hour = F.date_trunc("hour", F.col(time)).cast("timestamp_ntz")
    return (
        readings.filter(F.col(time).isNotNull()).withColumn("_v", there).groupBy(*keys, hour.alias("hour"))
        .agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("_v").isNull()).alias("n_missing"),
             F.kll_sketch_agg_double("_v", k).alias("sketch"))
        .withColumn("sketch", F.when(F.col("n") > F.col("n_missing"), F.col("sketch")))
        .withColumn("month", month_of(F.col("hour")))
    )


def write_sketches(sketches: DataFrame, path: str) -> None:
    """Append hourly sketches; an hour may come in several rows, as they merge in any order."""
    sketches.hint("rebalance", "month").write.mode("append").partitionBy("month").parquet(path)


def sketched_quantiles(sketches: DataFrame, shares: dict[str, float], k: int = K, keys: list[str] = KEY) -> DataFrame:
    """(keys, n, a column per share) of the given hours; NULL for a group with a missing value."""
    merged = sketches.groupBy(*keys).agg(
        F.sum("n").alias("n"), F.sum("n_missing").alias("n_missing"),
        F.kll_merge_agg_double(F.col("sketch"), k).alias("sketch"))
    whole = F.col("n_missing") == 0
    return merged.select(*keys, "n", *[
        F.when(whole, F.kll_sketch_get_quantile_double("sketch", F.lit(float(s)))).alias(name) for name, s in shares.items()])


def rank_errors(readings: DataFrame, quantiles: DataFrame, column: str, share: float, value: str = "v", keys: list[str] = KEY) -> DataFrame:
    """(keys, n, rank_error): how far ``column`` is from the rank ``share``, by an exact count of ``readings``."""
    v, q = F.col(value), F.col(column)
    joined = readings.select(*keys, value).join(quantiles.select(*keys, column), keys)
    ranks = joined.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(v < q).alias("below"), F.count_if(v <= q).alias("upto"))
    at = F.col("n") * F.lit(float(share))
    off = F.greatest(F.col("below") - at, at - F.col("upto"), F.lit(0.0)) / F.col("n")
    return ranks.select(*keys, "n", off.alias("rank_error"))
