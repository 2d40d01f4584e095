"""Exact quantiles of groups with any number of different values.

``F.median`` keeps every different value of a group in one task. Here a group is narrowed
down by distribution: splits of its values (a mergeable sketch, partial before the shuffle),
exact counts of the stretches between them, and then only the stretches that hold the wanted
ranks. The counts decide, so an inexact split costs a round, never a wrong rank.
"""

from pyspark.sql import Column, DataFrame, Window, functions as F

from breathline.functions.numbers import is_missing
from breathline.plans.sizing import broadcast_if_small
from breathline.session import frozen

SPLITS = 128
ACCURACY = 2_048
SETTLE = 65_536


def narrowed(rows: DataFrame, ranks: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows (``g``, ``v``, weight ``w``) of the stretches that hold a group's ranks ``k1`` and
    ``k2``, one row per different value, and the ranks within them."""
    shares = F.array(*[F.lit(i / SPLITS) for i in range(1, SPLITS)])
    splits = broadcast_if_small(frozen(
        rows.groupBy("g").agg(F.array_distinct(F.percentile_approx("v", shares, ACCURACY)).alias("splits"))))
    stretch = F.size(F.filter("splits", lambda s: s <= F.col("v")))
    placed = rows.join(splits, "g").withColumn("stretch", stretch).drop("splits")
    counts = placed.groupBy("g", "stretch").agg(F.sum("w").alias("held"))
    # a row per stretch, at most SPLITS in a group
    before = F.sum("held").over(Window.partitionBy("g").orderBy("stretch")) - F.col("held")

    def holds(k: str) -> Column:
        return (F.col(k) > F.col("before")) & (F.col(k) <= F.col("before") + F.col("held"))

    kept = frozen(counts.withColumn("before", before).join(ranks, "g").filter(holds("k1") | holds("k2")))
    left = placed.join(broadcast_if_small(kept.select("g", "stretch")), ["g", "stretch"], "left_semi")
    # between the stretches of the two ranks there are only empty ones
    inside = kept.groupBy("g").agg(*[(F.min(k) - F.min("before")).alias(k) for k in ("k1", "k2")])
    return frozen(left.groupBy("g", "v").agg(F.sum("w").alias("w"))), inside


def exact_quantile(
    rows: DataFrame, keys: list[str], value: str, share: float = 0.5, settle: int = SETTLE, name: str = "quantile",
) -> DataFrame:
    """(keys, ``name``, n) with the interpolated quantile of ``value``, equal to ``F.percentile``.

    A group with a missing value has a NULL quantile, as in publishing; ``n`` counts all its
    rows. NULL keys form groups, repeated values shrink to one row each, an empty table gives
    an empty result. No task holds more of a group than ``settle`` different values. Every
    round but the first reads only what the one before left, about 1/64 of a group.
    """
    if not 0 <= share <= 1 or settle < 2:
        raise ValueError("share must be between 0 and 1, settle at least 2")
    # as a struct, NULL keys compare equal; -0.0 counts as 0.0, so that grouping and order agree
    packed = rows.select(
        F.struct(*keys).alias("g"), (F.col(value).cast("double") + F.lit(0.0)).alias("v"), F.lit(1).cast("bigint").alias("w"))
    sizes = frozen(packed.groupBy("g").agg(F.count(F.lit(1)).alias("n"), F.bool_or(is_missing(F.col("v"))).alias("missing")))
    at = (F.col("n") - 1) * F.lit(float(share))
    ranks = frozen(sizes.filter(~F.col("missing")).select("g", (F.floor(at) + 1).alias("k1"), (F.ceil(at) + 1).alias("k2")))
    left = packed.join(broadcast_if_small(ranks.select("g")), "g", "left_semi")
    left, ranks = narrowed(left, ranks)
    while (left.groupBy("g").count().agg(F.max("count")).first()[0] or 0) > settle:
        left, ranks = narrowed(left, ranks)
    upto = F.sum("w").over(Window.partitionBy("g").orderBy("v"))
    found = left.withColumn("upto", upto).join(ranks, "g").groupBy("g").agg(*[
        F.min(F.when(F.col("upto") >= F.col(k), F.col("v"))).alias(end) for k, end in (("k1", "low"), ("k2", "high"))])
    part = at - F.floor(at)
    between = F.when(F.col("low") == F.col("high"), F.col("low")).otherwise(
        (F.lit(1.0) - part) * F.col("low") + part * F.col("high"))
    return sizes.join(found, "g", "left").select("g.*", between.alias(name), "n")
