"""From raw lines to checked values: trim, split, parse, check, quarantine."""

from pyspark.sql import DataFrame, functions as F

from breathline.functions import lines as L
from breathline.functions import numbers as N


def channel_counts(lut: DataFrame) -> DataFrame:
    """Channels per device: the arity a line must have."""
    return lut.groupBy("device_id").agg(F.count(F.lit(1)).cast("int").alias("n_channels"))


def most_channels(lut: DataFrame) -> int:
    """The greatest number of channels of a device."""
    return channel_counts(lut).agg(F.max("n_channels")).first()[0] or 0


def classify_lines(raw: DataFrame, lut: DataFrame | None = None) -> DataFrame:
    """Add ``text``, ``values`` and ``reason``; ``reason`` is NULL for an accepted line.

    Without ``lut`` the number of values is not checked. Column functions only, so the
    same code serves batch and stream.
    """
    parsed = (
        raw.withColumn("text", L.trim_line(F.col("line")))
        .withColumn("values", L.parse_line(F.col("text")))
    )
    arity_wrong = F.lit(False)
    if lut is not None:
        parsed = parsed.join(channel_counts(lut), "device_id", "left")
        arity_wrong = F.size("values") != F.coalesce("n_channels", F.lit(-1))
    reason = (
        F.when(F.coalesce(F.length("line"), F.lit(0)) == 0, "empty")
        .when(L.is_comment(F.col("text")), "comment")
        .when(L.has_bad_field(F.col("values")), "not_float")
        .when(arity_wrong, "wrong_arity")
    )
    return parsed.withColumn("reason", reason).drop("n_channels")


def accepted(classified: DataFrame, strict: bool = False) -> DataFrame:
    """Lines that parsed. ``strict`` fails the job on a malformed number instead of skipping it."""
    if strict:
        complaint = F.concat(F.lit("not a number in line: "), F.col("text"))
        classified = classified.withColumn("reason", F.when(
            F.col("reason") == "not_float", F.raise_error(complaint).cast("string")
        ).otherwise(F.col("reason")))
    return classified.filter(F.col("reason").isNull()).drop("reason")


def quarantined(classified: DataFrame) -> DataFrame:
    """Lines that were rejected, with the reason."""
    return classified.filter(F.col("reason").isNotNull()).drop("values", "text")


def wide_to_long(wide: DataFrame, lut: DataFrame, value: str = "v", mask: bool = False) -> DataFrame:
    """One row per channel, channel position replaced by the sensor id.

    ``mask`` turns values outside the valid range into NULL; by default they pass.
    """
    # The outer form spares a second parse: for the inner one Catalyst infers a filter
    # on the array's size and pushes it, parsing included, below the projection.
    long = wide.select(
        *[c for c in wide.columns if c not in ("values", "text", "line")],
        F.posexplode_outer("values").alias("channel", value),
    )
    if mask:
        long = long.withColumn(value, N.mask_range(F.col(value)))
    return join_lut(long, lut)


def join_lut(long: DataFrame, lut: DataFrame) -> DataFrame:
    """Channel position to sensor id. The look-up is a file; Catalyst broadcasts it by its size."""
    return long.join(lut, ["device_id", "channel"])
