"""Publishing: the median of a period's readings per channel, in tenths of ppm."""

from pyspark.sql import Column, DataFrame, functions as F

from breathline.functions import numbers as N
from breathline.functions import times as T
from breathline.plans.chunks import with_lags, with_states
from breathline.session import frozen

PERIOD_S = 10
MIN_READINGS = 3
# A reading is known by the position of its channel; two channels may share a sensor.
CHANNEL = ["device_id", "channel", "sensor_id"]


def median_tenths(value: str = "v") -> Column:
    """Unrounded median of ``value`` x 10; NULL if any value of the group is missing.

    The device prints two decimals of a mean of 32 ten-bit samples, so a sensor has at
    most 32,737 different values and the exact median's value counts stay small.
    """
    v = F.col(value)
    return F.when(~F.bool_or(N.is_missing(v)), F.median(v * F.lit(10.0)))


def publish_median(
    long: DataFrame, period_s: int = PERIOD_S, min_readings: int = MIN_READINGS,
    time: str = "arrival_ts", value: str = "v", keys: list[str] = CHANNEL,
) -> DataFrame:
    """Per channel and epoch-aligned period with enough readings: end of period, median, count.

    Every accepted line has one value per channel, so a channel's count is that of its lines.
    """
    return publish_windows(long.groupBy(*keys, F.window(time, f"{period_s} seconds")), value, min_readings, keys)


def publish_windows(
    grouped, value: str = "v", min_readings: int = MIN_READINGS, keys: list[str] = CHANNEL
) -> DataFrame:
    """The aggregate of ``publish_median`` over groups of ``keys`` and a ``window``."""
    return (
        grouped.agg(median_tenths(value).alias("tenths"), F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") >= min_readings)
        .select(*keys, F.col("window.end").cast("timestamp_ntz").alias("T"), "tenths", "n")
    )


def drop_missing_sensor(published: DataFrame) -> DataFrame:
    """No row for a sensor whose median is missing."""
    return published.filter(~N.is_missing(F.col("tenths")))


def encode_published(published: DataFrame) -> DataFrame:
    """Rows ready to be stored: half-even tenths within the column's range."""
    whole = N.storable(N.round_tenths(F.col("tenths")))
    return (
        published.withColumn("PPM_10X", whole).filter(F.col("PPM_10X").isNotNull())
        .withColumn("SENSOR", F.col("sensor_id").cast("int")).drop("tenths", "sensor_id")
    )


def rejected_published(published: DataFrame) -> DataFrame:
    """Published values that cannot be stored, with the reason."""
    return published.withColumn("reason", N.tenths_status(F.col("tenths"))).filter(F.col("reason") != "ok")


def tick_number(lines: DataFrame, period_s: int, time: str) -> DataFrame:
    """Add ``tick``, the number of the epoch-aligned period a row falls in."""
    us = lines.withColumn("_us", T.micros(F.col(time)))
    return us.withColumn("tick", F.expr(f"_us div {period_s * 1_000_000}L")).drop("_us")


def carry_ticks(
    lines: DataFrame, period_s: int = PERIOD_S, min_readings: int = MIN_READINGS,
    time: str = "arrival_ts", width: int | None = None,
) -> DataFrame:
    """``device_id, tick, close_tick``: the period in which each non-empty period is published.

    A period with too few readings is kept and joins the next one. Empty periods change
    nothing, so only non-empty ones are visited. The state is the number of readings
    carried so far; readings are counted per line, since all channels share a line.
    Periods still waiting at the end are left out.
    """
    sizes = {} if width is None else {"width": width}
    full = min_readings
    ticks = (
        tick_number(lines, period_s, time).groupBy("device_id", "tick")
        .agg(F.least(F.count(F.lit(1)), F.lit(full)).cast("int").alias("n"))
    )
    # Fewer than ``full`` periods can wait for one, as each holds a reading at least.
    lags = [f"lag_{k}" for k in range(1, full)]
    # One row per non-empty period, kept, as every step below reads it again.
    lagged = frozen(with_lags(ticks, ["device_id"], "tick", F.struct("tick", "n"), n=full - 1, **sizes))

    # Nothing waits after a full period, so a full one that follows it stands alone and
    # only the stretches with short ones have to be folded.
    fresh = F.col("lag_1").isNull() | (F.col("lag_1.n") >= full)
    alone = lagged.filter(fresh & (F.col("n") >= full)).select(
        "device_id", F.col("tick").alias("close_tick"), "tick"
    )
    restart = F.lit(full + 1)

    def carried(waiting: Column, code: Column) -> Column:
        total = F.when(code >= restart, code - restart).otherwise(waiting + code)
        return F.when(total >= full, F.lit(0)).otherwise(total)

    stretches = lagged.filter(~(fresh & (F.col("n") >= full)))
    coded = stretches.withColumn("_code", F.when(fresh, restart).otherwise(0) + F.col("n"))
    states = with_states(coded, ["device_id"], "tick", "_code", full, carried, carry=lags, **sizes)
    started = F.col("_code") >= restart
    closing = states.filter(~started & (F.col("state") + F.col("_code") >= full))
    # Walk back until the waiting readings are accounted for.
    members, missing = [F.col("tick")], F.col("state")
    for lag in lags:
        members.append(F.when(missing > 0, F.col(f"{lag}.tick")))
        missing = missing - F.coalesce(f"{lag}.n", F.lit(0))
    joined = closing.select(
        "device_id", F.col("tick").alias("close_tick"), F.explode(F.array(*members)).alias("tick")
    ).filter(F.col("tick").isNotNull())
    return alone.unionByName(joined)


def publish_median_carry(
    lines: DataFrame, long: DataFrame, period_s: int = PERIOD_S, min_readings: int = MIN_READINGS,
    time: str = "arrival_ts", value: str = "v", width: int | None = None,
) -> DataFrame:
    """Like ``publish_median``, but short periods are carried into the next one.

    ``lines`` are the accepted lines, ``long`` the readings made from them.
    """
    closing = carry_ticks(lines, period_s, min_readings, time, width)
    joined = tick_number(long, period_s, time).join(closing, ["device_id", "tick"])
    return (
        joined.groupBy(*CHANNEL, "close_tick")
        .agg(median_tenths(value).alias("tenths"), F.count(F.lit(1)).alias("n"))
        .select(
            *CHANNEL,
            T.from_micros((F.col("close_tick") + 1) * F.lit(period_s * 1_000_000)).alias("T"),
            "tenths", "n",
        )
    )
