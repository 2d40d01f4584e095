"""Time column functions. Stored times are TIMESTAMP_NTZ holding UTC."""

from pyspark.sql import Column, functions as F

TZONE = "America/Vancouver"


def stamp_seconds(ts: Column) -> Column:
    """Truncate to whole seconds, zone-less."""
    return F.date_trunc("second", ts).cast("timestamp_ntz")


def micros(ts: Column) -> Column:
    """Microseconds since the epoch of a zone-less UTC time."""
    return F.unix_micros(ts.cast("timestamp"))


def from_micros(us: Column) -> Column:
    return F.timestamp_micros(us).cast("timestamp_ntz")


def seconds_between(later: Column, earlier: Column) -> Column:
    return (micros(later) - micros(earlier)) / F.lit(1e6)


def to_local(ts: Column, zone: str = TZONE) -> Column:
    """UTC time on the wall clock of ``zone``."""
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), ts)


def to_utc(local: Column, zone: str = TZONE) -> Column:
    """Wall-clock time to UTC; NULL for a time the clock change skips."""
    shifted = F.convert_timezone(F.lit(zone), F.lit("UTC"), local)
    return F.when(to_local(shifted, zone) == local, shifted)


def local_date_bounds(
    start: str | Column, end: str | Column, as_of: str, zone: str = TZONE
) -> tuple[Column, Column]:
    """UTC bounds for two calendar dates at the local time of day of ``as_of`` (UTC).

    The upper bound is one hour later. Seconds are added as an interval, since
    rounding may give 60 of them.
    """
    now = to_local(F.lit(as_of).cast("timestamp_ntz"), zone)
    time_of_day = F.make_interval(
        hours=F.hour(now), mins=F.minute(now), secs=F.bround(F.date_part(F.lit("second"), now), 0)
    )
    dates = (F.lit(d).cast("date").cast("timestamp_ntz") for d in (start, end))
    low, high = (to_utc(date + time_of_day, zone) for date in dates)
    return low, high + F.expr("INTERVAL 1 HOUR")


def age_text(ts: Column, as_of: str) -> Column:
    """Age at ``as_of``, to the second, as ``HH:MM:SS ago``; hours may pass 24."""
    age = F.bround(seconds_between(F.lit(as_of).cast("timestamp_ntz"), ts), 0).cast("bigint")
    size = F.abs(age)
    return F.when(age.isNotNull(), F.format_string(
        "%s%02d:%02d:%02d ago",
        F.when(age < 0, "-").otherwise(""),
        F.floor(size / 3600), F.floor(size / 60) % 60, size % 60,
    ))


def clock_text(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss")
