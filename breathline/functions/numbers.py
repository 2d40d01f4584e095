"""Numeric column functions: text to number, calibration, fixed-point encoding."""

from pyspark.sql import Column, functions as F

# What a decimal field of a line may look like: underscores between digits are fine,
# a type suffix such as ``1d`` is not (a bare cast would take it).
_DIGITS = r"\d+(?:_\d+)*"
NUMBER = rf"^\s*[+-]?(?:{_DIGITS}\.?(?:{_DIGITS})?|\.{_DIGITS})(?:[eE][+-]?{_DIGITS})?\s*$"
_IGNORED = " \t\n\r\f\v_"
INFINITE = r"(?i)^\s*[+-]?inf(?:inity)?\s*$"
NOT_A_NUMBER = r"(?i)^\s*[+-]?nan\s*$"

# Fixed values of the acquisition board: reference millivolts, ADC steps, zero offset
# in millivolts, ppm per millivolt (numerator, denominator).
AREF = 1127
ADC_STEPS = 1024.0
ZERO_MV = 400.0
PPM_PER_MV = (50.0, 16.0)

# Largest value of an unsigned 16-bit column.
TENTHS_MAX = 65535


def parse_number(text: Column) -> Column:
    """Text to double; NULL when the text is not a number."""
    return (
        F.when(text.rlike(NUMBER), F.translate(text, _IGNORED, "").try_cast("double"))
        .when(text.rlike(INFINITE), F.translate(text, _IGNORED, "").try_cast("double"))
        .when(text.rlike(NOT_A_NUMBER), F.lit(float("nan")))
    )


def is_missing(value: Column) -> Column:
    """NULL or NaN. Spark orders NaN above every number, so it needs its own test."""
    return value.isNull() | F.isnan(value)


def out_of_range(value: Column, low: float = 300.0, high: float = 5000.0) -> Column:
    """True for a value outside ``[low, high]``; a missing value is never out of range."""
    return ~is_missing(value) & ((value < F.lit(low)) | (value > F.lit(high)))


def mask_range(value: Column, low: float = 300.0, high: float = 5000.0) -> Column:
    """The value, or NULL when it is missing or out of range."""
    return F.when(~is_missing(value) & ~out_of_range(value, low, high), value)


def calibrate(mean_adc: Column) -> Column:
    """Mean ADC count to ppm."""
    num, den = PPM_PER_MV
    return (mean_adc * F.lit(AREF / ADC_STEPS) - F.lit(ZERO_MV)) * F.lit(num) / F.lit(den)


def round_tenths(tenths: Column) -> Column:
    """Half-even to a whole number; NULL for NaN or beyond 32 bits."""
    return F.bround(tenths, 0).try_cast("int")


def encode_tenths(ppm: Column) -> Column:
    """ppm to tenths of ppm; NULL when missing or outside 0..65535, never clipped."""
    return storable(round_tenths(ppm * F.lit(10.0)))


def storable(tenths: Column) -> Column:
    return F.when(tenths.between(0, TENTHS_MAX), tenths)


def tenths_status(tenths: Column) -> Column:
    """Why a published value cannot be stored, or ``ok``. Takes unrounded tenths."""
    whole = round_tenths(tenths)
    return (
        F.when(is_missing(tenths), "missing")
        .when(whole.isNull() | ~whole.between(0, TENTHS_MAX), "overflow")
        .otherwise("ok")
    )


def decode_tenths(tenths: Column) -> Column:
    """Tenths of ppm to ppm as double (a decimal literal would give DECIMAL)."""
    return tenths.cast("double") / F.lit(10.0)


def round_stat(value: Column, digits: int = 3) -> Column:
    """Half-even rounding that the order of summation cannot tip.

    A mean of two-decimal values often lies on a tie; the noise of the sum is rounded
    off first, so every plan rounds the tie the same way.
    """
    return F.bround(F.round(value, 9), digits)
