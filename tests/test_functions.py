"""Hand-computed cases for the column functions."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from breathline.functions import lines as L
from breathline.functions import numbers as N
from breathline.functions import times as T

NAN = float("nan")


@pytest.mark.parametrize("text, value", [
    ("1.5", 1.5), ("1_000", 1000.0), (" 7 ", 7.0), ("+3", 3.0), ("-.5e2", -50.0), ("5.", 5.0), ("1e400", math.inf),
    ("inf", math.inf), ("-Infinity", -math.inf), ("1d", None), ("1f", None), ("1__0", None), ("_1", None),
    ("1_", None), (".", None), (" ", None), ("0x10", None), ("x1", None), ("1 2", None), ("--1", None),
])
def test_parse_number(one, text, value):
    assert one(t=text)(N.parse_number(F.col("t"))) == (value,)


@pytest.mark.parametrize("text", ["nan", "NaN", "+nan", " -nan "])
def test_parse_nan(one, text):
    assert math.isnan(one(t=text)(N.parse_number(F.col("t")))[0])


@pytest.mark.parametrize("text, values", [
    ("1,,2", [1.0, 2.0]), (",,", []), ("1,x,3", [1.0, None, 3.0]), ("1,2d", [1.0, None]), ("1e2,-3.,.5", [100.0, -3.0, 0.5]),
    ("1..2,3", [None, 3.0]), ("e5,+-1", [None, None]), ("1_0, 2", [10.0, 2.0]), ("", []),
])
def test_parse_line(one, text, values):
    assert one(t=text)(L.parse_line(F.col("t"))) == (values,)


def test_out_of_range_and_mask(one):
    cases = {299.99: True, 300.0: False, 5000.0: False, 5000.01: True, NAN: False}
    for value, outside in cases.items():
        assert one(v=value)(N.out_of_range(F.col("v"))) == (outside,)
        masked = one(v=value)(N.mask_range(F.col("v")))[0]
        assert (masked is None) == (outside or math.isnan(value))
    assert one("v double", v=None)(N.out_of_range(F.col("v")), N.mask_range(F.col("v"))) == (False, None)


@pytest.mark.parametrize("ppm, tenths, status", [
    (0.25, 2, "ok"), (0.35, 4, "ok"), (6553.5, 65535, "ok"), (6553.6, None, "overflow"), (-0.1, None, "overflow"),
    (1e12, None, "overflow"), (-1250.0, None, "overflow"), (NAN, None, "missing"), (math.inf, None, "overflow"),
])
def test_encode_tenths(one, ppm, tenths, status):
    assert one(p=ppm)(N.encode_tenths(F.col("p")), N.tenths_status(F.col("p") * 10.0)) == (tenths, status)


def test_decode_is_double(one):
    assert one("t int", t=4321)(N.decode_tenths(F.col("t")), F.typeof(N.decode_tenths(F.col("t")))) == (432.1, "double")


def test_calibrate(one):
    assert one(a=0.0)(N.calibrate(F.col("a"))) == (-1250.0,)
    assert one(a=1024.0)(N.calibrate(F.col("a"))) == ((1127 - 400) * 50 / 16,)


def test_round_stat_ignores_summation_noise(one):
    assert one(a=65.4325, b=65.43250000000001, c=65.43249999999999)(
        *[N.round_stat(F.col(c)) for c in "abc"]) == (65.432,) * 3
    assert one(a=65.4335)(N.round_stat(F.col("a"))) == (65.434,)


def test_line_text(one):
    assert one(t="1,2,\r\n")(L.trim_line(F.col("t"))) == ("1,2,",)
    assert one(v=[1.0, 2.345, -3.0])(L.encode_line(F.col("v"))) == ("1.00,2.35,-3.00,",)
    assert one(e=1.5, t="7,")(L.log_line(F.col("e"), F.col("t"))) == ("1.500000,7,",)


def test_label(one):
    row = one(s=3, d="dev", p=430.5, t="2024-01-01 00:00:07")
    assert row(L.last_point_label(*[F.col(c) for c in "sdpt"])) == ("3@dev, 430 PPM\n2024-01-01 00:00:07",)


def test_stamp_keeps_no_zone(one):
    row = one("t timestamp_ntz", t=dt.datetime(2024, 1, 1, 5, 6, 7, 999999))
    assert row(T.stamp_seconds(F.col("t")), F.typeof(T.stamp_seconds(F.col("t")))) == (
        dt.datetime(2024, 1, 1, 5, 6, 7), "timestamp_ntz")


@pytest.mark.parametrize("local, utc", [
    ("2020-01-15 12:00:00", "2020-01-15 20:00:00"),
    ("2020-03-08 02:30:00", None),                       # skipped by the clock change
    ("2020-11-01 01:30:00", "2020-11-01 08:30:00"),      # twice: the earlier one
    ("2020-07-01 00:00:00", "2020-07-01 07:00:00"),
])
def test_local_to_utc(one, local, utc):
    row = one("t timestamp_ntz", t=dt.datetime.fromisoformat(local))
    assert row(T.to_utc(F.col("t"))) == (utc and dt.datetime.fromisoformat(utc),)


def test_date_bounds(one):
    low, high = one(x=1)(*T.local_date_bounds("2024-01-10", "2024-01-12", "2024-01-30 20:15:30"))
    assert (low, high) == (dt.datetime(2024, 1, 10, 20, 15, 30), dt.datetime(2024, 1, 12, 21, 15, 30))
    low, _ = one(x=1)(*T.local_date_bounds("2024-01-10", "2024-01-12", "2024-01-30 20:15:59.7"))
    assert low == dt.datetime(2024, 1, 10, 20, 16, 0)    # sixty seconds
    low, high = one(x=1)(*T.local_date_bounds("2020-03-08", "2020-03-09", "2024-01-30 10:30:00"))
    assert (low, high) == (None, dt.datetime(2020, 3, 9, 10, 30))


@pytest.mark.parametrize("at, text", [
    ("2024-01-30 23:59:59", "00:00:01 ago"), ("2024-01-26 00:00:00", "120:00:00 ago"),
    ("2024-01-31 00:01:05", "-00:01:05 ago"),
])
def test_age(one, at, text):
    row = one("t timestamp_ntz", t=dt.datetime.fromisoformat(at))
    assert row(T.age_text(F.col("t"), "2024-01-31 00:00:00")) == (text,)
