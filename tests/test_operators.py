"""Small hand-computed tables through the operators."""

import datetime as dt
import math
import statistics

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from breathline.operators import enrich, filters, ingest, publish, reshape, summary, trailing
from breathline.schema import LUT, RANGES, RAW_LINE, READING
from breathline.session import scratch
from breathline.sinks import readings as sink
from breathline.sources import readings as source

T0 = dt.datetime(2024, 1, 1)


def at(seconds):
    return T0 + dt.timedelta(seconds=seconds)


@pytest.fixture
def lut(spark):
    return spark.createDataFrame([("a", c, c + 6) for c in range(3)] + [("b", 0, 1)], LUT)


def raw(spark, *lines, device="a"):
    return spark.createDataFrame([(device, i, at(i), line) for i, line in enumerate(lines)], RAW_LINE)


def test_reasons(spark, lut):
    lines = raw(spark, "1,2,3,\r\n", "", "#1,2,3", "t,1", "1,x,3", "1,2", "1,,2,3", ",,,", "\r\n", "nan,1,2", " 1,2,3", None)
    got = [r.reason for r in ingest.classify_lines(lines, lut).orderBy("line_id").collect()]
    assert got == [None, "empty", "comment", "comment", "not_float", "wrong_arity", None, "wrong_arity",
                   "wrong_arity", None, None, "empty"]


def test_every_line_is_accepted_or_quarantined(spark, lut):
    lines = ingest.classify_lines(raw(spark, "1,2,3", "x", "", "1"), lut)
    assert ingest.accepted(lines).count() + ingest.quarantined(lines).count() == 4


def test_without_lut_any_arity_passes(spark):
    got = ingest.classify_lines(raw(spark, "1", "1,2", "x")).orderBy("line_id").collect()
    assert [r.reason for r in got] == [None, None, "not_float"]


def test_unknown_device_is_wrong_arity(spark, lut):
    got = ingest.classify_lines(raw(spark, "1", device="zz"), lut).first()
    assert got.reason == "wrong_arity"


def test_strict_fails_the_job(spark, lut):
    lines = ingest.classify_lines(raw(spark, "1,2,3", "1,x,3"), lut)
    with pytest.raises(PySparkException, match="not a number"):
        ingest.accepted(lines, strict=True).collect()


def test_wide_to_long_raw_and_masked(spark, lut):
    lines = ingest.accepted(ingest.classify_lines(raw(spark, "299,300,nan"), lut))
    plain = {r.sensor_id: r.v for r in ingest.wide_to_long(lines, lut).collect()}
    assert plain[6] == 299 and plain[7] == 300 and math.isnan(plain[8])
    masked = {r.sensor_id: r.v for r in ingest.wide_to_long(lines, lut, mask=True).collect()}
    assert masked == {6: None, 7: 300.0, 8: None}


def test_oversample_drops_the_open_block(spark):
    rows = [("a", 0, i, i) for i in range(70)]
    samples = spark.createDataFrame(rows, "device_id string, channel int, sample_no bigint, adc int")
    got = reshape.oversample_mean(samples).orderBy("block").collect()
    assert [(r.block, r.mean_adc) for r in got] == [(0, 15.5), (1, 47.5)]


def readings(spark, rows):
    return spark.createDataFrame(rows, READING)


def test_ranges_keep_every_reading_and_multiply(spark):
    rd = enrich.decode_readings(readings(spark, [("a", 1, T0, 1, 7000), ("a", 2, T0, 9, None)]))
    limits = spark.createDataFrame([(1, 700.0, 600.0, 800.0), (1, 430.0, 370.0, 480.0)], RANGES)
    joined = enrich.join_ranges(rd, limits)
    assert sorted((r.id, r.set) for r in joined.filter("id = 1").collect()) == [(1, 430.0), (1, 700.0)]
    assert [(r.id, r.set, r.CO2_ppm) for r in joined.filter("id = 2").collect()] == [(2, None, None)]


@pytest.mark.parametrize("value, low, high, unbounded, null", [
    (600.0, 600.0, 800.0, True, True), (800.0, 600.0, 800.0, True, True), (599.9, 600.0, 800.0, False, False),
    (900.0, 600.0, None, True, None), (500.0, 600.0, None, False, False), (1.0, None, None, True, None),
    (None, 600.0, 800.0, None, None),
])
def test_in_range_bounds(one, value, low, high, unbounded, null):
    row = one("v double, lo double, hi double", v=value, lo=low, hi=high)
    args = [F.col(c) for c in ("v", "lo", "hi")]
    assert row(enrich.in_range(*args), enrich.in_range(*args, "null")) == (unbounded, null)


def test_summary_of_known_values(spark):
    ids, ppm, gaps = [5, 1, 9, 7], [4000, 4100, 4300, 4250], [10, 0, 100, 40]
    rd = readings(spark, [("a", i, at(g), 1, p) for i, p, g in zip(ids, ppm, gaps)])
    got = summary.device_summary(enrich.decode_readings(rd), "2024-01-01 01:00:00").first()
    values = [p / 10 for p in ppm]
    assert (got.min, got.max, got.median, got.N) == (400.0, 430.0, statistics.median(values), 4)
    assert got["mean"] == pytest.approx(statistics.mean(values), rel=1e-14)
    assert got.sd == pytest.approx(statistics.stdev(values), rel=1e-12)
    assert got.avg_sampling_period == pytest.approx(100 / 3)
    assert got.last_point == "00:58:20 ago"


def test_summary_of_one_row_and_of_missing_values(spark):
    rd = readings(spark, [("a", 1, T0, 1, 4000), ("b", 1, T0, 1, 4000), ("b", 2, at(5), 1, None), ("c", 1, T0, 1, None),
                          ("d", 1, T0, 1, 1), ("d", 2, None, 1, 1), ("d", 3, at(9), 1, 1)])
    got = {r.device_id: r for r in summary.device_summary(enrich.decode_readings(rd), "2024-01-02 00:00:00").collect()}
    assert (got["a"].sd, got["a"].avg_sampling_period, got["a"].N) == (None, None, 1)
    for device in "bc":
        assert [got[device][c] for c in ("min", "max", "mean", "sd", "median")] == [None] * 5
    assert (got["b"].N, got["b"].avg_sampling_period) == (2, 5.0)
    assert (got["d"].sd, got["d"].avg_sampling_period) == (0.0, None)


def test_sd_keeps_digits_on_large_values(spark):
    rows = [("a", i, T0, 1, 65535 - i % 2) for i in range(1000)]
    got = summary.device_summary(enrich.decode_readings(readings(spark, rows)), "2024-01-02 00:00:00").first()
    assert got.sd == pytest.approx(statistics.stdev([r[4] for r in rows]) / 10, rel=1e-13)


def test_last_is_by_id_not_by_time(spark):
    rd = enrich.decode_readings(readings(spark, [("a", 2, T0, 1, 10), ("a", 1, at(99), 1, 20)]))
    assert (summary.last_per_key(rd).first().id, summary.first_per_key(rd).first().id) == (2, 1)
    assert summary.device_summary(rd, "2024-01-02 00:00:00").first().last_T == T0


def test_median_of_group_with_nan_is_dropped(spark):
    rows = [("a", 1, at(i), v) for i, v in enumerate([400.0, 500.0, float("nan")])]
    rows += [("a", 2, at(i), v) for i, v in enumerate([400.04, 400.05, 400.06, 400.05])]
    long = spark.createDataFrame(rows, "device_id string, sensor_id int, arrival_ts timestamp_ntz, v double")
    published = publish.publish_median(long.withColumn("channel", F.lit(0)))
    assert published.count() == 2
    stored = publish.encode_published(publish.drop_missing_sensor(published)).collect()
    assert [(r.SENSOR, r.PPM_10X, r.T, r.n) for r in stored] == [(2, 4000, at(10), 4)]
    assert [r.reason for r in publish.rejected_published(published).collect()] == ["missing"]


def test_too_large_a_value_is_rejected_not_clipped(spark):
    rows = [("a", 1, at(i), 6554.0) for i in range(3)]
    long = spark.createDataFrame(rows, "device_id string, sensor_id int, arrival_ts timestamp_ntz, v double")
    published = publish.publish_median(long.withColumn("channel", F.lit(0)))
    assert publish.encode_published(published).count() == 0
    assert publish.rejected_published(published).first().reason == "overflow"


def test_period_needs_three_readings(spark):
    rows = [("a", 1, at(t), 400.0) for t in (0, 1, 10, 11, 12, 20)]
    long = spark.createDataFrame(rows, "device_id string, sensor_id int, arrival_ts timestamp_ntz, v double")
    assert [r.T for r in publish.publish_median(long.withColumn("channel", F.lit(0))).collect()] == [at(20)]


def test_zoom_and_skipped_hour(spark):
    rd = readings(spark, [("a", i, at(i * 3600), 1, 1) for i in range(24)])
    ids = lambda df: sorted(r.id for r in df.collect())
    full = ("2024-01-01 02:00:00", "2024-01-01 05:00:00")
    epoch = (T0 - dt.datetime(1970, 1, 1)).total_seconds()
    assert ids(filters.filter_zoom(rd, *full)) == [2, 3, 4, 5]
    assert ids(filters.filter_zoom(rd, *full, epoch + 7 * 3600, epoch + 8 * 3600)) == [7, 8]
    assert ids(filters.filter_zoom(rd, *full, xmin=epoch + 4 * 3600)) == [4, 5]
    assert filters.filter_local_dates(rd, "2020-03-08", "2030-01-01", "2024-01-30 10:30:00").count() == 0
    assert ids(filters.filter_recent_days(rd, "2024-01-01 06:00:00"))[-1] == 7


def test_union_order_is_irrelevant(spark):
    rd = readings(spark, [("a", 1, T0, 1, 1), ("b", 1, T0, 1, 2)])
    tables = {d: rd.filter(F.col("device_id") == d).drop("device_id") for d in "ab"}
    swapped = dict(reversed(tables.items()))
    assert sorted(source.union_devices(tables).collect()) == sorted(source.union_devices(swapped).collect())


def test_setpoints_of_unseen_and_unlimited_sensors(spark):
    rd = enrich.decode_readings(readings(spark, [("a", 1, T0, 1, 1), ("a", 2, T0, 12, 1)]))
    limits = spark.createDataFrame([(1, 700.0, 600.0, 800.0), (2, 430.0, 370.0, 480.0)], RANGES)
    got = {r.sensor_id: (r.set, r.has_readings) for r in enrich.setpoint_overlay(rd, limits).collect()}
    assert got == {1: (700.0, True), 2: (430.0, False), 12: (None, True)}


def test_constant_channel_suppresses_the_line(spark):
    rows = [("a", 0, at(0), [1.0, 5.0]), ("a", 1, at(1), [2.0, 5.0]), ("a", 2, at(2), [4.0, 6.0])]
    lines = spark.createDataFrame(rows, "device_id string, line_id bigint, arrival_ts timestamp_ntz, values array<double>")
    got = trailing.trailing_minmax_scale(lines, channels=2).orderBy("line_id", "channel").collect()
    assert [(r.line_id, r.channel, r.scaled) for r in got] == [(2, 0, 0.0), (2, 1, 0.0)]


def test_no_channel_is_left_out(spark):
    schema = "device_id string, line_id bigint, arrival_ts timestamp_ntz, values array<double>"
    moving = [("a", i, at(i), [float(i + c) for c in range(6)]) for i in range(3)]
    got = trailing.trailing_minmax_scale(spark.createDataFrame(moving, schema), channels=6)
    assert sorted({r.channel for r in got.collect()}) == list(range(6))
    constant = [(d, i, t, [*v[:5], 7.0]) for d, i, t, v in moving]
    assert trailing.trailing_minmax_scale(spark.createDataFrame(constant, schema), channels=6).count() == 0
    with pytest.raises(Exception, match="more than 5 values in line"):
        trailing.trailing_minmax_scale(spark.createDataFrame(moving, schema), channels=5).collect()


def test_two_channels_of_a_sensor_are_published_each(spark):
    schema = "device_id string, line_id bigint, arrival_ts timestamp_ntz, values array<double>"
    lut = spark.createDataFrame([("a", 0, 1), ("a", 1, 1)], LUT)
    for n, want in ((2, []), (3, [(0, 1, 4000.0, 3), (1, 1, 8000.0, 3)])):
        lines = spark.createDataFrame([("a", i, at(i), [400.0, 800.0]) for i in range(n)], schema)
        long = ingest.wide_to_long(lines, lut)
        for published in (publish.publish_median(long), publish.publish_median_carry(lines, long)):
            assert sorted((r.channel, r.sensor_id, r.tenths, r.n) for r in published.collect()) == want


def test_drawing_order_needs_no_broadcast(spark):
    rows = [("d%d" % (i % 3), i, at(i * 977 % 50_000), i % 4, float(i)) for i in range(3000)]
    df = spark.createDataFrame(rows, "device_id string, id bigint, T timestamp_ntz, sensor_id int, CO2_ppm double").repartition(7)
    kept = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        got = [(r.device_id, r.sensor_id, r["T"], r.id) for r in trailing.series_order(df).collect()]
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)
    assert got == sorted(got) and len(got) == 3000


def test_flagged_stored_readings_have_no_month(spark):
    stored = readings(spark, [("a", 1, T0, 1, 1)]).withColumn("month", F.lit("2024-01"))
    assert "month" not in enrich.flag_readings(stored, spark.createDataFrame([], RANGES)).columns


def test_window_holds_both_ends(spark):
    rows = [("a", i, at(t), 1, float(v)) for i, (t, v) in enumerate([(0, 1), (20, 3), (20.000001, 5)])]
    arrivals = spark.createDataFrame(rows, "device_id string, id bigint, ts timestamp_ntz, sensor_id int, v double")
    got = trailing.trailing_stats(arrivals).orderBy("id").collect()
    assert [(r.n, r["mean"], r.sd) for r in got] == [(1, 1.0, 0.0), (2, 2.0, 1.0), (2, 4.0, 1.0)]


def test_export_name():
    assert sink.export_name("co2", "2024-01-08 00:00:00", "2024-01-09 01:00:00") == (
        "co2_2024-01-08-00-00-00_2024-01-09-01-00-00.csv")


def test_folders_of_devices_take_one_scan(spark):
    root = scratch(spark, "device folders")
    rows = spark.range(30).select(
        F.col("id"), F.lit(T0).cast("timestamp_ntz").alias("T"), F.lit(1).alias("SENSOR"), F.col("id").cast("int").alias("PPM_10X"))
    devices = ["a", "b c", "d+e", "f%g", "device_id=h"]
    for i, device in enumerate(devices):
        rows.filter(F.col("id") % 5 == i).write.parquet(f"{root}/{device}/2024")
    got = source.scan_device_folders(spark, root)
    expected = source.union_devices({d.removeprefix("device_id="): rows.filter(F.col("id") % 5 == i) for i, d in enumerate(devices)})
    assert sorted(map(tuple, got.select(source.COLUMNS).collect())) == sorted(map(tuple, expected.select(source.COLUMNS).collect()))
    assert got._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    one = got.filter("device_id = 'b c'")
    assert one.count() == 6 and source.scan_device_folders(spark, f"file://{root}").count() == 30
