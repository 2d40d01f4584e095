"""Streams against a plain model or their batch form, with restarts in between."""

import datetime as dt
import os
import random
import statistics

from pyspark.sql import functions as F

from breathline.operators import enrich, filters, ingest, publish, summary
from breathline.schema import LUT, RANGES, RAW_LINE, READING
from breathline.session import scratch
from breathline.sinks import lines as line_sink
from breathline.sources import lines as line_source
from breathline.streaming import publish as live
from breathline.streaming import store, views

T0 = dt.datetime(2024, 1, 1)
LINES = "device_id string, line_id bigint, arrival_ts timestamp_ntz, values array<double>"


def drain(stream, out, mode="append"):
    (
        stream.writeStream.format("parquet").outputMode(mode).option("checkpointLocation", f"{out}/checkpoint")
        .trigger(availableNow=True).start(f"{out}/rows").awaitTermination()
    )


def push(lines, root, **options):
    """Drain a stream of accepted lines through the carry sink; what it published so far."""
    sink = live.carry_sink(root, live.to_folder(f"{root}/rows"), **options)
    store.start_store(lines, sink, f"{root}/checkpoint", availableNow=True).awaitTermination()
    return lines.sparkSession.read.parquet(f"{root}/rows")


def push_model(lines, period, least):
    """The publishing loop over one device's (seconds, values)."""
    last_push, buffer, out = lines[0][0], [], []
    for t, values in lines:
        buffer.append(values)
        if t - last_push >= period:
            last_push = t
            if len(buffer) >= least:
                out.append((t, [statistics.median(v * 10 for v in channel) for channel in zip(*buffer)], len(buffer)))
                buffer = []
    return out


def test_carry_stream_matches_loop_over_restarts(spark):
    rng = random.Random(3)
    lines, rows, line_id = {}, [], 0
    for device, n in (("hot", 200), ("b", 40), ("c", 1)):
        t = 0.0
        for _ in range(n):
            t += rng.choice([0.5, 1, 4, 9, 10, 25])
            values = [rng.randrange(60000) / 100 for _ in range(2)]
            lines.setdefault(device, []).append((t, values))
            rows.append((device, line_id, T0 + dt.timedelta(seconds=t), values))
            line_id += 1
    rows.sort(key=lambda r: r[2])
    feed, out = scratch(spark, "lines"), scratch(spark, "pushes")
    for start in range(0, len(rows), 70):
        spark.createDataFrame(rows[start:start + 70], LINES).write.mode("append").parquet(feed)
        rows_so_far = push(spark.readStream.schema(LINES).parquet(feed), out)
    got = {}
    for r in rows_so_far.collect():
        got[r.device_id, r.T, r.channel] = (round(r.tenths, 6), r.n)
    want = {}
    for device, series in lines.items():
        for t, medians, n in push_model(series, 10, 3):
            for channel, m in enumerate(medians):
                want[device, T0 + dt.timedelta(seconds=int(t)), channel] = (round(m, 6), n)
    assert got == want


def test_carry_stream_keeps_missing_channel_missing(spark):
    rows = [("a", i, T0 + dt.timedelta(seconds=5 * i), [1.0, float("nan") if i == 1 else 2.0]) for i in range(3)]
    feed, out = scratch(spark, "lines"), scratch(spark, "pushes")
    spark.createDataFrame(rows, LINES).write.parquet(feed)
    got = {r.channel: (r.tenths, r.n) for r in push(spark.readStream.schema(LINES).parquet(feed), out).collect()}
    assert got == {0: (10.0, 3), 1: (None, 3)}


def test_carry_stream_starts_anew_when_channels_change(spark):
    feed, out = scratch(spark, "lines"), scratch(spark, "pushes")
    parts = [[("a", 0, T0, [1.0, 2.0, 3.0, 4.0]), ("a", 1, T0 + dt.timedelta(seconds=2), [1.0, 2.0, 3.0, 4.0])],
             [("a", i, T0 + dt.timedelta(seconds=4 * i), [float(i), 50.0]) for i in range(2, 5)]]
    for part in parts:
        spark.createDataFrame(part, LINES).write.mode("append").parquet(feed)
        pushed = push(spark.readStream.schema(LINES).parquet(feed), out, min_readings=2)
    assert sorted((r.channel, r.tenths, r.n) for r in pushed.collect()) == [(0, 25.0, 2), (1, 500.0, 2)]


def test_carry_of_a_hot_device_in_many_batches(spark):
    """Nine lines in ten are of one device; any cut into batches gives the same."""
    rng = random.Random(8)
    rows, t = [], 0.0
    for i in range(600):
        t += rng.choice([0.2, 0.7, 3, 12])
        rows.append(("hot" if i % 10 else "cold", i, T0 + dt.timedelta(seconds=t), [float(rng.randrange(300, 900)) for _ in range(3)]))
    results = []
    for size in (600, 97):
        feed, out = scratch(spark, "lines"), scratch(spark, "pushes")
        for start in range(0, len(rows), size):
            spark.createDataFrame(rows[start:start + size], LINES).coalesce(1).write.mode("append").parquet(feed)
            pushed = push(spark.readStream.schema(LINES).option("maxFilesPerTrigger", 1).parquet(feed), out)
        results.append(sorted((r.device_id, r.T, r.channel, r.tenths, r.n) for r in pushed.collect()))
    assert results[0] == results[1] and len({r[0] for r in results[0]}) == 2
    want = push_model([((r[2] - T0).total_seconds(), r[3]) for r in rows if r[0] == "hot"], 10, 3)
    assert [r[4] for r in results[0] if r[0] == "hot" and r[2] == 0] == [n for *_, n in want]


def test_tumbling_stream_equals_batch_for_closed_windows(spark):
    rng = random.Random(5)
    rows = [("a", c := rng.randrange(3), c % 2, T0 + dt.timedelta(seconds=i * 2), rng.randrange(9000) / 10) for i in range(200)]
    schema = "device_id string, channel int, sensor_id int, arrival_ts timestamp_ntz, v double"
    feed, out = scratch(spark, "long"), scratch(spark, "tumbling")
    long = spark.createDataFrame(rows, schema)
    for part in (long.limit(100), long.filter(long.arrival_ts > T0 + dt.timedelta(seconds=198))):
        part.write.mode("append").parquet(feed)
        drain(live.stream_publish_tumbling(spark.readStream.schema(schema).parquet(feed), "0 seconds"), out)
    closed = max(r[3] for r in rows)
    want = {tuple(r) for r in publish.publish_median(long).collect() if r.T <= closed}
    assert {tuple(r) for r in spark.read.parquet(f"{out}/rows").collect()} == want
    assert want


def test_every_tick_refreshes_range_and_ages(spark):
    rng = random.Random(6)
    rows = [("a" if i % 3 else "b", i, T0 + dt.timedelta(minutes=i), i % 2, rng.randrange(9000)) for i in range(90)]
    limits = spark.createDataFrame([(1, 700.0, 600.0, 800.0)], RANGES)
    feed, root, out, checkpoint = (scratch(spark, n) for n in ("readings", "store", "summary", "checkpoint"))
    store.seed_store(spark.createDataFrame([], READING), root)
    for part, clock in ((rows[:50], "2024-01-01 12:00:00"), (rows[50:], "2024-01-03 01:00:00")):
        spark.createDataFrame(part, READING).write.mode("append").parquet(feed)
        stream = spark.readStream.schema(READING).parquet(feed)
        views.start_refresh_summary(stream, limits, root, out, checkpoint, lambda c=clock: c, availableNow=True).awaitTermination()
        so_far = spark.createDataFrame(rows[:rows.index(part[-1]) + 1], READING)
        want = summary.device_summary(enrich.flag_readings(filters.filter_recent_days(so_far, clock), limits), clock)
        got = views.latest_refresh(spark, out)
        assert got.columns == want.columns
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
        assert 0 < got.agg(F.sum("N")).first()[0] <= len(rows)


def test_lines_to_stored_readings(spark):
    """Device lines in, numbered readings out, over a restart."""
    lut = spark.createDataFrame([("a", 0, 3), ("a", 1, 4)], LUT)
    texts = [f"{400 + i}.00,{700 if i != 5 else 9000}.00,\r\n" for i in range(12)]
    texts[2] = "#boot\r\n"
    texts[7] = texts[8] = texts[9] = "409.00,7000.00,\r\n"
    rows = [("a", i, T0 + dt.timedelta(seconds=4 * i), text) for i, text in enumerate(texts)]
    feed, root, checkpoint = (scratch(spark, n) for n in ("feed", "store", "checkpoint"))
    store.seed_store(spark.createDataFrame([("a", 41, T0, 3, 1)], READING), root)
    for part in (rows[:6], rows[6:]):
        spark.createDataFrame(part, RAW_LINE).write.mode("append").parquet(feed)
        raw = line_source.scan_raw_lines(spark, feed, streaming=True, files_per_batch=1000)
        lines = ingest.accepted(ingest.classify_lines(raw, lut))
        sink = live.carry_sink(root, store.publish_sink(root, lut))
        store.start_store(lines, sink, checkpoint, availableNow=True).awaitTermination()
    got = sorted((r.id, (r["T"] - T0).seconds, r.SENSOR, r.PPM_10X) for r in store.stored_rows(spark, root).collect())
    # Pushes at 12 s (lines 0, 1, 3), 24 s (4, 5, 6), 36 s (7, 8, 9), the last above the column's range.
    assert got[1:] == [(42, 12, 3, 4010), (43, 12, 4, 7000), (44, 24, 3, 4050), (45, 24, 4, 7000), (46, 36, 3, 4090)]
    assert [(r.sensor_id, r.tenths, r.reason) for r in store.rejected_rows(spark, root).collect()] == [(4, 70000.0, "overflow")]


def test_text_lines_as_table_stream_and_log(spark):
    rows = [("a", 0, T0, "1,2,\r\n"), ("b", 1, T0 + dt.timedelta(microseconds=5), "3,\r\n"), ("a", 2, T0, "")]
    raw = spark.createDataFrame(rows, RAW_LINE)
    path, log, out = (scratch(spark, n) for n in ("text", "log", "out"))
    trimmed = ingest.classify_lines(raw)
    line_sink.write_lines(trimmed.select("device_id", trimmed.text.alias("line")), path)
    want = [("a", "1,2,"), ("b", "3,")]
    table = line_source.scan_text_lines(spark, path)
    assert table.columns == RAW_LINE.fieldNames()
    assert sorted((r.device_id, r.line) for r in table.collect()) == want
    drain(line_source.scan_text_lines(spark, path, streaming=True), out)
    assert sorted(map(tuple, spark.read.parquet(f"{out}/rows").select(table.columns).collect())) == sorted(map(tuple, table.collect()))
    line_sink.write_lines(line_sink.log_lines(ingest.accepted(trimmed)), log)
    got = line_source.scan_recorded_log(spark, log)
    assert got.columns == RAW_LINE.fieldNames()
    assert sorted((r.device_id, r.line_id, r.arrival_ts, r.line) for r in got.collect()) == [
        ("a", 1, T0, "1,2,"), ("b", 1, T0 + dt.timedelta(microseconds=5), "3,")]


def test_text_files_to_stored_readings(spark):
    """A feed of text files, stamped as they come, is published and stored."""
    lut = spark.createDataFrame([("a", 0, 3)], LUT)
    folder, root, checkpoint = (scratch(spark, n) for n in ("text", "store", "checkpoint"))
    feed = f"{folder}/device_id=a"
    store.seed_store(spark.createDataFrame([], READING), root)
    os.makedirs(feed)
    for number in range(4):
        path = f"{feed}/{number}.txt"
        with open(path, "w") as out:
            out.write("".join(f"{400 + 10 * number + i}.00,\r\n" for i in range(3)))
        at = (T0 + dt.timedelta(seconds=12 * number)).replace(tzinfo=dt.timezone.utc).timestamp()
        os.utime(path, (at, at))
        raw = line_source.scan_text_lines(spark, folder, streaming=True)
        lines = ingest.accepted(ingest.classify_lines(raw, lut))
        assert [f.name for f in raw.schema] == RAW_LINE.fieldNames()
        seen = line_source.scan_text_lines(spark, folder).orderBy("line_id").collect()
        assert len({r.line_id for r in seen}) == len(seen) and [r.arrival_ts for r in seen] == sorted(r.arrival_ts for r in seen)
        assert [float(r.line.split(",")[0]) for r in seen] == sorted(float(r.line.split(",")[0]) for r in seen)
        sink = live.carry_sink(root, store.publish_sink(root, lut))
        store.start_store(lines, sink, checkpoint, availableNow=True).awaitTermination()
    got = sorted((r.id, (r["T"] - T0).seconds, r.SENSOR, r.PPM_10X) for r in store.stored_rows(spark, root).collect())
    # a push takes the first line of a file, and the lines since the last push
    assert got == [(1, 12, 3, 4015), (2, 24, 3, 4120), (3, 36, 3, 4220)]


def test_live_flags_keep_unmatched_readings(spark):
    limits = spark.createDataFrame([(1, 700.0, 600.0, 800.0)], RANGES)
    feed, out = scratch(spark, "readings"), scratch(spark, "flags")
    spark.createDataFrame([("a", 1, T0, 1, 5000), ("a", 2, T0, 7, 5000)], READING).write.parquet(feed)
    drain(enrich.flag_readings(spark.readStream.schema(READING).parquet(feed), limits), out)
    got = {r.id: (r.set, r.in_range) for r in spark.read.parquet(f"{out}/rows").collect()}
    assert got == {1: (700.0, False), 2: (None, True)}


def test_carry_counts_lines_that_share_a_number_once(spark):
    """Two files of one time may repeat line numbers; each line still counts as itself."""
    rows = [("a", number, T0 + dt.timedelta(seconds=5 * i), [float(i)]) for i, number in enumerate([7, 7, 8])]
    feed, out = scratch(spark, "lines"), scratch(spark, "pushes")
    spark.createDataFrame(rows, LINES).write.parquet(feed)
    assert [(r.tenths, r.n) for r in push(spark.readStream.schema(LINES).parquet(feed), out).collect()] == [(10.0, 3)]
