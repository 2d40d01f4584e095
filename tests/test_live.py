"""The exact live view against the batch operators and a plain loop, over restarts."""

import datetime as dt
import random
import statistics

import pytest
from pyspark.sql import functions as F

from breathline.operators import trailing
from breathline.session import scratch, streaming_session
from breathline.streaming import live

T0 = dt.datetime(2024, 1, 1)
LINES = "device_id string, line_id long, arrival_ts timestamp_ntz, values array<double>"


def some_lines(seed, devices=(("hot", 300), ("b", 60), ("c", 4)), channels=3):
    rng, rows, line_id = random.Random(seed), [], 0
    for device, n in devices:
        t = 0.0
        for _ in range(n):
            t += rng.choice([0.2, 0.5, 1, 1, 2, 7, 25, 60])
            rows.append((device, line_id, T0 + dt.timedelta(seconds=t), [float(rng.choice([400, 401, 999]) + c) for c in range(channels)]))
            line_id += 1
    return sorted(rows, key=lambda r: r[2])


def drain(spark, feed, out, **options):
    lines = spark.readStream.schema(LINES).option("maxFilesPerTrigger", 1).parquet(feed)
    (
        live.stream_trailing_rows(lines, **options).writeStream.format("parquet").option("checkpointLocation", f"{out}/checkpoint")
        .trigger(availableNow=True).start(f"{out}/rows").awaitTermination()
    )
    return spark.read.parquet(f"{out}/rows")


def rows_of(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


def loop(lines, window, warmup):
    """A device's buffer: (line_id, channel, latest, mean, sd, n, scaled) of every drawn frame."""
    times, values, out = [], [], []
    for _, line_id, at, vs in lines:
        times.append(at)
        values.append(vs)
        if len(times) < warmup:
            continue
        while (at - times[0]).total_seconds() > window:
            times.pop(0)
            values.pop(0)
        columns = list(zip(*values, strict=True))
        constant = any(min(c) == max(c) for c in columns)
        for i, c in enumerate(columns):
            scaled = None if constant else round(1 - (c[-1] - min(c)) / (max(c) - min(c)), 9)
            out.append((line_id, i, c[-1], round(statistics.fmean(c), 3), round(statistics.pstdev(c), 3), len(c), scaled))
    return out


@pytest.fixture
def streams(spark):
    return live.with_state_store(streaming_session(spark, 2))


@pytest.mark.parametrize("seed,warmup", [(1, 5), (2, 1)])
def test_restarted_stream_equals_loop_and_batch(streams, seed, warmup):
    rows = some_lines(seed)
    feed, out = scratch(streams, "live-feed"), scratch(streams, "live")
    for part in range(4):  # a restart from the checkpoint between any two files
        some = rows[part * len(rows) // 4:(part + 1) * len(rows) // 4]
        streams.createDataFrame(some, LINES).coalesce(1).write.mode("append").parquet(feed)
        got = drain(streams, feed, out, warmup=warmup)
    assert got.filter("late").count() == 0
    mine = rows_of(got.withColumn("scaled", F.round("scaled", 9)), "line_id", "channel", "latest", "mean", "sd", "n", "scaled")
    expected = []
    for device in {r[0] for r in rows}:
        expected += loop([r for r in rows if r[0] == device], 20, warmup)
    assert len(mine) == len(expected)
    for a, b in zip(mine, sorted(expected, key=str), strict=True):
        assert a[:3] + a[5:] == b[:3] + b[5:] and a[3:5] == pytest.approx(b[3:5], abs=1.1e-3)

    lines = streams.createDataFrame(rows, LINES)
    long = lines.select("device_id", F.col("line_id").alias("id"), F.col("arrival_ts").alias("ts"),
                        F.posexplode("values").alias("sensor_id", "v"))
    drawn = trailing.trailing_warmup_gate(lines, warmup=warmup).filter("emitted").select("device_id", F.col("line_id").alias("id"))
    batch = trailing.trailing_stats(long).join(drawn, ["device_id", "id"])
    assert rows_of(got, "device_id", "line_id", "channel", "latest", "mean", "sd", "n") == rows_of(
        batch, "device_id", "id", "sensor_id", "latest", "mean", "sd", "n")
    scaled = trailing.trailing_minmax_scale(lines, 3).join(drawn.withColumnRenamed("id", "line_id"), ["device_id", "line_id"])
    assert rows_of(got.filter("scaled is not null").withColumn("scaled", F.round("scaled", 9)), "line_id", "channel", "scaled") == rows_of(
        scaled.withColumn("scaled", F.round("scaled", 9)), "line_id", "channel", "scaled")


def test_late_lines_are_told_apart(streams):
    rows = some_lines(3, (("a", 40), ("b", 40)))
    late = [r for r in rows[:30] if r[1] % 7 == 0]
    rest = [r for r in rows if r not in late]
    feed, out = scratch(streams, "live-feed"), scratch(streams, "live")
    for some in (rest[:50], late + rest[50:]):
        streams.createDataFrame(some, LINES).coalesce(1).write.mode("append").parquet(feed)
        got = drain(streams, feed, out, warmup=1)
    assert rows_of(got.filter("late"), "line_id") == sorted([(r[1],) for r in late], key=str)
    assert {r["line_id"] for r in got.filter("not late").collect()} == {r[1] for r in rest}
    assert got.filter("late and (latest is not null or n is not null)").count() == 0


def test_other_channels_begin_a_new_buffer():
    buffer = live.Buffer(20_000_000, 2, [], 0)
    assert buffer.add(1, [1.0, 2.0]) is None and len(buffer.add(2, [1.0, 3.0])) == 2
    assert buffer.add(3, [1.0]) is None and buffer.add(4, [5.0]).tolist() == [[1.0], [5.0]]
