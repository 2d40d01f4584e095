"""No reading is lost: published, short, late, untimed and still open ones make up the input."""

import datetime as dt
import random
import statistics

from pyspark.sql import functions as F

from breathline.session import scratch, streaming_session
from breathline.streaming import late, live

T0 = dt.datetime(2024, 1, 1)
LONG = "device_id string, line_id long, arrival_ts timestamp_ntz, channel int, sensor_id int, v double"


def drain(spark, feed, out, delay="30 seconds"):
    rows = spark.readStream.schema(LONG).parquet(feed)
    (
        late.stream_publish_accounted(rows, delay, 10, 3).writeStream.format("parquet")
        .option("checkpointLocation", f"{out}/checkpoint").trigger(availableNow=True).start(f"{out}/rows").awaitTermination()
    )


def loop(parts, delay=30, period=10, least=3):
    """(published and short windows, late line ids, readings of open windows)."""
    newest, windows, gone = None, {}, []
    for part in parts:
        mark = newest and newest - dt.timedelta(seconds=delay)
        for device, line_id, at, channel, sensor, v in part:
            if at is None:
                continue
            end = T0 + dt.timedelta(seconds=((at - T0).total_seconds() // period + 1) * period)
            if mark and end <= mark:
                gone.append((device, channel, line_id))
            else:
                windows.setdefault((device, channel, sensor, end), []).append(v)
        newest = max([r[2] for r in part if r[2]] + [newest or T0])
    closed = {k: vs for k, vs in windows.items() if k[3] <= newest - dt.timedelta(seconds=delay)}
    figures = {
        (*k, "published" if len(vs) >= least else "short", len(vs)):
            None if len(vs) < least or None in vs else round(statistics.median(v * 10.0 for v in vs), 6)
        for k, vs in closed.items()}
    return figures, sorted(gone), sum(map(len, windows.values())) - sum(map(len, closed.values()))


def test_disorder_over_restarts(spark):
    rng, parts, t = random.Random(4), [], 0.0
    for part in range(4):
        rows = []
        for i in range(150):
            t += rng.choice([0.1, 1, 1, 2, 3])
            back = rng.choice([0, 0, 0, 5, 25, 60, 300])
            at = None if i == 70 else T0 + dt.timedelta(seconds=max(0.0, round(t - back, 1)))
            for c in range(2):
                v = None if i % 50 == 49 and c else float(rng.choice([400, 401, 999]))
                rows.append((rng.choice(["hot", "hot", "b"]), part * 1000 + i, at, c, c + 1, v))
        parts.append(rows)
    session = live.with_state_store(streaming_session(spark, 3))
    feed, out = scratch(spark, "late-feed"), scratch(spark, "late-out")
    for rows in parts:
        spark.createDataFrame(rows, LONG).repartition(2).write.mode("append").parquet(feed)
        drain(session, feed, out)
    got = spark.read.parquet(f"{out}/rows").collect()
    figures, gone, still_open = loop(parts)
    windows = {(r["device_id"], r["channel"], r["sensor_id"], r["T"], r["status"], r["n"]): r["tenths"] and round(r["tenths"], 6)
               for r in got if r["status"] in ("published", "short")}
    assert windows == figures and any(k[4] == "short" for k in figures) and None in figures.values()
    assert sorted((r["device_id"], r["channel"], r["line_id"]) for r in got if r["status"] == "late") == gone and len(gone) > 20
    assert sum(r["n"] for r in got if r["status"] == "untimed") == 8
    assert sum(r["n"] for r in got) + still_open == sum(map(len, parts))
    assert all(r["line_id"] is not None and r["arrival_ts"] is not None for r in got if r["status"] == "late")


def test_empty_feed(spark):
    session = live.with_state_store(streaming_session(spark, 2))
    feed, out = scratch(spark, "late-feed"), scratch(spark, "late-out")
    spark.createDataFrame([], LONG).write.parquet(feed)
    drain(session, feed, out)
    assert spark.read.schema("status string").parquet(f"{out}/rows").filter(F.col("status").isNotNull()).count() == 0
