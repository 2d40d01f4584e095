"""The text feed as a table and a stream: byte ranges, ids, restarts."""

import io
import os
import random

import pytest
from pyspark.sql import functions as F

from breathline.operators import ingest
from breathline.session import scratch
from breathline.sources import feed, lines as line_source


def write(root, device, name, data, seconds=1_700_000_000):
    folder = f"{root}/device_id={device}"
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "wb") as file:
        file.write(data)
    os.utime(f"{folder}/{name}", (seconds, seconds))


def some_text(rng, n):
    return b"".join(rng.choice([b"1.00,2.00,\r\n", b"\n", b"# note\n", "naïve €\n".encode(), b"x" * rng.randrange(90) + b"\n", b"\xff\xfe\n"]) for _ in range(n))


@pytest.mark.parametrize("last", [b"", b"tail without an end", b"\n\n"])
@pytest.mark.parametrize("split,block", [(1, 1), (7, 3), (64, 10), (100, 1 << 20)])
def test_every_line_is_read_once_whatever_the_cuts(split, block, last):
    data = some_text(random.Random(split), 40) + last
    expected, at = [], 0
    for line in data.split(b"\n"):
        expected.append((at, line))
        at += len(line) + 1
    if not expected[-1][1]:
        expected.pop()
    got = []
    for start in range(0, len(data), split):
        for starts, lines in feed.lines_of(io.BytesIO(data), start, min(start + split, len(data)), block):
            got += zip(starts.tolist(), lines, strict=True)
    assert got == expected


def rows(df):
    return [tuple(r) for r in df.orderBy("device_id", "line_id").select("device_id", "line").collect()]


def test_equals_whole_file_reading_and_ids_are_distinct(spark):
    rng, root = random.Random(5), scratch(spark, "feed")
    for device in ("a", "b c", "hot"):
        for i in range(3):  # files of one device with one time
            write(root, device, f"part-{i}", some_text(rng, 30))
    write(root, "a", "_partial", b"not yet\n")
    write(root, "a", "empty", b"")
    table = feed.scan_text_feed(spark, root, split_bytes=97)
    assert table.rdd.getNumPartitions() > 9
    assert table.schema == line_source.RAW_LINE and table.select("line_id").distinct().count() == table.count()
    whole = line_source.scan_text_lines(spark, root)
    assert sorted(rows(table)) == sorted(rows(whole))
    assert rows(table) == rows(feed.scan_text_feed(spark, root))
    one = spark.read.text(f"{root}/device_id=hot/part-1", lineSep="\n").filter("value <> ''").collect()
    base = sum(size for _, path, size in feed.feed_files(root) if not path.endswith("device_id=hot/part-2")) - os.path.getsize(f"{root}/device_id=hot/part-1")
    mine = table.filter((F.col("device_id") == "hot") & (F.col("line_id") >= base)).orderBy("line_id").limit(len(one)).collect()
    assert [r["line"] for r in mine] == [r["value"] for r in one]


def test_stream_restarts_without_loss_or_repeat(spark):
    rng, root, out = random.Random(6), scratch(spark, "feed"), scratch(spark, "fed")
    for round_ in range(3):
        for device in ("a", "b"):
            write(root, device, f"f{round_}", some_text(rng, 25), 1_700_000_000 + round_)
            write(root, device, f"g{round_}", some_text(rng, 25), 1_700_000_000 + round_)
        (
            feed.scan_text_feed(spark, root, streaming=True, split_bytes=200).writeStream.format("parquet")
            .option("checkpointLocation", f"{out}/checkpoint").trigger(availableNow=True).start(f"{out}/rows").awaitTermination()
        )
    got, table = spark.read.parquet(f"{out}/rows"), feed.scan_text_feed(spark, root)
    columns = ["device_id", "line_id", "arrival_ts", "line"]
    assert sorted(map(tuple, got.select(columns).collect())) == sorted(map(tuple, table.select(columns).collect()))
    lut = spark.createDataFrame([("a", 0, 0), ("a", 1, 1), ("b", 0, 0), ("b", 1, 1)], "device_id string, channel int, sensor_id int")
    assert ingest.accepted(ingest.classify_lines(got, lut)).count() > 0


def test_a_stream_refuses_a_changed_feed(tmp_path):
    stream = feed.FeedStream(str(tmp_path), 100, 0)
    assert stream.latestOffset() == stream.initialOffset()
    write(tmp_path, "a", "f", b"1,\n2,\n")
    end = stream.latestOffset()
    assert len(stream.partitions(stream.initialOffset(), end)) == 1 and stream.partitions(end, end) == []
    write(tmp_path, "a", "f", b"1,\n2,\n3,\n")
    with pytest.raises(ValueError, match="changed"):
        stream.partitions(stream.initialOffset(), end)
