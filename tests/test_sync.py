"""Replication: marks, holes, repeats, ids, and the streaming sink."""

import datetime as dt

import pytest

from breathline.operators import sync
from breathline.schema import READING
from breathline.session import scratch
from breathline.sinks import readings as sink
from breathline.sources import readings as source
from breathline.streaming import store as live

T0 = dt.datetime(2024, 1, 31, 23, 59)


def rows(device, ids):
    return [(device, i, T0 + dt.timedelta(seconds=i), 1, 4000 + i) for i in ids]


def frame(spark, data):
    return spark.createDataFrame(data, READING)


def store(spark, data):
    path = scratch(spark, "store")
    sink.append_readings(frame(spark, data), path)
    return path


def content(spark, path):
    return sorted((r.device_id, r.id) for r in source.scan_readings(spark, path).collect())


def test_sync_twice_is_sync_once_and_holes_stay(spark):
    src = frame(spark, rows("a", range(10)) + rows("new", [0, 1]))
    path = store(spark, rows("a", [0, 2, 5]))
    want = sorted([("a", i) for i in (0, 2, 5, 6, 7, 8, 9)] + [("new", 0), ("new", 1)])
    for _ in range(2):
        sink.sync_incremental(src, path)
        assert content(spark, path) == want


def test_stores_are_synced_by_their_partitions(spark):
    src = store(spark, rows("a", range(0, 200, 5)) + rows("new", [0, 1]) + rows("done", range(4)))
    path = store(spark, rows("a", [0, 10, 95]) + rows("done", range(4)))
    for _ in range(2):
        sink.sync_stores(spark, src, path)
        assert content(spark, path) == sorted(
            [("a", i) for i in (0, 10, *range(95, 200, 5))] + [("new", 0), ("new", 1)] + [("done", i) for i in range(4)])


def test_a_sync_prunes_partitions_and_row_groups(spark):
    src = store(spark, rows("a", range(0, 200, 5)) + rows("b", range(20)))
    path = store(spark, rows("a", [100]) + rows("b", range(20)))
    plan = sink.new_stored_rows(spark, src, path)._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan and "GreaterThan(id,100)" in plan
    marks = sink.partition_marks(spark, src)
    assert "PushedAggregation: [MAX(id)]" in marks._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(tuple, marks.collect())) == [("a", "2024-01", 55), ("a", "2024-02", 195), ("b", "2024-01", 19)]


def test_rows_keep_values_over_months(spark):
    data = rows("a", range(0, 200, 20))
    path = store(spark, data)
    got = source.scan_readings(spark, path)
    assert sorted(map(tuple, got.select(*source.COLUMNS).collect())) == data
    assert {r.month for r in got.collect()} == {"2024-01", "2024-02"}
    kept = source.scan_device_range(got, "a", "2024-02-01 00:00:00", "2024-02-01 00:01:00")
    assert sorted(r.id for r in kept.collect()) == [60, 80, 100, 120]


def test_marks_of_empty_and_missing_devices(spark):
    marks = sync.marks(frame(spark, rows("a", [3]) + rows("b", [0])), frame(spark, rows("a", [2]) + rows("z", [9])))
    assert sorted(map(tuple, marks.collect())) == [("a", 2), ("b", -1)]


def test_mirror_moves_own_out_and_others_in(spark):
    local = store(spark, rows("own", range(5)) + rows("x", [0]))
    central = store(spark, rows("own", [0, 1]) + rows("x", range(3)) + rows("y", [0]))
    sink.mirror(spark, "own", local, central)
    assert content(spark, central) == sorted([("own", i) for i in range(5)] + [("x", i) for i in range(3)] + [("y", 0)])
    assert content(spark, local) == sorted([("own", i) for i in range(5)] + [("x", i) for i in range(3)] + [("y", 0)])


def test_new_ids_follow_the_highest(spark):
    path = store(spark, rows("a", [4, 7]))
    data = [("a", T0, 2, 10, 3), ("a", T0, 1, 11, 3), ("a", T0 - dt.timedelta(days=40), 5, 12, 3), ("b", T0, 1, 13, 3)]
    encoded = spark.createDataFrame(data, "device_id string, T timestamp_ntz, SENSOR int, PPM_10X int, n bigint")
    sink.write_published(encoded, path)
    got = {(r.device_id, r.PPM_10X): r.id for r in source.scan_readings(spark, path).collect() if r.PPM_10X < 100}
    assert got == {("a", 12): 8, ("a", 11): 9, ("a", 10): 10, ("b", 13): 1}


def test_table_is_created_once_and_appended(spark):
    location = scratch(spark, "table")
    for _ in range(2):
        sink.create_table(spark, "readings_test", location)
        sink.append_to_table(frame(spark, rows("a", [1])), "readings_test")
    table = spark.table("readings_test")
    assert table.columns[:4] == ["id", "T", "SENSOR", "PPM_10X"]
    assert table.count() == 2
    spark.sql("DROP TABLE readings_test")


def test_export_does_not_overwrite(spark):
    folder = scratch(spark, "export")
    args = (folder, "x", "2024-01-01", "2024-01-02")
    path = sink.export_csv(frame(spark, rows("a", [1, 2])), *args)
    assert spark.read.option("header", True).csv(path).count() == 2
    with pytest.raises(Exception, match="already exists"):
        sink.export_csv(frame(spark, rows("a", [1])), *args)


def test_repeated_batch_changes_nothing(spark):
    root = scratch(spark, "live")
    live.seed_store(frame(spark, rows("a", [0, 3])), root)
    write = live.sync_sink(root)
    first, second = frame(spark, rows("a", range(6)) + rows("b", [0])), frame(spark, rows("a", range(8)))
    for batch_id, batch in [(0, first), (0, first), (1, second), (1, second)]:
        write(batch, batch_id)
    got = sorted((r.device_id, r.id) for r in live.stored_rows(spark, root).collect())
    assert got == [("a", 0), ("a", 3), ("a", 4), ("a", 5), ("a", 6), ("a", 7), ("b", 0)]


def test_a_batch_cut_short_is_completed(spark):
    root = scratch(spark, "live")
    live.seed_store(frame(spark, rows("a", [0])), root)
    batch = frame(spark, rows("a", range(1, 90, 10)) + rows("b", [0]))
    live.files.make_folder(spark, f"{root}/_pending/batch=0")
    sink.append_readings(batch.filter("id in (11, 71)"), root)  # what the first try had stored
    for _ in range(2):
        live.sync_sink(root)(batch, 0)
    assert content(spark, root) == [("a", i) for i in (0, *range(1, 90, 10))] + [("b", 0)]


def test_a_batch_lists_as_many_folders_after_many_batches(spark):
    root = scratch(spark, "live")
    write = live.sync_sink(root)
    live.seed_store(frame(spark, rows("a", [0])), root)
    for batch_id in range(12):
        write(frame(spark, rows("a", [batch_id, batch_id + 1])), batch_id)
        assert len(live.files.names(spark, f"{root}/_marks")) <= 2
    assert live.files.names(spark, f"{root}/_pending") == []
    assert content(spark, root) == [("a", i) for i in range(13)]
    assert sorted(map(tuple, live.earlier_marks(spark, root, 12).collect())) == [("a", 12)]


def test_a_compacted_month_holds_the_same_rows(spark):
    path = store(spark, rows("a", range(5)) + rows("b", [1]))
    for i in range(5, 9):
        sink.append_readings(frame(spark, rows("a", [i, 100 + i])), path)
    before = content(spark, path)
    parts = lambda: len(live.files.names(spark, f"{path}/device_id=a/month=2024-01"))
    many = parts()
    sink.compact_month(spark, path, "a", "2024-01")
    assert content(spark, path) == before and parts() < many


def test_sync_stream_resumes(spark):
    feed, root, checkpoint = (scratch(spark, n) for n in ("feed", "live", "checkpoint"))
    live.seed_store(frame(spark, []), root)
    for ids in (range(3), range(5), []):
        frame(spark, rows("a", ids)).write.mode("append").parquet(feed)
        stream = spark.readStream.schema(READING).parquet(feed)
        live.start_store(stream, live.sync_sink(root), checkpoint, availableNow=True).awaitTermination()
    assert sorted(r.id for r in live.stored_rows(spark, root).collect()) == [0, 1, 2, 3, 4]


def test_devices_of_a_catalog(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS devices_test")
    for name in ("dev_a", "dev_b"):
        spark.sql(f"CREATE TABLE devices_test.{name} (id BIGINT) USING parquet LOCATION '{scratch(spark, name)}'")
    names = lambda df: sorted(r.device_id for r in df.collect())
    assert names(source.discover_tables(spark, "devices_test")) == ["dev_a", "dev_b"]
    assert names(source.discover_tables(spark, "devices_test", own="dev_a")) == ["dev_b"]
    spark.sql("DROP DATABASE devices_test CASCADE")


def test_stores_are_created_when_absent(spark):
    own, central, published = (scratch(spark, n) for n in ("own", "central", "published"))
    sink.append_readings(frame(spark, rows("own", [0, 1])), own)
    sink.mirror(spark, "own", own, central)
    assert content(spark, central) == [("own", 0), ("own", 1)]
    data = [("a", T0, 1, 10, 3)]
    encoded = spark.createDataFrame(data, "device_id string, T timestamp_ntz, SENSOR int, PPM_10X int, n bigint")
    for _ in range(2):
        sink.write_published(encoded, published)
    assert content(spark, published) == [("a", 1), ("a", 2)]
