"""The summary from hourly counts against the one of all rows."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from breathline.operators import summary
from breathline.schema import RANGES, READING
from breathline.session import scratch
from breathline.sinks import files
from breathline.streaming import partials, store, views

T0 = dt.datetime(2024, 1, 30, 20)
AS_OF = "2024-02-02 05:30:00"


def some_readings(spark, seed, n=1200):
    rng, rows, t = random.Random(seed), [], 0
    for i in range(n):
        t += rng.choice([0, 1, 60, 400, 900])
        rows.append((rng.choice(["a", "a", "b"]), i, T0 + dt.timedelta(seconds=t), rng.choice([1, 2]), rng.choice([None] + [4000 + rng.randrange(50)] * 400)))
    return spark.createDataFrame(rows, READING)


def rows_of(df):
    return sorted(str(tuple(round(x, 9) if isinstance(x, float) else x for x in r)) for r in df.select(sorted(df.columns)).collect())


@pytest.mark.parametrize("dates", [None, ("2024-01-30", "2024-02-01"), ("2024-02-01", "2024-02-01"), ("2023-01-01", "2023-02-01")])
def test_counts_of_batches_give_the_summary_of_the_rows(spark, dates):
    rows, root = some_readings(spark, 1), scratch(spark, "counted")
    ranges = spark.createDataFrame([(1, 1.0, 0.0, 2.0), (2, 1.0, None, 2.0), (2, 9.0, 0.0, None)], RANGES)
    store.seed_store(rows.filter("id < 300"), root)
    partials.seed_counts(rows.filter("id < 300"), root)
    out = f"{root}-summary"
    sink = partials.refresh_sink(root, ranges, out, lambda: AS_OF, dates, merge_every=2)
    for batch in range(5):
        part = rows.filter((F.col("id") >= 300 + batch * 180) & (F.col("id") < 480 + batch * 180))
        sink(part, batch)
        if batch in (1, 4):
            sink(part, batch)  # a repeat changes nothing
        expected = views.refreshed(views.scan_readings(spark, root), ranges, AS_OF, dates)
        assert rows_of(views.latest_refresh(spark, out)) == rows_of(expected)
    assert len(files.names(spark, f"{root}/_counts")) <= 4


def test_a_tick_reads_counts_and_two_hours(spark):
    rows, root = some_readings(spark, 2, 3000), scratch(spark, "counted")
    store.seed_store(rows, root)
    partials.seed_counts(rows, root)
    ranges = spark.createDataFrame([(1, 1.0, 0.0, 2.0)], RANGES)
    ticked = partials.refreshed_from_counts(spark, root, ranges, AS_OF)
    plan = ticked._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "FileScan parquet" in line]
    assert len(scans) == 2 and sum("LessThanOrEqual(T,2024-02-02T06:30), Or(Le" in line for line in scans) == 1
    start, end = dt.datetime(2024, 1, 31, 5, 30), dt.datetime(2024, 2, 2, 6, 30)
    inside = rows.filter(F.col("T").between(start, end))
    ends = inside.filter((F.col("T") < dt.datetime(2024, 1, 31, 6)) | (F.col("T") >= dt.datetime(2024, 2, 2, 6)))
    assert ends.count() < inside.count() / 20
    assert rows_of(ticked) == rows_of(views.refreshed(views.scan_readings(spark, root), ranges, AS_OF))


def test_summary_is_unchanged_by_splitting_counts(spark):
    rows = some_readings(spark, 3, 500).withColumn("sensor_id", F.col("SENSOR"))
    halves = [summary.value_counts(rows.filter(F.col("id") % 2 == k)) for k in (0, 1)]
    assert rows_of(summary.summary_of_counts(halves[0].unionByName(halves[1]), AS_OF)) == rows_of(summary.device_summary(rows, AS_OF))
