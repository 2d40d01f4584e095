"""What the plans must look like at scale."""

import re

import pytest

from breathline.operators import enrich, filters, summary, trailing
from breathline.queries import fixtures as fx
from breathline.queries.registry import QUERIES
from breathline.session import scratch
from breathline.sinks import readings as sink
from breathline.sources import readings as source

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def formatted(df):
    return df.sparkSession._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


@pytest.fixture(scope="module")
def stored(spark):
    path = scratch(spark, "stored")
    sink.append_readings(fx.readings(spark, SF), path)
    return source.scan_readings(spark, path)


def test_time_range_reaches_the_scan_and_prunes_partitions(stored):
    text = formatted(source.scan_device_range(stored, "click", "2024-01-08 00:00:00", "2024-01-09 00:00:00"))
    assert "GreaterThanOrEqual(T," in text and "LessThanOrEqual(T," in text
    partition_filters = re.search(r"PartitionFilters: (.*)", text).group(1)
    assert "device_id" in partition_filters and "month" in partition_filters


def test_local_dates_fold_to_literals(stored):
    text = plan(filters.filter_local_dates(stored, "2024-01-10", "2024-01-12", fx.AS_OF))
    assert "GreaterThanOrEqual(T,2024-01-11T00:00)" in text
    assert "convert_timezone" not in text


def test_union_reads_one_table_for_one_device(spark):
    tables = {d: fx.readings(spark, SF).filter(f"device_id = '{d}'").drop("device_id") for d in ("click", "view")}
    text = plan(source.union_devices(tables).filter("device_id = 'view'"))
    assert text.count("FileScan") == 1


def test_summary_broadcasts_limits_and_preaggregates(spark):
    flagged = enrich.flag_readings(fx.readings(spark, SF), fx.ranges(spark, SF))
    text = plan(summary.device_summary(flagged, fx.AS_OF))
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text
    assert text.count("Exchange hashpartitioning") == 2
    assert "SortAggregate" not in text


def test_summary_of_one_figure_prunes_the_rest(spark):
    rows = enrich.decode_readings(fx.readings(spark, SF))
    assert "percentile" not in plan(summary.device_summary(rows, fx.AS_OF).select("device_id", "N"))


def test_last_row_needs_no_sort(spark):
    assert "Sort" not in plan(summary.last_per_key(enrich.decode_readings(fx.readings(spark, SF))))


def test_carry_reads_its_input_twice(spark):
    text = plan(QUERIES["publish_median_carry"](spark, SF))
    # Before reuse; the periods are read from where they were kept.
    assert text.count("FileScan") <= 4
    assert text.count("Exchange hashpartitioning") <= 10


def test_no_window_spans_a_whole_device(spark):
    arrivals = fx.arrivals(spark, SF)
    for df in (trailing.trailing_stats(arrivals), trailing.diff_time(enrich.decode_readings(fx.readings(spark, SF)))):
        for keys in re.findall(r"Window \[.*?windowspecdefinition\((.*?) ASC", plan(df)):
            assert "_bucket" in keys or "_chunk" in keys


BATCH = [name for name in QUERIES if not name.startswith(("stream_", "sink_", "sync_", "mirror_", "scan_"))]


@pytest.mark.parametrize("name", BATCH)
def test_no_cross_joins_and_no_python(spark, name):
    text = plan(QUERIES[name](spark, SF))
    for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Pandas"):
        assert word not in text
