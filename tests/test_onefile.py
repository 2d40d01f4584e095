"""One CSV file of many parts against a write by one task."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from breathline.session import scratch
from breathline.sinks import onefile


@pytest.mark.parametrize("n,parts", [(5000, 6), (3, 4), (0, 1)])
def test_equals_a_write_by_one_task(spark, n, parts):
    rows = spark.range(n).select(
        "id", F.concat(F.lit('a "b", c '), F.col("id")).alias("a,name"), F.when(F.col("id") % 7 > 0, F.col("id") / 3).alias("v"),
        F.timestamp_seconds(F.col("id")).cast("timestamp_ntz").alias("T"), F.lit("é\nü").alias("text")).repartition(parts)
    folder = scratch(spark, "export here")
    path = onefile.export_one_csv(rows, folder, "co2", "2024-01-01 00:00", "2024-01-02 00:00", ["id"])
    assert os.listdir(folder) == [os.path.basename(path)] or set(os.listdir(folder)) == {os.path.basename(path), f".{os.path.basename(path)}.crc"}
    one = scratch(spark, "one-task")
    rows.orderBy("id").coalesce(1).write.option("header", True).csv(one)
    with open(path, "rb") as mine, open(glob.glob(f"{one}/part-*")[0], "rb") as theirs:
        assert mine.read() == theirs.read()
    with pytest.raises(FileExistsError):
        onefile.export_one_csv(rows, folder, "co2", "2024-01-01 00:00", "2024-01-02 00:00", ["id"])
