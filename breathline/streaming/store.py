"""Stores fed by streams: replicated rows, and published ones.

A stream writes into the same store as a batch does, by device and month, so it can be
mirrored, pruned and shown alike. Beside the data, in folders that readers pass over:

- ``_marks/batch=<n>``: the highest id of every device after batch n, rolled forward from
  the batch before, so that a batch reads one small table and lists few folders;
- ``_pending/batch=<n>``: there while batch n is being stored. A batch that finds it was
  begun before, and leaves out the rows which that try has stored;
- ``_rejected/batch=<n>``: published medians that can't be stored, with the reason.

A batch whose marks are there is complete, and a repeat of it does nothing.
"""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from breathline.operators.filters import filter_newer_than
from breathline.operators.ingest import join_lut
from breathline.operators.publish import drop_missing_sensor, encode_published, rejected_published
from breathline.plans.sizing import broadcast_if_small
from breathline.session import frozen
from breathline.sinks import files
from breathline.sinks.readings import append_readings, create_store, with_next_ids
from breathline.sources.readings import COLUMNS, month_of, scan_readings

SEED_BATCH = -1
MARKS = "device_id string, last_id bigint"


def _folder(root: str, kind: str, batch_id: int) -> str:
    return f"{root}/_{kind}/batch={batch_id}"


def is_stored(spark: SparkSession, root: str, batch_id: int) -> bool:
    return files.exists(spark, _folder(root, "marks", batch_id) + "/_SUCCESS")


def earlier_marks(spark: SparkSession, root: str, batch_id: int) -> DataFrame:
    """Highest id per device before this batch: the marks of the newest earlier one."""
    numbers = [int(name.removeprefix("batch=")) for name in files.names(spark, f"{root}/_marks")]
    earlier = [n for n in numbers if n < batch_id and is_stored(spark, root, n)]
    if not earlier:
        return spark.createDataFrame([], MARKS)
    return frozen(spark.read.schema(MARKS).parquet(_folder(root, "marks", max(earlier))))


def write_batch(rows: DataFrame, marks: DataFrame, root: str, batch_id: int) -> None:
    """Store one batch of rows above ``marks``, then the marks after it."""
    spark = rows.sparkSession
    create_store(spark, root)
    fixed, pending = frozen(rows.select(*COLUMNS)), _folder(root, "pending", batch_id)
    fresh = fixed
    if files.exists(spark, pending):
        # Only the batch's own partitions can hold what the try before has stored.
        parts = fixed.select("device_id", month_of(F.col("T")).alias("month")).distinct()
        begun = scan_readings(spark, root).join(broadcast_if_small(frozen(parts)), ["device_id", "month"])
        fresh = fixed.join(filter_newer_than(begun, marks).select("device_id", "id"), ["device_id", "id"], "left_anti")
    files.make_folder(spark, pending)
    append_readings(fresh, root)
    (
        fixed.groupBy("device_id").agg(F.max("id").alias("last_id")).unionByName(marks)
        .groupBy("device_id").agg(F.max("last_id").alias("last_id"))
        .write.mode("overwrite").parquet(_folder(root, "marks", batch_id))
    )
    files.delete(spark, pending)
    for name in files.names(spark, f"{root}/_marks"):
        # The marks before the last ones are of no use, not even to a repeated batch.
        if int(name.removeprefix("batch=")) < batch_id - 1:
            files.delete(spark, f"{root}/_marks/{name}")


def seed_store(rows: DataFrame, root: str) -> None:
    """Start a store from rows that are there already."""
    write_batch(rows, rows.sparkSession.createDataFrame([], MARKS), root, SEED_BATCH)


def stored_rows(spark: SparkSession, root: str) -> DataFrame:
    return scan_readings(spark, root)


def sync_sink(root: str) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function: append rows above each device's mark, once."""
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if not is_stored(spark, root, batch_id):
            marks = earlier_marks(spark, root, batch_id)
            write_batch(filter_newer_than(batch.select(*COLUMNS), marks), marks, root, batch_id)
    return write


def publish_sink(root: str, lut: DataFrame) -> Callable[[DataFrame, int], None]:
    """What ``carry_sink`` publishes goes to the store.

    Channels become sensors, missing medians are left out, those that can't be stored go
    to ``rejected_rows``, and ids follow each device's mark.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        published = drop_missing_sensor(join_lut(frozen(batch), lut))
        if not is_stored(spark, root, batch_id):
            marks = earlier_marks(spark, root, batch_id)
            rejected_published(published).write.mode("overwrite").parquet(_folder(root, "rejected", batch_id))
            write_batch(with_next_ids(encode_published(published), marks), marks, root, batch_id)
    return write


def rejected_rows(spark: SparkSession, root: str) -> DataFrame:
    """Medians that could not be stored, with the reason and their batch."""
    schema = "device_id string, channel int, T timestamp_ntz, tenths double, n bigint, sensor_id int, reason string, batch bigint"
    return spark.read.schema(schema).parquet(f"{root}/_rejected")


def start_store(stream: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str, **trigger):
    """Run one of the sinks on a stream. Seed the store first, even with no rows."""
    return (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint).trigger(**trigger).start()
    )
