"""Writing readings: the table, appends with new ids, replication, CSV export."""

import re

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from breathline.operators.sync import CHUNK_ROWS, new_rows, numbered_chunks
from breathline.plans.chunks import with_ordinal
from breathline.plans.sizing import broadcast_if_small
from breathline.session import frozen, scratch
from breathline.sinks.files import delete
from breathline.sources.readings import COLUMNS, STORED, month_of, scan_readings

PARTITIONS = ["device_id", "month"]
TABLE_COLUMNS = [c for c in COLUMNS if c not in PARTITIONS] + PARTITIONS


def create_table(spark: SparkSession, name: str, location: str) -> None:
    """The readings table, unless it is there already."""
    spark.sql(f"""
        CREATE TABLE IF NOT EXISTS {name} (
            id BIGINT, T TIMESTAMP_NTZ, SENSOR INT, PPM_10X INT, device_id STRING, month STRING
        ) USING parquet PARTITIONED BY (device_id, month) LOCATION '{location}'
    """)


def create_store(spark: SparkSession, path: str) -> None:
    """The same without a catalog: an empty store, unless there is one at ``path``."""
    empty = spark.createDataFrame([], STORED)
    empty.write.mode("ignore").partitionBy(*PARTITIONS).parquet(path)


def _laid_out(rows: DataFrame) -> DataFrame:
    """Rows in the table's column order, spread for writing.

    Rebalancing gathers a partition's rows in one task, and AQE splits a hot one over
    several and lets small ones share, so files stay few and of similar size. Within a
    file rows are in time order, which keeps the row-group statistics of ``T`` narrow.
    """
    stored = rows.withColumn("month", month_of(F.col("T"))).select(*TABLE_COLUMNS)
    return stored.hint("rebalance", *PARTITIONS).sortWithinPartitions(*PARTITIONS, "T", "id")


def append_to_table(rows: DataFrame, name: str) -> None:
    """Append rows that have their ids to a catalog table made by ``create_table``."""
    _laid_out(rows).write.insertInto(name)


def append_readings(rows: DataFrame, path: str) -> None:
    """The same without a catalog."""
    _laid_out(rows).write.mode("append").partitionBy(*PARTITIONS).parquet(path)


def with_next_ids(rows: DataFrame, marks: DataFrame) -> DataFrame:
    """Give published rows the ids after their device's ``last_id``, by time, then channel.

    Rows without a channel go by sensor. A device publishes one row per channel and
    period, so the rows of a day are bounded.
    """
    order = ["T", "channel" if "channel" in rows.columns else "SENSOR"]
    numbered = with_ordinal(rows, ["device_id"], F.to_date("T"), order, "_no")
    return (
        numbered.join(broadcast_if_small(marks), "device_id", "left")
        .withColumn("id", F.coalesce("last_id", F.lit(0)) + F.col("_no")).select(*COLUMNS)
    )


def partition_marks(spark: SparkSession, path: str) -> DataFrame:
    """Highest id per device and month of a store, from the footers of its files alone.

    A session of its own reads them, as the aggregate is pushed down by the newer Parquet
    reader only.
    """
    footers = spark.newSession()
    older = [f for f in footers.conf.get("spark.sql.sources.useV1SourceList").split(",") if f != "parquet"]
    footers.conf.set("spark.sql.sources.useV1SourceList", ",".join(older))
    footers.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return footers.read.schema(STORED).parquet(path).groupBy(*PARTITIONS).agg(F.max("id").alias("top_id"))


def device_marks(spark: SparkSession, path: str) -> DataFrame:
    """Highest id per device of a store, fixed before anything is written."""
    return frozen(partition_marks(spark, path).groupBy("device_id").agg(F.max("top_id").alias("last_id")))


def write_published(encoded: DataFrame, path: str) -> None:
    """Append published rows to a store, ids included; the store is created if need be."""
    create_store(encoded.sparkSession, path)
    append_readings(with_next_ids(encoded, device_marks(encoded.sparkSession, path)), path)


def sync_incremental(source: DataFrame, target_path: str) -> None:
    """Append what the target lacks above its marks; one append for all devices."""
    create_store(source.sparkSession, target_path)
    target = scan_readings(source.sparkSession, target_path)
    append_readings(new_rows(source, target), target_path)


def new_stored_rows(
    spark: SparkSession, source_path: str, target_path: str, devices: Column | None = None
) -> DataFrame:
    """``new_rows`` between stores (of ``devices``, a condition), reading only what may be new.

    The marks come from file footers. Only partitions of the source that reach above the
    device's mark are read (dynamic pruning), and the lowest of these marks is a literal
    that reaches the row groups. Holes below a mark stay holes.
    """
    tops = partition_marks(spark, source_path)
    tops = tops if devices is None else tops.filter(devices)
    marks = partition_marks(spark, target_path).groupBy("device_id").agg(F.max("top_id").alias("last_id"))
    ahead = frozen(
        tops.join(marks, "device_id", "left")
        .select(*PARTITIONS, "top_id", F.coalesce("last_id", F.lit(-1)).cast("bigint").alias("last_id"))
        .filter(F.col("top_id") > F.col("last_id")).drop("top_id")
    )
    lowest = ahead.agg(F.min("last_id")).first()[0]
    rows = scan_readings(spark, source_path)
    if lowest is None:
        return rows.select(*COLUMNS).limit(0)
    # The condition holds for all; it makes Catalyst prune by this side.
    reaching = broadcast_if_small(ahead.filter(F.col("last_id") >= -1))
    return (
        rows.filter(F.col("id") > lowest).join(reaching, PARTITIONS)
        .filter(F.col("id") > F.col("last_id")).select(*COLUMNS)
    )


def sync_stores(spark: SparkSession, source_path: str, target_path: str) -> None:
    """``sync_incremental`` from store to store."""
    create_store(spark, target_path)
    append_readings(new_stored_rows(spark, source_path, target_path), target_path)


def sync_in_chunks(source: DataFrame, target: DataFrame) -> DataFrame:
    """The rows a sync would send, with the chunk each one travels in."""
    return numbered_chunks(new_rows(source, target))


def sync_stores_in_chunks(spark: SparkSession, source_path: str, target_path: str) -> DataFrame:
    """The same between stores."""
    return numbered_chunks(new_stored_rows(spark, source_path, target_path))


def mirror(spark: SparkSession, own: str, local_path: str, central_path: str) -> None:
    """Push the own device to the central store, then pull every other device."""
    for path in (local_path, central_path):
        create_store(spark, path)
    mine = F.col("device_id") == own
    push = new_stored_rows(spark, local_path, central_path, mine)
    pull = new_stored_rows(spark, central_path, local_path, ~mine)
    append_readings(push, central_path)
    append_readings(pull, local_path)


def compact_month(spark: SparkSession, path: str, device: str, month: str) -> None:
    """Rewrite one partition of a store in few files.

    The rows are copied aside first. Readers of the store should pause, as its files are
    replaced.
    """
    aside = scratch(spark, "compact")
    part = (F.col("device_id") == device) & (F.col("month") == month)
    scan_readings(spark, path).filter(part).write.parquet(aside)
    rows = spark.read.schema(STORED).parquet(aside).select(*COLUMNS)
    (
        _laid_out(rows).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy(*PARTITIONS).parquet(path)
    )
    delete(spark, aside)


def write_jdbc(rows: DataFrame, url: str, table: str, **options: str) -> None:
    """Append one device's rows to its table in a relational database."""
    bare = rows.drop("device_id")
    bare.write.format("jdbc").mode("append").options(url=url, dbtable=table, batchsize=CHUNK_ROWS, **options).save()


def export_name(prefix: str, start: str, end: str) -> str:
    """File name of an export; blanks and colons become dashes."""
    return "_".join([prefix, *(re.sub("[ :]", "-", t) for t in (start, end))]) + ".csv"


def export_csv(rows: DataFrame, folder: str, prefix: str, start: str, end: str) -> str:
    """Write rows as CSV with a header, in parts below one named folder; returns its path."""
    path = f"{folder.rstrip('/')}/{export_name(prefix, start, end)}"
    rows.write.mode("errorifexists").option("header", True).csv(path)
    return path
