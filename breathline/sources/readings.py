"""Stored readings: one table for all devices, partitioned by device and month."""

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from breathline.schema import RANGES, READING

COLUMNS = READING.fieldNames()
STORED = T.StructType([*READING.fields, T.StructField("month", T.StringType())])


def scan_readings(spark: SparkSession, path: str) -> DataFrame:
    """All devices. The ``month`` partition column stays, so that time filters can prune."""
    return spark.read.schema(STORED).parquet(path)


def month_of(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM")


def time_filter(readings: DataFrame, start: Column, end: Column) -> DataFrame:
    """Rows with ``T`` in ``[start, end]``; also prunes by ``month`` where that column exists."""
    kept = readings.filter(F.col("T").between(start, end))
    if "month" in readings.columns:
        kept = kept.filter(F.col("month").between(month_of(start), month_of(end)))
    return kept


def scan_device_range(readings: DataFrame, device: str, start: str, end: str) -> DataFrame:
    """One device's rows in an inclusive time range, all columns."""
    bounds = (F.lit(t).cast("timestamp_ntz") for t in (start, end))
    return time_filter(readings.filter(F.col("device_id") == device), *bounds).select(*COLUMNS)


def discover_devices(readings: DataFrame, own: str | None = None) -> DataFrame:
    """Known devices; without the own one when it is named."""
    devices = readings.select("device_id").distinct()
    return devices if own is None else devices.filter(F.col("device_id") != own)


def discover_tables(spark: SparkSession, database: str, own: str | None = None) -> DataFrame:
    """Device tables of a catalog that keeps one table per device."""
    tables = spark.sql(f"SHOW TABLES IN `{database}`").filter(~F.col("isTemporary"))
    devices = tables.select(F.col("tableName").alias("device_id"))
    return devices if own is None else devices.filter(F.col("device_id") != own)


def tag_device(table: DataFrame, device: str) -> DataFrame:
    """Add the device name to the rows of a table that holds one device."""
    return table.withColumn("device_id", F.lit(device))


def union_devices(tables: dict[str, DataFrame]) -> DataFrame:
    """Bag union of per-device tables, tagged. A filter on ``device_id`` prunes whole tables.

    For tables that need a reader each (databases); folders of files take one scan with
    ``scan_device_folders`` or, in a store's layout, ``scan_readings``.
    """
    parts = [tag_device(table, device) for device, table in sorted(tables.items())]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def scan_device_folders(spark: SparkSession, root: str) -> DataFrame:
    """All rows of a folder that has a folder of files for each device, tagged, in one scan.

    The device is the first folder's name below ``root`` (what follows ``device_id=`` if it
    begins so), taken from the path of the row's file; files themselves have no device column.
    A filter on ``device_id`` skips the other devices' files.
    """
    bare = T.StructType([f for f in READING.fields if f.name != "device_id"])
    rows = spark.read.schema(bare).option("recursiveFileLookup", True).parquet(root)
    # paths are those of URIs, where a plus sign stands for itself
    depth = F.lit(len([part for part in root.split("://")[-1].split("/")[("://" in root):] if part]))
    parts = F.filter(F.split(F.regexp_replace("_metadata.file_path", "^[a-z0-9]+:(//[^/]*)?", ""), "/"), lambda p: p != "")
    name = F.url_decode(F.replace(F.get(parts, depth), F.lit("+"), F.lit("%2B")))
    return rows.select(F.regexp_replace(name, "^device_id=", "").alias("device_id"), *bare.fieldNames())


def scan_jdbc_device(
    spark: SparkSession, url: str, table: str, ids: tuple[int, int], partitions: int,
    newer_than: int | None = None, **options: str,
) -> DataFrame:
    """One device table of a relational database, read in parallel over id ranges.

    The id mark is pushed down by the JDBC source. Needs the database's driver jar.
    """
    reader = spark.read.format("jdbc").options(url=url, dbtable=table, **options)
    reader = reader.options(partitionColumn="id", lowerBound=ids[0], upperBound=ids[1], numPartitions=partitions)
    rows = reader.load()
    if newer_than is not None:
        rows = rows.filter(F.col("id") > newer_than)
    return tag_device(rows, table).select(
        *[F.col(field.name).cast(field.dataType) for field in READING.fields]
    )


def scan_ranges(spark: SparkSession, path: str) -> DataFrame:
    """Per-sensor limits from CSV with a header; types are declared, not inferred."""
    return spark.read.schema(RANGES).option("header", True).csv(path)
