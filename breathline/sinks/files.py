"""Folders of a store, through the file system that Spark uses for it."""

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    there = spark._jvm.org.apache.hadoop.fs.Path(path)
    return there, there.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    there, files = _at(spark, path)
    return files.exists(there)


def make_folder(spark: SparkSession, path: str) -> None:
    there, files = _at(spark, path)
    files.mkdirs(there)


def delete(spark: SparkSession, path: str) -> None:
    there, files = _at(spark, path)
    files.delete(there, True)


def names(spark: SparkSession, path: str) -> list[str]:
    """Names below a folder, none if there is no such folder."""
    there, files = _at(spark, path)
    return [s.getPath().getName() for s in files.listStatus(there)] if files.exists(there) else []
