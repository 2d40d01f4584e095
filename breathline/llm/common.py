"""What the operators share: words and white space, row keys, scratch tables."""

from __future__ import annotations

import gc
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from breathline.session import frozen, scratch

#: White space as the contracts have it: the space and U+0009 to U+000D.
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"
SPACE_CHARS = " \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

#: Stands for a null id: rows without one count as one document after all others.
LAST_ID = (1 << 63) - 1


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_or_last(column: str) -> Column:
    return F.coalesce(F.col(column).cast("long"), F.lit(LAST_ID))


def last_to_null(column: Column) -> Column:
    return F.when(column != LAST_ID, column)


def whole(column: str) -> Column:
    """A text, null as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def ascii_lower(text: Column) -> Column:
    """A-Z alone in lower case; ``lower`` does the same where all characters are ASCII, and faster."""
    is_ascii = F.octet_length(text) == F.char_length(text)
    return F.when(is_ascii, F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))


def fixed(df: DataFrame) -> DataFrame:
    """A checkpoint of ``df`` in the shared folder; its lineage ends there."""
    return frozen(df)


def settled(make: Callable[[], DataFrame]) -> DataFrame:
    """As ``fixed`` of what ``make`` returns, after which the shuffle files behind it are given back.

    Spark removes them once the driver's JVM has collected what refers to them, by default
    every half hour; a step that moves much asks for it here, so that the next has the disk.
    """
    done = fixed(make())
    gc.collect()
    done.sparkSession.sparkContext._jvm.System.gc()
    return done


def written(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """``df`` as a Parquet table in the shared folder, and its path, for ``discarded``."""
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def discarded(spark: SparkSession, path: str) -> None:
    there = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    there.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(there, True)
