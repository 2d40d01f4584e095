"""An export as one CSV file, without a task or driver that all rows pass through.

Rows are sorted and written as parts without a header. The parts, in order behind the header,
become one file: on HDFS by its own concatenation, which moves no bytes; on a shared POSIX file
system by tasks that each copy a part to its place in the file. Other file systems can join no
files; there ``readings.export_csv`` leaves the parts in a folder.
"""

import os
from collections.abc import Iterable, Iterator
from urllib.parse import unquote, urlparse

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from breathline.session import scratch
from breathline.sinks import files
from breathline.sinks.readings import export_name

BLOCK_BYTES = 1 << 20


def _parts(spark: SparkSession, folder: str) -> list[tuple[str, int]]:
    """(path, bytes) of the parts that hold anything, in the order of their rows."""
    there, system = files._at(spark, folder)
    found = [(s.getPath().getName(), s.getPath().toString(), s.getLen()) for s in system.listStatus(there)]
    return [(path, size) for name, path, size in sorted(found) if name.startswith("part-") and size > 0]


def _local(path: str) -> str:
    return unquote(urlparse(path).path) if "://" in path or path.startswith("file:") else path


def _copied(target: str):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, at in zip(batch.column("path").to_pylist(), batch.column("at").to_pylist(), strict=True):
                with open(_local(path), "rb") as part, open(target, "r+b") as whole:
                    whole.seek(at)
                    while block := part.read(BLOCK_BYTES):
                        whole.write(block)
            yield batch.select(["at"])
    return run


def _placed(spark: SparkSession, parts: list[tuple[str, int]], target: str) -> None:
    """Every part at its bytes of a file made at full length; a repeated task writes the same bytes."""
    rows, at = [], 0
    for path, size in parts:
        rows.append((path, at))
        at += size
    with open(target, "wb") as whole:
        whole.truncate(at)
    places = spark.createDataFrame(rows, "path string, at long").repartition(len(rows), "at")
    done = places.mapInArrow(_copied(target), "at long").agg(F.count("*")).first()[0]
    if done != len(rows):
        raise OSError(f"{done} of {len(rows)} parts were copied to {target}")


def export_one_csv(rows: DataFrame, folder: str, prefix: str, start: str, end: str, order: list[str]) -> str:
    """Write rows in ``order`` as one CSV file with a header; returns its path. An earlier export is not replaced."""
    spark, path = rows.sparkSession, f"{folder.rstrip('/')}/{export_name(prefix, start, end)}"
    if files.exists(spark, path):
        raise FileExistsError(path)
    there, system = files._at(spark, folder)
    scheme = system.getUri().getScheme()
    if scheme not in ("file", "hdfs", "viewfs"):
        raise NotImplementedError(f"{scheme} joins no files; export_csv writes a folder of parts")
    body, head, aside = scratch(spark, "export-body"), scratch(spark, "export-head"), f"{folder.rstrip('/')}/_{os.urandom(8).hex()}"
    names = [f"c{i}" for i in range(len(rows.columns))]
    spark.createDataFrame([tuple(rows.columns)], ", ".join(f"{n} string" for n in names)).coalesce(1).write.csv(head)
    rows.orderBy(*order).write.csv(body)
    files.make_folder(spark, folder)
    parts = _parts(spark, head) + _parts(spark, body)
    made = files._at(spark, aside)[0]
    if scheme == "file":
        _placed(spark, parts, _local(aside))
    else:
        at = [spark._jvm.org.apache.hadoop.fs.Path(p) for p, _ in parts]
        system.rename(at[0], made)
        rest = spark.sparkContext._gateway.new_array(spark._jvm.org.apache.hadoop.fs.Path, len(at) - 1)
        for i, part in enumerate(at[1:]):
            rest[i] = part
        if len(at) > 1:
            system.concat(made, rest)
    if not system.rename(made, files._at(spark, path)[0]):
        raise OSError(f"{path} can't get its name")
    for folder_done in (body, head):
        files.delete(spark, folder_done)
    return path
