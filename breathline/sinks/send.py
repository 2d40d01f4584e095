"""Sending new rows in chunks that are whole or absent, and going on where a send broke off.

A chunk is a file of its own below ``device_id=<name>``, written aside and then renamed, so a
send that dies leaves whole chunks only. Every row carries ``after_id``, the last id of the
chunk before (the device's mark for the first one), and ``last_id``, the chunk's own. Chunks
are sent by many tasks at once, so a broken send may leave chunks beyond a gap. A device's
chunks count as sent as far as each one's ``after_id`` is the ``last_id`` of another (or -1, the
mark of an empty table); readers see these, and the next send goes on from there. Chunks
beyond a gap are removed by the next send and sent again.
"""

import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from breathline.operators.sync import CHUNK_ROWS, numbered_chunks
from breathline.plans.sizing import broadcast_if_small
from breathline.session import frozen
from breathline.sinks import files
from breathline.sources.readings import COLUMNS

EMPTY_MARK = -1
SENT = "id bigint, T timestamp_ntz, SENSOR int, PPM_10X int, after_id bigint, last_id bigint, device_id string"
_FILE_COLUMNS = ["id", "T", "SENSOR", "PPM_10X", "after_id", "last_id"]


@dataclass
class Sent(WriterCommitMessage):
    """What a task has sent: device, chunk number, rows and last id of each chunk."""

    chunks: list[tuple[str, int, int, int]]


class ChunkWriter(DataSourceArrowWriter):
    """Rows (device_id, chunk_no, ...) of whole chunks, in order, to a file per chunk."""

    def __init__(self, root: str):
        self.root = root

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Sent:
        system, folder = fs.FileSystem.from_uri(self.root) if "://" in self.root else (fs.LocalFileSystem(), self.root)
        sent, held, at = [], [], None
        for batch in iterator:
            device, number = (batch.column(c).to_pylist() for c in ("device_id", "chunk_no"))
            start = 0
            for i in range(batch.num_rows + 1):
                if i == batch.num_rows or (device[i], number[i]) != (device[start], number[start]):
                    if i > start:
                        if at is not None and at != (device[start], number[start]):
                            sent.append(_store(system, folder, at, held))
                            held = []
                        at = (device[start], number[start])
                        held.append(batch.slice(start, i - start))
                    start = i
        if held:
            sent.append(_store(system, folder, at, held))
        return Sent(sent)

    def commit(self, messages: list[Sent | None]) -> None:
        """Each chunk counts from the moment its file is named; nothing is left to do."""

    def abort(self, messages: list[Sent | None]) -> None:
        """Whole chunks stay, as a sender that dies leaves them."""


def _store(system, folder: str, at: tuple[str, int], batches: list[pa.RecordBatch]) -> tuple[str, int, int, int]:
    chunk = pa.Table.from_batches(batches).select(_FILE_COLUMNS)
    last = chunk.column("last_id")[0].as_py()
    place = f"{folder.rstrip('/')}/device_id={quote(at[0], safe=' ')}"
    aside = f"{place}/_{uuid.uuid4().hex}"
    system.create_dir(place, recursive=True)
    with system.open_output_stream(aside) as file:
        pq.write_table(chunk, file)
    system.move(aside, f"{place}/{chunk.column('after_id')[0].as_py()}-{last}.parquet")
    return at[0], at[1], chunk.num_rows, last


class ChunkTarget(DataSource):
    """Option: ``path``."""

    @classmethod
    def name(cls) -> str:
        return "breathline_chunks"

    def writer(self, schema, overwrite: bool) -> ChunkWriter:
        return ChunkWriter(self.options["path"])


def _stored(spark: SparkSession, root: str) -> DataFrame:
    files.make_folder(spark, root)
    return spark.read.schema(SENT).parquet(root)


def _gaps(chunks: DataFrame) -> DataFrame:
    """(device_id, gap): the least ``after_id`` that no chunk ends with. ``chunks``: (device_id, after_id, last_id)."""
    ends = chunks.select("device_id", F.col("last_id").alias("after_id"))
    loose = chunks.filter(F.col("after_id") != EMPTY_MARK).join(ends, ["device_id", "after_id"], "left_anti")
    return loose.groupBy("device_id").agg(F.min("after_id").alias("gap"))


def _chunks(spark: SparkSession, root: str) -> DataFrame:
    return _stored(spark, root).select("device_id", "after_id", "last_id").distinct()


def _joined(rows: DataFrame, gaps: DataFrame) -> DataFrame:
    return rows.join(broadcast_if_small(frozen(gaps)), "device_id", "left").filter(F.col("gap").isNull() | (F.col("after_id") < F.col("gap"))).drop("gap")


def scan_sent(spark: SparkSession, root: str) -> DataFrame:
    """Readings of the chunks that count as sent."""
    return _joined(_stored(spark, root), _gaps(_chunks(spark, root))).select(*COLUMNS)


def sent_marks(spark: SparkSession, root: str) -> DataFrame:
    """(device_id, last_id): the highest id sent, for devices with any."""
    chunks = _chunks(spark, root)
    return _joined(chunks, _gaps(chunks)).groupBy("device_id").agg(F.max("last_id").alias("last_id"))


def _drop_beyond_gaps(spark: SparkSession, root: str) -> None:
    beyond = _stored(spark, root).select("device_id", "after_id", F.col("_metadata.file_path").alias("path")).distinct()
    gaps = broadcast_if_small(frozen(_gaps(_chunks(spark, root))))
    for row in beyond.join(gaps, "device_id").filter(F.col("after_id") >= F.col("gap")).select("path").toLocalIterator():
        files.delete(spark, row["path"])


def send_in_chunks(source: DataFrame, root: str, chunk_rows: int = CHUNK_ROWS) -> None:
    """Send the source's rows above what each device has sent, in chunks by id.

    Holes below a mark stay holes. ``source`` has the columns of a reading; its rows must
    not change while they are sent.
    """
    spark = source.sparkSession
    spark.dataSource.register(ChunkTarget)
    _drop_beyond_gaps(spark, root)
    marks = frozen(sent_marks(spark, root))
    new = source.select(*COLUMNS).join(broadcast_if_small(marks), "device_id", "left").withColumn("last_id", F.coalesce("last_id", F.lit(EMPTY_MARK)))
    numbered = numbered_chunks(new.filter(F.col("id") > F.col("last_id")).withColumnRenamed("last_id", "mark"), chunk_rows)
    ends = frozen(numbered.groupBy("device_id", "chunk_no", "mark").agg(F.max("id").alias("last_id")))
    before = ends.select("device_id", (F.col("chunk_no") + 1).alias("chunk_no"), F.col("last_id").alias("after_id"))
    bounds = ends.join(before, ["device_id", "chunk_no"], "left").select(
        "device_id", "chunk_no", "last_id", F.coalesce("after_id", "mark").alias("after_id"))
    rows = numbered.drop("mark").join(bounds, ["device_id", "chunk_no"])
    (
        rows.repartition("device_id", "chunk_no").sortWithinPartitions("chunk_no", "device_id", "id")
        .write.format(ChunkTarget.name()).option("path", root).mode("append").save()
    )
