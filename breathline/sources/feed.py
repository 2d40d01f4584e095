"""Text feeds of any file size, as a data source of tables and streams.

The files below ``device_id=<name>`` folders, in order of their time and path, are read as
one long text; a line's id is the place of its first byte in it. So ids are distinct whatever
the files' times, rise in arrival order, and are the same in a table, a stream and a repeated
read. Files are cut by bytes, not lines: a task reads the lines that begin in its range, and
holds one block of a file at a time.

A file is complete when it appears and stays while the stream's checkpoint is in use. A stream
takes files once they are ``settle_ms`` old, so that files of one time are seen together.
"""

import re
import time
from collections.abc import Iterator
from urllib.parse import unquote

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from breathline.schema import RAW_LINE

SPLIT_BYTES = 64 << 20
BLOCK_BYTES = 1 << 20
SETTLE_MS = 1000
_DEVICE = re.compile(r"(?:^|/)device_id=([^/]+)/")


class Piece(InputPartition):
    """Bytes [start, end) of a file, whose first byte is at ``base`` of the feed."""

    def __init__(self, path: str, device: str, ms: int, base: int, start: int, end: int):
        self.path, self.device, self.ms, self.base, self.start, self.end = path, device, ms, base, start, end


def feed_files(root: str) -> list[tuple[int, str, int]]:
    """(time in ms, path, bytes) of the feed's files in order."""
    system, folder = fs.FileSystem.from_uri(root) if "://" in root else (fs.LocalFileSystem(), root)
    found = system.get_file_info(fs.FileSelector(folder, recursive=True))
    return sorted(
        (f.mtime_ns // 1_000_000, f.path, f.size) for f in found
        if f.type == fs.FileType.File and _DEVICE.search(f.path) and not f.base_name.startswith(("_", ".")))


def pieces(files: list[tuple[int, str, int]], base: int, split: int) -> list[Piece]:
    out = []
    for ms, path, size in files:
        device = unquote(_DEVICE.search(path).group(1))
        out += [Piece(path, device, ms, base, at, min(at + split, size)) for at in range(0, size, split)]
        base += size
    return out


def lines_of(file, start: int, end: int, block: int = BLOCK_BYTES) -> Iterator[tuple[np.ndarray, list[bytes]]]:
    """(first bytes, lines) of the lines that begin in [start, end), a block at a time."""
    at, held = start, b""
    file.seek(max(0, start - 1))
    skipping = start > 0
    while True:
        new = file.read(max(block, len(held)))  # a line longer than a block doubles what is read
        if not new:
            if held and not skipping and at < end:
                yield np.array([at]), [held]
            return
        if skipping:  # up to the first line that begins here
            cut = new.find(b"\n")
            if cut < 0:
                at += len(new)
                continue
            skipping, at, new = False, max(0, at - 1) + cut + 1, new[cut + 1:]
        held += new
        cut = held.rfind(b"\n")
        if at >= end:
            return
        if cut < 0:
            continue
        lines = held[:cut].split(b"\n")
        starts = at + np.cumsum([0, *(len(x) + 1 for x in lines[:-1])])
        inside = int(np.searchsorted(starts, end))
        yield starts[:inside], lines[:inside]
        at, held = at + cut + 1, held[cut + 1:]
        if at >= end:
            return


def _read(root: str, piece: Piece) -> Iterator[pa.RecordBatch]:
    system = fs.FileSystem.from_uri(root)[0] if "://" in root else fs.LocalFileSystem()
    with system.open_input_file(piece.path) as file:
        for starts, lines in lines_of(file, piece.start, piece.end):
            some = np.array([len(x) > 0 for x in lines], dtype=bool)
            starts = starts[some]
            text = [x.decode(errors="replace") for x in lines if x]
            yield pa.RecordBatch.from_arrays([
                pa.array([piece.device] * len(text), pa.string()), pa.array(piece.base + starts, pa.int64()),
                pa.array(piece.ms * 1000 + starts, pa.timestamp("us")), pa.array(text, pa.string())],
                names=RAW_LINE.fieldNames())


class FeedReader(DataSourceReader):
    def __init__(self, root: str, split: int):
        self.root, self.split = root, split

    def partitions(self) -> list[Piece]:
        return pieces(feed_files(self.root), 0, self.split)

    def read(self, partition: Piece) -> Iterator[pa.RecordBatch]:
        return _read(self.root, partition)


class FeedStream(DataSourceStreamReader):
    """Offsets are the newest file taken and the bytes up to its end."""

    def __init__(self, root: str, split: int, settle_ms: int):
        self.root, self.split, self.settle_ms = root, split, settle_ms

    def initialOffset(self) -> dict:
        return {"ms": -1, "path": "", "bytes": 0}

    def latestOffset(self) -> dict:
        newest = time.time() * 1000 - self.settle_ms
        files = [f for f in feed_files(self.root) if f[0] <= newest]
        if not files:
            return self.initialOffset()
        return {"ms": files[-1][0], "path": files[-1][1], "bytes": sum(size for *_, size in files)}

    def partitions(self, start: dict, end: dict) -> list[Piece]:
        after, to = (start["ms"], start["path"]), (end["ms"], end["path"])
        new = [f for f in feed_files(self.root) if after < f[:2] <= to]
        if start["bytes"] + sum(size for *_, size in new) != end["bytes"]:
            raise ValueError(f"files of the feed {self.root} have changed or gone, or came with an earlier time")
        return pieces(new, start["bytes"], self.split)

    def read(self, partition: Piece) -> Iterator[pa.RecordBatch]:
        return _read(self.root, partition)

    def commit(self, end: dict) -> None:
        pass


class TextFeed(DataSource):
    """Options: ``path``, ``split_bytes``, ``settle_ms``."""

    @classmethod
    def name(cls) -> str:
        return "breathline_text_feed"

    def schema(self):
        return RAW_LINE

    def _split(self) -> int:
        return int(self.options.get("split_bytes", SPLIT_BYTES))

    def reader(self, schema) -> FeedReader:
        return FeedReader(self.options["path"], self._split())

    def streamReader(self, schema) -> FeedStream:
        return FeedStream(self.options["path"], self._split(), int(self.options.get("settle_ms", SETTLE_MS)))


def scan_text_feed(
    spark: SparkSession, path: str, streaming: bool = False, split_bytes: int = SPLIT_BYTES, settle_ms: int = SETTLE_MS
) -> DataFrame:
    """RAW_LINE rows of a text feed, empty reads dropped.

    A line arrives with its file: its time is that of the file, a microsecond later for each
    byte before it. Files of any size are split over tasks; bytes that aren't UTF-8 are replaced.
    """
    spark.dataSource.register(TextFeed)
    reader = spark.readStream if streaming else spark.read
    return reader.format(TextFeed.name()).option("path", path).option("split_bytes", split_bytes).option("settle_ms", settle_ms).load()
