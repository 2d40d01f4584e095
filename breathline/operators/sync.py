"""Copying new rows between stores by each device's highest id."""

from pyspark.sql import DataFrame, functions as F

from breathline.operators.filters import filter_newer_than
from breathline.operators.summary import high_water_mark
from breathline.plans.chunks import id_chunk, with_ordinal
from breathline.session import frozen
from breathline.sources.readings import COLUMNS, discover_devices

# Rows sent together; a chunk is flushed once it holds more than 100.
CHUNK_ROWS = 101


def marks(source: DataFrame, target: DataFrame) -> DataFrame:
    """The target's mark for each device of the source, fixed before anything is written."""
    return frozen(high_water_mark(discover_devices(source), target))


def new_rows(source: DataFrame, target: DataFrame) -> DataFrame:
    """Rows of the source above the target's mark. Holes below the mark stay holes."""
    return filter_newer_than(source.select(*COLUMNS), marks(source, target))


def numbered_chunks(rows: DataFrame, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Add ``chunk_no``, the batch of ``chunk_rows`` rows per device in id order."""
    numbered = with_ordinal(rows, ["device_id"], id_chunk(), ["id"], "_no")
    return numbered.withColumn("chunk_no", F.expr(f"(_no - 1) div {chunk_rows}L")).drop("_no")
