"""SimHash near-dedup with Golay-code fuzzy hashing.

A fingerprint is cut into three segments, each filled up to a 23-bit word. Of at most two
differing bits some segment has none, and the segment after it at most two, which the Golay
numbers of that segment tolerate. So a key is one segment as it is and a Golay number of
the next: up to 18 keys, and fingerprints in reach share one. Candidates of a key are
verified by their bit distance.

Only distinct fingerprints are joined, never copies. A key with more than ``BUCKET``
fingerprints isn't paired: its fingerprints are linked exactly through the words next to
them. Two fingerprints are within two bits if and only if some word is within one bit of
both, and all that share such a word are in reach of each other, so a star replaces pairs.

Defined results
- No words (null, empty or white space): fingerprint zero, linked like any other.
- Fewer words than a shingle: the whole sequence is the one shingle.
- A null id sorts after all others; a component of null ids only has a null component_id.
- Rows that repeat an id stand for themselves. Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from breathline.llm import golay
from breathline.llm.common import LAST_ID, fixed, id_or_last, last_to_null
from breathline.llm.components import connected

SHINGLE_WORDS = 3
MAX_BITS = 2
SEED = 42
#: The segments of a fingerprint: first bit and number of bits.
SEGMENTS = ((0, 22), (22, 21), (43, 21))
#: Fingerprints of a key that are still paired; more are linked through adjacent words.
BUCKET = 16
BLOCK = 1 << 16


def fingerprint(text: bytes, shingle: int = SHINGLE_WORDS) -> int:
    """Of a UTF-8 text; bytes.lower and bytes.split mean A-Z and ASCII white space."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(joined, SEED)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.r_[0, ends[:-shingle] + 1].tolist()
    hashes = np.array(
        [xxhash.xxh64_intdigest(joined[a:b], SEED) for a, b in zip(starts, ends[shingle - 1:].tolist(), strict=True)],
        dtype="<u8")
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), BLOCK):
        block = hashes[at:at + BLOCK]
        ones += np.unpackbits(block.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def _fingerprints(shingle: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").cast(pa.binary())
            prints = np.array([fingerprint(t.as_py() or b"", shingle) for t in texts], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(prints)], names=["id", "fp"])
    return run


def fingerprints(docs: DataFrame, id: str = "doc_id", text: str = "text", shingle: int = SHINGLE_WORDS) -> DataFrame:
    rows = docs.select(id_or_last(id).alias("id"), F.col(text).alias("text"))
    return rows.mapInArrow(_fingerprints(shingle), "id long, fp long")


def keys_of(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(positions in ``prints``, keys): a segment as it is with the Golay numbers of the next."""
    parts = [(prints >> np.uint64(at) & np.uint64((1 << n) - 1)).astype(np.int64) for at, n in SEGMENTS]
    rows, keys = [], []
    for slot in range(len(SEGMENTS)):
        row, number = golay.near_codewords(parts[(slot + 1) % len(SEGMENTS)])
        rows.append(row)
        keys.append(slot << 40 | parts[slot][row] << golay.DATA_BITS | number)
    return np.concatenate(rows), np.concatenate(keys)


def _keys(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        prints = batch.column("fp").to_numpy(zero_copy_only=False)
        rows, keys = keys_of(prints.view(np.uint64))
        yield pa.RecordBatch.from_arrays([pa.array(prints[rows]), pa.array(keys)], names=["fp", "key"])


def _adjacent(max_bits: int) -> Column:
    """Words that all fingerprints in reach of each other have in common, some pair of bits at a time."""
    flipped = "fp ^ shiftleft(1L, b)"
    if max_bits == 2:
        return F.expr(
            "concat(array(named_struct('bit', -1, 'word', fp)),"
            f" transform(sequence(0, 63), b -> named_struct('bit', -1, 'word', {flipped})))")
    return F.expr(f"transform(sequence(0, 63), b -> named_struct('bit', b, 'word', least(fp, {flipped})))")


def links(prints: DataFrame, max_bits: int = MAX_BITS, bucket: int = BUCKET) -> DataFrame:
    """``prints``: distinct fingerprints (fp) -> (a, b), which connect all within ``max_bits``."""
    if max_bits not in (0, 1, 2):
        raise ValueError("the segments and Golay numbers reach fingerprints up to 2 bits apart")
    if max_bits == 0:
        return prints.select(F.col("fp").alias("a"), F.col("fp").alias("b")).limit(0)
    keyed = fixed(prints.select("fp").mapInArrow(_keys, "fp long, key long"))
    sizes = keyed.groupBy("key").count().where("count > 1")
    shared = keyed.join(sizes, "key")
    few = shared.where(F.col("count") <= bucket).select("key", "fp")
    pairs = (
        few.withColumnRenamed("fp", "a").join(few.withColumnRenamed("fp", "b"), "key").where("a < b")
        .where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits).select("a", "b")
    )
    many = shared.where(F.col("count") > bucket).select("fp").distinct()
    stars = many.select("fp", F.explode(_adjacent(max_bits)).alias("near")).select("fp", "near.bit", "near.word")
    centres = stars.groupBy("bit", "word").agg(F.min("fp").alias("a"), F.max("fp").alias("z")).where("a < z").select("bit", "word", "a")
    return pairs.unionByName(stars.join(centres, ["bit", "word"]).where("fp <> a").select("a", F.col("fp").alias("b")))


def near_duplicates(docs: DataFrame, id: str = "doc_id", text: str = "text", shingle: int = SHINGLE_WORDS,
                    max_bits: int = MAX_BITS, bucket: int = BUCKET) -> DataFrame:
    """Per row: id, fp (as a signed long) and component_id, the smallest id reachable."""
    printed = fixed(fingerprints(docs, id, text, shingle))
    classes = fixed(printed.groupBy("fp").agg(F.min("id").alias("least")))
    roots = connected(links(classes, max_bits, bucket))
    placed = classes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root"))
    least = placed.groupBy("root").agg(F.min("least").alias("component"))
    component = placed.select("fp", "root").join(least, "root").select("fp", "component")
    return printed.join(component, "fp").select(
        last_to_null(F.col("id")).alias(id), "fp", last_to_null(F.col("component")).alias("component_id"))


def one_of_each(docs: DataFrame, id: str = "doc_id", text: str = "text", shingle: int = SHINGLE_WORDS,
                max_bits: int = MAX_BITS) -> DataFrame:
    """The rows of ``docs`` whose id is the smallest of its group, with all their columns."""
    stay = (
        near_duplicates(docs, id, text, shingle, max_bits)
        .select(F.coalesce(id, F.lit(LAST_ID)).alias("stay_id"), F.coalesce("component_id", F.lit(LAST_ID)).alias("c"))
        .where("stay_id = c").select("stay_id").distinct()
    )
    return docs.join(stay, F.coalesce(docs[id].cast("long"), F.lit(LAST_ID)) == stay["stay_id"], "left_semi")
