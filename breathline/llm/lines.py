"""Line dedup: a line found in several documents stays only in the first of them.

Lines are exploded and their normalised form hashed (128 bits); the first and last document
of a hash tell whether more than one holds it, without counting sets. What travels is a
hash, an id and a position per line; texts move once, to meet the positions they lose.

Defined results
- A null or empty text is one empty line. A text may lose all its lines and is then empty.
- A null id counts as one document after all others.
- Rows that repeat an id are one document: their lines are judged alike.
- Columns of the input beside id and text are carried along untouched, in ``row``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from breathline.llm.common import SPACE_CHARS, ascii_lower, fixed, id_or_last, whole

MIN_CHARS = 10
MIN_DOCUMENTS = 2


def drop_repeated_lines(docs: DataFrame, id: str = "doc_id", text: str = "text", min_chars: int = MIN_CHARS,
                        min_documents: int = MIN_DOCUMENTS) -> DataFrame:
    """``row`` (the input row), ``kept_text``, ``n_lines`` and ``n_dropped`` of each document."""
    # step by step through arrays, as a column of columns would be worked out again at each use
    trimmed = F.transform(F.split(whole(text), "\n"), lambda line: F.btrim(line, F.lit(SPACE_CHARS)))
    keys = docs.select(
        id_or_last(id).alias("doc"), F.xxhash64(whole(text)).alias("body"),
        F.posexplode(F.transform(trimmed, ascii_lower)).alias("pos", "key"),
    ).where(F.char_length("key") >= min_chars)
    keys = keys.select("doc", "body", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(min_chars), "key").alias("h2"))

    by_hash = keys.groupBy("h1", "h2")
    if min_documents == 2:
        repeated = by_hash.agg(F.min("doc").alias("first"), F.max("doc").alias("last")).where("first < last")
    else:
        one_each = keys.select("h1", "h2", "doc").distinct()
        repeated = (
            one_each.groupBy("h1", "h2").agg(F.min("doc").alias("first"), F.count("*").alias("documents"))
            .where(F.col("documents") >= min_documents)
        )
    # a table of its own, so that the join below deals both sides out and AQE can split a hot line
    repeated = fixed(repeated.select("h1", "h2", "first"))
    lost = (
        keys.join(repeated, ["h1", "h2"]).where("doc > first")
        .groupBy("doc", "body").agg(F.collect_set("pos").alias("lost"))
    )

    rows = docs.select(
        F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"),
        id_or_last(id).alias("doc"), whole(text).alias("content"),
    ).withColumn("body", F.xxhash64("content"))
    pieces = F.split("content", "\n")
    stays = F.array_except(F.sequence(F.lit(0), F.size(pieces) - 1), F.coalesce("lost", F.array().cast("array<int>")))
    return rows.join(lost, ["doc", "body"], "left").select(
        "row",
        F.when(F.col("lost").isNull(), F.col("content"))
        .otherwise(F.array_join(F.transform(stays, lambda i: F.get(pieces, i)), "\n")).alias("kept_text"),
        F.size(pieces).cast("long").alias("n_lines"),
        F.coalesce(F.size("lost"), F.lit(0)).cast("long").alias("n_dropped"),
    )
