"""Exact dedup by progressive refinement: length, then prefix hash, then full hash.

Each level sees only the rows whose group at the level before had more than one row. The
first two levels move counts and short keys; whole texts are hashed for the survivors alone.

Groups are never gathered: each level counts by key (summed before the shuffle) and joins
its small result back, so a key with a third of all rows is a skewed join that AQE splits.

Defined results
- A null text is empty. Empty texts (and texts of white space only) are equal to each other.
- Ties in length of the original text go to the smallest id; a null id comes last.
- Rows that repeat the keeper's id with the same text and length are one document under one
  id: all are kept, and all count in ``group_size``.
- Other columns of the input are not looked at, whatever their names. No rows, no result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from breathline.llm.common import LAST_ID, SPACE, fixed, id_or_last, last_to_null, whole

PREFIX_CHARS = 64


def normal_text(text: Column) -> Column:
    return F.regexp_replace(text, SPACE + "+", "")


def refine(docs: DataFrame, id: str = "doc_id", text: str = "text", digest_all: bool = False,
           prefix_chars: int = PREFIX_CHARS) -> DataFrame:
    """Per row: id, keep_id, group_size, kept and content_sha256 of the normalised text.

    ``content_sha256`` is null for rows that differ from all others in length or prefix,
    unless ``digest_all`` asks for it on every row.
    """
    norm = normal_text(whole(text))
    rows = docs.select(id_or_last(id).alias("id"), whole(text).alias("body"), norm.alias("norm"))
    keyed = rows.select(
        "id", "norm", F.char_length("body").alias("chars"), F.octet_length("norm").alias("bytes"),
        F.xxhash64(F.substring("norm", 1, prefix_chars)).alias("prefix"),
    )

    # each small result is a table of its own, so that joins deal out both sides and AQE can split a hot key
    same_length = fixed(keyed.groupBy("bytes").count().where("count > 1").select("bytes"))
    same_prefix = fixed(
        keyed.select("bytes", "prefix").join(same_length, "bytes", "left_semi")
        .groupBy("bytes", "prefix").count().where("count > 1")
        .select("bytes", "prefix", F.lit(True).alias("alike"))
    )
    hashed = keyed.join(same_prefix, ["bytes", "prefix"], "left").select(
        "id", "chars", "bytes", "prefix", F.coalesce("alike", F.lit(False)).alias("alike"),
        (F.sha2("norm", 256) if digest_all else F.when(F.col("alike"), F.sha2("norm", 256))).alias("content_sha256"),
    )
    hashed = fixed(hashed)

    # the largest (chars, -id) of a group is its keeper; -1 - id keeps the order without overflow
    groups = fixed(
        hashed.where("alike").groupBy("bytes", "prefix", "content_sha256")
        .agg(F.count("*").alias("n"), F.max(F.struct("chars", (F.lit(-1) - F.col("id")).alias("back"))).alias("best"))
        .where("n > 1")
        .select("bytes", "prefix", "content_sha256", "n", F.col("best.chars").alias("keep_chars"),
                (F.lit(-1) - F.col("best.back")).alias("keeper"))
    )
    joined = hashed.join(groups, ["bytes", "prefix", "content_sha256"], "left")
    keeper = F.coalesce("keeper", "id")
    return joined.select(
        last_to_null(F.col("id")).alias(id),
        last_to_null(keeper).alias("keep_id"),
        F.coalesce("n", F.lit(1)).cast("long").alias("group_size"),
        (F.col("keeper").isNull() | ((F.col("id") == F.col("keeper")) & (F.col("chars") == F.col("keep_chars")))).alias("kept"),
        "content_sha256",
    )


def deduplicated(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    gone = (
        refine(docs, id, text).where(~F.col("kept"))
        .select(F.coalesce(id, F.lit(LAST_ID)).alias("gone_id")).distinct()
    )
    return docs.join(gone, F.coalesce(docs[id].cast("long"), F.lit(LAST_ID)) == gone["gone_id"], "left_anti")
