"""From raw documents to a training mix: five operators, each on all that the one before kept.

Every stage takes (spark, docs, sf_dir) and returns rows with the columns of ``docs``; the
last returns each document as often as the mix takes it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from breathline.llm import kneser_ney, lines, qgram_filter, sampling, simhash
from breathline.llm.common import discarded, table, written


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose perplexity is above their language's threshold go."""
    return kneser_ney.well_written(docs, table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that an earlier document holds go; a text that loses some gets its new length."""
    kept = lines.drop_repeated_lines(docs)
    new = {"text": F.col("kept_text"), "n_chars": F.char_length("kept_text").cast("long")}
    lost = F.col("n_dropped") > 0
    return kept.select(*(
        F.when(lost, new[c]).otherwise(F.col(f"row.`{c}`")).alias(c) if c in new else F.col(f"row.`{c}`") for c in docs.columns))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest id stays."""
    return simhash.one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of the benchmark go."""
    return qgram_filter.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's target takes it."""
    return sampling.emitted(docs)


STAGES = [
    ("quality", quality),
    ("line_dedup", line_dedup),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mix", mix),
]

#: Fingerprints, perplexities and alignments have no form in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again by the next."""
    docs, path = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        docs, done = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
        if path:
            discarded(spark, path)
        path = done
    return STAGES[-1][1](spark, docs, sf_dir)
