"""Mixing sources to target weights by systematic sampling.

Each source has a target in words, and each of its documents the same expected number of
copies, target / source size. Along a fixed order of the source's documents these add up;
with one random offset per source, a document is emitted once for each integer its stretch
of the sum crosses. The order goes by size class first, so that the words taken come near
the target, and within a class by a hash of the id.

The sum up to a document is its rank times the expected copies, so only ranks are needed.
They are built from three levels, none of which holds a source: classes of a source, hash
cells of a class, and documents of a cell (at most ``CELL_ROWS`` on average).

Defined results
- Size counts the words of the text; a null text has none. Documents without words take 0.
- Sources are ordered by code point, null last, and weigh 3, 1, 2, repeating.
- A source without words has target 0. No documents, no result.
- A null id sorts as an empty one; rows that repeat an id are documents of their own.
- The offset and the order come from MD5 of the names, so reruns agree.
- The input row is carried in ``row``, whatever its columns are called.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from breathline.llm.common import WORD, fixed, whole

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST_COPIES = 2
CELL_ROWS = 16_384


def words_in(text: str) -> Column:
    return F.regexp_count(whole(text), F.lit(WORD)).cast("long")


def source_targets(totals: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE,
                   most: int = MOST_COPIES) -> DataFrame:
    """``totals`` (source, source_size) with each source's target.

    Sharing by weight with a stop for each source is a common level: a source gets its
    weight times the level, or its stop if that is less. In the order of stop / weight the
    stopped sources come first, so the level follows from sums before and after a source;
    past the first source below its stop that figure only falls, so the largest is right.
    One row per source passes through one task here.
    """
    named = Window.orderBy(F.col("source").asc_nulls_last())
    number = (F.row_number().over(named) - 1) % len(weights)
    weighted = totals.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), number + 1)).withColumn(
        "stop", most * F.col("source_size"))
    order = [F.col("stop") / F.col("weight"), F.col("source").asc_nulls_last()]
    before = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    rest = Window.orderBy(*order).rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.partitionBy()
    level = (F.sum("source_size").over(everything) * F.lit(float(share)) - F.coalesce(F.sum("stop").over(before), F.lit(0))) / F.sum("weight").over(rest)
    levelled = weighted.withColumn("level", level).withColumn("fits", F.col("level") * F.col("weight") <= F.col("stop"))
    common = F.max(F.when(F.col("fits"), F.col("level"))).over(everything)
    return levelled.withColumn("common", common).select(
        "source", "source_size",
        F.least(F.col("stop").cast("double"), F.coalesce(F.col("common") * F.col("weight"), F.col("stop").cast("double"))).alias("target"),
    )


def sample_mix(docs: DataFrame, id: str = "doc_id", text: str = "text", source: str = "source",
               weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST_COPIES,
               seed: str = "mix", cell_rows: int = CELL_ROWS, carry: list[str] | None = None) -> DataFrame:
    """``row`` (the input row, or its columns in ``carry``), size, source_size, target, copies and taken of each document."""
    digits, rows = 0, docs.count()
    while rows > cell_rows * 16**digits:
        digits += 1
    sized = docs.select(
        F.struct(*(F.col(f"`{c}`") for c in carry or docs.columns)).alias("row"), F.col(source).alias("source"),
        F.coalesce(F.concat(F.lit("="), F.col(source)), F.lit("")).alias("src"), words_in(text).alias("size"),
        F.coalesce(F.col(id).cast("string"), F.lit("")).alias("name"),
    ).select(
        "*", F.floor(F.log(F.col("size") + 1) * 8).cast("int").alias("cls"), F.md5("name").alias("spot"),
    ).withColumn("cell", F.substring("spot", 1, digits) if digits else F.lit(""))

    cells = fixed(sized.groupBy("src", "source", "cls", "cell").agg(F.count("*").alias("n"), F.sum("size").alias("words")))
    classes = cells.groupBy("src", "source", "cls").agg(F.sum("n").alias("n"), F.sum("words").alias("words"))
    totals = source_targets(
        classes.groupBy("src", "source").agg(F.sum("words").alias("source_size")), weights, share, most
    ).withColumn("src", F.coalesce(F.concat(F.lit("="), "source"), F.lit(""))).drop("source")

    earlier = (Window.unboundedPreceding, -1)
    class_start = classes.select(
        "src", "cls",
        F.coalesce(F.sum("n").over(Window.partitionBy("src").orderBy("cls").rowsBetween(*earlier)), F.lit(0)).alias("class_start"),
    )
    cell_start = cells.select(
        "src", "cls", "cell",
        F.coalesce(F.sum("n").over(Window.partitionBy("src", "cls").orderBy("cell").rowsBetween(*earlier)), F.lit(0)).alias("cell_start"),
    )
    starts = cell_start.join(class_start, ["src", "cls"]).select(
        "src", "cls", "cell", (F.col("class_start") + F.col("cell_start")).alias("start"))

    in_cell = F.row_number().over(Window.partitionBy("src", "cls", "cell").orderBy("spot", "name", "size")) - 1
    ranked = (
        sized.withColumn("in_cell", in_cell).join(starts, ["src", "cls", "cell"]).join(totals, "src")
        .withColumn("rank", F.col("start") + F.col("in_cell"))
    )
    offset = F.conv(F.substring(F.md5(F.concat(F.lit(seed), "src")), 1, 5), 16, 10).cast("double") / float(16**5)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    crossed = ranked.withColumn("rate", rate).withColumn("offset", offset).withColumn(
        "copies", (F.floor(F.col("rate") * (F.col("rank") + 1) + F.col("offset")) - F.floor(F.col("rate") * F.col("rank") + F.col("offset"))).cast("long"))
    return crossed.select("row", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))


def emitted(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: the rows of ``docs``, each as often as it is taken."""
    return (
        sample_mix(docs, **options).where("copies > 0")
        .select("row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select("row.*")
    )
