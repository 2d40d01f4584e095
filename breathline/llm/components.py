"""Connected components by alternating large and small stars.

Every round joins each edge with its node's smallest neighbour; both the minimum (summed
before the shuffle) and the join stand a node with very many neighbours. Rounds are cut by
checkpoints, and only a row count and a sum of hashes per round reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from breathline.llm.common import fixed


def _toward_least(pairs: DataFrame) -> DataFrame:
    """Each node's smallest neighbour or itself, beside its pairs."""
    least = pairs.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return pairs.join(least, "u")


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def connected(edges: DataFrame) -> DataFrame:
    """``edges`` (a, b), in any direction and repeated or not -> (node, root), root the least node.

    Nodes without an edge to another node are not in the result.
    """
    now = fixed(
        edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct()
    )
    state = _state(now)
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _toward_least(both).where("v > u and v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = _toward_least(large.where("u > v"))
        now = fixed(
            small.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(small.select("u", F.col("m").alias("v"))).where("u <> v").distinct()
        )
        before, state = state, _state(now)
        if state == before:
            break
    roots = now.groupBy("u").agg(F.min("v").alias("root"))
    return roots.select(F.col("u").alias("node"), "root").unionByName(
        roots.select(F.col("root").alias("node"), "root").distinct())
