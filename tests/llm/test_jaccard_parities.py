"""Parities of sets: what they let through, and what they spare the join."""

import numpy as np
from pyspark.sql import functions as F

from breathline.llm import jaccard as j


def pair(rng, n, common):
    x = rng.integers(-2**63, 2**63 - 1, 2 * n - common)
    return np.sort(x[:n]), np.sort(x[n - common:])


def passed(spark, pairs):
    rows = [(i, len(a), len(b), j.parities(a).tolist(), j.parities(b).tolist()) for i, (a, b) in enumerate(pairs)]
    df = spark.createDataFrame(rows, "i long, na long, nb long, bits_a array<long>, bits_b array<long>")
    return {r["i"] for r in df.where(j._alike(F.col("na"), F.col("nb"), j.PERCENT)).collect()}


def test_every_link_passes_and_what_differs_does_not(spark):
    rng = np.random.default_rng(4)
    sizes = [1, 2, 7, 45, 200, 400, 2500] * 20
    links = [pair(rng, n, int(j.needed(n, n))) for n in sizes]
    assert passed(spark, links) == set(range(len(links)))
    shorter = [(a, b[np.sort(rng.permutation(len(b))[:-(-85 * len(b) // 100)])]) for a, b in ((a, a) for a, _ in links)]
    assert passed(spark, shorter) == set(range(len(shorter)))
    # near copies with 0.63 of their elements in common, as on the check's input of one large group
    near = [pair(rng, n, 2 * n * 63 // 163) for n in (100, 200, 400) for _ in range(100)]
    assert len(passed(spark, near)) <= 3


def test_parities_count_every_element():
    assert j.parities(np.zeros(0, dtype=np.int64)).tolist() == [0] * (j.BITS // 64)
    x = np.arange(-300, 700, dtype=np.int64)
    assert sum(int(w).bit_count() for w in j.parities(x).view(np.uint64)) == sum(np.bincount(x % j.BITS) % 2)
