"""Vector codes against a full search, and the tree's bounds."""

import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from breathline.llm import queries, vectorcode as vc

SCHEMA = "vec_id long, embedding array<float>, label int"


def plain(rows, parts=16, entries=64, rounds=2):
    """(id, vector, label) rows -> (id, code, error, label_error, digest), by comparing with every entry."""
    rows = [(i, [math.floor(256 * float(np.float32(x))) for x in v], g) for i, v, g in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    rows.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    width = len(rows[0][1]) // parts
    cut = [[v[p * width:(p + 1) * width] for p in range(parts)] for _, v, _ in rows]
    books = [[list(c[p]) for c in cut[:entries]] for p in range(parts)]

    def nearest(p, x):
        return min((sum((a - b) ** 2 for a, b in zip(x, e, strict=True)), i) for i, e in enumerate(books[p]))

    for _ in range(rounds):
        new = []
        for p in range(parts):
            groups = {}
            for c in cut:
                groups.setdefault(nearest(p, c[p])[1], []).append(c[p])
            new.append([[sum(col) // len(groups[i]) for col in zip(*groups[i], strict=True)] if i in groups else e for i, e in enumerate(books[p])])
        books = new
    out, sums = [], {}
    for (i, _, g), c in zip(rows, cut, strict=True):
        found = [nearest(p, c[p]) for p in range(parts)]
        out.append((i, "".join(f"{e:02x}" for _, e in found), sum(d for d, _ in found), g))
        sums[g] = sums.get(g, 0) + out[-1][2]
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return sorted(((i, code, err, sums[g], digest) for i, code, err, g in out), key=str)


def got(df):
    return sorted((tuple(r) for r in df.select("vec_id", "code", "error", "label_error", "codebooks_sha256").collect()), key=str)


@pytest.mark.parametrize("n,spread,width", [(64, 30, 4), (64, 2, 4), (64, 10**6, 3), (200, 50, 2), (9, 5, 1), (1, 9, 2), (64, 0, 4)])
def test_tree_finds_what_a_full_search_finds(n, spread, width):
    rng = np.random.default_rng(n + spread)
    entries = rng.integers(-spread, spread + 1, (n, width))
    queries_ = np.concatenate([rng.integers(-spread - 2, spread + 3, (3000, width)), entries])
    squares = ((queries_[:, None] - entries[None]) ** 2).sum(axis=2)
    at, best = vc.Gnat(entries).nearest(queries_)
    assert (at == squares.argmin(axis=1)).all() and (best == squares.min(axis=1)).all()


def test_tree_rules_out_entries():
    rng = np.random.default_rng(1)
    entries = rng.integers(-100, 101, (64, 4))
    some = entries[rng.integers(0, 64, 1000)] + rng.integers(-5, 6, (1000, 4))
    best, at = np.full(1000, np.iinfo(np.int64).max), np.full(1000, 64)
    assert vc.Gnat(entries).search(some, best, at, np.arange(1000)) < 0.6 * 64 * 1000


def test_query_agrees_with_a_full_search(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    assert got(queries.op13_vector_codes(spark, sf)) == plain(rows)


def test_odd_rows(spark):
    rng = random.Random(3)
    vector = lambda: [rng.choice([-1.0, 0.0, 0.5, rng.uniform(-2, 2)]) for _ in range(32)]
    same = vector()
    rows = [(i, vector(), rng.choice([1, 2, None])) for i in range(70)] + [(i, same, 5) for i in range(100, 400)]
    rows += [(None, vector(), 1), (None, vector(), None), (5, vector(), 2), (5, rows[5][1], 2)]
    bad = [(500, None, 1), (501, [None, *vector()[1:]], 1), (-3, [float("nan"), *vector()[1:]], 1), (503, [*vector()[1:], float("-inf")], 1)]
    df = spark.createDataFrame(rows + bad, SCHEMA).repartition(5)
    for name in ("id", "v", "code", "error", "part", "entry", "k", "of"):
        df = df.withColumn(name, F.lit("q"))
    assert got(vc.compress(df)) == plain(rows)
    assert got(vc.compress(df, parts=4, entries=7, rounds=3)) == plain(rows, 4, 7, 3)
    other = [(-9, [], 1), (-8, [1.0], 1), (-7, [1e30] + [0.0] * 31, 1), (0, vector(), 1), (1, [0.0] * 16, 1)]
    mixed = {r["vec_id"]: r for r in vc.compress(spark.createDataFrame(other, SCHEMA)).collect()}
    assert len(mixed) == 5 and all((mixed[i]["code"] is None) == (i != 0) for i in mixed)
    assert mixed[0]["error"] == mixed[-9]["label_error"] == 0
    assert vc.compress(spark.createDataFrame([], SCHEMA)).collect() == []
    assert vc.compress(spark.createDataFrame([(1, None, 1)], SCHEMA)).collect() == []
