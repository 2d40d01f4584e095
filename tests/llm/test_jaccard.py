"""The Jaccard join against all pairs, and the bounds that its lists rest on."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from breathline.llm import jaccard, queries

LAST = (1 << 63) - 1
SF = "/root/testdata/sf0.001"


def plain_set(text, shingle=4):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return frozenset()
    return frozenset(" ".join(words[i:i + shingle]) for i in range(len(words) - shingle + 1)) or frozenset([" ".join(words)])


def plain(rows, percent=85, shingle=4):
    """(id, text) -> rows of (id, n, smallest id reachable), by all pairs that share an element."""
    sets = [plain_set(t, shingle) for _, t in rows]
    at = list(range(len(rows)))

    def root(i):
        while at[i] != i:
            i = at[i]
        return i

    lists = {}
    for i, s in enumerate(sets):
        for e in s:
            lists.setdefault(e, []).append(i)
    for i, s in enumerate(sets):
        for j in {j for e in s for j in lists[e] if j > i}:
            both = len(s & sets[j])
            if 100 * both >= percent * (len(s) + len(sets[j]) - both):
                a, b = sorted((root(i), root(j)))
                at[b] = a
    least = {}
    for i, (doc, _) in enumerate(rows):
        least[root(i)] = min(least.get(root(i), LAST), LAST if doc is None else doc)
    return sorted(((doc, len(sets[i]), least[root(i)]) for i, (doc, _) in enumerate(rows)), key=str)


def got(df):
    return sorted(((r["doc_id"], r["n_shingles"], LAST if r["component_id"] is None else r["component_id"]) for r in df.collect()), key=str)


@pytest.mark.parametrize("percent", [51, 70, 85, 99])
def test_sets_that_link_may_link(percent):
    """Pairs at the very edge: as many other elements as a link allows, at any places."""
    rng = random.Random(percent)
    for _ in range(300):
        n = rng.choice([*range(1, 40), 100, 300, 1000])
        t = rng.randrange(-(-percent * n // 100), 100 * n // percent + 1)
        common = min(n, t, jaccard.needed(n, t, percent))
        places = rng.sample(range(10 ** 6), n + t - common)
        if rng.random() < 0.5:  # the other set's own elements come first, or this one's
            places.sort(reverse=rng.random() < 0.5)
        mine, theirs = sorted(places[:n]), sorted(places[n - common:])
        seen = set(theirs[:jaccard.reach(t, percent)])
        shared = np.array([i for i, e in enumerate(mine[:jaccard.reach(n, percent)]) if e in seen])
        assert jaccard.may_link(n, shared, percent)
    assert not jaccard.may_link(100, np.arange(10)) and not jaccard.may_link(2000, np.arange(0, 600, 6))


def test_query_agrees_with_all_pairs(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    df = queries.op11_jaccard_join(spark, SF)
    assert df.columns == ["doc_id", "n_shingles", "component_id"]
    assert got(df) == plain(rows)


@pytest.mark.parametrize("seed,most", [(1, None), (2, 0), (3, 14), (4, 20)])
def test_edited_texts_of_all_sizes(spark, monkeypatch, seed, most):
    """Groups of edited copies, short and long, a line that half of all texts hold, whatever the boundary."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    line = rng.choices(words, k=14)
    rows = []
    for _ in range(40):
        base = rng.choices(words, k=rng.choice([3, 6, 9, 12, 14, 17, 20, 25, 33, 60, 120, 400]))
        for _ in range(rng.choice([1, 2, 6, 12])):
            copy = list(base)
            for _ in range(rng.choice([0, 1, 1, 2, len(base) // 40])):
                copy[rng.choice([0, -1, rng.randrange(len(copy))])] = rng.choice(words)
            if rng.random() < 0.5:
                copy = copy + line
            rows.append((len(rows), rng.choice([" ", "\n", " \t "]).join(w.upper() if rng.random() < 0.1 else w for w in copy)))
    monkeypatch.setattr(jaccard, "TILE", 2 + seed % 3 * 30)
    if most is not None:
        monkeypatch.setattr(jaccard, "boundary", lambda sizes, percent: most)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    assert got(jaccard.similar(df)) == plain(rows)
    if seed == 2:
        monkeypatch.setattr(jaccard, "BROADCAST_IDS", -1)
        assert got(jaccard.similar(df, percent=70, shingle=2)) == plain(rows, 70, 2)


def test_odd_rows(spark):
    rng = random.Random(8)
    long = " ".join(rng.choices([f"w{i}" for i in range(3000)], k=60_000))
    same = " ".join(f"x{i}" for i in range(100))
    rows = [(9, None), (8, ""), (7, " \t\n"), (6, "One two"), (5, "one  TWO"), (4, "É one"), (3, "é one"), (None, "one two"), (None, None),
            (20, long), (19, long + " end"), (18, long.upper()), (17, same), (17, same), (17, "another text of one id"), (None, same + " y"), (2, "wörd " * 50)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for name in ("id", "n", "key", "seen", "c", "least", "e", "a", "b", "set", "g"):
        df = df.withColumn(name, F.lit("q"))
    assert got(jaccard.similar(df)) == plain(rows)
    none = spark.createDataFrame([], "doc_id long, text string")
    assert jaccard.similar(none).collect() == []
    only_nulls = spark.createDataFrame([(None, "a b c d e")] * 2, "doc_id long, text string")
    assert got(jaccard.similar(only_nulls)) == [(None, 2, LAST)] * 2


def test_boundary_by_cost():
    assert jaccard.boundary({}) == 0
    few, many = jaccard.boundary({5: 10, 30: 1}), jaccard.boundary({n: 100 for n in range(1, 41)})
    assert 5 <= few < 30 and 5 <= many < 20
    assert jaccard.subset_count(13, 40) == 13 + 13 + 1 + 1
