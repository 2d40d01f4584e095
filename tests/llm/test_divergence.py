"""The source audit against dictionaries, and its trees against plain sums."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from breathline.llm import divergence as dv

SCHEMA = "doc_id long, text string, lang string, source string"


def plain(rows, min_docs=30, top=50):
    """(text, lang, source) -> the audit's rows, with Python integers."""
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    counts, docs, groups = {}, {}, {}
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        found = [t.translate(lower) for t in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text or "")]
        groups.setdefault(lang, set()).add(source)
        for t in found:
            counts[lang, source, t] = counts.get((lang, source, t), 0) + 1
        for t in set(found):
            docs[lang, t] = docs.get((lang, t), 0) + 1
    out = []
    for lang, sources in groups.items():
        kept = [t for (g, t), n in docs.items() if g == lang and n >= min_docs]

        def rates(get):
            n = {t: get(t) for t in kept}
            return {t: 1 + 10**9 * (n[t] + 5) // (sum(n.values()) + 5 * len(kept)) for t in kept}

        p = {s: rates(lambda t: counts.get((lang, s, t), 0)) for s in sources}
        q = rates(lambda t: sum(counts.get((lang, s, t), 0) for s in sources))
        for s in sources:
            pairs = [(sum(abs(p[s][t] - p[o][t]) for t in kept), o) for o in sources if o != s]
            terms = [(p[s][t] - q[t], t) for t in kept if counts.get((lang, s, t)) and p[s][t] > q[t]]
            for part, items, most in (("pair", pairs, len(pairs)), ("term", terms, top)):
                items.sort(key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, item, value, i + 1) for i, (value, item) in enumerate(items[:most])]
    return sorted(out)


def got(df):
    return sorted(tuple(r) for r in df.select("lang", "source", "part", "item", "value", "rank").collect())


def some_rows(seed, n=400, sources=9):
    rng = random.Random(seed)
    words = ["the", "Ünder", "ÜNDER", "river", "RIVER", "x", "日本", "a_b", "don't", "naïve"] + [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(120)]
    weights = [1 / (i + 1) for i in range(len(words))]
    return [(" ".join(rng.choices(words, weights, k=rng.randrange(1, 60))) + rng.choice(["", ".", "\n1 2 3"]),
             rng.choice(["en", "de", None]), rng.choice([None, *(f"s{i}" for i in range(sources))])) for _ in range(n)]


def frame(spark, rows):
    return spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], SCHEMA).repartition(5)


@pytest.mark.parametrize("block,tile,held", [(1 << 12, 64, 400_000), (8, 3, 50), (1, 1, 1)])
def test_agrees_with_dictionaries(spark, monkeypatch, block, tile, held):
    rows = some_rows(1)
    monkeypatch.setattr(dv, "BLOCK", block)
    monkeypatch.setattr(dv, "TILE", tile)
    monkeypatch.setattr(dv, "HELD", held)
    monkeypatch.setattr(dv, "PIECE", 16)
    assert got(dv.audit(frame(spark, rows))) == plain(rows)
    assert got(dv.audit(frame(spark, rows), min_docs=3, top=7)) == plain(rows, 3, 7)


def test_odd_rows(spark):
    rows = some_rows(2, 200, 3) + [(None, "en", "empty"), ("", "xx", "a"), ("1 2 3", "xx", "b"), ("once", "yy", None), ("pad " * 50_000, "en", "long"), ("", "", "")]
    rows += [("same text here", "zz", s) for s in ("p", "q") for _ in range(40)]  # equal rates, ties of items
    df = frame(spark, rows)
    for name in ("term", "n", "docs", "v", "slot", "tile", "tiles", "total", "a", "b", "value", "rank", "item", "part", "block", "place"):
        df = df.withColumn(name, F.lit("q"))
    result = got(dv.audit(df))
    assert result == plain(rows)
    assert ("xx", "a", "pair", "b", 0, 1) in result and ("zz", "p", "pair", "q", 0, 1) in result
    assert dv.audit(spark.createDataFrame([], SCHEMA)).collect() == []


def test_rates_are_exact():
    rng = random.Random(4)
    for _ in range(300):
        total = rng.choice([rng.randrange(5, 50), rng.randrange(5, 9 * 10**15)])
        n = rng.choice([0, total - 5, rng.randrange(0, total - 4)])
        assert dv.rate(np.array([n]), total)[0] == 1 + 10**9 * (n + 5) // total


def test_rate_columns_are_exact(spark):
    rng = random.Random(5)
    rows = [(rng.randrange(0, t - 4), t) for t in (rng.choice([rng.randrange(5, 50), rng.randrange(5, 9 * 10**15)]) for _ in range(300))]
    df = spark.createDataFrame(rows, "n long, t long").select("n", "t", dv._rate(F.col("n"), F.col("t")).alias("p"))
    assert all(r["p"] == 1 + 10**9 * (r["n"] + 5) // r["t"] for r in df.collect())


def test_equal_subtrees_are_one_node():
    rng = np.random.default_rng(1)
    block = rng.integers(0, 3, (6, 64))
    leaves = np.concatenate([block, block, np.zeros_like(block)], axis=1)
    leaves = np.pad(leaves, ((0, 0), (0, 64)), constant_values=-1)
    forest = dv.Forest(leaves)
    assert len(forest.levels[5][0]) <= 8  # six groups' blocks, none, all zeros
    totals = leaves.clip(0).sum(axis=1) + 5 * 192
    for a in range(5):
        others = np.arange(a + 1, 6)
        assert forest.prices(a, others, totals).tolist() == [
            int(np.abs(dv.rate(leaves[a, :192], totals[a]) - dv.rate(leaves[b, :192], totals[b])).sum()) for b in others]
