"""Substring dedup against plain loops over all windows."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from breathline.llm import debruijn, wordhash

LAST = (1 << 63) - 1


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def plain(rows, k=13):
    first = {}
    for i, t in rows:
        own, doc = words_of(t), LAST if i is None else i
        for p in range(len(own) - k + 1):
            w = tuple(own[p:p + k])
            first[w] = min(first.get(w, doc), doc)
    out = []
    for i, t in rows:
        own, doc = words_of(t), LAST if i is None else i
        gone = {p + j for p in range(len(own) - k + 1) if first[tuple(own[p:p + k])] < doc for j in range(k)}
        out.append((i, " ".join(w for p, w in enumerate(own) if p not in gone), len(own), len(gone)))
    return out


def some_texts(seed, n=120):
    rng = random.Random(seed)
    words = ["a", "the", "of", "For", "é", "ñandú"] + ["w%d" % i for i in range(400)]
    passages = [[rng.choice(words) for _ in range(rng.randrange(8, 90))] for _ in range(12)]
    passages += [["For"] * 40, ["x", "y"] * 20, ["x", "y", "z"] * 15]
    rows = []
    for i in range(n):
        text = [rng.choice(words) for _ in range(rng.randrange(0, 60))]
        for _ in range(rng.randrange(0, 4)):
            passage = rng.choice(passages)
            a = rng.randrange(0, len(passage) // 2 + 1)
            piece = passage[a:a + rng.randrange(5, 90)] * rng.choice([1, 1, 1, 2])
            if rng.random() < 0.3 and piece:
                piece = [*piece]
                piece[rng.randrange(len(piece))] = "changed%d" % i
            at = rng.randrange(len(text) + 1)
            text[at:at] = piece
        rows.append((rng.choice([i, i, i, i * 7919 % 1000]), rng.choice([" ", "  ", "\n", "\t "]).join(text)))
    return rows


@pytest.mark.parametrize("seed,k,m", [(1, 13, 4), (2, 13, 1), (3, 5, 5), (4, 1, 1), (5, 13, 13)])
def test_agrees_with_all_windows(spark, seed, k, m):
    rows = some_texts(seed)
    got = debruijn.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"), window=k, anchor=m).collect()
    assert sorted(map(tuple, got)) == sorted(plain(rows, k))


def test_odd_rows(spark):
    base = " ".join("w%d" % i for i in range(40))
    rows = [(2, base), (2, base), (2, "start " + base), (1, base + " tail"), (None, base), (None, "own " * 5), (5, None), (6, ""),
            (7, " \n\t"), (8, "twelve words only " * 3), (9, "long " + base * 2000), (10, "long " + base * 2000),
            (11, " ".join("w%d" % i for i in range(12))), (12, "\x1f".join("w%d" % i for i in range(20)))]
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, spot string")
    for name in ("doc", "anchor", "first", "marks", "edge", "edges", "through", "branching", "id"):
        docs = docs.withColumn(name, F.lit("z"))
    got = debruijn.remove_repeats(docs).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, plain(rows)))
    assert debruijn.remove_repeats(docs.limit(0)).count() == 0


def test_word_hashes_follow_words_not_white_space():
    texts = [b"one  two\tthree", b"", b"   ", b"two one\x0bthree ", " one two".encode()]
    hashes, of = wordhash.word_hashes(texts)
    words = [(i, w) for i, t in enumerate(texts) for w in t.split()]
    assert of.tolist() == [i for i, _ in words]
    assert len(set(hashes.tolist())) == len({w for _, w in words})
    assert {w: h for (_, w), h in zip(words, hashes.tolist(), strict=True)} == dict(
        zip([w for _, w in words], hashes.tolist(), strict=True))


def test_least_of_every_width():
    values = np.random.default_rng(3).integers(0, 1000, 50).astype(np.uint64)
    for width in range(1, 14):
        assert debruijn.least_of(values, width).tolist() == [min(values[i:i + width]) for i in range(50 - width + 1)]


@pytest.mark.parametrize("chars", ["ab", "01"])
def test_words_that_cancel_out_in_a_polynomial(spark, chars):
    """A Thue-Morse string and its complement have one hash in every polynomial modulo 2**64."""
    morse = "".join(chars[bin(i).count("1") % 2] for i in range(4096))
    other = "".join(chars[1 - bin(i).count("1") % 2] for i in range(4096))
    around = ["w%d" % i for i in range(12)]
    rows = [(1, " ".join([*around[:6], morse, *around[6:]])), (2, " ".join([*around[:6], other, *around[6:]]))]
    hashes, _ = wordhash.word_hashes([morse.encode(), other.encode(), morse.encode()])
    assert hashes[0] != hashes[1] and hashes[0] == hashes[2]
    got = debruijn.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(map(tuple, got)) == sorted(plain(rows)) and all(r["n_removed"] == 0 for r in got)
