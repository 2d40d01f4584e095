"""SimHash near-dedup, its code and its components against brute force."""

import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from breathline.llm import golay, queries, simhash
from breathline.llm.components import connected

LAST = (1 << 63) - 1


def plain_fingerprint(text, shingle=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i:i + shingle]) for i in range(len(words) - shingle + 1)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints, bits=2):
    """Ids with fingerprints -> smallest id reachable, by all pairs."""
    at = list(range(len(prints)))

    def root(i):
        while at[i] != i:
            i = at[i]
        return i

    values = np.array([p for _, p in prints], dtype=np.uint64)
    for i in range(len(prints)):
        for j in np.nonzero(np.bitwise_count(values ^ values[i]) <= bits)[0]:
            a, b = sorted((root(i), root(int(j))))
            at[b] = a
    least = {}
    for i, (doc, _) in enumerate(prints):
        least[root(i)] = min(least.get(root(i), LAST), doc)
    return [least[root(i)] for i in range(len(prints))]


def test_golay_code_is_perfect():
    words = np.arange(1 << 23, dtype=np.int64)[:: 997]
    numbers = golay.decode(words)
    codewords = np.array([int(n) << 11 | golay.remainder(int(n) << 11) for n in numbers])
    assert all(golay.remainder(int(c)) == 0 for c in codewords[:500])
    assert np.bitwise_count(words ^ codewords).max() == 3


def test_words_within_two_bits_share_a_number():
    rng = random.Random(1)
    for _ in range(300):
        a = rng.getrandbits(23)
        b = a ^ (1 << rng.randrange(23)) ^ rng.choice([0, 1 << rng.randrange(23)])
        rows, numbers = golay.near_codewords(np.array([a, b], dtype=np.int64))
        mine, theirs = set(numbers[rows == 0]), set(numbers[rows == 1])
        assert mine & theirs and len(mine) in (1, 6)


def test_fingerprints_within_two_bits_share_a_key():
    rng = random.Random(2)
    for _ in range(300):
        a = rng.getrandbits(64)
        b = a ^ (1 << rng.randrange(64)) ^ rng.choice([0, 1 << rng.randrange(64)])
        rows, keys = simhash.keys_of(np.array([a, b], dtype=np.uint64))
        assert set(keys[rows == 0]) & set(keys[rows == 1])
        assert max(np.bincount(rows)) <= 18


@pytest.mark.parametrize("text", ["", None, " \t\n", "One", "one TWO", "A b\x0bc d", "É é É é x", "a a a a a a", "w " * 70_000 + "z"])
def test_fingerprint_of_text(text):
    assert simhash.fingerprint((text or "").encode()) == plain_fingerprint(text)


@pytest.mark.parametrize("bits,bucket", [(2, 16), (2, 1), (1, 16), (1, 1), (0, 16)])
def test_links_connect_what_all_pairs_connect(spark, bits, bucket):
    rng = random.Random(bits + bucket)
    prints = [0, (1 << 64) - 1]
    for _ in range(12):
        prints.append(rng.getrandbits(64))
        for _ in range(12):
            prints.append(rng.choice(prints[-12:]) ^ (1 << rng.randrange(64)) ^ rng.choice([0, 1 << rng.randrange(64)]))
    prints = sorted(set(prints))
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    found = simhash.links(spark.createDataFrame([(p,) for p in signed], "fp long"), bits, bucket)
    for a, b in found.collect():
        assert 1 <= ((a ^ b) & ((1 << 64) - 1)).bit_count() <= bits
    roots = {r["node"]: r["root"] for r in connected(found).collect()}
    expected = plain_components(list(zip(signed, prints, strict=True)), bits)
    assert [roots.get(p, p) for p in signed] == expected


def test_components_of_a_path_and_a_hub(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(5, 200 + i) for i in range(300)] + [(7, 7)]
    roots = {r["node"]: r["root"] for r in connected(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert roots == {i: 100 for i in range(100, 161)} | {200 + i: 5 for i in range(300)} | {5: 5}
    assert connected(spark.createDataFrame([], "a long, b long")).count() == 0


def test_odd_rows(spark):
    base = " ".join("word%d" % i for i in range(200))
    rows = [(4, base), (2, base), (2, base), (9, base + " more"), (None, None), (7, ""), (8, " \n"), (11, "lone text"), (None, "lone text")]
    docs = spark.createDataFrame([(i, t, "x", "y") for i, t in rows], "doc_id long, text string, fp string, id string")
    for name in ("least", "root", "component", "node", "stay_id", "key", "a"):
        docs = docs.withColumn(name, F.lit(1))
    found = simhash.near_duplicates(docs).collect()
    prints = [(LAST if i is None else i, plain_fingerprint(t)) for i, t in rows]
    expected = [(i, p - (1 << 64) if p >> 63 else p, None if c == LAST else c)
                for (i, _), (_, p), c in zip(rows, prints, plain_components(prints), strict=True)]
    assert sorted(map(str, map(tuple, found))) == sorted(map(str, expected))
    kept = simhash.one_of_each(docs)
    assert kept.columns == docs.columns and {r[0] for r in kept.collect()} >= {2, 7, 11} and kept.where("doc_id = 8").count() == 0
    assert simhash.near_duplicates(docs.limit(0)).count() == 0


def test_query_against_all_pairs(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()
    prints = [(r[0], plain_fingerprint(r[1])) for r in docs]
    expected = [(d, f"{p:016x}", c) for (d, p), c in zip(prints, plain_components(prints), strict=True)]
    assert sorted(map(tuple, queries.op5_simhash(spark, sf).collect())) == expected
    assert len({c for *_, c in expected}) < len(expected)
