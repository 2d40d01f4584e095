"""Benchmark decontamination against alignment of every probe with every text."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from breathline.llm import qgram_filter as qf
from breathline.llm import queries


def plain(text):
    out = []
    for c in text:
        low = (c.lower() if len(c.lower()) == 1 else c) if c.isalnum() else " "
        if low != " " or (out and out[-1] != " "):
            out.append(low)
    return "".join(out).strip(" ")


def fewest_edits(probe, text):
    """Of a stretch of ``text``, any at all, to ``probe``; rows of the full alignment."""
    codes = np.array([ord(c) for c in text], dtype=np.int64)
    row = np.zeros(len(codes) + 1, dtype=np.int64)
    for n, c in enumerate(probe, 1):
        new = np.r_[n, np.minimum(row[:-1] + (codes != ord(c)), row[1:] + 1)]
        row = np.minimum.accumulate(new - np.arange(len(new))) + np.arange(len(new))
    return int(row.min())


def probes_of(text, s):
    body = plain(text)
    if len(body) < max(s.least, s.q):
        return []
    last = max(0, len(body) - s.probe)
    return [body[a:a + s.probe] for a in sorted({*range(0, last, s.step), last})]


def brute(docs, items, s):
    found = {}
    for d, (i, t) in enumerate(docs):
        body = plain(t or "")
        for n, (j, u) in enumerate(items):
            edits = [fewest_edits(p, body) for p in probes_of(u or "", s) if body]
            good = [e for e, p in zip(edits, probes_of(u or "", s), strict=False) if e <= int(len(p) * s.rate)]
            if good:
                found[d, n] = (i, j, min(good))
    return found


def edited(rng, text, n):
    for _ in range(n):
        at = rng.randrange(len(text))
        text = rng.choice([text[:at] + text[at + 1:], text[:at] + rng.choice("abcxyz") + text[at:], text[:at] + rng.choice("éq") + text[at + 1:]])
    return text


def test_normalised_places_lead_back():
    text = "  Ab,\n\tC--d É\U0001F600 9İ "
    codes, places = qf.normalised(text)
    assert "".join(map(chr, codes)) == plain(text)
    assert all(not c.isalnum() or text[p] == c or text[p].lower() == c for c, p in zip(map(chr, codes), places, strict=True))


@pytest.mark.parametrize("seed", [1, 2])
def test_agrees_with_full_alignment(spark, seed):
    rng = random.Random(seed)
    words = ["".join(rng.choice("aeiourst") for _ in range(rng.randrange(2, 8))) for _ in range(60)]
    say = lambda n: " ".join(rng.choice(words) for _ in range(n))
    items = [(i, say(rng.randrange(7, 45)).capitalize() + ".") for i in range(8)] + [(90, "too short"), (91, None), (92, "")]
    docs = []
    for i in range(40):
        body = say(rng.randrange(0, 60))
        if rng.random() < 0.7:
            passage = rng.choice(items[:8])[1]
            a = rng.choice([0, 0, len(passage) // 3])
            passage = edited(rng, passage[a:], rng.choice([0, 0, 1, 4, 8, 12, 20]))
            at = rng.randrange(len(body) + 1)
            body = body[:at] + rng.choice([" ", "\n", ", "]) + passage + " " + body[at:]
        docs.append((i, body))
    docs += [(200, None), (201, ""), (202, " \n"), (None, items[0][1]), (203, items[1][1]), (203, items[1][1])]
    s = qf.Settings()
    expected = sorted(map(str, brute(docs, items, s).values()))
    frame = spark.createDataFrame([(i, t, "x") for i, t in docs], "doc_id long, text string, item_id string").withColumn("begin", F.lit(0))
    bench = spark.createDataFrame(items, "item_id long, text string")
    for block_chars in (qf.BLOCK_CHARS, 300):
        got = qf.contaminated(frame, bench, block_chars=block_chars).select("doc_id", "item_id", "edits").collect()
        assert sorted(map(str, map(tuple, got))) == expected
    clean = qf.decontaminated(frame, bench)
    assert clean.columns == frame.columns
    hit = {d for d, _ in brute(docs, items, s)}
    assert sorted(map(str, [r["doc_id"] for r in clean.collect()])) == sorted(str(i) for d, (i, _) in enumerate(docs) if d not in hit)


def test_spans_cover_the_passage(spark):
    item = "Of the seven little boats that left the harbour in the morning, only one returned before the storm."
    text = "clean words come first. " * 30 + item.upper() + " and more clean words follow" * 3000
    row = qf.contaminated(spark.createDataFrame([(1, text)], "doc_id long, text string"),
                          spark.createDataFrame([(5, item)], "item_id long, text string")).collect()
    assert len(row) == 1 and row[0]["edits"] == 0 and text[row[0]["begin"]:row[0]["end"]] == item.upper().rstrip(".")


def test_two_halves_in_two_texts_are_no_match(spark):
    item = "a passage whose first half ends one text and whose second half begins the next one in line"
    docs = spark.createDataFrame([(1, "z " + item[:45]), (2, item[45:] + " z")], "doc_id long, text string").coalesce(1)
    assert qf.contaminated(docs, spark.createDataFrame([(5, item)], "item_id long, text string")).count() == 0


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "text")], "doc_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    some = spark.createDataFrame([(1, "long enough to be looked for in all of the documents")], none.schema)
    assert qf.contaminated(docs, none).count() == 0 and qf.decontaminated(docs, none).count() == 1
    assert qf.contaminated(docs.limit(0), some).count() == 0 and qf.decontaminated(docs.limit(0), some).count() == 0


def test_query_against_full_alignment(spark):
    sf = "/root/testdata/sf0.001"
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{sf}/benchmark.parquet").select("item_id", "text").collect()]
    s, got = qf.Settings(), {}
    for r in queries.op3_decontaminate(spark, sf).collect():
        got[r["doc_id"], r["item_id"]] = r["edits"]
    bodies = {i: plain(t or "") for i, t in docs}
    joined = "\0".join(bodies.values())
    for j, u in items:
        within = any(fewest_edits(p, joined) <= int(len(p) * s.rate) for p in probes_of(u, s))
        assert within == any(k == j for _, k in got)
        assert all(((i, j) in got) for i, b in bodies.items() if plain(u) in b)
    for (i, j), edits in got.items():
        assert min(fewest_edits(p, bodies[i]) for p in probes_of(dict(items)[j], s)) == edits
    assert got


def test_quotes_cut_anywhere_from_items(spark):
    """Quotes of at least a probe and a step are found, with an edit too; what shares only half of that is left."""
    sf, rng = "/root/testdata/sf0.01", random.Random(7)
    items = [tuple(r) for r in spark.read.parquet(f"{sf}/benchmark.parquet").select("item_id", "text").collect()]
    long = [(i, t) for i, t in items if len(plain(t or "")) > 150]
    docs, wanted = [], {}
    for n, (i, t) in enumerate(long):
        for chars, edits in ((qf.PROBE_CHARS + qf.PROBE_STEP, 0), (100, 0), (100, 2)):
            body = plain(t)
            at = rng.randrange(len(body) - chars + 1)
            quote = edited(rng, body[at:at + chars], edits)
            docs.append((len(docs), "clean words come first " * 5 + "and " + quote + " then clean words follow"))
            wanted[len(docs) - 1] = (i, chars, edits)
        body = plain(t)
        docs.append((10_000 + n, "clean words come first " + body[:30] + " then clean words follow"))
    got = {(r["doc_id"], r["item_id"]) for r in qf.contaminated(
        spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()}
    missed = [w for d, w in wanted.items() if (d, w[0]) not in got]
    assert not [w for w in missed if w[2] == 0] and len(missed) <= 0.1 * len(long)
    assert not [d for d, _ in got if d >= 10_000]
