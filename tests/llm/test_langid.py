"""The conditional random field against enumeration, held-out documents and mixed texts."""

import itertools
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from breathline.llm import langid, queries

SF = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def fitted(spark):
    return langid.train(langid.learnable(spark.read.parquet(f"{SF}/documents.parquet")), sample_docs=60)


def plain_marginals(field, emissions):
    states, total, out = range(len(field.langs)), 0.0, np.zeros(emissions.shape)
    for way in itertools.product(states, repeat=len(emissions)):
        s = field.first[way[0]] + sum(emissions[i, w] for i, w in enumerate(way)) + sum(field.change[a, b] for a, b in itertools.pairwise(way))
        p = np.exp(s)
        total += p
        for i, w in enumerate(way):
            out[i, w] += p
    return out / total


@pytest.mark.parametrize("segment", [1, 2, 3, 64])
def test_marginals_agree_with_enumeration(monkeypatch, segment):
    monkeypatch.setattr(langid, "SEGMENT", segment)
    rng = np.random.default_rng(segment)
    field = langid.Field(["a", "b", "c"], np.zeros((1, 3)), rng.normal(size=(3, 3)), rng.normal(size=3))
    lengths = np.array([1, 7, 2, 3, 6, 1, 5])
    emissions = rng.normal(size=(lengths.sum(), 3)) * 2
    got, at = field.marginals(emissions, lengths), 0
    for n in lengths:
        assert got[at:at + n] == pytest.approx(plain_marginals(field, emissions[at:at + n]))
        at += n


def test_long_chain_is_the_same_in_any_segments(monkeypatch):
    rng = np.random.default_rng(9)
    field = langid.Field(["a", "b"], np.zeros((1, 2)), rng.normal(size=(2, 2)), rng.normal(size=2))
    emissions, lengths = rng.normal(size=(5000, 2)), np.array([4000, 1000])
    one = field.marginals(emissions, lengths)
    monkeypatch.setattr(langid, "SEGMENT", 4000)
    assert one == pytest.approx(field.marginals(emissions, lengths))


def test_features_are_those_of_each_word_alone():
    words = ["word", "a", "éa", "漢字", "word"]
    of, bucket = langid.features(words)
    each = [sorted(bucket[of == i].tolist()) for i in range(len(words))]
    assert each[0] == each[4]
    for i, w in enumerate(words):
        assert each[i] == sorted(langid.features([w])[1].tolist())
        n = len(w)
        assert len(each[i]) == 1 + (n + 1) + n + 2 * min(3, n)


def test_held_out_documents(spark, fitted):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    langs = {r["doc_id"]: r["lang"] for r in docs.select("doc_id", "lang").collect()}
    got = langid.identify(docs, fitted).collect()
    assert len(got) == len(langs)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in got)
    held = [r for r in got if r["held_out"]]
    assert sum(langs[r["doc_id"]] == r["lang_pred"] for r in held) / len(held) > 0.995
    assert all(0 <= r["score"] <= 1 and r["lang_pred"] in set(langs.values()) for r in got)


def test_words_of_code_switched_text(spark, fitted):
    docs = [r for r in spark.read.parquet(f"{SF}/documents.parquet").where(langid.held_out("doc_id")).where("doc_id < 2000").orderBy("doc_id").collect()
            if len(r["text"].split()) > 60 and "\n" in r["text"]]
    rng, rows, gold = random.Random(3), [], {}
    for i in range(40):
        words = []
        for r in rng.sample(docs, 4):
            own = [w for w in r["text"].split() if langid.plain_word(w)]
            at = rng.randrange(len(own) - 20)
            words += [(w, r["lang"]) for w in own[at:at + 20]]
        rows.append((i, " ".join(w for w, _ in words)))
        gold |= {(i, p): (w, g) for p, (w, g) in enumerate(words)}
    got = langid.label_words(spark.createDataFrame(rows, "doc_id long, text string"), fitted).collect()
    assert len(got) == len(gold) and all(gold[r["doc_id"], r["pos"]][0] == r["word"] for r in got)
    assert sum(gold[r["doc_id"], r["pos"]][1] == r["lang"] for r in got) / len(got) > 0.9


def test_odd_rows(spark, fitted):
    rows = [(1, None, "en"), (2, "", "en"), (3, "123 ### 4.5 \u00bd _", "fr"), (4, "the " * 70_000, None), (4, "the " * 70_000, None), (None, "the of and that", "en"),
            (5, "x", ""), (6, "漢字 かな Ж", "zz"), (7, "y" * 50_000, "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    for name in ("id", "held_out", "lang_pred", "score", "n", "spot", "rank"):
        docs = docs.withColumn(name, F.lit("q"))
    got = sorted(langid.identify(docs, fitted).collect(), key=str)
    assert len(got) == len(rows)
    by = {r["doc_id"]: r for r in got}
    assert all(by[i]["lang_pred"] == "und" and by[i]["score"] == 0 for i in (1, 2, 3))
    assert by[4]["lang_pred"] == by[None]["lang_pred"] == "en" and not by[None]["held_out"]
    assert langid.identify(docs.limit(0), fitted).count() == 0
    assert langid.train(docs.limit(0)) is None
    assert {r["lang_pred"] for r in langid.identify(docs, None).collect()} == {"und"}
    assert set(langid.train(docs, rounds=2).langs) <= {"", "en", "fr", "zz"}


def test_nothing_of_a_held_out_document_is_learned(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    learned = {r["doc_id"] for r in langid.learnable(docs).select("doc_id").collect()}
    assert learned == {r["doc_id"] for r in docs.select("doc_id").collect() if zlib.crc32(str(r["doc_id"]).encode()) % 4 != 2}


def test_query_is_stable(spark):
    sf = "/root/testdata/sf0.001"
    runs = [sorted(map(tuple, queries.op8_language(spark, sf).collect())) for _ in range(2)]
    assert runs[0] == runs[1] and len(runs[0]) == spark.read.parquet(f"{sf}/documents.parquet").count()
