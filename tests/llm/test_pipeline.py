"""The pipeline, stage by stage, against brute force on each stage's own input."""

import collections
import hashlib
import math

import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from breathline.llm import kneser_ney as kn
from breathline.llm import qgram_filter as qf
from test_kneser_ney import Plain
from test_native import SPACE, targets
from test_qgram_filter import fewest_edits, plain, probes_of
from test_simhash import plain_components, plain_fingerprint

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark):
    """Rows before the first and after each stage."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [[tuple(r) for r in docs.collect()]]
    for _, stage in corpus_pipeline.STAGES:
        docs = spark.createDataFrame([tuple(r) for r in stage(spark, docs, SF).select(*COLUMNS).collect()], docs.schema)
        out.append([tuple(r) for r in docs.collect()])
    return out


def test_stage_names():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "line_dedup", "near_duplicates", "decontamination", "mix"]



def signed_part(doc_id):
    h = xxhash.xxh64_intdigest(doc_id.to_bytes(8, "little"), seed=42)
    return 1 + (h - (1 << 64) if h >> 63 else h) % kn.FOLDS


def test_quality(spark, stages):
    before, after = stages[0], stages[1]
    bad, seen = set(), set()
    for r in spark.read.parquet(f"{SF}/labels.parquet").collect():
        seen.add(r["doc_id"])
        if r["quality"] != 1 or r["toxic"]:
            bad.add(r["doc_id"])
    good, kept = seen - bad, []
    for lang in {r[2] for r in before}:
        own = [r for r in before if r[2] == lang]
        trusted = [r for r in own if r[0] in good]
        models = {f: Plain([r[1] for r in trusted if f == 0 or signed_part(r[0]) != f]) for f in range(kn.FOLDS + 1)}
        bits = {r[0]: models[signed_part(r[0]) if r[0] in good else 0].bits(r[1]) for r in own}
        mean = -sum(bits[r[0]] for r in trusted) / sum(len(r[1]) for r in trusted)
        smooth = {r[0]: (kn.PRIOR * mean - bits[r[0]]) / (len(r[1]) + kn.PRIOR) for r in own}
        bins = sorted(math.floor(smooth[r[0]] * kn.BINS_PER_BIT) for r in trusted)
        limit = (bins[math.ceil(kn.KEEP_SHARE * len(bins)) - 1] + 1) / kn.BINS_PER_BIT
        kept += [r for r in own if smooth[r[0]] < limit]
    assert sorted(kept) == sorted(after) and len(after) < len(before)


def test_line_dedup(stages):
    before, after = stages[1], stages[2]
    key = lambda l: "".join(c.lower() if "A" <= c <= "Z" else c for c in l.strip(SPACE))
    holders = collections.defaultdict(set)
    for r in before:
        for l in r[1].split("\n"):
            holders[key(l)].add(r[0])
    expected = []
    for r in before:
        text = "\n".join(l for l in r[1].split("\n") if len(key(l)) < 10 or min(holders[key(l)]) == r[0])
        expected.append((r[0], text, r[2], r[3], r[4] if text == r[1] else len(text)))
    assert sorted(expected) == sorted(after) and sorted(after) != sorted(before)


def test_near_duplicates(stages):
    before, after = stages[2], stages[3]
    found = plain_components([(r[0], plain_fingerprint(r[1])) for r in before])
    assert sorted(after) == sorted(r for r, c in zip(before, found, strict=True) if r[0] == c) and len(after) < len(before)


def test_decontamination(spark, stages):
    before, after = stages[3], stages[4]
    s, hit = qf.Settings(), set()
    probes = [p for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect() for p in probes_of(r["text"], s)]
    bodies = {r[0]: plain(r[1]) for r in before}
    for p in probes:
        budget = int(len(p) * s.rate)
        if fewest_edits(p, "\0".join(bodies.values())) <= budget:
            hit |= {i for i, b in bodies.items() if i not in hit and b and fewest_edits(p, b) <= budget}
    assert sorted(after) == sorted(r for r in before if r[0] not in hit)


def test_mix(stages):
    before, after = stages[4], stages[5]
    sizes, sources = {}, collections.defaultdict(list)
    for r in before:
        sizes[r[3]] = sizes.get(r[3], 0) + len(r[1].split())
        sources[r[3]].append(r)
    want, expected = targets(sizes), []
    for source, rows in sources.items():
        rows.sort(key=lambda r: (math.floor(math.log(len(r[1].split()) + 1) * 8), hashlib.md5(str(r[0]).encode()).hexdigest()))
        rate = want[source] / sizes[source] if sizes[source] else 0.0
        offset = int(hashlib.md5(f"mix={source}".encode()).hexdigest()[:5], 16) / 16**5
        for k, r in enumerate(rows):
            expected += [r] * (math.floor(rate * (k + 1) + offset) - math.floor(rate * k + offset))
    assert sorted(expected) == sorted(after)


def test_run_gives_the_last_stage(spark, stages):
    got = corpus_pipeline.run(spark, SF)
    assert got.columns == COLUMNS and sorted(map(tuple, got.collect())) == sorted(stages[5])


def test_stages_take_odd_rows(spark):
    rows = [(1, None, None, None, None), (2, "", "en", "a", 0), (2, "", "en", "a", 0), (None, "some words here", None, "a", None), (3, "some words here", "xx", "b", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").withColumn("row", F.lit(1))
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), SF).count() == 0
        got = stage(spark, docs, SF)
        assert got.columns == docs.columns
        got.collect()
