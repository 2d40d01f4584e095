"""Line dedup, exact dedup and mixing on small tables against plain Python."""

import hashlib
import math
import re

import pytest
from pyspark.sql import functions as F

from breathline.llm import lines, refine, sampling

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
SPACE = " \t\n\x0b\x0c\r"
LAST = (1 << 63) - 1


def frame(spark, rows):
    return spark.createDataFrame([(i, t, None, s, None) for i, t, s in rows], SCHEMA)


CASES = [
    (3, "A shared line here\nown of three\n a SHARED line here ", "b"),
    (1, "a shared line here\t\nshort\nown of one", "b"),
    (2, "short\nA Shared Line Here", None),
    (4, None, None), (5, "", "a"), (6, "\n\n", "a"), (7, " \t", "é"),
    (8, "own of three\nx" + "y" * 100_000 + "\nlast line of eight", "z"),
    (8, "own of three\nx" + "y" * 100_000 + "\nlast line of eight", "z"),
    (None, "last line of eight\nown of one", "z"),
    (9, "ÀÉ straße ÀÉ straße\nàé straße àé straße", "b"),
]


def test_line_dedup_agrees_with_plain_loops(spark):
    holders = {}
    key = lambda l: "".join(c.lower() if "A" <= c <= "Z" else c for c in l.strip(SPACE))
    for i, t, _ in CASES:
        for l in (t or "").split("\n"):
            holders.setdefault(key(l), set()).add(LAST if i is None else i)
    expected = []
    for i, t, _ in CASES:
        own = (t or "").split("\n")
        stay = [l for l in own if len(key(l)) < 10 or len(holders[key(l)]) < 2 or min(holders[key(l)]) == (LAST if i is None else i)]
        expected.append((i, "\n".join(stay), len(own), len(own) - len(stay)))
    got = lines.drop_repeated_lines(frame(spark, CASES)).select("row.doc_id", "kept_text", "n_lines", "n_dropped").collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, expected))


def test_line_threshold_of_documents(spark):
    rows = [(i, "the common line\nown %d" % i, "s") for i in range(3)] + [(9, "two of us here", "s"), (10, "two of us here", "s")]
    got = {r[0]: r[1] for r in lines.drop_repeated_lines(frame(spark, rows), min_documents=3).select("row.doc_id", "n_dropped").collect()}
    assert got == {0: 0, 1: 1, 2: 1, 9: 0, 10: 0}


def test_exact_dedup_agrees_with_plain_loops(spark):
    rows = CASES + [(20, "own  of one two", "b"), (21, "ownofonetwo", "b"), (22, "own of  one  two", "b"), (23, "own of one twp", "b")]
    strip = lambda t: re.sub(r"[\x20\x09-\x0D]", "", t or "")
    groups = {}
    for i, t, _ in rows:
        groups.setdefault(strip(t), []).append((-len(t or ""), LAST if i is None else i))
    expected = []
    for i, t, _ in rows:
        best = min(groups[strip(t)])
        mine = (-len(t or ""), LAST if i is None else i)
        expected.append((i, None if best[1] == LAST else best[1], len(groups[strip(t)]), mine == best, hashlib.sha256(strip(t).encode()).hexdigest()))
    got = refine.refine(frame(spark, rows), digest_all=True).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, expected))
    some = refine.refine(frame(spark, rows)).where("content_sha256 is null").collect()
    assert all(r["group_size"] == 1 for r in some) and some
    assert refine.deduplicated(frame(spark, rows)).count() == sum(e[3] for e in expected)


def targets(sizes, weights=(3, 1, 2), share=1.5):
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: weights[i % 3] for i, s in enumerate(order)}
    left, open_, out = share * sum(sizes.values()), set(order), dict.fromkeys(order, 0.0)
    while open_:
        total = sum(weight[s] for s in open_)
        over = {s for s in open_ if left * weight[s] / total >= 2 * sizes[s]}
        if not over:
            out |= {s: left * weight[s] / total for s in open_}
            break
        for s in over:
            out[s] = 2.0 * sizes[s]
            left -= out[s]
        open_ -= over
    return out


def test_mix_meets_its_targets(spark):
    rows = [(i, "word " * (1 + i * 7919 % 300), ["a", "b", None, "\U0001F600", ""][i % 5] if i % 3 else "b") for i in range(3000)]
    rows += CASES
    got = sampling.sample_mix(frame(spark, rows), cell_rows=100).select(
        "row.source", "size", "source_size", "target", "copies", "taken").collect()
    sizes = {}
    for _, t, s in rows:
        sizes[s] = sizes.get(s, 0) + len((t or "").split())
    want = targets(sizes)
    taken = dict.fromkeys(sizes, 0)
    for s, size, source_size, target, copies, words in got:
        assert source_size == sizes[s] and target == pytest.approx(want[s]) and words == copies * size and 0 <= copies <= 2
        taken[s] += words
    assert sum(want.values()) == pytest.approx(1.5 * sum(sizes.values()))
    for s in ("a", "b", None, "\U0001F600", ""):
        assert abs(taken[s] - want[s]) <= max(0.02 * want[s], 300)
    assert len(got) == len(rows)


def test_mix_is_the_same_for_any_cells_and_runs(spark):
    rows = [(i, "w " * (i % 50), "s%d" % (i % 4)) for i in range(800)]
    runs = [sorted(map(tuple, sampling.sample_mix(frame(spark, rows).repartition(n), cell_rows=c).select("row.doc_id", "taken").collect()))
            for n, c in ((1, 100_000), (7, 10))]
    assert runs[0] == runs[1]
    assert sampling.emitted(frame(spark, rows)).columns == [c.split()[0] for c in SCHEMA.split(", ")]


def test_each_boundary_crossed_emits_once(spark):
    rows = [(i, "one two three four", "only") for i in range(1000)]
    copies = [r[0] for r in sampling.sample_mix(frame(spark, rows)).select("copies").collect()]
    assert sum(copies) in (math.floor(1500), math.ceil(1500)) and set(copies) <= {1, 2}


def test_empty_tables_and_clashing_columns(spark):
    none = frame(spark, [])
    assert lines.drop_repeated_lines(none).count() == refine.refine(none).count() == sampling.sample_mix(none).count() == 0
    odd = frame(spark, CASES)
    for name in ("doc", "body", "pos", "line", "key", "h1", "first", "lost", "row", "size", "target", "src", "cell", "id", "n", "count", "prefix", "bytes"):
        odd = odd.withColumn(name, F.lit("x"))
    assert lines.drop_repeated_lines(odd).count() == refine.refine(odd).count() == sampling.sample_mix(odd).count() == len(CASES)
