"""Source divergence audit: term rates of sources compared through hash-consed segment trees.

Every group (a language and a source) has a segment tree over the ids of its language's
terms, whose leaves are counts. Equal subtrees are one node, in all groups together. Two
trees are walked at the same time, level by level: of each level the different pairs of
nodes are kept with the number of places they stand for, so a pair of equal counts, or of
whole equal subtrees, is priced once. Ids run from frequent to rare terms, so rare ones,
absent from most groups, fall into the same few nodes.

The forest is cut to stay bounded: a task holds the subtrees of ``BLOCK`` term ids for two
tiles of at most ``TILE`` groups. What a pair of groups costs in each block is summed by
Spark, and so are all counts. Numbers are exact: rates are whole billionths, divided
digit by digit in 64 bits, which holds for groups up to 9 * 10**15 terms.

Defined results
- Null text, language and source are the empty string.
- Documents are rows: rows that repeat an id or a text count as documents of their own.
- A language with no term in ``MIN_DOCS`` documents has no kept terms: its pairs have value 0.
- Very long texts are split into terms whole. Ties of a value go by the item's UTF-8 bytes.
- An empty table gives an empty result. Other columns are not looked at, whatever their names.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from breathline.llm.common import fixed
from breathline.llm.wordhash import chunks

MIN_DOCS = 30
SMOOTH = 5
SCALE = 1_000_000_000
TOP = 50
#: Term ids of a subtree, a power of two, and groups of a tile: what a task holds at once.
BLOCK = 1 << 12
TILE = 64
#: Cells of equal frequency in which terms are numbered.
CELLS = 256
#: Distinct (group, term) a task sums before it hands them on.
HELD = 400_000
#: Bytes of a text whose terms are split at once.
PIECE = 1 << 22
#: Everything but letters and what lies beyond ASCII parts terms; A-Z in lower case.
TERMS = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def _parts(text: bytes) -> Iterator[bytes]:
    """A long text in pieces that end with a term."""
    at = 0
    while len(text) - at > PIECE:
        end = text.rfind(b" ", at, at + PIECE)
        end = end if end > at else text.find(b" ", at + PIECE)
        if end < 0:
            break
        yield text[at:end]
        at = end
    yield text[at:]


def _counted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, source, term, n, docs) of a task; a group's own row has the null term."""
    held: dict[tuple[str, str], tuple[Counter, Counter]] = {}
    size = 0

    def rows() -> Iterator[pa.RecordBatch]:
        for (lang, source), (n, docs) in held.items():
            terms = list(n)
            yield pa.RecordBatch.from_arrays([
                pa.array([lang] * (len(terms) + 1)), pa.array([source] * (len(terms) + 1)),
                pa.array([None, *(t.decode() for t in terms)], pa.string()),
                pa.array([0, *(n[t] for t in terms)], pa.int64()), pa.array([0, *(docs[t] for t in terms)], pa.int64())],
                names=["lang", "source", "term", "n", "docs"])

    for batch in batches:
        for piece, texts in chunks(batch):
            for lang, source, text in zip(piece.column("lang").to_pylist(), piece.column("source").to_pylist(), texts, strict=True):
                n, docs = held.setdefault((lang, source), (Counter(), Counter()))
                before, found = len(n), Counter()
                for part in _parts(text.translate(TERMS)):
                    found.update(part.split(b" "))
                found.pop(b"", None)
                n.update(found)
                docs.update(found.keys())
                size += len(n) - before
            if size > HELD:
                yield from rows()
                held, size = {}, 0
    yield from rows()


def rate(n: np.ndarray, total: np.ndarray | int) -> np.ndarray:
    """1 + floor(SCALE * (n + SMOOTH) / total), exactly."""
    top = n + SMOOTH
    whole, rest = top // total, top % total
    for _ in range(3):
        whole, rest = whole * 1000 + rest * 1000 // total, rest * 1000 % total
    return 1 + whole


def _rate(n: Column, total: Column) -> Column:
    def div(a: Column) -> Column:
        return F.call_function("div", a, total)

    top = n + SMOOTH
    whole, rest = div(top), top % total
    for _ in range(3):
        whole, rest = whole * 1000 + div(rest * 1000), rest * 1000 % total
    return whole + 1


class Forest:
    """Hash-consed trees of one height. ``leaves``: a row of counts per group; below 0 is no term."""

    def __init__(self, leaves: np.ndarray):
        self.counts, ids = np.unique(leaves, return_inverse=True)
        ids = ids.reshape(leaves.shape)
        #: From the leaves up: (left, right) of each node of a level.
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []
        width = len(self.counts)
        while ids.shape[1] > 1:
            pairs, above = np.unique(ids[:, 0::2].astype(np.int64) * width + ids[:, 1::2], return_inverse=True)
            self.levels.append((pairs // width, pairs % width))
            ids, width = above.reshape(ids.shape[0], -1), len(pairs)
        self.roots = ids[:, 0].astype(np.int64)

    def prices(self, a: int, others: np.ndarray, totals: np.ndarray) -> np.ndarray:
        """Sums of the differences of rates between group ``a`` and each of ``others``; ``totals`` by group."""
        which, mine, theirs = np.arange(len(others)), np.full(len(others), self.roots[a]), self.roots[others]
        times = np.ones(len(others), dtype=np.int64)
        for left, right in reversed(self.levels):
            # groups of one total and one node do not differ
            open_ = (mine != theirs) | (totals[others[which]] != totals[a])
            which, mine, theirs, times = which[open_], mine[open_], theirs[open_], times[open_]
            which, times = np.concatenate([which, which]), np.concatenate([times, times])
            mine = np.concatenate([left[mine], right[mine]])
            theirs = np.concatenate([left[theirs], right[theirs]])
            order = np.lexsort((theirs, mine, which))
            which, mine, theirs, times = which[order], mine[order], theirs[order], times[order]
            new = np.ones(len(which), dtype=bool)
            new[1:] = (which[1:] != which[:-1]) | (mine[1:] != mine[:-1]) | (theirs[1:] != theirs[:-1])
            at = np.flatnonzero(new)
            times = np.add.reduceat(times, at) if len(at) else times
            which, mine, theirs = which[at], mine[at], theirs[at]
        m, t = self.counts[mine], self.counts[theirs]
        there = m >= 0
        which, m, t, times = which[there], m[there], t[there], times[there]
        out = np.zeros(len(others), dtype=np.int64)
        np.add.at(out, which, times * np.abs(rate(m, totals[a]) - rate(t, totals[others[which]])))
        return out


def _priced(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
    """Both tiles' groups (place -1, n their total) and counts in a block -> (lang, a, b, value) of each pair."""
    lang, _, tile_a, tile_b = (k.as_py() for k in key)
    slot, place, n, tile, held = (rows.column(c).to_numpy() for c in ("slot", "place", "n", "tile", "held"))
    group = place < 0
    order = np.lexsort((slot[group], tile[group]))
    slots, totals, split = slot[group][order], n[group][order], int((tile[group] == tile_a).sum())
    terms = int(held.max())
    leaves = np.zeros((len(slots), 1 << max(0, terms - 1).bit_length()), dtype=np.int64)
    leaves[:, terms:] = -1
    # slots rise with the tile
    leaves[np.searchsorted(slots, slot[~group]), place[~group]] = n[~group]
    forest, out = Forest(leaves), []
    for a in range(split):
        others = np.arange(a + 1 if tile_a == tile_b else split, len(slots))
        if len(others):
            out.append(pa.table({
                "lang": pa.array([lang] * len(others), pa.string()), "a": np.full(len(others), slots[a]), "b": slots[others],
                "value": forest.prices(a, others, totals)}))
    if out:
        return pa.concat_tables(out)
    return pa.table({"lang": pa.array([], pa.string()), **{c: pa.array([], pa.int64()) for c in ("a", "b", "value")}})


def _numbered(terms: DataFrame) -> DataFrame:
    """``terms`` (lang, term, n, ...) with term ids from 0 in each language, frequent ones first."""
    cells = terms.withColumn("rank", -F.floor(F.log2(F.col("n") + 1) * 2).cast("int")).withColumn(
        "cell", F.pmod(F.xxhash64("term"), F.lit(CELLS)))
    at = ["lang", "rank", "cell"]
    sizes = cells.groupBy(*at).agg(F.count("*").alias("held"))
    before = Window.partitionBy("lang").orderBy("rank", "cell").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(*at, F.coalesce(F.sum("held").over(before), F.lit(0)).alias("start"))
    place = F.row_number().over(Window.partitionBy(*at).orderBy("term")) - 1
    return cells.join(starts, at).withColumn("term_id", F.col("start") + place).drop("rank", "cell", "start")


def _pairs(groups: DataFrame, langs: DataFrame, counts: DataFrame) -> DataFrame:
    """(lang, a, b, value) for a < b, numbers of sources in their language."""
    last = F.greatest(F.lit(0).cast("long"), F.ceil(F.col("v") / BLOCK) - 1)
    blocks = langs.select("lang", "v", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("block"))
    held = F.least(F.lit(BLOCK).cast("long"), F.col("v") - F.col("block") * BLOCK)
    here = ["lang", "block", "tile", "tiles", "slot"]
    whole = groups.join(blocks, "lang").select(*here, F.lit(-1).cast("long").alias("place"), F.col("total").alias("n"), held.alias("held"))
    entries = counts.withColumn("block", F.floor(F.col("term_id") / BLOCK)).select(
        *here, (F.col("term_id") % BLOCK).alias("place"), "n", F.lit(0).cast("long").alias("held"))
    # a tile's counts go where each pair of tiles is priced: as often as the language has tiles
    rows = whole.unionByName(entries).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1)))
    rows = rows.withColumn("tile_a", F.least("tile", "other")).withColumn("tile_b", F.greatest("tile", "other")).drop("tiles", "other")
    priced = rows.groupBy("lang", "block", "tile_a", "tile_b").applyInArrow(_priced, "lang string, a long, b long, value long")
    return priced.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))


def audit(docs: DataFrame, lang: str = "lang", source: str = "source", text: str = "text", min_docs: int = MIN_DOCS, top: int = TOP) -> DataFrame:
    """(lang, source, part, item, value, rank); part ``pair`` has the other sources of the language, ``term`` its terms."""
    blank = F.lit("")
    rows = docs.select(*(F.coalesce(F.col(c).cast("string"), blank).alias(n) for c, n in ((lang, "lang"), (source, "source"), (text, "text"))))
    found = rows.mapInArrow(_counted, "lang string, source string, term string, n long, docs long")
    counts = fixed(found.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")))
    terms = counts.where("term is not null").groupBy("lang", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")).where(F.col("docs") >= min_docs)
    kept = fixed(_numbered(terms.select("lang", "term", F.col("n").alias("n"))).withColumnRenamed("n", "lang_n"))
    held = kept.groupBy("lang").agg(F.count("*").alias("v"), F.sum("lang_n").alias("all_n"))
    langs = fixed(counts.where("term is null").select("lang").distinct().join(held, "lang", "left").select(
        "lang", F.coalesce("v", F.lit(0)).alias("v"), F.coalesce("all_n", F.lit(0)).alias("all_n")))
    used = counts.where("term is not null").select("lang", "source", "term", "n").join(kept, ["lang", "term"])
    sums = used.groupBy("lang", "source").agg(F.sum("n").alias("all"))
    slot = F.row_number().over(Window.partitionBy("lang").orderBy("source")).cast("long") - 1
    groups = fixed(
        counts.where("term is null").select("lang", "source").join(sums, ["lang", "source"], "left").join(langs, "lang").select(
            "lang", "source", (F.coalesce("all", F.lit(0)) + SMOOTH * F.col("v")).alias("total"), slot.alias("slot"),
            (F.col("all_n") + SMOOTH * F.col("v")).alias("lang_total"))
        .withColumn("tile", F.floor(F.col("slot") / TILE))
        .withColumn("tiles", F.max("tile").over(Window.partitionBy("lang")) + 1))
    used = fixed(used.join(groups, ["lang", "source"]))

    values = _pairs(groups, langs, used)
    both = values.unionByName(values.select("lang", F.col("b").alias("a"), F.col("a").alias("b"), "value"))
    names = groups.select("lang", F.col("slot"), "source")
    pairs = both.join(names.withColumnRenamed("slot", "a"), ["lang", "a"]).join(
        names.select("lang", F.col("slot").alias("b"), F.col("source").alias("item")), ["lang", "b"]).select("lang", "source", "item", "value")
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", "value", F.row_number().over(order).alias("rank"))

    more = _rate(F.col("n"), F.col("total")) - _rate(F.col("lang_n"), F.col("lang_total"))
    over = used.select("lang", "source", F.col("term").alias("item"), more.alias("value")).where("value > 0")
    over = over.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return pairs.unionByName(over.select("lang", "source", F.lit("term").alias("part"), "item", "value", "rank"))
