"""Benchmark decontamination by the q-gram lemma.

Each benchmark item is searched as probes: its windows of ``PROBE_CHARS`` normalised
characters every ``PROBE_STEP``, or the whole item if shorter, so every passage of an item of 79 characters or
more holds a whole probe. A probe of m characters is
found in a document if a stretch of it is within k = ``EDIT_RATE`` * m edits. Such a
stretch shares at least m - q + 1 - k*q of the probe's q-grams, on diagonals (place in the
document less place in the probe) at most k apart. So shared q-grams are counted in bands
of 2(k+1) diagonals that overlap by half, bands below the bound are left, and the others
are verified by alignment inside the band.

Documents are never moved: a block of benchmark items (``BLOCK_CHARS`` on average) goes to
all tasks, and a larger benchmark is taken in several blocks, one pass each. Each text is
searched whole; arrays are as long as a few MB of text, or one longer text.

Normalised: letters in lower case and digits stay, whatever lies between is one space.

Defined results
- Null and empty texts match nothing. Rows with equal or null ids are searched on their own.
- Items shorter than ``MIN_CHARS`` normalised characters are not searched, as chance finds
  them in clean text. Null items likewise. Items that repeat are found each.
- An empty benchmark finds nothing, and all documents stay.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import cache, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from breathline.llm.wordhash import Spans, chunks

Q = 8
PROBE_CHARS, PROBE_STEP = 64, 16
EDIT_RATE = 0.08
MIN_CHARS = 32
BLOCK_CHARS = 4_000_000
#: Candidate bands that are aligned at once.
ALIGN = 4096


@cache
def _folds() -> np.ndarray:
    """Lower case of every letter and digit, a space for every other character."""
    table = np.full(0x110000, 32, dtype=np.int32)
    for point in range(0x110000):
        c = chr(point)
        if c.isalnum():
            low = c.lower()
            table[point] = ord(low) if len(low) == 1 else point
    return table


def normalised(text: str) -> tuple[np.ndarray, np.ndarray]:
    """(characters, their places in ``text``)."""
    codes = _folds()[np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)]
    blank = codes == 32
    stays = ~blank
    stays[1:] |= ~blank[:-1]  # the first blank after a character
    places = np.flatnonzero(stays)
    codes = codes[places]
    if len(codes) and codes[-1] == 32:
        codes, places = codes[:-1], places[:-1]
    return codes, places


@dataclass(frozen=True)
class Settings:
    q: int = Q
    probe: int = PROBE_CHARS
    step: int = PROBE_STEP
    rate: float = EDIT_RATE
    least: int = MIN_CHARS


class Index:
    """Probes of a block of items, and where their q-grams are."""

    def __init__(self, items: list[tuple[int, str]], settings: Settings):
        self.q, self.ids, probes, owners = settings.q, [], [], []
        for item, text in items:
            codes, _ = normalised(text)
            if len(codes) < max(settings.least, settings.q):
                continue
            last = max(0, len(codes) - settings.probe)
            for at in sorted({*range(0, last, settings.step), last}):
                probes.append(codes[at:at + settings.probe])
                owners.append(len(self.ids))
            self.ids.append(item)
        self.owners = np.array(owners, dtype=np.int64)
        self.lengths = np.array([len(p) for p in probes], dtype=np.int64)
        self.budget = (self.lengths * settings.rate).astype(np.int64)
        self.bound = np.maximum(1, self.lengths - self.q + 1 - self.budget * self.q)
        if not len(probes):
            return
        #: Characters of the probes, filled up with a code that no text has.
        self.codes = np.full((len(probes), self.lengths.max()), -1, dtype=np.int32)
        for i, p in enumerate(probes):
            self.codes[i, : len(p)] = p
        grams = [gram_hashes(p, self.q) for p in probes]
        hashes = np.concatenate(grams)
        order = np.argsort(hashes, kind="stable")
        self.hashes = hashes[order]
        self.probe = np.repeat(np.arange(len(probes)), [len(g) for g in grams])[order]
        self.offset = np.concatenate([np.arange(len(g)) for g in grams])[order]
        bits = max(16, min(26, int(len(hashes)).bit_length() + 5))
        self.shift = np.uint64(64 - bits)
        self.seen = np.zeros(1 << bits, dtype=bool)
        self.seen[self.hashes >> self.shift] = True

    def hits(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(place, probe, offset in the probe) of shared q-grams where enough of them are near each other."""
        grams = gram_hashes(codes, self.q)
        shared = self.seen[grams >> self.shift]
        # a stretch in reach holds its probe's bound of shared grams within probe + budget places
        reach = int((self.lengths + self.budget).max())
        sums = np.zeros(len(shared) + 2 * reach + 1, dtype=np.int32)
        np.cumsum(shared, out=sums[reach + 1:reach + 1 + len(shared)])
        sums[reach + 1 + len(shared):] = sums[reach + len(shared)]
        dense = sums[reach:] - sums[: len(sums) - reach] >= self.bound.min()  # windows ending before each place
        marks = np.zeros(len(dense) + 1, dtype=np.int32)
        marks[1:] = np.cumsum(dense)
        places = np.flatnonzero(shared)
        near = marks[np.minimum(places + reach + 1, len(dense))] - marks[np.minimum(places + 1, len(dense))] > 0
        places = places[near]
        low = np.searchsorted(self.hashes, grams[places], side="left")
        times = np.searchsorted(self.hashes, grams[places], side="right") - low
        posting = np.repeat(low - np.r_[0, np.cumsum(times)[:-1]], times) + np.arange(times.sum())
        return np.repeat(places, times), self.probe[posting], self.offset[posting]

    def bands(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(probe, first diagonal) of the bands that meet their bound."""
        place, probe, offset = self.hits(codes)
        half = self.budget[probe] + 1
        band = (place - offset + self.lengths.max()) // half  # shifted, so that none is negative
        keys = np.concatenate([probe << 40 | band, probe << 40 | np.maximum(band - 1, 0)])
        found, counts = np.unique(keys, return_counts=True)
        probe, band = found >> 40, found & ((1 << 40) - 1)
        enough = counts >= self.bound[probe]
        probe, band = probe[enough], band[enough]
        return probe, band * (self.budget[probe] + 1) - self.lengths.max()

    def aligned(self, codes: np.ndarray, probe: np.ndarray, diagonal: np.ndarray) -> tuple[np.ndarray, ...]:
        """(edits, begin, end) of the best stretch of each band, by rows of the alignment."""
        wide = int(2 * (self.budget[probe].max() + 1))
        pad = self.codes.shape[1] + wide + 1
        text = np.full(len(codes) + 2 * pad, -2, dtype=np.int32)
        text[pad:pad + len(codes)] = codes
        lanes = np.arange(wide)
        cost = np.where(lanes < 2 * (self.budget[probe] + 1)[:, None], 0, 1 << 20)
        outside = cost > 0
        begin = diagonal[:, None] + lanes
        edits, starts, ends = np.zeros(len(probe), np.int64), np.zeros(len(probe), np.int64), np.zeros(len(probe), np.int64)
        for row in range(int(self.lengths[probe].max())):
            here = np.clip(diagonal[:, None] + lanes + row + pad, 0, len(text) - 1)
            step = cost + (text[here] != self.codes[probe, row][:, None])
            came = begin.copy()
            skip = cost[:, 1:] + 1
            better = skip < step[:, :-1]
            step[:, :-1] = np.where(better, skip, step[:, :-1])
            came[:, :-1] = np.where(better, begin[:, 1:], came[:, :-1])
            # a character of the text beside the probe costs one more than the lane before
            level = step - lanes
            least = np.minimum.accumulate(level, axis=1)
            source = np.maximum.accumulate(np.where(level == least, lanes, 0), axis=1)
            cost, begin = least + lanes, np.take_along_axis(came, source, axis=1)
            cost[outside] = 1 << 20
            done = np.flatnonzero(self.lengths[probe] == row + 1)
            if len(done):
                best = cost[done].argmin(axis=1)
                edits[done], starts[done] = cost[done, best], begin[done, best]
                ends[done] = diagonal[done] + best + row + 1
        return edits, starts, ends

    def matches(self, texts: list[str]) -> dict[tuple[int, int], tuple[int, int, int]]:
        """(text number, item number) -> (begin, end, fewest edits), places in the original text."""
        if not len(self.owners) or not texts:
            return {}
        gap = np.zeros(int(self.budget.max()) + 1, dtype=np.int32)  # no stretch in reach spans two texts
        parts = [normalised(t) for t in texts]
        lengths = np.array([len(c) for c, _ in parts], dtype=np.int64)
        codes = np.concatenate([x for c, _ in parts for x in (c, gap)])
        starts = np.r_[0, np.cumsum(lengths + len(gap))[:-1]]
        if len(codes) < self.q:
            return {}
        probe, diagonal = self.bands(codes)
        found: dict[tuple[int, int], tuple[int, int, int]] = {}
        for at in range(0, len(probe), ALIGN):
            some = probe[at:at + ALIGN]
            edits, begin, end = self.aligned(codes, some, diagonal[at:at + ALIGN])
            good = np.flatnonzero(edits <= self.budget[some])
            # by its middle: a stretch may begin in the gap before its text, or end in the one after
            whose = np.searchsorted(starts, np.maximum((begin[good] + end[good]) // 2, 0), side="right") - 1
            for j, w in zip(good.tolist(), whose.tolist(), strict=True):
                places = parts[w][1]
                a = max(0, int(begin[j] - starts[w]))
                b = min(len(places), int(end[j] - starts[w]))
                if a >= b:
                    continue
                key = (w, int(self.owners[some[j]]))
                now = (int(places[a]), int(places[b - 1]) + 1, int(edits[j]))
                old = found.get(key, now)
                found[key] = (min(old[0], now[0]), max(old[1], now[1]), min(old[2], now[2]))
        return found


def gram_hashes(codes: np.ndarray, q: int) -> np.ndarray:
    return Spans(codes.astype(np.uint64) + np.uint64(1)).grams(q)


_indexes: dict = {}


def _index(shared, settings: Settings) -> Index:
    """The index of a broadcast block, built once in a Python worker."""
    key = (shared.value[0], settings)
    if key not in _indexes:
        _indexes.clear()
        _indexes[key] = Index(shared.value[1], settings)
    return _indexes[key]


def _found(shared, settings: Settings):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = _index(shared, settings)
        for batch in batches:
            for piece, texts in chunks(batch):
                hits = index.matches([t.decode() for t in texts])
                ids = piece.column("id").to_pylist()
                yield pa.RecordBatch.from_pydict({
                    "id": pa.array([ids[w] for w, _ in hits], pa.int64()),
                    "item": pa.array([index.ids[i] for _, i in hits], pa.int64()),
                    "begin": pa.array([v[0] for v in hits.values()], pa.int64()),
                    "end": pa.array([v[1] for v in hits.values()], pa.int64()),
                    "edits": pa.array([v[2] for v in hits.values()], pa.int64()),
                })
    return run


def _clean(shared, settings: Settings, column: str):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = _index(shared, settings)
        for batch in batches:
            for piece, texts in chunks(batch, column):
                keep = np.ones(len(texts), dtype=bool)
                keep[[w for w, _ in index.matches([t.decode() for t in texts])]] = False
                yield piece.filter(pa.array(keep))
    return run


def blocks(benchmark: DataFrame, id: str, text: str, block_chars: int) -> Iterator:
    """The benchmark as broadcasts of bounded size."""
    spark = benchmark.sparkSession
    items = benchmark.select(F.col(id).cast("long").alias("item"), F.col(text).alias("body")).where(F.col(text).isNotNull())
    total = items.agg(F.sum(F.char_length("body"))).first()[0] or 0
    count = -(-total // block_chars)
    for number in range(count):
        part = items.where(F.pmod(F.xxhash64("item", "body"), F.lit(count)) == number)
        rows = sorted((r["item"] if r["item"] is not None else -1, r["body"], r["item"]) for r in part.collect())
        yield spark.sparkContext.broadcast((uuid.uuid4().hex, [(i, t) for _, t, i in rows]))


def contaminated(docs: DataFrame, benchmark: DataFrame, id: str = "doc_id", text: str = "text", item_id: str = "item_id",
                 item_text: str = "text", settings: Settings = Settings(), block_chars: int = BLOCK_CHARS) -> DataFrame:
    """A row per document and item found in it: id, item id, begin, end (of the text) and edits."""
    rows = docs.select(F.col(id).cast("long").alias("id"), F.col(text).alias("text"))
    schema = "id long, item long, begin long, end long, edits long"
    found = [rows.mapInArrow(_found(b, settings), schema) for b in blocks(benchmark, item_id, item_text, block_chars)]
    empty = docs.sparkSession.createDataFrame([], schema)
    return reduce(DataFrame.unionByName, found or [empty]).select(
        F.col("id").alias(id), F.col("item").alias(item_id), "begin", "end", "edits")


def decontaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id",
                   item_text: str = "text", settings: Settings = Settings(), block_chars: int = BLOCK_CHARS) -> DataFrame:
    """The rows of ``docs`` in which no item is found, with all their columns, where they are."""
    for block in blocks(benchmark, item_id, item_text, block_chars):
        docs = docs.mapInArrow(_clean(block, settings, text), docs.schema)
    return docs
