"""Vector code compression: parts of vectors are coded by the nearest entry of a codebook, found through GNATs.

A vector becomes integers (``floor(scale * x)``), cut into equal consecutive parts. Every
part position has a codebook, trained in a fixed number of rounds: each round is one pass
over all vectors that sums, per entry, the parts nearest to it (sums per task first, so a
row per task and entry is shuffled), and an entry becomes the floor of its parts' mean.

The nearest entry is found by a geometric near-neighbour access tree over the entries of a
codebook. A node has a few split points; every other entry is the child of its nearest split
point, and a node stores, for each split point and each child, the least and greatest
distance from the split point to what the child holds. A query's distance to a split point
rules out each child whose range lies farther than the best entry so far, strictly and with
all square roots widened by more than their rounding; what is left is compared by exact
integer distances, ties to the lower index. So codes equal those of a full search.

Codebooks alone are collected and sent with the tasks: entries times dimensions integers.

Defined results
- A null vector and one with a null, NaN or infinite component is dropped.
- The dimension is that of the smallest id's vector with a length that the parts divide.
  Vectors of another length, and those with a component beyond 2**24 after scaling, stay
  in the result, with null code and error; they train nothing and count in no label's sum.
- A null id sorts after all others; rows that repeat an id are ordered by their vectors.
- Fewer vectors than entries: codebooks have as many entries as there are vectors.
- Null labels count together. An empty table gives an empty result.
- Columns other than the three named are not looked at, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from breathline.llm.common import fixed, id_or_last, last_to_null

PARTS = 16
ENTRIES = 64
ROUNDS = 2
SCALE = 256
#: A node has this many split points, and what has no more entries is not divided.
SPLITS = 8
LIMIT = 1 << 24
#: Wider than the rounding of a square root, a sum and a difference of doubles.
WIDER = 2.0 ** -46
ROWS = 1 << 14


class Gnat:
    """The tree over some entries of a codebook (rows of ``entries``), by their indexes."""

    def __init__(self, entries: np.ndarray, indexes: np.ndarray | None = None):
        self.entries = entries
        self.indexes = np.arange(len(entries)) if indexes is None else indexes
        self.children: list[Gnat | None] = []
        if len(self.indexes) <= SPLITS:
            return
        points = entries[self.indexes]
        # split points far from each other: each is the entry farthest from those before it
        chosen, near = [0], ((points - points[0]) ** 2).sum(axis=1)
        while len(chosen) < SPLITS:
            chosen.append(int(np.argmax(near)))
            near = np.minimum(near, ((points - points[chosen[-1]]) ** 2).sum(axis=1))
        if len(set(chosen)) < len(chosen):  # fewer different entries than split points
            return
        squares = ((points[:, None, :] - points[None, chosen, :]) ** 2).sum(axis=2)
        home = np.argmin(squares, axis=1)
        home[chosen] = np.arange(SPLITS)
        self.splits = self.indexes[chosen]
        self.low, self.high = np.zeros((SPLITS, SPLITS)), np.zeros((SPLITS, SPLITS))
        rest = np.ones(len(points), dtype=bool)
        rest[chosen] = False
        for j in range(SPLITS):
            held = home == j
            roots = np.sqrt(squares[held].astype(np.float64))
            self.low[:, j], self.high[:, j] = roots.min(axis=0) * (1 - WIDER), roots.max(axis=0) * (1 + WIDER)
            below = self.indexes[held & rest]
            self.children.append(Gnat(entries, below) if len(below) else None)

    def search(self, queries: np.ndarray, best: np.ndarray, at: np.ndarray, rows: np.ndarray) -> int:
        """Improve ``best`` (squared distances) and ``at`` (indexes) of ``rows``; the number of distances worked out."""
        if not self.children:
            return sum(self._compare(queries, best, at, rows, i) for i in self.indexes)
        work, alive = 0, np.ones((len(rows), SPLITS), dtype=bool)
        for i, split in enumerate(self.splits):
            here = np.flatnonzero(alive[:, i])
            some = rows[here]
            work += self._compare(queries, best, at, some, split)
            root = np.sqrt(((queries[some] - self.entries[split]) ** 2).sum(axis=1).astype(np.float64))
            most = np.sqrt(best[some].astype(np.float64)) * (1 + WIDER)
            reach, short = (root * (1 + WIDER) + most) * (1 + WIDER), (root * (1 - WIDER) - most) * (1 - WIDER)
            gone = (self.low[i][None, :] > reach[:, None]) | (self.high[i][None, :] < short[:, None])
            alive[here] &= ~gone
        for i, child in enumerate(self.children):
            if child is not None:
                some = rows[alive[:, i]]
                if len(some):
                    work += child.search(queries, best, at, some)
        return work

    def _compare(self, queries: np.ndarray, best: np.ndarray, at: np.ndarray, rows: np.ndarray, entry: int) -> int:
        squares = ((queries[rows] - self.entries[entry]) ** 2).sum(axis=1)
        better = (squares < best[rows]) | ((squares == best[rows]) & (entry < at[rows]))
        best[rows[better]], at[rows[better]] = squares[better], entry
        return len(rows)

    def nearest(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index of the nearest entry, squared distance) of each query."""
        best = np.full(len(queries), np.iinfo(np.int64).max)
        at = np.full(len(queries), len(self.entries))
        self.search(queries, best, at, np.arange(len(queries)))
        return at, best


def _integers(vectors: pa.Array, scale: int, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(kept rows, which of these are coded, the coded rows' integers) of a batch."""
    valid = vectors.is_valid().to_numpy(zero_copy_only=False)
    lengths = np.where(valid, np.diff(vectors.offsets.to_numpy()), 0)
    numbers = vectors.flatten().fill_null(np.nan).to_numpy(zero_copy_only=False)
    starts = np.cumsum(lengths) - lengths
    unsound = np.concatenate([[0], np.cumsum(~np.isfinite(numbers))])
    kept = np.flatnonzero(valid & (unsound[starts + lengths] == unsound[starts]))
    fit = np.flatnonzero(lengths[kept] == size)
    at = starts[kept[fit]]
    with np.errstate(over="ignore"):
        whole = np.floor(numbers[at[:, None] + np.arange(size)[None, :]] * scale)
    small = (np.abs(whole) <= LIMIT).all(axis=1) if size else np.zeros(len(fit), dtype=bool)
    return kept, fit[small], whole[small].astype(np.int64)


def _blocks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            yield batch.slice(at, ROWS)


def _assigned(books: np.ndarray, whole: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(codes, squared distances), a row per vector and a column per part."""
    parts, entries, width = books.shape
    cut = whole.reshape(len(whole), parts, width)
    found = [Gnat(books[p]).nearest(np.ascontiguousarray(cut[:, p])) for p in range(parts)]
    return np.stack([a for a, _ in found], axis=1), np.stack([d for _, d in found], axis=1)


def _summed(books: np.ndarray, scale: int):
    """(part, entry, parts nearest to it, their sums) of a task."""
    parts, entries, width = books.shape

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, sums = np.zeros((parts, entries), np.int64), np.zeros((parts, entries, width), np.int64)
        for batch in _blocks(batches):
            _, _, whole = _integers(batch.column("v"), scale, parts * width)
            if not len(whole):
                continue
            codes, _ = _assigned(books, whole)
            cut = whole.reshape(len(whole), parts, width)
            for p in range(parts):
                counts[p] += np.bincount(codes[:, p], minlength=entries)
                np.add.at(sums[p], codes[:, p], cut[:, p])
        at = np.argwhere(counts > 0)
        yield pa.RecordBatch.from_arrays(
            [pa.array(at[:, 0].astype(np.int32)), pa.array(at[:, 1].astype(np.int32)), pa.array(counts[counts > 0]),
             pa.array(list(sums[counts > 0]), pa.list_(pa.int64()))], names=["part", "entry", "k", "s"])
    return run


def _coded(books: np.ndarray, scale: int):
    parts, entries, width = books.shape
    pairs = np.array([f"{i:02x}" for i in range(entries)])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _blocks(batches):
            kept, coded, whole = _integers(batch.column("v"), scale, parts * width)
            codes, errors = [None] * len(kept), [None] * len(kept)
            if len(whole):
                at, squares = _assigned(books, whole)
                for i, code, error in zip(coded.tolist(), pairs[at], squares.sum(axis=1).tolist(), strict=True):
                    codes[i], errors[i] = "".join(code), error
            rows = batch.take(pa.array(kept))
            yield pa.RecordBatch.from_arrays(
                [rows.column("id"), rows.column("label"), pa.array(codes, pa.string()), pa.array(errors, pa.int64())],
                names=["id", "label", "code", "error"])
    return run


def _first_vectors(vectors: DataFrame, parts: int, entries: int, scale: int) -> np.ndarray | None:
    """The integers of the smallest ids' vectors, a row each; None where there is none."""
    v = F.col("v")
    sound = vectors.where(v.isNotNull() & (F.size(v) > 0) & (F.size(v) % parts == 0) & F.forall(
        v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))
    small = sound.where(F.forall(v, lambda x: F.abs(F.floor(x.cast("double") * scale)) <= LIMIT))
    rows = small.orderBy("id", "v").limit(entries).select("v").collect()
    if not rows:
        return None
    size = len(rows[0]["v"])
    if any(len(r["v"]) != size for r in rows):
        rows = small.where(F.size(v) == size).orderBy("id", "v").limit(entries).select("v").collect()
    return np.floor(np.array([r["v"] for r in rows], dtype=np.float64) * scale).astype(np.int64)


def train(vectors: DataFrame, parts: int, entries: int, rounds: int, scale: int) -> np.ndarray | None:
    """``vectors`` (id, label, v) -> codebooks: parts x entries x width integers."""
    first = _first_vectors(vectors, parts, entries, scale)
    if first is None:
        return None
    books = np.ascontiguousarray(first.reshape(len(first), parts, -1).transpose(1, 0, 2))
    width = books.shape[2]
    for _ in range(rounds):
        sums = vectors.select("v").mapInArrow(_summed(books, scale), "part int, entry int, k long, s array<long>")
        total = sums.groupBy("part", "entry").agg(
            F.sum("k").alias("k"), *(F.sum(F.col("s")[i].cast("decimal(38,0)")).alias(f"s{i}") for i in range(width)))
        books = books.copy()
        for r in total.collect():  # at most parts * entries rows
            books[r["part"], r["entry"]] = [int(r[f"s{i}"]) // r["k"] for i in range(width)]
    return books


def digest(books: np.ndarray | None) -> str:
    numbers = [] if books is None else books.ravel().tolist()
    return hashlib.sha256(",".join(map(str, numbers)).encode()).hexdigest()


def compress(df: DataFrame, id: str = "vec_id", vector: str = "embedding", label: str = "label", parts: int = PARTS,
             entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> DataFrame:
    """Per kept row: id, code, error, label_error and codebooks_sha256."""
    if not 1 <= entries <= 256:
        raise ValueError("a code has two hex digits a part")
    vectors = df.select(id_or_last(id).alias("id"), F.col(label).alias("label"), F.col(vector).cast("array<double>").alias("v"))
    books = train(vectors, parts, entries, rounds, scale)
    used = np.zeros((parts, 1, 0), dtype=np.int64) if books is None else books
    kind = df.schema[label].dataType.simpleString()
    coded = fixed(vectors.mapInArrow(_coded(used, scale), f"id long, label {kind}, code string, error long"))
    sums = coded.groupBy("label").agg(F.sum(F.col("error").cast("decimal(38,0)")).try_cast("long").alias("label_error"))
    named = sums.withColumnRenamed("label", "of")
    return coded.join(named, F.col("label").eqNullSafe(F.col("of"))).select(
        last_to_null(F.col("id")).alias(id), "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))
