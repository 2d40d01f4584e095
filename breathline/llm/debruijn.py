"""Substring dedup on the de Bruijn graph of word k-mers.

Every window of k words is an edge of the graph. Windows in a row whose least m-gram hash
is the same (their anchor) are one path, so a text of n words gives about 2n / (k-m+2)
paths in place of n edges. Grouping by anchor tells, in one join:

- a path found in one document only is dropped with all its edges;
- where every path of an anchor has the same words, it doesn't branch: all its edges occur
  in the same documents, and the first of these speaks for the whole path;
- where paths of an anchor differ, they branch (passages begin or end there), and only
  their edges are taken one by one, again grouped and joined.

The marks go back to their sources: each text is cut into its paths and edges anew, by
position, and words that a marked one covers leave. Groups hold a first and a last
document, summed before the shuffle, never members; joins take a passage that very many
documents share as a skewed key, whose rows AQE splits. Paths are told apart by two 64-bit
hashes, single edges by one.

Defined results
- A null text has no words. Texts shorter than a window keep all their words.
- A null id counts as one document after all others; rows that repeat an id are one
  document, so passages they share with each other alone stay.
- Repeats within one document stay. Columns beside id and text are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from breathline.llm.common import discarded, fixed, id_or_last, last_to_null, settled, written
from breathline.llm.wordhash import Spans, chunks, mixed, word_hashes

WINDOW_WORDS = 13
ANCHOR_WORDS = 4


def least_of(values: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` values in a row."""
    span = 1
    while 2 * span <= width:
        values, span = np.minimum(values[:-span], values[span:]), 2 * span
    return np.minimum(values[: len(values) - (width - span)], values[width - span:]) if width > span else values


class Paths:
    """Windows of some texts, and their stretches with the same anchor."""

    def __init__(self, texts: list[bytes], k: int, m: int):
        hashes, self.text_of = word_hashes(texts)
        self.k, self.n = k, len(hashes)
        if self.n < k:
            self.at = self.anchors = self.starts = self.lengths = np.zeros(0, dtype=np.int64)
            return
        self.spans = Spans(hashes)
        least = least_of(self.spans.grams(m), k - m + 1)
        inside = self.text_of[: self.n - k + 1] == self.text_of[k - 1:]
        #: First word of each window, and its anchor.
        self.at = np.flatnonzero(inside)
        self.anchors = least[self.at]
        fresh = np.ones(len(self.at), dtype=bool)
        fresh[1:] = (self.anchors[1:] != self.anchors[:-1]) | (np.diff(self.at) != 1)
        #: Number of the first window of each path, and its number of windows.
        self.starts = np.flatnonzero(fresh)
        self.lengths = np.diff(np.r_[self.starts, len(self.at)])

    def path_texts(self) -> np.ndarray:
        return self.text_of[self.at[self.starts]]

    def path_hashes(self) -> np.ndarray:
        first = self.at[self.starts]
        return self.spans.of(first, first + self.lengths + self.k - 1)

    def window_hashes(self, which: np.ndarray) -> np.ndarray:
        return self.spans.of(self.at[which], self.at[which] + self.k)


def _longs(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64) if values.dtype == np.uint64 else values.astype(np.int64))


def _own(texts: np.ndarray, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(number of the text, value) of all lists of a column."""
    lists = column.fill_null([]) if column.null_count else column
    lengths = np.diff(lists.offsets.to_numpy())
    return np.repeat(texts, lengths), lists.flatten().to_numpy(zero_copy_only=False).view(np.uint64)


def _held(of: np.ndarray, values: np.ndarray, column: pa.Array, texts: int) -> np.ndarray:
    """Whether each value is in the list of its text."""
    salt = mixed(np.arange(1, texts + 1, dtype=np.uint64))
    owner, listed = _own(np.arange(texts), column)
    return np.isin(values ^ salt[of], listed ^ salt[owner]) if len(listed) else np.zeros(len(values), dtype=bool)


def _path_rows(k: int, m: int, with_body: bool):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece, texts in chunks(batch):
                paths = Paths(texts, k, m)
                if not len(paths.starts):
                    continue
                whose = piece.column("id").to_numpy(zero_copy_only=False)[paths.path_texts()]
                columns = {"anchor": _longs(paths.anchors[paths.starts]), "id": _longs(whose)}
                if with_body:
                    columns["body"] = _longs(paths.path_hashes())
                yield pa.RecordBatch.from_pydict(columns)
    return run


def _window_rows(k: int, m: int):
    """Windows of the branching paths of each text."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece, texts in chunks(batch):
                paths = Paths(texts, k, m)
                if not len(paths.at):
                    continue
                of = paths.text_of[paths.at]
                which = np.flatnonzero(_held(of, paths.anchors, piece.column("branching"), len(texts)))
                whose = {c: piece.column(c).to_numpy(zero_copy_only=False)[of[which]] for c in ("doc", "spot")}
                yield pa.RecordBatch.from_pydict(
                    {"edge": _longs(paths.window_hashes(which))} | {c: _longs(v) for c, v in whose.items()})
    return run


def _cleaned(k: int, m: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece, texts in chunks(batch):
                paths = Paths(texts, k, m)
                gone = np.zeros(paths.n + 1, dtype=np.int32)
                if len(paths.at):
                    of, marked = paths.text_of[paths.at], np.zeros(len(paths.at), dtype=bool)
                    marked |= _held(of, paths.anchors, piece.column("through"), len(texts))
                    some = np.flatnonzero(_held(of, paths.anchors, piece.column("branching"), len(texts)))
                    marked[some] |= _held(of[some], paths.window_hashes(some), piece.column("edges"), len(texts))
                    np.add.at(gone, paths.at[marked], 1)
                    np.add.at(gone, paths.at[marked] + k, -1)
                stays = np.cumsum(gone[:-1]) == 0
                bounds = np.searchsorted(paths.text_of, np.arange(len(texts) + 1))
                kept, counts, lost = [], np.diff(bounds), np.zeros(len(texts), dtype=np.int64)
                for i, text in enumerate(texts):
                    own = stays[bounds[i]:bounds[i + 1]]
                    lost[i] = len(own) - np.count_nonzero(own)
                    words = text.split()
                    kept.append(b" ".join(compress(words, own.tolist()) if lost[i] else words))
                yield pa.RecordBatch.from_pydict({
                    "id": piece.column("id"), "kept_text": pa.array(kept, pa.binary()).cast(pa.string()),
                    "n_words": _longs(counts), "n_removed": _longs(lost),
                })
    return run


def remove_repeats(docs: DataFrame, id: str = "doc_id", text: str = "text", window: int = WINDOW_WORDS,
                   anchor: int = ANCHOR_WORDS) -> DataFrame:
    """Per row: id, kept_text (its words joined by one space), n_words and n_removed.

    A word goes if a window of ``window`` words covers it that also occurs in a document
    with a smaller id.
    """
    if not 1 <= anchor <= window:
        raise ValueError("an anchor is a part of a window")
    # spot tells rows apart that repeat an id, so that no list grows past one text
    rows = docs.select(id_or_last(id).alias("doc"), F.xxhash64(id, text).alias("spot"), F.col(text).alias("text"))
    shared = settled(lambda: _shared_paths(rows, window, anchor))
    marks = settled(lambda: _marks(rows, shared, window, anchor))

    of = lambda test: F.transform(F.filter("marks", test), lambda m: m["anchor"])
    marked = lambda how: rows.join(marks, "spot", how).select(
        "doc", "spot", "text",
        of(lambda m: m["is_through"] & (m["first"] < F.col("doc"))).alias("through"),
        of(lambda m: ~m["is_through"]).alias("branching"),
    )
    single, path = written(
        marked("inner").where(F.size("branching") > 0).mapInArrow(_window_rows(window, anchor), "edge long, doc long, spot long"),
        "edges")
    repeated = fixed(
        single.groupBy("edge").agg(F.min("doc").alias("first"), F.max("doc").alias("last"))
        .where("first < last").select("edge", "first"))
    edges = settled(lambda: (
        single.join(repeated, "edge").where("first < doc").groupBy("spot").agg(F.collect_set("edge").alias("edges"))))
    discarded(docs.sparkSession, path)

    full = marked("left").join(edges, "spot", "left").select(F.col("doc").alias("id"), "text", "through", "branching", "edges")
    cleaned = full.mapInArrow(_cleaned(window, anchor), "id long, kept_text string, n_words long, n_removed long")
    return cleaned.select(last_to_null(F.col("id")).alias(id), "kept_text", "n_words", "n_removed")


def _shared_paths(rows: DataFrame, window: int, anchor: int) -> DataFrame:
    """Anchors found in several documents: the first of these, and whether all their paths are equal."""
    paths = rows.select(F.col("doc").alias("id"), "text").mapInArrow(
        _path_rows(window, anchor, True), "anchor long, id long, body long")
    return (
        paths.groupBy("anchor")
        .agg(F.min("id").alias("first"), F.max("id").alias("last"), F.min("body").alias("low"), F.max("body").alias("high"))
        .where("first < last").select("anchor", "first", (F.col("low") == F.col("high")).alias("is_through"))
    )


def _marks(rows: DataFrame, shared: DataFrame, window: int, anchor: int) -> DataFrame:
    """The shared anchors of each text."""
    paths = rows.select(F.col("spot").alias("id"), "text").mapInArrow(_path_rows(window, anchor, False), "anchor long, id long")
    return (
        paths.join(shared, "anchor").groupBy(F.col("id").alias("spot"))
        .agg(F.collect_set(F.struct("anchor", "first", "is_through")).alias("marks"))
    )
