"""Hashes of words and of runs of words, over many texts at once.

Texts are joined in one byte array. A word's hash is the sum of a mixed code for each of its
bytes at its place in the word, so no pattern of bytes cancels out, as it may in a polynomial
modulo 2**64. The hash of a stretch of words is a sum of their hashes times powers of an odd
base. Both come from running sums, so every word, n-gram and span costs the same few array
operations, whatever its length.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_BASE, _MASK = 0x9E3779B97F4A7C15, (1 << 64) - 1
_SPACES = np.zeros(256, dtype=bool)
_SPACES[[0x20, *range(0x09, 0x0E)]] = True
_CODES = np.random.default_rng(20).integers(1, 1 << 63, 256, dtype=np.uint64)
_powers: dict[int, np.ndarray] = {}
CHUNK_BYTES = 1 << 20


def powers(base: int, n: int) -> np.ndarray:
    """1, base, base**2, ... modulo 2**64, at least ``n`` of them."""
    known = _powers.get(base)
    if known is None or len(known) < n:
        known = np.ones(1, dtype=np.uint64)
        while len(known) < n:
            known = np.concatenate([known, known * np.uint64(pow(base, len(known), 1 << 64))])
        _powers[base] = known
    return known[:n]


def mixed(x: np.ndarray) -> np.ndarray:
    """The finalising shifts and factors of MurmurHash3."""
    x = (x ^ x >> np.uint64(33)) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ x >> np.uint64(33)) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ x >> np.uint64(33)


class Spans:
    """Hashes of stretches [a, b) of a sequence of 64-bit codes."""

    def __init__(self, codes: np.ndarray):
        self.sums = np.zeros(len(codes) + 1, dtype=np.uint64)
        np.cumsum(codes * powers(_BASE, len(codes)), out=self.sums[1:])
        self.back = powers(pow(_BASE, -1, 1 << 64), len(codes) + 1)

    def of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return mixed((self.sums[b] - self.sums[a]) * self.back[a] + (b - a).astype(np.uint64))

    def grams(self, n: int) -> np.ndarray:
        """Of every n codes in a row."""
        if len(self.sums) <= n:
            return np.zeros(0, dtype=np.uint64)
        return mixed((self.sums[n:] - self.sums[:-n]) * self.back[: len(self.sums) - n] + np.uint64(n))


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each word, number of the text that it is in)."""
    data = np.frombuffer(b"\n".join(texts) + b"\n", dtype=np.uint8)
    blank = _SPACES[data]
    edge = np.flatnonzero(blank[1:] != blank[:-1]) + 1
    if not blank[0]:
        edge = np.r_[0, edge]
    starts, ends = edge[0::2], edge[1::2]
    place = np.zeros(len(data) + 1, dtype=np.int64)
    place[starts] = np.diff(starts, prepend=0)
    place = np.arange(len(data)) - np.cumsum(place[:-1])
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(mixed(_CODES[data] + place.astype(np.uint64) * np.uint64(_BASE)), out=sums[1:])
    hashes = mixed(sums[ends] - sums[starts] + (ends - starts).astype(np.uint64))
    lengths = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
    return hashes, np.searchsorted(np.cumsum(lengths), starts, side="right")


def chunks(batch: pa.RecordBatch, column: str = "text") -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Slices of a batch with about a MB of text each, or one longer text."""
    lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    part = np.cumsum(lengths, dtype=np.int64) // CHUNK_BYTES
    bounds = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(part)]
    for a, b in zip(bounds, bounds[1:], strict=False):
        if a < b:
            piece = batch.slice(a, b - a)
            yield piece, [t or b"" for t in piece.column(column).cast(pa.binary()).to_pylist()]
