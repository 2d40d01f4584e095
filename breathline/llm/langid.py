"""Language of the words of a text by a linear-chain conditional random field.

Each word with a letter is a place in the chain. Its features are its identity (the
lexicon), prefixes and suffixes of 1 to 3 characters, and its character bigrams and
trigrams, hashed to ``BUCKETS`` rows of weights; transitions between the languages of
neighbouring words are learned with them. Forward-backward gives each word a probability
per language, so a text may change language between words; a document gets the language
with the greatest mean probability.

The field is fitted on at most ``SAMPLE_DOCS`` documents per language, chosen by hash of
the text, whose words have the document's language. Runs of words of different languages
are put behind each other, so that changes of language are seen. The weights (``BUCKETS``
rows) go to all tasks; documents are never moved.

A text of any length is taken whole: it is cut into segments, whose transfer matrices give
the exact messages at the cuts, so the work is a few array operations for all segments.

Defined results
- A null text, or one without a letter: ``und``, score 0.
- Texts or languages that are null, and rows with a null id, are not learned from; the
  latter are not held out. Without anything to learn from all texts are ``und``.
- Repeated rows are judged each. Columns beside id, text and lang are not looked at.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from breathline.llm.wordhash import Spans, chunks

SAMPLE_DOCS = 200
BUCKETS = 1 << 16
#: Words of a training sequence, and of a run in one language within it.
SEQUENCE, RUNS = 32, (4, 24)
ROUNDS, RATE, DECAY = 40, 0.1, 1e-6
SEGMENT = 64
#: Words whose weights a task keeps at hand.
KEPT_WORDS = 400_000
UNKNOWN = "und"
_NO_LETTER = re.compile(r"[\W\d_]+")


def plain_word(token: str) -> str:
    """The letters of a token, in lower case."""
    word = _NO_LETTER.sub("", token)
    return (word if word.isalpha() else "".join(filter(str.isalpha, word))).lower()


def features(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(number of the word, bucket) of all features of words that aren't empty."""
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + 2
    codes = np.frombuffer("".join(f"\x02{w}\x03" for w in words).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    ends = np.cumsum(lengths)
    starts = ends - lengths
    spans = Spans(codes.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(1))
    word_of = np.repeat(np.arange(len(words)), lengths)
    each, parts = np.arange(len(words)), [(np.arange(len(words)), spans.of(starts, ends))]
    for n in (2, 3):
        grams = spans.grams(n)
        inside = word_of[: len(grams)] == word_of[n - 1:]
        parts.append((word_of[: len(grams)][inside], grams[inside] * np.uint64(2 * n + 1)))
    for n in (1, 2, 3):
        some = each[lengths >= n + 2]
        parts.append((some, spans.of(starts[some] + 1, starts[some] + 1 + n) * np.uint64(2 * n + 11)))
        parts.append((some, spans.of(ends[some] - 1 - n, ends[some] - 1) * np.uint64(2 * n + 21)))
    of = np.concatenate([p[0] for p in parts])
    bucket = (np.concatenate([p[1] for p in parts]) >> np.uint64(64 - BUCKETS.bit_length() + 1)).astype(np.int64)
    order = np.argsort(of, kind="stable")
    return of[order], bucket[order]


@dataclass
class Field:
    """A fitted field: weights (bucket, language), log-odds of changes and of first words."""
    langs: list[str]
    weights: np.ndarray
    change: np.ndarray
    first: np.ndarray

    def emissions(self, words: list[str]) -> np.ndarray:
        of, bucket = features(words)
        starts = np.searchsorted(of, np.arange(len(words)))
        return np.add.reduceat(self.weights[bucket], starts, axis=0)

    def marginals(self, emissions: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Probabilities (word, language) for texts of ``lengths`` words behind each other."""
        k, states = SEGMENT, len(self.langs)
        change, first = np.exp(self.change - self.change.max()), np.exp(self.first - self.first.max())
        weight = np.exp(emissions - emissions.max(axis=1, keepdims=True)).astype(np.float64)
        pieces = -(-lengths // k)
        text_of = np.repeat(np.arange(len(lengths)), pieces)
        number = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        begin = np.repeat(np.cumsum(lengths) - lengths, pieces) + number * k
        filled = np.minimum(k, lengths[text_of] - number * k)
        places = begin[:, None] + np.arange(k)
        there = np.arange(k) < filled[:, None]
        weight = weight[np.where(there, places, 0)]
        fresh = number == 0

        def normal(x: np.ndarray) -> np.ndarray:
            return x / x.sum(axis=-1, keepdims=True)

        # messages into the first word of each segment, and out of its last
        forward = np.full((len(begin), states), 1 / states)
        backward = np.ones((len(begin), states))
        if pieces.max(initial=0) > 1:
            transfer = np.broadcast_to(np.eye(states), (len(begin), states, states)).copy()
            for i in range(k):
                step = np.where((fresh & (i == 0))[:, None, None], transfer.sum(2, keepdims=True) * first, transfer @ change) * weight[:, i, None, :]
                step /= step.max(axis=(1, 2), keepdims=True)
                transfer = np.where(there[:, i, None, None], step, transfer)
            for n in range(1, int(pieces.max())):
                now = np.flatnonzero(number == n) if n == 1 else now[pieces[text_of[now]] > n] + 1
                forward[now] = normal(np.einsum("ni,nij->nj", forward[now - 1], transfer[now - 1]))
            at = np.cumsum(pieces) - 1
            for n in range(1, int(pieces.max())):
                at = at[pieces[text_of[at]] > n] - 1
                backward[at] = normal(np.einsum("nij,nj->ni", transfer[at + 1], backward[at + 1]))
        ahead = np.empty((k, len(begin), states))
        for i in range(k):
            step = forward @ change
            if i == 0:
                step[fresh] = first
            forward = np.where(there[:, i, None], normal(step * weight[:, i]), forward)
            ahead[i] = forward
        out = np.empty((len(emissions), states))
        for i in range(k - 1, -1, -1):
            now = there[:, i]
            out[places[now, i]] = normal(ahead[i][now] * backward[now])
            backward[now] = normal((weight[now, i] * backward[now]) @ change.T)
        return out


def fit(texts: list[tuple[str, str]], seed: int = 8, rounds: int = ROUNDS) -> Field | None:
    """``texts``: (language, text). By gradient steps on the likelihood of mixed sequences."""
    langs = sorted({g for g, _ in texts})
    rng, number = np.random.default_rng(seed), {}
    runs: list[tuple[int, list[int]]] = []
    for g, text in texts:
        words = [w for w in map(plain_word, text.split()) if w]
        ids = [number.setdefault(w, len(number)) for w in words]
        while ids:
            n = int(rng.integers(*RUNS))
            runs.append((langs.index(g), ids[:n]))
            ids = ids[n:]
    if not runs:
        return None
    rng.shuffle(runs)
    stream = np.array([w for _, ids in runs for w in ids])
    labels = np.array([g for g, ids in runs for _ in ids])
    steps = min(SEQUENCE, len(stream))
    count, states = len(stream) // steps, len(langs)
    stream, labels = stream[: count * steps].reshape(count, steps), labels[: count * steps].reshape(count, steps)
    of, bucket = features(list(number))
    starts = np.searchsorted(of, np.arange(len(number)))
    weights, change, first = np.zeros((BUCKETS, states)), np.zeros((states, states)), np.zeros(states)
    params = [weights, change, first]
    slow, square = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    gold = np.eye(states)[labels]
    pairs = np.zeros((states, states))
    np.add.at(pairs, (labels[:, :-1].ravel(), labels[:, 1:].ravel()), 1)
    for turn in range(1, rounds + 1):
        emission = np.add.reduceat(weights[bucket], starts, axis=0)[stream]
        weight = np.exp(emission - emission.max(axis=2, keepdims=True))
        move, start = np.exp(change), np.exp(first)
        ahead, back = np.empty_like(weight), np.ones_like(weight)
        ahead[:, 0] = start * weight[:, 0]
        ahead[:, 0] /= ahead[:, 0].sum(1, keepdims=True)
        for t in range(1, steps):
            ahead[:, t] = (ahead[:, t - 1] @ move) * weight[:, t]
            ahead[:, t] /= ahead[:, t].sum(1, keepdims=True)
        for t in range(steps - 2, -1, -1):
            back[:, t] = (weight[:, t + 1] * back[:, t + 1]) @ move.T
            back[:, t] /= back[:, t].sum(1, keepdims=True)
        share = ahead * back
        share /= share.sum(2, keepdims=True)
        both = np.zeros((states, states))
        for t in range(1, steps):
            joint = ahead[:, t - 1, :, None] * move * (weight[:, t] * back[:, t])[:, None, :]
            both += (joint / joint.sum((1, 2), keepdims=True)).sum(0)
        by_word = np.stack([np.bincount(stream.ravel(), (gold - share)[..., s].ravel(), len(number)) for s in range(states)], 1)
        spread = np.stack([np.bincount(bucket, by_word[of, s], BUCKETS) for s in range(states)], 1)
        slopes = [spread / count - DECAY * weights, (pairs - both) / count, (gold - share)[:, 0].mean(0)]
        for p, g, m, v in zip(params, slopes, slow, square, strict=True):
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            p += RATE * (m / (1 - 0.9**turn)) / (np.sqrt(v / (1 - 0.999**turn)) + 1e-8)
    return Field(langs, weights.astype(np.float32), change, first)


class Labeller:
    """A field with the emissions of the words seen lately."""

    def __init__(self, field: Field):
        self.field, self.rows, self.emissions = field, {}, np.zeros((0, len(field.langs)), dtype=np.float32)

    def _learn(self, tokens: list[str]) -> None:
        new = [t for t in dict.fromkeys(tokens) if t not in self.rows]
        if not new:
            return
        if len(self.rows) > KEPT_WORDS:
            self.rows, self.emissions = {}, self.emissions[:0]
            new = list(dict.fromkeys(tokens))
        words = list(map(plain_word, new))
        lettered = [w for w in words if w]
        at, rows = len(self.emissions), []
        for w in words:
            rows.append(at if w else -1)
            at += bool(w)
        self.rows.update(zip(new, rows, strict=True))
        if lettered:
            self.emissions = np.concatenate([self.emissions, self.field.emissions(lettered).astype(np.float32)])

    def words(self, texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
        """(tokens with letters, words per text, text of each, probabilities)."""
        split = [t.split() for t in texts]
        tokens = [w for s in split for w in s]
        of = np.repeat(np.arange(len(texts)), [len(s) for s in split])
        self._learn(tokens)
        rows = np.fromiter(map(self.rows.__getitem__, tokens), np.int64, len(tokens))
        there = rows >= 0
        of, rows = of[there], rows[there]
        counts = np.bincount(of, minlength=len(texts))
        lengths = counts[counts > 0]
        shares = self.field.marginals(self.emissions[rows], lengths) if len(rows) else np.zeros((0, len(self.field.langs)))
        return [t for t, k in zip(tokens, there.tolist(), strict=True) if k], counts, of, shares


_labellers: dict[str, Labeller] = {}


def _labeller(shared) -> Labeller:
    """One in a Python worker, for all its tasks."""
    name, field = shared.value
    if name not in _labellers:
        _labellers.clear()
        _labellers[name] = Labeller(field)
    return _labellers[name]


def _documents(shared):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labeller = _labeller(shared)
        for batch in batches:
            for piece, texts in chunks(batch):
                _, counts, of, shares = labeller.words([t.decode() for t in texts])
                sums = np.stack([np.bincount(of, shares[:, s], len(texts)) for s in range(shares.shape[1])], 1)
                best = sums.argmax(axis=1)
                score = sums[np.arange(len(texts)), best] / np.maximum(counts, 1)
                names = [labeller.field.langs[b] if n else UNKNOWN for b, n in zip(best.tolist(), counts.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [piece.column("id"), piece.column("held_out"), pa.array(names, pa.string()),
                     pa.array(np.clip(np.where(counts > 0, score, 0.0), 0.0, 1.0))],
                    names=["id", "held_out", "lang_pred", "score"])
    return run


def _words(shared):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labeller = _labeller(shared)
        for batch in batches:
            for piece, texts in chunks(batch):
                tokens, counts, of, shares = labeller.words([t.decode() for t in texts])
                best = shares.argmax(axis=1) if len(shares) else np.zeros(0, dtype=np.int64)
                place = np.arange(len(of)) - (np.cumsum(counts) - counts)[of]
                yield pa.RecordBatch.from_arrays(
                    [piece.column("id").take(pa.array(of)), pa.array(place.astype(np.int64)), pa.array(tokens, pa.string()),
                     pa.array([labeller.field.langs[b] for b in best.tolist()], pa.string()), pa.array(shares[np.arange(len(best)), best])],
                    names=["id", "pos", "word", "lang", "p"])
    return run


def sample(docs: DataFrame, text: str, lang: str, sample_docs: int = SAMPLE_DOCS) -> list[tuple[str, str]]:
    """At most ``sample_docs`` different texts of each language, those with the least hashes."""
    rows = docs.where(F.col(text).isNotNull() & F.col(lang).isNotNull()).select(
        F.col(lang).cast("string").alias("lang"), F.col(text).alias("text"), F.xxhash64(text).alias("spot"))
    # copies count once, else a text with many of them leaves no room for others
    hashes = rows.select("lang", "spot").distinct()
    counts = hashes.groupBy("lang").agg(F.count("*").alias("n"))
    # about twice as many as are wanted, ranked among themselves
    # a row per language, fewer than the field has weights
    near = hashes.join(F.broadcast(counts), "lang").where(
        F.pmod("spot", F.lit(1 << 30)) < F.lit(2.0 * sample_docs + 50) / F.col("n") * (1 << 30))
    ranked = near.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy("spot")))
    least = ranked.where(F.col("rank") <= sample_docs).select("lang", "spot")
    one = rows.join(F.broadcast(least), ["lang", "spot"]).groupBy("lang", "spot").agg(F.min("text").alias("text"))
    return sorted((r["lang"], r["text"]) for r in one.collect())


def train(docs: DataFrame, text: str = "text", lang: str = "lang", sample_docs: int = SAMPLE_DOCS, rounds: int = ROUNDS) -> Field | None:
    return fit(sample(docs, text, lang, sample_docs), rounds=rounds)


def held_out(id: str):
    return F.coalesce(F.crc32(F.col(id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def learnable(docs: DataFrame, id: str = "doc_id") -> DataFrame:
    return docs.where(F.col(id).isNotNull() & ~held_out(id))


def identify(docs: DataFrame, field: Field | None, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: id, held_out, lang_pred and score."""
    rows = docs.select(F.col(id).cast("long").alias("id"), held_out(id).alias("held_out"), F.col(text).alias("text"))
    if field is None:
        return rows.select(F.col("id").alias(id), "held_out", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    shared = docs.sparkSession.sparkContext.broadcast((uuid.uuid4().hex, field))
    return rows.mapInArrow(_documents(shared), "id long, held_out boolean, lang_pred string, score double").withColumnRenamed("id", id)


def label_words(docs: DataFrame, field: Field, id: str = "doc_id", text: str = "text") -> DataFrame:
    """A row per word with a letter: id, pos (among them), word, lang and its probability p."""
    rows = docs.select(F.col(id).cast("long").alias("id"), F.col(text).alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast((uuid.uuid4().hex, field))
    return rows.mapInArrow(_words(shared), "id long, pos long, word string, lang string, p double").withColumnRenamed("id", id)
