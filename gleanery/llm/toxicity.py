"""Toxicity of documents by a recurrent network over overlapping windows.

A word, or each piece of a long one, enters the network as a vector of its own, if the training texts have it often
enough, beside the mean vector of its character trigrams. Both kinds of vectors start from log odds and are trained with the network. The score of a text follows from its most toxic window,
so a single bad passage in a long text counts. Training knows labels of documents only:
in every round the windows that score highest in each document carry its label. A part
of the training documents is kept back to turn the highest logit of a document, given the number of its
windows, into a probability.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanery.llm import gru
from gleanery.llm.common import fold, slices
from gleanery.llm.decontaminate import words_of

FOLDS, HELD_OUT = 4, 2
# Bounds of the training sample: documents per class, by the smallest hash of the id, and characters of each.
LABELLED = {0: 1400, 1: 700}
MOST_CHARS = 20_000

WINDOW, STRIDE = 32, 16
HIDDEN, WORD_SIZE, CHAR_SIZE, TRIGRAMS = 10, 2, 8, 8192
MOST_BYTES = 64  # of a word; a longer one counts as several
LEAST_DOCS = 3
MOST_WORDS = 50_000
ROUNDS, BATCH, RATE = 10, 128, 0.01
# Documents of a class that a word or trigram is taken to have been in besides.
PRIOR_DOCS = 3
CALIBRATED = 5  # every so many-th training document

_SLICE_BYTES = 1 << 20
_WINDOWS_AT_ONCE = 8192

# Punctuation and blanks beyond ASCII: Latin-1, general, CJK, and full-width forms of those of ASCII.
_STOPS = re.compile(rb"(?:\xC2[\xA0-\xBF]|\xE2[\x80\x81][\x80-\xBF]|\xE3\x80[\x80-\xBF]|\xEF\xBC[\x81-\x8F\x9A-\xA0])+")


def pieces_of(text: str | None) -> list[bytes]:
    """The words of a text, long ones as consecutive pieces of at most ``MOST_BYTES`` bytes and of whole characters.

    All bytes beyond ASCII are word characters, so that sentences in scripts without blanks are single words.
    A long word is cut behind its punctuation and blanks first: the same passage gives mostly the same pieces anywhere.
    """
    pieces = []
    for w in words_of(text):
        if len(w) <= MOST_BYTES:
            pieces.append(w)
            continue
        at = 0
        for stop in [*(m.end() for m in _STOPS.finditer(w)), len(w)]:
            while stop - at > MOST_BYTES:
                end = at + MOST_BYTES
                while end > at + MOST_BYTES - 4 and w[end] & 0xC0 == 0x80:
                    end -= 1
                pieces.append(w[at:end])
                at = end
            if stop > at:
                pieces.append(w[at:stop])
            at = stop
    return pieces


def _trigrams(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed trigrams of words with their edges, one word after another, and how many each has."""
    edged = [b"<" + w + b">" for w in words]
    data = np.frombuffer(b"".join(edged), np.uint8).astype(np.int64)
    lengths = np.fromiter(map(len, edged), np.int64, len(edged))
    sizes = lengths - 2
    shift = np.cumsum(lengths) - lengths - (np.cumsum(sizes) - sizes)
    at = np.arange(int(sizes.sum())) + np.repeat(shift, sizes)
    return ((data[at] * 961 + data[at + 1] * 31 + data[at + 2]) * 2654435761 >> 7) % TRIGRAMS, sizes


def windows_of(ids: np.ndarray) -> np.ndarray:
    """All windows of a text, padded with 0: every ``STRIDE`` words, the last one holds the end."""
    starts = np.arange(0, max(1, len(ids) - (WINDOW - STRIDE)), STRIDE)
    padded = np.concatenate([ids, np.zeros(WINDOW, ids.dtype)])
    return padded[starts[:, None] + np.arange(WINDOW)]


class Features(NamedTuple):
    """Of each word: its row in the vocabulary; its trigrams, one word after another, and how many."""

    rows: np.ndarray
    trigrams: np.ndarray
    sizes: np.ndarray

    def take(self, words: np.ndarray) -> Features:
        sizes = self.sizes[words]
        first, before = np.cumsum(self.sizes)[words] - sizes, np.cumsum(sizes) - sizes
        return Features(self.rows[words], self.trigrams[np.arange(int(sizes.sum())) + np.repeat(first - before, sizes)], sizes)


class Model:
    """Odds of words, vectors of trigrams, the network and the calibration: a few MB, bounded by the constants above."""

    def __init__(self, texts: list[str], labels: np.ndarray, rng: np.random.Generator):
        self.vocabulary: dict[bytes, int] = {}  # row 0 stands for all other words
        split = [set(pieces_of(t)) for t in texts]
        count = Counter(w for words in split for w in words)
        known = sorted((w for w, n in count.items() if n >= LEAST_DOCS), key=lambda w: (-count[w], w))[:MOST_WORDS]
        self.vocabulary = {w: i + 1 for i, w in enumerate(known)}
        words = [np.unique([self.vocabulary.get(w, 0) for w in s]) for s in split]
        trigrams = [np.unique(_trigrams(list(s))[0]) for s in split]
        self.words = np.stack([_odds(words, labels, len(known) + 1), np.ones(len(known) + 1)], axis=1).astype(np.float32)
        self.words[0] = 0
        self.trigrams = (0.1 * rng.standard_normal((TRIGRAMS, CHAR_SIZE))).astype(np.float32)
        self.trigrams[:, 0] = _odds(trigrams, labels, TRIGRAMS)
        self.network = gru.initial(WORD_SIZE + CHAR_SIZE, HIDDEN, rng)
        self.calibration = np.array([0.0, 1.0, 0.0])

    def features(self, words: list[bytes]) -> Features:
        return Features(np.array([self.vocabulary.get(w, 0) for w in words], np.int64), *_trigrams(words))

    def table(self, features: Features) -> np.ndarray:
        """The input vector of each word, behind a row of padding."""
        table = np.zeros((len(features.rows) + 1, WORD_SIZE + CHAR_SIZE), np.float32)
        table[1:, :WORD_SIZE] = self.words[features.rows]
        starts = np.cumsum(features.sizes) - features.sizes
        table[1:, WORD_SIZE:] = np.add.reduceat(self.trigrams[features.trigrams], starts, axis=0) / features.sizes[:, None]
        return table

    def trigram_slopes(self, features: Features, by_table: np.ndarray) -> np.ndarray:
        """Gradients of the vectors of trigrams, given those of the table."""
        slopes = np.zeros_like(self.trigrams)
        np.add.at(slopes, features.trigrams, np.repeat(by_table[1:, WORD_SIZE:] / features.sizes[:, None], features.sizes, axis=0))
        return slopes

    def word_slopes(self, features: Features, by_table: np.ndarray) -> np.ndarray:
        """Gradients of the vectors of words, given those of the table; that of all other words stays."""
        slopes = np.zeros_like(self.words)
        np.add.at(slopes, features.rows, by_table[1:, :WORD_SIZE])
        slopes[0] = 0
        return slopes

    def logits(self, table: np.ndarray, windows: np.ndarray) -> np.ndarray:
        parts = range(0, len(windows), _WINDOWS_AT_ONCE)
        return np.concatenate([gru.forward(self.network, table, windows[i : i + _WINDOWS_AT_ONCE])[0] for i in parts])

    def evidence(self, texts: list[str | None]) -> np.ndarray:
        """Per text: 1, its highest logit, the logarithm of the number of its windows; zeros if it has no words."""
        number, doc, windows = _numbered(texts)
        out = np.zeros((len(texts), 3))
        if len(doc):
            best = np.full(len(texts), -np.inf)
            np.maximum.at(best, doc, self.logits(self.table(self.features(list(number))), windows))
            counts = np.bincount(doc, minlength=len(texts))
            some = counts > 0
            out[some] = np.stack([np.ones(int(some.sum())), best[some], np.log(counts[some])], axis=1)
        return out

    def scores(self, texts: list[str | None]) -> np.ndarray:
        """The probability of each text, 0 for one without words."""
        evidence = self.evidence(texts)
        return np.where(evidence[:, 0] > 0, _sigmoid(evidence @ self.calibration), 0.0)


def _odds(sets: list[np.ndarray], labels: np.ndarray, size: int) -> np.ndarray:
    """Log odds of each number to be in the sets of label 1 against those of label 0."""
    counts = [np.bincount(np.concatenate([s for s, y in zip(sets, labels, strict=True) if y == c] or [np.zeros(0, np.int64)]), minlength=size) for c in (0, 1)]
    totals = [max(int((labels == c).sum()), 1) for c in (0, 1)]
    prior = PRIOR_DOCS / max(totals)
    return np.log(counts[1] / totals[1] + prior) - np.log(counts[0] / totals[0] + prior)


def _sigmoid(logits: np.ndarray) -> np.ndarray:
    return 0.5 + 0.5 * np.tanh(0.5 * logits.astype(np.float64))


def _numbered(texts: list[str | None]) -> tuple[dict[bytes, int], np.ndarray, np.ndarray]:
    """Numbers of the different words, from 1; the text of each window, and the windows. A text without words has none."""
    number: dict[bytes, int] = {}
    ids = [np.array([number.setdefault(w, len(number) + 1) for w in pieces_of(t)], np.int64) for t in texts]
    windows = [windows_of(i) if len(i) else np.zeros((0, WINDOW), np.int64) for i in ids]
    return number, np.repeat(np.arange(len(texts)), [len(w) for w in windows]), np.concatenate(windows)


def _calibrate(evidence: np.ndarray, labels: np.ndarray, stands_for: np.ndarray) -> np.ndarray:
    """Logistic regression by Newton steps, held near the plain logit when there are few documents.

    ``stands_for``: how many documents each one stands for, 1 on average.
    """
    start = np.array([0.0, 1.0, 0.0])
    weights = start.copy()
    for _ in range(20):
        p = _sigmoid(evidence @ weights)
        slope = evidence.T @ (stands_for * (p - labels)) + 0.5 * (weights - start)
        curve = (evidence * (stands_for * p * (1 - p))[:, None]).T @ evidence + 0.5 * np.eye(3)
        weights -= np.linalg.solve(curve, slope)
    return weights


def train(texts: list[str], labels: np.ndarray, seed: int = 1, totals: tuple[int, int] | None = None) -> Model:
    """A model of documents' labels (0 and 1) on texts that have words.

    ``totals``: how many documents of each label there are; the probabilities are calibrated to that mix, whatever the sample's.

    In every round the best window of each document is trained on, and a random one of those with
    label 0; before the first round the windows are ranked by the odds of their words.
    """
    rng = np.random.default_rng(seed)
    kept_back = np.arange(len(texts)) % CALIBRATED == CALIBRATED - 1
    own, seen = [t for t, k in zip(texts, kept_back, strict=True) if not k], labels[~kept_back]
    model = Model(own, seen, rng)
    number, doc, windows = _numbered(own)
    features = model.features(list(number))
    parameters = model.network | {"trigrams": model.trigrams, "words": model.words}
    adam = gru.Adam(parameters, RATE)
    table = model.table(features)
    scores = (table[:, 0] + table[:, WORD_SIZE])[windows].max(axis=1)
    for _ in range(ROUNDS):
        by_score, by_chance = np.lexsort((scores, doc)), np.lexsort((rng.random(len(doc)), doc))
        last = np.flatnonzero(np.diff(np.append(doc, -1)))
        clean = by_chance[last][seen[doc[last]] == 0]
        chosen = rng.permutation(np.unique(np.concatenate([by_score[last], clean])))
        for i in range(0, len(chosen), BATCH):
            part = chosen[i : i + BATCH]
            used = np.unique(np.append(0, windows[part]))
            local, these = np.searchsorted(used, windows[part]), features.take(used[1:] - 1)
            table = model.table(these)
            logits, kept = gru.forward(model.network, table, local, keep=True)
            slope = ((_sigmoid(logits) - seen[doc[part]]) / len(part)).astype(np.float32)
            gradients, by_table = gru.backward(model.network, table, local, kept, slope)
            slopes = {"trigrams": model.trigram_slopes(these, by_table), "words": model.word_slopes(these, by_table)}
            adam.step(parameters, gradients | slopes)
        scores = model.logits(model.table(features), windows)
    if kept_back.any():
        shares = np.ones(2) if totals is None else np.array(totals) / np.maximum(np.bincount(labels, minlength=2), 1)
        stands_for = shares[labels[kept_back]]
        evidence = model.evidence([t for t, k in zip(texts, kept_back, strict=True) if k])
        model.calibration = _calibrate(evidence, labels[kept_back], stands_for / stands_for.mean())
    return model


def fit(docs: DataFrame, labels: DataFrame) -> Model | None:
    """A model of ``labels`` (doc_id, toxic) outside the held-out fold, on at most ``LABELLED`` documents of each class.

    Documents of more than ``MOST_CHARS`` characters are not trained on (all are scored). An id with
    several labels counts with the higher one, one with several texts with the least of them; null labels do not count. None if there is nothing to learn from.
    """
    usable = labels.filter(F.col("toxic").isNotNull() & (fold(F.col("doc_id"), FOLDS) != HELD_OUT))
    once = usable.groupBy("doc_id").agg(F.max("toxic").alias("label"))
    short = docs.select("doc_id", "text").filter(F.length("text").between(1, MOST_CHARS))
    chosen = [once.filter(F.col("label") == c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(n) for c, n in LABELLED.items()]
    picked = F.broadcast(chosen[0].union(chosen[1]))  # as many rows as LABELLED says
    sample = short.join(picked, "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"), F.min("label").alias("label"))
    found = sorted((r.doc_id, r.text, r.label) for r in sample.collect() if words_of(r.text))
    if not found:
        return None
    totals = {r.label: r.n for r in once.groupBy("label").agg(F.count("*").alias("n")).collect()}  # two rows
    return train([r[1] for r in found], np.array([r[2] for r in found], np.int64), totals=(totals.get(0, 0), totals.get(1, 0)))


def score(docs: DataFrame, model: Model | None) -> DataFrame:
    """(doc_id, score) of every row of ``docs`` (doc_id, text), from the windows of its whole text.

    Null texts and texts without words have score 0; so have all without a model. Nothing is shuffled;
    the model is broadcast. Repeated rows are scored each, other columns are ignored.
    """
    if model is None:
        return docs.select("doc_id", F.lit(0.0).alias("score"))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", _SLICE_BYTES):
            scores = pa.array(shared.value.scores(batch.column("text").to_pylist()), pa.float64())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), scores], ["doc_id", "score"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, score double")
