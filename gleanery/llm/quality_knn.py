"""Quality by a vote of the nearest labelled documents in a latent-semantic space.

Terms are trigrams of character classes, hashed words, and repetitions of words at short
distances. A truncated singular value decomposition of the labelled sample gives the latent
space; every document is projected, its cosine to every labelled vector is computed
in blocks, and the labels of the nearest ones are weighted by their similarity.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from gleanery.llm.common import fold, slices

FOLDS, HELD_OUT = 3, 1
# Labelled rows per class that the model is fitted on: those with the smallest hash of the id.
LABELLED = 1500
DIMENSIONS = 48
NEIGHBOURS = 15
SHARPNESS = 8

_SLICE_BYTES = 1 << 20
_BLOCK = 128
_PIECE = 1 << 18

# Classes of bytes: letters and digits by kind, frequent marks each by itself.
_CLASSES = [b" ", b"\n", bytes(range(97, 123)), bytes(range(65, 91)), b"0123456789", b".", b",", b"!", b"?", b"'\"()[]{}", b"-:;", b"|", b"#*$%&<>", b"@/\\_=+~^`"]
_CLASS = np.full(256, 15, np.int64)
_CLASS[128:] = 14
for _number, _bytes in enumerate(_CLASSES):
    _CLASS[list(_bytes)] = _number
_TRIGRAMS, _WORDS, _LAGS = 16**3, 4096, 4
TERMS = _TRIGRAMS + _WORDS + _LAGS
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint64)
_LOWER[65:91] += 32

# Words are hashed as polynomials modulo 2^64; the inverse of the odd base moves each to the same power.
_BASE = 0x9E3779B97F4A7C15


def _powers(base: int, n: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.concatenate(([np.uint64(1)], np.cumprod(np.full(max(n - 1, 0), base, np.uint64))))


_UP = _powers(_BASE, 1 << 12)
_DOWN = _powers(pow(_BASE, -1, 1 << 64), 1 << 12)


def _word_hashes(data: np.ndarray, space: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and first byte of every word. Equal words of up to 4096 bytes have equal hashes; those of longer ones depend on the place too."""
    edges = np.flatnonzero(np.diff(np.concatenate(([True], space, [True])).astype(np.int8)))
    starts, ends = edges[::2], edges[1::2]
    at = np.arange(len(data)) & 4095
    with np.errstate(over="ignore"):
        sums = np.concatenate(([np.uint64(0)], np.cumsum(_LOWER[data] * _UP[at], dtype=np.uint64)))
        # powers start again every 4096 bytes: a word across such a place is hashed in two parts
        split = np.minimum((starts | 4095) + 1, ends)
        first = (sums[split] - sums[starts]) * _DOWN[starts & 4095]
        length = split - starts
        second = (sums[ends] - sums[split]) * _UP[np.minimum(length, 4095)]
        hashed = first + second
        hashed ^= hashed >> np.uint64(29)
        hashed *= np.uint64(0xBF58476D1CE4E5B9)
        return hashed ^ (hashed >> np.uint64(32)), starts


def _count(piece: bytes) -> np.ndarray:
    """Counts of the terms of a piece of text."""
    data = np.frombuffer(piece, np.uint8)
    kind = _CLASS[data]
    trigrams = np.bincount((kind[:-2] << 8) + (kind[1:-1] << 4) + kind[2:], minlength=_TRIGRAMS) if len(data) > 2 else np.zeros(_TRIGRAMS)
    hashed, _ = _word_hashes(data, _SPACE[data])
    words = np.bincount((hashed % np.uint64(_WORDS)).astype(np.int64), minlength=_WORDS)
    lags = [np.count_nonzero(hashed[k:] == hashed[:-k]) for k in range(1, _LAGS + 1)]
    return np.concatenate([trigrams, words, lags])


def _pieces(text: bytes) -> Iterator[bytes]:
    """Parts of a long text, cut at white space where there is some."""
    at = 0
    while len(text) - at > _PIECE:
        cut = text.rfind(b" ", at, at + _PIECE) + 1
        cut = cut if cut > at else at + _PIECE
        yield text[at:cut]
        at = cut
    yield text[at:]


def terms(text: str | None) -> np.ndarray:
    """Weights of the terms of a text: trigrams and words by the root of their share, repetitions by their share of the words."""
    data = (text or "").encode()
    counts = sum(_count(p) for p in _pieces(data))
    n_words = max(counts[_TRIGRAMS : _TRIGRAMS + _WORDS].sum(), 1)
    counts = counts.astype(np.float32)
    counts[:_TRIGRAMS] = np.sqrt(counts[:_TRIGRAMS] / max(counts[:_TRIGRAMS].sum(), 1))
    counts[_TRIGRAMS : _TRIGRAMS + _WORDS] = 0.5 * np.sqrt(counts[_TRIGRAMS : _TRIGRAMS + _WORDS] / n_words)
    counts[-_LAGS:] = 2 * np.sqrt(counts[-_LAGS:] / n_words)
    return counts


class Model:
    """Latent space, labelled vectors and their labels: a few MB, bounded by the constants above.

    ``rows`` is the matrix of the terms, or a function that makes it, which is held only once then.
    """

    def __init__(self, rows: np.ndarray | Callable[[], np.ndarray], labels: np.ndarray, seed: int = 1, weights: tuple[float, float] = (1.0, 1.0)):
        make = rows if callable(rows) else rows.copy
        self.labels = labels.astype(np.float32)
        self.weights = np.array(weights, np.float32)[labels]
        scaled = make()
        used = sum(np.count_nonzero(scaled[at : at + _BLOCK], axis=0) for at in range(0, len(scaled), _BLOCK))
        idf = (np.log((1 + len(scaled)) / (1 + used)) + 0.1).astype(np.float32)
        scaled *= idf
        rank = min(DIMENSIONS, *scaled.shape)
        # randomised subspace iteration
        basis = np.random.default_rng(seed).standard_normal((scaled.shape[1], rank + 8)).astype(np.float32)
        for _ in range(4):
            basis = np.linalg.qr(scaled.T @ (scaled @ basis))[0]
        _, _, right = np.linalg.svd(scaled @ basis, full_matrices=False)
        del scaled
        self.projection = (idf[:, None] * (basis @ right[:rank].T)).astype(np.float32)
        self.vectors = self.project(make())

    def project(self, rows: np.ndarray) -> np.ndarray:
        found = rows @ self.projection
        return found / np.maximum(np.linalg.norm(found, axis=1, keepdims=True), 1e-9)

    def scores(self, rows: np.ndarray) -> np.ndarray:
        """Share of label 1 among the nearest labelled vectors, weighted by similarity and by how many labelled rows each stands for."""
        similarity = self.project(rows) @ self.vectors.T
        k = min(NEIGHBOURS, similarity.shape[1])
        nearest = np.argpartition(-similarity, k - 1, axis=1)[:, :k]
        weights = np.maximum(np.take_along_axis(similarity, nearest, axis=1), 1e-3) ** SHARPNESS * self.weights[nearest]
        return (weights * self.labels[nearest]).sum(axis=1) / weights.sum(axis=1)


def _term_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text", _SLICE_BYTES, _BLOCK):
        found = [terms(t) for t in batch.column("text").to_pylist()]
        places = [np.flatnonzero(f) for f in found]
        columns = [
            batch.column("label"),
            pa.array([p.astype("<u2").tobytes() for p in places], pa.binary()),
            pa.array([f[p].astype("<f4").tobytes() for f, p in zip(found, places, strict=True)], pa.binary()),
        ]
        yield pa.RecordBatch.from_arrays(columns, ["label", "places", "weights"])


def _model_batches(totals: dict[int, int]):
    """Fits the model in the one task that has the terms of all sampled documents; ``totals``: labels of each class."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = [r for b in batches for r in zip(*(c.to_pylist() for c in b.columns), strict=True)]
        if not found:
            return
        found.sort()  # not as they arrived

        def matrix() -> np.ndarray:
            rows = np.zeros((len(found), TERMS), np.float32)
            for row, (_, places, weights) in zip(rows, found, strict=True):
                row[np.frombuffer(places, "<u2")] = np.frombuffer(weights, "<f4")
            return rows

        labels = np.array([label for label, _, _ in found])
        counts = np.bincount(labels, minlength=2)
        model = Model(matrix, labels, weights=tuple(totals.get(c, 0) / max(int(counts[c]), 1) for c in (0, 1)))
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(model)], pa.binary())], ["model"])

    return run


def fit(docs: DataFrame, labels: DataFrame) -> Model | None:
    """A model of ``labels`` (doc_id, quality) outside the held-out fold, on at most ``LABELLED`` rows of each class.

    An id with several labels counts with the lower one, one with several texts with the least; null labels do not count. A
    row of a class counts for as many labels as there are of the class for each of its sampled rows, so that the mix of classes in the sample, which depends on its
    bound, does not matter. The terms of the sampled documents, at most twice ``LABELLED`` rows, meet in one task; only the
    model comes to the driver, which never holds their matrix. None if no labelled document is there.
    """
    usable = labels.filter(F.col("quality").isNotNull() & (fold(F.col("doc_id"), FOLDS) != HELD_OUT))
    once = usable.groupBy("doc_id").agg(F.min("quality").alias("label"))
    chosen = [once.filter(F.col("label") == c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(LABELLED) for c in (0, 1)]
    picked = F.broadcast(chosen[0].union(chosen[1]))  # at most 2 * LABELLED rows
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(picked, "doc_id")
    sample = texts.groupBy("doc_id").agg(F.min("text").alias("text"), F.min("label").cast("int").alias("label")).select("label", "text")
    totals = {r.label: r.n for r in once.groupBy("label").agg(F.count("*").alias("n")).collect()}  # two rows
    found = sample.mapInArrow(_term_batches, "label int, places binary, weights binary")
    fitted = found.repartition(1).mapInArrow(_model_batches(totals), "model binary").first()
    return pickle.loads(fitted.model) if fitted else None


def score(docs: DataFrame, model: Model | None) -> DataFrame:
    """``docs`` (with a column text) and a column ``score``, 0 to 1, of each whole text.

    A null text is an empty one; a column ``score`` that is there already is replaced. Repeated rows are scored each. Of labelled vectors
    that are equally near beyond the last neighbour any may vote. Without a model all scores are 0.5. Nothing is shuffled; the model
    is broadcast.
    """
    docs = docs.drop("score")
    if model is None:
        return docs.withColumn("score", F.lit(0.5))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    columns = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", _SLICE_BYTES, _BLOCK):
            rows = np.stack([terms(t) for t in batch.column("text").to_pylist()])
            scores = pa.array(shared.value.scores(rows).astype(np.float64).clip(0, 1))
            yield pa.RecordBatch.from_arrays([*batch.columns, scores], [*columns, "score"])

    return docs.mapInArrow(run, StructType(list(docs.schema.fields)).add("score", "double"))
