"""The quality vote: held-out accuracy, exact neighbours, odd inputs."""

import random
import tracemalloc
import zlib

import numpy as np
import pytest

from gleanery.llm import quality_knn
from gleanery.llm.queries import op4_quality_knn

SMALL = "/root/testdata/sf0.01"


def corpus():
    r = random.Random(4)
    words = ["".join(r.choice("abcdefghij") for _ in range(r.randrange(2, 9))) for _ in range(800)]
    rows, labels = [], []
    for i in range(300):
        text = [r.choice(words) for _ in range(r.randrange(25, 300))]
        bad = i % 3 == 0
        if bad:
            text = [w.upper() + "!!" for w in text] if i % 2 else [w for w in text[:60] for _ in range(6)]
        rows.append((i, " ".join(text), 0.5, "x"))
        labels.append((i, 0 if bad else 1, 0))
    return rows, labels


@pytest.fixture(scope="module")
def tables(spark):
    rows, labels = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string, score double, label string")
    return docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_held_out_rows(spark, tables):
    docs, labels = tables
    truth = {r.doc_id: r.quality for r in labels.collect()}
    scored = quality_knn.score(docs.select("doc_id", "text"), quality_knn.fit(docs, labels)).collect()
    held = [r for r in scored if zlib.crc32(str(r.doc_id).encode()) % 3 == 1]
    assert len(scored) == 300 and all((r.score >= 0.5) == truth[r.doc_id] for r in held)


def test_labels_of_the_held_out_fold_are_not_read(spark, tables):
    docs, labels = tables
    flipped = labels.selectExpr("doc_id", "if(crc32(cast(doc_id as string)) % 3 = 1, 1 - quality, quality) as quality")
    a, b = (sorted(map(tuple, quality_knn.score(docs.select("doc_id", "text"), quality_knn.fit(docs, x)).collect())) for x in (labels, flipped))
    assert a == b


def test_vote_against_brute_force():
    rng = np.random.default_rng(2)
    rows = rng.random((60, quality_knn.TERMS)).astype(np.float32) * (rng.random((60, quality_knn.TERMS)) < 0.02)
    labels = rng.integers(0, 2, 60)
    model = quality_knn.Model(rows, labels)
    for row, score in zip(rows[:20], model.scores(rows[:20]), strict=True):
        own = row @ model.projection
        cosines = [float(own @ v / np.linalg.norm(own) / max(np.linalg.norm(v), 1e-9)) for v in model.vectors]
        near = sorted(range(60), key=lambda i: -cosines[i])[: quality_knn.NEIGHBOURS]
        weights = [max(cosines[i], 1e-3) ** quality_knn.SHARPNESS for i in near]
        assert score == pytest.approx(sum(w * labels[i] for w, i in zip(weights, near, strict=True)) / sum(weights), abs=1e-3)


def test_the_matrix_is_held_once():
    size = 1200 * quality_knn.TERMS * 4

    def matrix():
        rows = np.zeros((1200, quality_knn.TERMS), np.float32)
        rows[np.arange(6000) % 1200, np.random.default_rng(3).integers(0, quality_knn.TERMS, 6000)] = 1
        return rows

    labels = np.arange(1200) % 2
    plain = quality_knn.Model(matrix(), labels)
    tracemalloc.start()
    try:
        model = quality_knn.Model(matrix, labels)
        most = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert most < 1.6 * size and np.array_equal(model.vectors, plain.vectors) and np.array_equal(model.projection, plain.projection)


def test_word_hashes_do_not_depend_on_the_place():
    word = b"abcdefgh" * 20
    data = np.frombuffer((b"x " * 2000 + word + b" ") * 6 + word, np.uint8)
    hashes, starts = quality_knn._word_hashes(data, quality_knn._SPACE[data])
    own = [h for h, s in zip(hashes, starts, strict=True) if data[s] == ord("a")]
    assert len(own) == 7 and len(set(own)) == 1


def test_defined_cases(spark, tables):
    docs, labels = tables
    model = quality_knn.fit(docs, labels)
    rows = [(None, None), (1, ""), (1, ""), (2, " "), (3, "a"), (4, "word " * 300_000), (5, "z" * 600_000)]
    odd = spark.createDataFrame(rows, "doc_id long, text string")
    scored = quality_knn.score(odd, model).collect()
    assert len(scored) == 7 and all(0 <= r.score <= 1 for r in scored)
    assert quality_knn.score(odd.limit(0), model).collect() == []
    none = quality_knn.fit(docs, labels.limit(0))
    assert none is None and {r.score for r in quality_knn.score(odd, none).collect()} == {0.5}
    twice = quality_knn.fit(docs, labels.union(labels.selectExpr("doc_id", "null", "toxic")).union(labels))
    assert len(twice.labels) == len(model.labels)
    only = quality_knn.fit(docs, labels.filter("quality = 1"))
    assert {r.score for r in quality_knn.score(odd, only).collect()} == {1.0}


def test_the_driver_holds_the_model_only(spark):
    r = random.Random(5)
    rows = [(i, " ".join(r.choice("abcdef") * r.randrange(1, 9) for _ in range(20)), i % 2) for i in range(1500)]
    table = spark.createDataFrame(rows, "doc_id long, text string, quality int").repartition(8)
    quality_knn.fit(table.limit(10), table)  # whatever is loaded at the first call
    tracemalloc.start()
    try:
        model = quality_knn.fit(table, table)
        most = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    sampled = [x for x in rows if zlib.crc32(str(x[0]).encode()) % 3 != 1]
    assert len(model.labels) == len(sampled) > 900
    assert most < len(sampled) * quality_knn.TERMS * 4 / 2, f"{most / 1e6:.0f} MB"  # half of a matrix of all terms
    found = [(label, quality_knn.terms(text)) for _, text, label in sampled]
    found.sort(key=lambda x: (x[0], np.flatnonzero(x[1]).astype("<u2").tobytes(), x[1][x[1] != 0].tobytes()))
    matrix, labels = np.stack([f for _, f in found]), np.array([label for label, _ in found])
    expected = quality_knn.Model(matrix, labels)
    assert np.allclose(model.scores(matrix[::50]), expected.scores(matrix[::50]), atol=1e-3)


def test_given_labels(spark):
    truth = {r.doc_id: r.quality for r in spark.read.parquet(f"{SMALL}/labels.parquet").collect()}
    found = op4_quality_knn(spark, SMALL).collect()
    held = [r for r in found if r.held_out and r.doc_id in truth]
    assert len(found) == spark.read.parquet(f"{SMALL}/documents.parquet").count()
    assert sum(r.predicted == truth[r.doc_id] for r in held) >= 0.97 * len(held)
