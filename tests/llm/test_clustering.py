"""Clusters against plain integer arithmetic on all pairs; the lower bound; rows that are left out."""

import hashlib
import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from gleanery.llm import clustering

SCHEMA = "vec_id long, embedding array<float>"


def plain(rows, clusters, rounds, size=64):
    """(vec_id, cluster, distance, cluster_inertia, inertia, hash) of each vector, in Python integers."""
    kept = []
    for vec_id, x in rows:
        if x is not None and len(x) == size and all(v is not None and math.isfinite(v) for v in x):
            kept.append((vec_id, [math.floor(256 * float(np.float32(v))) for v in x]))
    first = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"2:{r[0]}".encode()).hexdigest() if r[0] is not None else ""))
    centroids = [v for _, v in first[:clusters]]

    def assign():
        found = []
        for _, v in kept:
            distances = [sum((a - b) ** 2 for a, b in zip(v, c, strict=True)) for c in centroids]
            found.append((distances.index(min(distances)), min(distances)))
        return found

    for _ in range(rounds):
        found = assign()
        for i in range(len(centroids)):
            own = [v for (_, v), (c, _) in zip(kept, found, strict=True) if c == i]
            if own:
                centroids[i] = [sum(column) // len(own) for column in zip(*own, strict=True)]
    found = assign()
    inertia = {i: sum(d for c, d in found if c == i) for i in range(len(centroids))}
    hashes = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return [(r[0], c, d, inertia[c], sum(inertia.values()), hashes[c]) for r, (c, d) in zip(kept, found, strict=True)]


def result(spark, rows, schema=SCHEMA, **options):
    found = clustering.digests(clustering.cluster(spark.createDataFrame(rows, schema).repartition(3), **options)).collect()
    return sorted((tuple(r) for r in found), key=str)


def vectors(n, spread, seed=1, size=64):
    chance = np.random.default_rng(seed)
    middles = chance.standard_normal((5, size))
    return [(i, (middles[i % 5] + spread * chance.standard_normal(size)).astype(np.float32).tolist()) for i in range(n)]


def test_against_integers(spark):
    rows = vectors(120, 0.3)
    assert result(spark, rows, clusters=7) == sorted(plain(rows, 7, 5), key=str)


def test_rows_left_out_repeats_and_ties(spark):
    rows = vectors(30, 0.2)
    same = rows[3][1]
    rows += [(50 + i, same) for i in range(20)] + [(7, rows[7][1]), (7, rows[7][1]), (None, rows[8][1])]
    rows += [(90, None), (91, []), (92, [1.0] * 63), (93, [1.0] * 65), (94, [None] + [0.0] * 63), (95, [float("nan")] + [0.0] * 63)]
    rows += [(96, [float("inf")] + [0.0] * 63), (97, [-0.001] * 64), (98, [0.0] * 64), (99, [1e4] * 64)]
    wide = [(*r, 1, 2.0, "x") for r in rows]
    got = result(spark, wide, SCHEMA + ", cluster int, distance double, ints string", clusters=40)
    assert got == sorted(plain(rows, 40, 5), key=str)
    # more clusters than vectors
    assert result(spark, rows[:3], clusters=40) == sorted(plain(rows[:3], 40, 5), key=str)


def test_empty_table_and_vectors_of_no_use(spark):
    assert result(spark, []) == []
    assert result(spark, [(1, [1.0]), (2, None)]) == []


def test_components_too_large_for_64_bits(spark):
    with pytest.raises(Exception, match="64 bits"):
        result(spark, [(1, [1e30] * 64), (2, [0.0] * 64)])


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 10_000), st.integers(1, 6), st.sampled_from([1, 50, 1 << 26]))
def test_nearest_is_exact_whatever_the_rotation(seed, leading, size):
    chance = np.random.default_rng(seed)
    rows = chance.integers(-size, size + 1, (40, 6))
    centroids = rows[chance.integers(0, 40, 9)] + chance.integers(-1, 2, (9, 6))
    axes = np.linalg.qr(chance.standard_normal((6, 6)))[0]
    by = clustering.Rotation(chance.standard_normal(6) * size, axes)
    chosen, distances, _ = clustering.nearest(rows, *clustering.rotate(rows, by, leading), centroids, by)
    every = ((rows[:, None] - centroids[None]) ** 2).sum(axis=2)
    assert (chosen == every.argmin(axis=1)).all() and (distances == every.min(axis=1)).all()


def test_few_distances_are_verified():
    rows = np.array([np.floor(256 * np.array(v)) for _, v in vectors(400, 0.05)], np.int64)
    mean = rows.mean(axis=0)
    axes = np.linalg.eigh(np.cov((rows - mean).T))[1][:, ::-1]
    by = clustering.Rotation(mean, axes)
    _, _, verified = clustering.nearest(rows, *clustering.rotate(rows, by, 16), rows[:40], by)
    assert verified < 0.5 * 400 * 40
