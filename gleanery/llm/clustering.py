"""Exact k-means in integers, with distances bounded from below in rotated coordinates.

The principal axes of all vectors give a rotation. A vector is stored with its integers, its leading
rotated coordinates and the norm of the rest, its residual. The distance in the leading coordinates plus the squared
difference of the residual norms is never above the distance to a centroid; only centroids whose bound does
not exceed the distance to the most promising one are verified, in integers.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanery.session import materialise

# Fixed values of the contract.
COMPONENTS = 64
SCALE = 256
CLUSTERS = 40
ROUNDS = 5
SEED = 2

# Rotated coordinates that are stored.
LEADING = 16
# Integers up to this size have distances that fit in 64 bits.
LARGEST = 1 << 27

_BLOCK = 1024


def _kept(vectors: DataFrame, components: int) -> DataFrame:
    """(vec_id, embedding) of vectors with all components, none of them null, NaN or infinite."""
    value = F.col("embedding").cast("array<double>")
    finite = F.forall("embedding", lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    return vectors.select("vec_id", value.alias("embedding")).filter((F.size("embedding") == components) & finite)


def _integers(batch: pa.RecordBatch, components: int) -> np.ndarray:
    values = batch.column("embedding").flatten().to_numpy(zero_copy_only=False).reshape(-1, components)
    floors = np.floor(values * SCALE)
    if len(floors) and np.abs(floors).max() > LARGEST:
        raise ValueError(f"components beyond {LARGEST // SCALE} have distances that do not fit in 64 bits")
    return floors.astype(np.int64)


def _int_batches(components: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = np.ascontiguousarray(_integers(batch, components), "<i4")
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), _binary(rows)], ["vec_id", "ints"])

    return run


def _binary(rows: np.ndarray) -> pa.Array:
    return pa.array([r.tobytes() for r in rows], pa.binary())


def _read(column: pa.Array, kind: str) -> np.ndarray:
    """Rows of equally long binary values as an array."""
    found = np.frombuffer(b"".join(column.to_pylist()), kind)
    return found.reshape(len(column), -1) if len(column) else found.reshape(0, 1)


class Rotation(NamedTuple):
    """Mean and principal axes (as columns, by falling variance) of all vectors."""

    mean: np.ndarray
    axes: np.ndarray


def _moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each task: number, sum and sum of products of its vectors, in floating point."""
    n, total, products = 0, 0.0, 0.0
    for batch in batches:
        rows = _read(batch.column("ints"), "<i4").astype(np.float64)
        if len(rows):
            n, total, products = n + len(rows), total + rows.sum(axis=0), products + rows.T @ rows
    if n:
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64()), pa.array([total.tolist()]), pa.array([products.ravel().tolist()])], ["n", "total", "products"])


def _sum_arrays(column: str, size: int) -> Column:
    return F.array(*[F.sum(F.col(column)[i]) for i in range(size)])


def rotation(table: DataFrame, components: int) -> Rotation | None:
    """Principal axes of ``table`` (ints); the driver receives one sum per task of ``components`` squared numbers, added in a tree."""
    sums = table.select("ints").mapInArrow(_moments, "n long, total array<double>, products array<double>")
    # few rows, wide ones: each number is summed by itself
    long = sums.select("n", F.posexplode(F.concat("total", "products")).alias("place", "value"))
    found = long.groupBy("place").agg(F.sum("value").alias("value"), F.sum("n").alias("n")).collect()
    if not found:
        return None
    n, values = found[0].n, np.zeros(components * (components + 1))
    for r in found:
        values[r.place] = r.value
    mean = values[:components] / n
    covariance = values[components:].reshape(components, components) / n - np.outer(mean, mean)
    return Rotation(mean, np.linalg.eigh(covariance)[1][:, ::-1])


def rotate(rows: np.ndarray, by: Rotation, leading: int) -> tuple[np.ndarray, np.ndarray]:
    """Leading coordinates and residual norms of integer vectors."""
    turned = (rows - by.mean) @ by.axes
    return turned[:, :leading], np.linalg.norm(turned[:, leading:], axis=1)


def _rotated_batches(by: Rotation, leading: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lead, rest = rotate(_read(batch.column("ints"), "<i4"), by, leading) if batch.num_rows else (np.zeros((0, leading)), np.zeros(0))
            stored = [_binary(lead.astype("<f8")), pa.array(rest, pa.float64())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *stored], ["vec_id", "ints", "lead", "residual"])

    return run


def nearest(rows: np.ndarray, lead: np.ndarray, rest: np.ndarray, centroids: np.ndarray, by: Rotation) -> tuple[np.ndarray, np.ndarray, int]:
    """Nearest centroid (the first of equally near ones) and squared distance of each integer vector, and the number of distances verified."""
    c_lead, c_rest = rotate(centroids, by, lead.shape[1])
    bounds = (lead**2).sum(axis=1)[:, None] - 2 * lead @ c_lead.T + (c_lead**2).sum(axis=1) + (rest[:, None] - c_rest) ** 2
    # what rounding may add to a bound: far more than the error of the sums above, far less than most distances
    size = (lead**2).sum(axis=1) + rest**2 + (c_lead**2).sum(axis=1).max() + (c_rest**2).max()
    slack = 1e-9 * size + 1e-6
    distances = np.full(bounds.shape, np.iinfo(np.int64).max)
    every = np.arange(len(rows))

    def verify(i: np.ndarray, c: np.ndarray) -> None:
        for at in range(0, len(i), _BLOCK * 8):
            a, b = i[at : at + _BLOCK * 8], c[at : at + _BLOCK * 8]
            distances[a, b] = ((rows[a] - centroids[b]) ** 2).sum(axis=1)

    first = bounds.argmin(axis=1)
    verify(every, first)
    survivors = bounds - slack[:, None] <= distances[every, first][:, None]
    survivors[every, first] = False
    i, c = np.nonzero(survivors)
    verify(i, c)
    chosen = distances.argmin(axis=1)
    return chosen, distances[every, chosen], len(rows) + len(i)


def _assign(batch: pa.RecordBatch, centroids: np.ndarray, by: Rotation) -> Iterator[tuple[slice, np.ndarray, np.ndarray, np.ndarray]]:
    for at in range(0, batch.num_rows, _BLOCK):
        part = batch.slice(at, _BLOCK)
        rows = _read(part.column("ints"), "<i4").astype(np.int64)
        rest = part.column("residual").to_numpy(zero_copy_only=False)
        chosen, distances, _ = nearest(rows, _read(part.column("lead"), "<f8"), rest, centroids, by)
        yield slice(at, at + len(rows)), rows, chosen, distances


def _sums(centroids: np.ndarray, by: Rotation):
    """For each task a row for each of its clusters: the cluster, its vectors and their sums."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(centroids)
        counts, sums = np.zeros(k, np.int64), np.zeros(centroids.shape, np.int64)
        for batch in batches:
            for _, rows, chosen, _ in _assign(batch, centroids, by):
                counts += np.bincount(chosen, minlength=k)
                np.add.at(sums, chosen, rows)
        full = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(full, pa.int32()), pa.array(counts[full]), pa.array(sums[full].tolist(), pa.list_(pa.int64()))], ["cluster", "n", "sums"]
        )

    return run


def first_centroids(table: DataFrame, clusters: int, seed: int) -> np.ndarray:
    """The ``clusters`` vectors with the smallest hashes of seed and id, in that order; null ids last, equal ids by their components."""
    name = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    chosen = table.select("ints", name.alias("name")).orderBy(F.col("name").asc_nulls_last(), F.hex("ints")).limit(clusters).collect()
    return np.array([np.frombuffer(r.ints, "<i4") for r in chosen], np.int64)


def lloyd_round(table: DataFrame, centroids: np.ndarray, by: Rotation) -> np.ndarray:
    """Centroids moved to the floors of their vectors' means; empty ones stay. The driver receives one sum for each cluster and component."""
    parts = table.select("ints", "lead", "residual").mapInArrow(_sums(centroids, by), "cluster int, n long, sums array<long>")
    wide = F.posexplode("sums").alias("place", "value")
    sums = parts.select("cluster", "n", wide).groupBy("cluster", "place").agg(F.sum("n").alias("n"), F.sum(F.col("value").cast("decimal(38,0)")).alias("value"))
    moved = centroids.copy()
    for r in sums.collect():
        moved[r.cluster, r.place] = int(r.value) // r.n
    return moved


class Clusters(NamedTuple):
    """Final centroids, and the stored vectors with cluster and distance (vec_id, cluster, distance)."""

    centroids: np.ndarray
    assigned: DataFrame


def cluster(
    vectors: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS, seed: int = SEED, components: int = COMPONENTS, leading: int = LEADING
) -> Clusters:
    """Clusters of ``vectors`` (vec_id, embedding: an array of numbers) after ``rounds`` of Lloyd's iteration.

    Vectors with other than ``components`` components, or with null, NaN or infinite ones, are left out. Components become
    ``floor(SCALE * x)``; those beyond 2^27 raise, since their distances do not fit in 64 bits. Distances are squared;
    of equally near centroids the one with the smaller number is taken. Fewer vectors than
    clusters give as many clusters; repeated rows are vectors of their own; a null vec_id is
    kept and is a first centroid only if there are not enough others. An empty table gives an empty result. The stored
    vectors and the assignment are written as scratch tables when this is called; the driver receives sums per cluster and component only.
    """
    kind = dict(vectors.dtypes)["vec_id"]
    ints = materialise(_kept(vectors, components).mapInArrow(_int_batches(components), f"vec_id {kind}, ints binary"))
    by = rotation(ints, components)
    if by is None:
        none = ints.select("vec_id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance"))
        return Clusters(np.zeros((0, components), np.int64), none)
    stored = materialise(ints.mapInArrow(_rotated_batches(by, leading), f"vec_id {kind}, ints binary, lead binary, residual double"))
    centroids = first_centroids(stored, clusters, seed)
    for _ in range(rounds):
        centroids = lloyd_round(stored, centroids, by)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, _, chosen, distances in _assign(batch, centroids, by):
                ids = batch.column("vec_id").slice(at.start, len(chosen))
                yield pa.RecordBatch.from_arrays([ids, pa.array(chosen, pa.int32()), pa.array(distances)], ["vec_id", "cluster", "distance"])

    return Clusters(centroids, materialise(stored.mapInArrow(run, f"vec_id {kind}, cluster int, distance long")))


def digests(found: Clusters) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of each vector."""
    summed = found.assigned.groupBy("cluster").agg(F.sum("distance").alias("distance")).collect()  # a row per cluster
    whole = sum(r.distance for r in summed)
    hashes = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in found.centroids.tolist()]
    rows = [(r.cluster, r.distance, whole, hashes[r.cluster]) for r in summed]
    kinds = "cluster int, cluster_inertia long, inertia long, centroid_sha256 string"
    facts = F.broadcast(found.assigned.sparkSession.createDataFrame(rows, kinds))
    return found.assigned.join(facts, "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
