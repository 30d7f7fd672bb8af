"""Near-duplicate documents by SimHash and deletion variants.

Two fingerprints of 64 bits that differ in at most three bits differ in at most one
bit of one of their two halves. Each half is therefore indexed as it is and once per
bit with that bit as a wildcard; fingerprints that meet in a variant are compared in full.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanery.llm.common import slices
from gleanery.llm.components import roots
from gleanery.session import materialise

# Fixed values of the fingerprint.
SHINGLE = 3
SEED = 42
MOST_BITS = 3

_SLICE_BYTES = 4 << 20
_CHUNK = 1 << 16
# A variant that more fingerprints share is indexed again by variants of the bits it leaves open.
CROWD = 1000
_LEAST_WIDTH = 8


def fingerprint(text: bytes) -> int:
    """SimHash of a UTF-8 text, as a signed 64-bit integer."""
    words = text.lower().split()  # bytes: A-Z and the six white-space characters of ASCII only
    if not words:
        return 0
    n = max(1, len(words) - SHINGLE + 1)
    joined, ends = b" ".join(words), np.cumsum([len(w) + 1 for w in words])
    starts = np.concatenate(([0], ends[:-1]))[:n].tolist()
    stops = (ends[min(SHINGLE, len(words)) - 1 :] - 1).tolist()
    digest, votes = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for at in range(0, n, _CHUNK):
        hashed = [digest(joined[a:b], SEED) for a, b in zip(starts[at : at + _CHUNK], stops[at : at + _CHUNK], strict=True)]
        bits = np.unpackbits(np.array(hashed, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        votes += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * votes > n, bitorder="little").view("<i8")[0])


def _fingerprint_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text", _SLICE_BYTES):
        texts = batch.column("text").cast(pa.binary()).to_pylist()
        values = pa.array([fingerprint(t or b"") for t in texts], pa.int64())
        others = [(n, batch.column(n)) for n in batch.schema.names if n != "text"]
        yield pa.RecordBatch.from_arrays([*(c for _, c in others), values], [*(n for n, _ in others), "fp"])


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, content, fp): ``content`` is a key of id and text, the same for equal rows only."""
    # Two hashes of 64 and 32 bits: their chance collisions do not matter at any number of rows.
    content = F.struct(F.xxhash64("doc_id", "text").alias("h"), F.hash("text", "doc_id").alias("g"))
    keyed = docs.select("doc_id", content.alias("content"), "text")
    return keyed.mapInArrow(_fingerprint_batches, "doc_id long, content struct<h:long,g:int>, fp long")


def _half_variants(own: Column, other: Column, half: int) -> Column:
    """Entries of the ``half`` bits from bit ``own`` on: with each bit as a wildcard, and as they are."""
    value = F.call_function("shiftrightunsigned", F.col("fp"), own).bitwiseAND(F.lit((1 << half) - 1).cast("long"))

    def entry(bit: Column, masked: Column, side: Column) -> Column:
        return F.struct(
            F.xxhash64("key", own, bit, masked).alias("key"), side.cast("int").alias("side"), other.cast("int").alias("rest")
        )

    def wildcard(bit: Column) -> Column:
        mask = F.call_function("shiftleft", F.lit(1).cast("long"), bit)
        side = F.when(value.bitwiseAND(mask) != 0, 1).otherwise(0)
        return entry(bit, value.bitwiseAND(F.bitwise_not(mask)), side)

    wildcards = F.transform(F.sequence(F.lit(0), F.lit(half - 1)), wildcard)
    return F.concat(wildcards, F.array(entry(F.lit(-1), value, F.lit(2))))


def _variants(rest: Column, width: int) -> Column:
    """Index entries of a fingerprint whose ``width`` bits from bit ``rest`` on are not settled yet.

    side 0 and 1: the value of the bit that is a wildcard; 2: none is. ``rest`` of an entry: where the other half begins.
    """
    half = width // 2
    return F.concat(_half_variants(rest, rest + half, half), _half_variants(rest + half, rest, half))


def _matches(index: DataFrame) -> DataFrame:
    one = index.filter("side != 1").select("key", F.col("side").alias("s"), F.col("fp").alias("a"))
    two = index.filter("side != 0").select("key", F.col("side").alias("t"), F.col("fp").alias("b"))
    met = ((F.col("s") == 0) & (F.col("t") == 1)) | ((F.col("s") == 2) & (F.col("t") == 2) & (F.col("a") < F.col("b")))
    close = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= MOST_BITS
    return one.join(two, "key").filter(met & close & (F.col("a") != F.col("b"))).select("a", "b")


def links(fps: DataFrame) -> DataFrame:
    """Pairs of different fingerprints (a, b) that differ in at most three bits, some of them twice.

    ``fps`` holds distinct non-null fingerprints. A variant shared by more than ``CROWD``
    fingerprints is not paired; its members are indexed again within it by the half that is still
    open, where again one half differs in at most one bit, down to bits
    that cannot hold more than some hundred different values. The index is written
    as a scratch table when this is called; only whether there is a crowd comes to the driver.
    """
    width, found = 64, None
    rows = fps.select("fp", F.lit(0).cast("long").alias("key"), F.lit(0).alias("rest"))
    while True:
        entries = rows.select("fp", F.explode(_variants(F.col("rest"), width)).alias("e"))
        index = materialise(entries.select("fp", "e.*"))
        width //= 2
        if width <= _LEAST_WIDTH:
            pairs, crowded = _matches(index), None
        else:
            crowds = materialise(index.groupBy("key").agg(F.count("*").alias("n")).filter(F.col("n") > CROWD).select("key"))
            crowded = None if crowds.isEmpty() else index.join(crowds, "key", "left_semi")
            pairs = _matches(index if crowded is None else index.join(crowds, "key", "left_anti"))
        found = pairs if found is None else found.union(pairs)
        if crowded is None:
            return found
        # a member may be in the crowd of a variant with a wildcard on either side
        rows = crowded.select("fp", "key", "rest")


def components(printed: DataFrame) -> DataFrame:
    """(fp, root, component_id) for every different fingerprint of ``printed`` (doc_id, fp).

    ``root`` names the component; ``component_id`` is its smallest doc_id, null if
    all are null. Equal fingerprints are one node, however many documents have them.
    """
    nodes = printed.groupBy("fp").agg(F.min("doc_id").alias("first"))
    linked = roots(links(nodes.select("fp"))).select(F.col("a").alias("fp"), F.col("b").alias("root"))
    rooted = materialise(nodes.join(linked, "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"), "first"))
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    return rooted.join(least, "root").select("fp", "root", "component_id")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, fingerprint, component_id.

    Null and empty texts have fingerprint zero and are linked like any other.
    Repeated rows and repeated ids are rows of their own; a row with a null id has the smallest
    id it reaches, or null. An empty table gives an empty result. Scratch tables are written
    when this is called. The last join has one row per fingerprint on its right;
    Spark splits a fingerprint of very many documents on its left.
    """
    printed = materialise(fingerprints(docs))
    found = components(printed).select("fp", "component_id")
    return printed.join(found, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of every component: one with its smallest doc_id. All columns stay."""
    printed = materialise(fingerprints(docs))
    found = components(printed)
    own = printed.join(found, "fp").filter(F.col("doc_id").eqNullSafe(F.col("component_id")))
    chosen = own.groupBy("root").agg(F.min("content").alias("content")).select(F.col("content.h").alias("h"), F.col("content.g").alias("g"))
    keyed = docs.select(F.struct("*").alias("row"), F.xxhash64("doc_id", "text").alias("h"), F.hash("text", "doc_id").alias("g"))
    kept = keyed.join(chosen, ["h", "g"], "left_semi")
    return kept.dropDuplicates(["h", "g"]).select("row.*")
