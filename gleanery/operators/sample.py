"""Reproducible samples of exactly n records."""

from __future__ import annotations

import random

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleanery.schema import ID
from gleanery.session import materialise

# Hex digits of the sort key that name a histogram bucket: 16^4 buckets.
_BUCKET_DIGITS = 4


def sample_key(seed: int) -> Column:
    """Sort key by record id and seed; it does not depend on partitioning."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col(ID).cast("string")))


def sample_ids(candidates: DataFrame, size: int = 1000, seed: int | None = 42) -> DataFrame:
    """``size`` of the candidate ids without replacement, or all when there are fewer.

    The sample is the ids with the smallest sort keys. Buckets of keys wholly below the
    cut are taken as they are; only in the bucket the cut falls into (1/65536 of the candidates)
    the best are picked, by a top-k that every task makes for itself. The histogram is
    counted when this is called; one row of it comes to the driver. Without a seed one is drawn.
    """
    seed = random.getrandbits(63) if seed is None else seed
    keyed = materialise(candidates.select(ID, sample_key(seed).alias("key")))  # read twice
    bucket = F.left("key", F.lit(_BUCKET_DIGITS))
    counts = keyed.groupBy(bucket.alias("bucket")).agg(F.count("*").alias("n"))
    cut = _cut(counts, size)
    if cut is None:
        return keyed.select(ID)
    name, room = cut
    within = keyed.filter(bucket == name).orderBy("key", ID).limit(room)
    return keyed.filter(bucket < name).union(within).select(ID)


def _cut(counts: DataFrame, size: int) -> tuple[str, int] | None:
    """The bucket in which the ``size``-th key lies and how many of its keys are wanted."""
    upto = F.sum("n").over(Window.orderBy("bucket"))  # at most 65536 rows
    found = counts.withColumn("upto", upto).filter(F.col("upto") >= size).orderBy("bucket").limit(1).collect()
    return (found[0]["bucket"], size - found[0]["upto"] + found[0]["n"]) if found else None


def sample_records(df: DataFrame, candidates: DataFrame, size: int = 1000, seed: int | None = 42) -> DataFrame:
    """The records of a sample of the candidate ids.

    The sampled ids are written once, so that Spark knows their number when it chooses the join.
    """
    return df.join(materialise(sample_ids(candidates, size, seed)), ID, "left_semi")
