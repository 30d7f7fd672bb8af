"""Packing of documents into batches of a token budget with little padding.

Documents are cut into sequences of at most a context. The histogram of sequence lengths over
the whole corpus gives the bucket lengths for which padding is least, by dynamic programming;
sequences are then numbered inside their bucket and batched.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleanery.llm.common import words
from gleanery.session import materialise

# Sequences of a bucket are numbered in so many parts, whose counts are then summed.
PARTS = 1024


def word_tokens(text: Column) -> Column:
    """A token for each word between white space."""
    return F.size(words(text))


def optimal_buckets(histogram: dict[int, int], buckets: int) -> list[int]:
    """Bucket lengths, ascending, that cover all lengths of the histogram with the least padding.

    best[j]: least padding of the lengths up to the j-th with the buckets so far. The last bucket
    of those ends at the j-th length and begins behind an i-th.
    """
    lengths = np.array(sorted(histogram), np.int64)
    counts = np.array([histogram[n] for n in lengths.tolist()], np.float64)
    if not len(lengths):
        return []
    upto, total = np.append(0, np.cumsum(counts)), np.append(0, np.cumsum(counts * lengths))
    n = len(lengths)
    best, choices = np.append(0, np.full(n, np.inf)), []
    for _ in range(min(buckets, n)):
        chosen, least = np.zeros(n + 1, np.int64), np.append(0, np.zeros(n))
        for j in range(1, n + 1):
            costs = best[:j] + lengths[j - 1] * (upto[j] - upto[:j]) - (total[j] - total[:j])
            chosen[j] = i = int(np.argmin(costs))
            least[j] = costs[i]
        choices.append(chosen)
        best = least
    ends, j = [], n
    for chosen in reversed(choices):
        if j:
            ends.append(int(lengths[j - 1]))
            j = int(chosen[j])
    return ends[::-1]


def sequences(docs: DataFrame, context: int, tokens=word_tokens) -> DataFrame:
    """(doc_id, chunk, start, n_tokens): every document cut every ``context`` tokens; one without tokens is an empty sequence."""
    n = docs.select("doc_id", tokens(F.col("text")).cast("long").alias("n"))
    chunks = F.sequence(F.lit(0), F.greatest(F.ceil(F.col("n") / context) - 1, F.lit(0)).cast("int"))
    start = F.col("chunk").cast("long") * context
    return n.select("doc_id", "n", F.explode(chunks).alias("chunk")).select(
        "doc_id", "chunk", start.alias("start"), F.least(F.col("n") - start, F.lit(context)).alias("n_tokens")
    )


def pack(docs: DataFrame, context: int = 2048, buckets: int = 16, budget: int = 65536, tokens=word_tokens) -> DataFrame:
    """One row per sequence of ``docs`` (doc_id, text): doc_id, chunk, start, n_tokens, bucket, batch, slot.

    ``bucket`` is the padded length; batch ``batch`` of a bucket holds ``budget // bucket``
    sequences, at least one, all but the last batch of a bucket that many. Nothing is
    dropped or shortened. A null text has no tokens, like an empty one; repeated rows
    are sequences of their own. The lengths are written once as a scratch table without texts when this is called; the
    driver receives the histogram, at most ``context`` + 1 rows. An empty table gives an empty result.
    """
    cut = materialise(sequences(docs, context, tokens))
    histogram = {r.n_tokens: r.n for r in cut.groupBy("n_tokens").agg(F.count("*").alias("n")).collect()}
    ends = optimal_buckets(histogram, buckets) or [0]
    bucket = F.array_min(F.filter(F.array(*[F.lit(e).cast("long") for e in ends]), lambda e: e >= F.col("n_tokens")))
    part = F.pmod(F.xxhash64("doc_id", "chunk", "n_tokens"), F.lit(PARTS)).cast("int")
    placed = cut.withColumn("bucket", bucket).withColumn("part", part)
    counts = placed.groupBy("bucket", "part").agg(F.count("*").alias("n"))
    before = Window.partitionBy("bucket").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("bucket", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    inside = Window.partitionBy("bucket", "part").orderBy("doc_id", "chunk", "n_tokens")
    number = F.row_number().over(inside) - 1 + F.col("before")
    room = F.greatest(F.floor(F.lit(budget) / F.greatest("bucket", F.lit(1))), F.lit(1))
    # at most a row per bucket and part
    numbered = placed.join(F.broadcast(offsets), ["bucket", "part"]).withColumn("number", number)
    return numbered.select(
        "doc_id",
        "chunk",
        "start",
        "n_tokens",
        "bucket",
        F.floor(F.col("number") / room).alias("batch"),
        (F.col("number") % room).alias("slot"),
    )
