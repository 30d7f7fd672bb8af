"""Mixing of sources to target weights, in blocks of a fixed number of words.

The documents of a source, one behind the other, are a stream of words that is cut into blocks. The
slots of every output shard draw their sources independently, so that the counts of a shard are
multinomial. The n-th slot of a source takes a block by a pseudo-random permutation of the
source's blocks, another one for each time through them: no block is taken an (e + 1)-th time before all
have been taken e times. Slots and blocks then meet by source and block number.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from gleanery.llm.common import words
from gleanery.session import materialise

# Fixed values of the contract: weights of the sources in order, size of the mix, most times that a source is taken.
WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2

# Words of a block, slots of a shard.
BLOCK = 128
SLOTS = 4096
SEED = 13

# Documents of a source that are numbered in one task.
PART = 2_000
# Slots of a cell in which an interval is looked up: with as many sources at most, each slot meets few of them.
CELL = 16

_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def _scramble(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * _MIX1
        x = (x ^ (x >> np.uint64(27))) * _MIX2
        return x ^ (x >> np.uint64(31))


def permuted(index: np.ndarray, n: np.ndarray, key: np.ndarray, rounds: int = 6) -> np.ndarray:
    """Where a permutation of 0 .. n - 1, one for each ``key``, sends ``index``: a Feistel network, walked until it is back below n."""
    n, key = n.astype(np.uint64), key.astype(np.int64).view(np.uint64)
    bits = np.frexp(np.maximum(n, np.uint64(2)).astype(np.float64) - 1)[1]
    half = ((bits + 1) // 2).astype(np.uint64)
    mask = (np.uint64(1) << half) - np.uint64(1)
    found, open_ = index.astype(np.uint64), np.ones(len(index), bool)
    while open_.any():
        h, m, k, x = half[open_], mask[open_], key[open_], found[open_]
        left, right = x >> h, x & m
        for r in range(rounds):
            with np.errstate(over="ignore"):
                mixed = _scramble(right + _scramble(k + np.uint64(r + 1) * np.uint64(0x9E3779B97F4A7C15)))
            left, right = right, left ^ (mixed & m)
        found[open_] = (left << h) | right
        open_ = found >= n
    return found.astype(np.int64)


@F.pandas_udf(LongType())
def _permuted(index: pd.Series, n: pd.Series, key: pd.Series) -> pd.Series:
    return pd.Series(permuted(index.to_numpy(), n.to_numpy(), key.to_numpy()))


def _before(df: DataFrame, group: str, amount: str, name: str) -> DataFrame:
    """Sums of ``amount`` over the rows of a group before each row, in order of ``part``."""
    window = Window.partitionBy(group).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return df.withColumn(name, F.coalesce(F.sum(amount).over(window), F.lit(0)))


def _key() -> Column:
    """Stands for id and text of a document."""
    return F.struct(F.xxhash64("text", "doc_id").alias("h"), F.hash("doc_id", "text").alias("g")).alias("key")


def _sizes(docs: DataFrame) -> DataFrame:
    """(doc_id, source, size, key, copies): documents of the same id, source and text are one row."""
    sized = docs.select("doc_id", "source", F.size(words(F.col("text"))).cast("long").alias("size"), _key())
    return sized.groupBy("doc_id", "source", "size", "key").agg(F.count("*").alias("copies"))


def targets(sized: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """(source, number, documents, source_size, target): sources in order of code points, null last, and the words that each shall give.

    ``weights`` are repeated over the sources. What a source cannot give, because its target is above ``most`` times its
    size, is shared again by weight; every round of that is one sum over the sources, and no
    source comes back from its limit, so that a few rounds do.
    """
    sums = sized.groupBy("source").agg(F.sum(F.col("size") * F.col("copies")).alias("source_size"), F.sum("copies").alias("documents"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    named = sums.withColumn("number", F.row_number().over(order).cast("long") - 1)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("number") % len(weights) + 1).cast("int"))
    sources = materialise(named.withColumn("weight", weight))
    total = share * (sources.agg(F.sum("source_size")).first()[0] or 0)
    limit, rate, bound = F.col("source_size") * float(most), 0.0, None
    while True:
        above = F.col("weight") * rate > limit
        full, free, n = sources.agg(F.sum(F.when(above, limit)), F.sum(F.when(~above, F.col("weight"))), F.count_if(above)).first()
        if not free or n == bound:
            break
        rate, bound = (total - (full or 0)) / free, n
    target = F.least(F.col("weight") * rate, limit)
    return sources.select("source", "number", "documents", "source_size", target.alias("target"))


def place(sized: DataFrame, sources: DataFrame) -> DataFrame:
    """(doc_id, source, number, size, key, copy, start): every document and where it begins in the stream of its source.

    Documents of a source are in an order of their hashes, which no partitioning changes. A large source is numbered in parts of about ``PART``
    documents, whose sums are then summed.
    """
    known = sources.select(F.col("source").alias("s"), "number", F.greatest(F.ceil(F.col("documents") / PART), F.lit(1)).alias("parts"))
    joined = sized.join(known, F.col("source").eqNullSafe(F.col("s"))).drop("s")
    parted = joined.withColumn("part", F.pmod(F.col("key.h"), F.col("parts"))).withColumn("all", F.col("size") * F.col("copies"))
    sums = _before(parted.groupBy("number", "part").agg(F.sum("all").alias("n")), "number", "n", "before").drop("n")
    inside = Window.partitionBy("number", "part").orderBy("key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    started = parted.withColumn("inside", F.coalesce(F.sum("all").over(inside), F.lit(0))).join(sums, ["number", "part"])
    # many copies are dealt in two steps, so that no array is long
    far = started.withColumn("far", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("copies") - 1) / 4096))))
    near = F.sequence(F.lit(0).cast("long"), F.least(F.col("copies") - 1 - F.col("far") * 4096, F.lit(4095)))
    copy = F.col("far") * 4096 + F.col("near")
    return far.withColumn("near", F.explode(near)).select(
        "doc_id", "source", "number", "size", "key", copy.alias("copy"), (F.col("before") + F.col("inside") + copy * F.col("size")).alias("start")
    )


def quotas(sources: DataFrame, block: int = BLOCK) -> DataFrame:
    """(number, blocks, quota, below): blocks of each source, slots it shall fill, and slots of the sources before it."""
    blocks = F.ceil(F.col("source_size") / block)
    # the last block of a source is short, so slots are counted by what a block holds on average
    quota = F.round(F.col("target") * blocks / F.col("source_size")).cast("long")
    some = sources.filter("source_size > 0").select("number", blocks.alias("blocks"), F.least(quota, blocks * MOST).alias("quota"))
    before = Window.orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    return some.withColumn("below", F.coalesce(F.sum("quota").over(before), F.lit(0)))


def _owner(points: DataFrame, at: Column, owned: DataFrame) -> DataFrame:
    """Join each point to the interval (``low`` up to ``high``, no overlaps) that holds it, by equal cells."""
    cells = owned.filter("high > low").withColumn(
        "cell", F.explode(F.sequence(F.floor(F.col("low") / CELL), F.floor((F.col("high") - 1) / CELL)))
    )
    placed = points.withColumn("at", at).withColumn("cell", F.floor(F.col("at") / CELL))
    return placed.join(cells, "cell").filter("at >= low and at < high").drop("cell")


def draw(shares: DataFrame, slots: int = SLOTS, seed: int = SEED) -> DataFrame:
    """(shard, slot, number, block, round): the block of a source that each slot of each shard takes.

    Slots draw a source with the chance of its quota. Over all shards a source is drawn about, not exactly, as often as
    its quota says; so surplus draws, chosen by a permutation and thus spread over all shards, are
    handed to the sources that lack as many.
    """
    spark = shares.sparkSession
    total = shares.agg(F.sum("quota")).first()[0] or 0
    intervals = shares.select("number", "blocks", "quota", F.col("below").alias("low"), (F.col("below") + F.col("quota")).alias("high"))
    every = spark.range(total)
    point = F.pmod(F.xxhash64(F.lit(seed), "id"), F.lit(max(total, 1)))
    sources_at = _owner(every, point, intervals).select("id", "number", F.floor(F.col("id") / slots).alias("shard"))
    drawn = materialise(sources_at)
    # numbers inside a source: shard by shard
    parts = drawn.groupBy("number", F.col("shard").alias("part")).agg(F.count("*").alias("n"))
    before = _before(parts, "number", "n", "before").select("number", F.col("part").alias("shard"), "before")
    inside = Window.partitionBy("number", "shard").orderBy("id")
    nth = drawn.withColumn("inside", F.row_number().over(inside) - 1).join(before, ["number", "shard"])
    counts = parts.groupBy("number").agg(F.sum("n").alias("drawn"))
    kept = shares.join(counts, "number", "left").withColumn("drawn", F.coalesce("drawn", F.lit(0)))
    behind = Window.orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    surplus, lack = F.greatest(F.col("drawn") - F.col("quota"), F.lit(0)), F.greatest(F.col("quota") - F.col("drawn"), F.lit(0))
    settled = materialise(
        kept.withColumn("surplus", surplus)
        .withColumn("lack", lack)
        .withColumn("over", F.coalesce(F.sum("surplus").over(behind), F.lit(0)))
        .withColumn("low", F.coalesce(F.sum("lack").over(behind), F.lit(0)))
    )
    numbered = nth.join(settled.select("number", "blocks", "quota", "drawn", "over"), "number").withColumn("n", F.col("inside") + F.col("before"))
    turn = _permuted("n", "drawn", F.xxhash64(F.lit(seed), F.lit("turn"), "number"))
    turned = materialise(numbered.select("id", "shard", "number", "blocks", turn.alias("turn"), "quota", "over"))
    own = turned.filter("turn < quota").select("id", "shard", "number", "blocks", "turn")
    spare = turned.filter("turn >= quota").select("id", "shard", (F.col("turn") - F.col("quota") + F.col("over")).alias("spare"))
    lacking = settled.select("number", "blocks", "drawn", "low", (F.col("low") + F.col("lack")).alias("high"))
    handed = _owner(spare, F.col("spare"), lacking).select(
        "id", "shard", "number", "blocks", (F.col("drawn") + F.col("at") - F.col("low")).alias("turn")
    )
    taken = own.unionByName(handed).withColumn("round", F.floor(F.col("turn") / F.col("blocks")))
    block = _permuted(F.col("turn") % F.col("blocks"), "blocks", F.xxhash64(F.lit(seed), F.lit("block"), "number", "round"))
    return taken.select("shard", (F.col("id") - F.col("shard") * slots).alias("slot"), "number", block.alias("block"), "round")


def _runs(block: int) -> Column:
    """What each block holds of a document: the block, the place in it, the first word and the number of words."""
    last = F.floor((F.col("start") + F.col("size") - 1) / block)

    def run(number: Column) -> Column:
        low = F.greatest(F.col("start"), number * block)
        high = F.least(F.col("start") + F.col("size"), (number + 1) * block)
        return F.struct(
            number.alias("block"), (low - number * block).alias("at"), (low - F.col("start")).alias("first"), (high - low).alias("n")
        )

    return F.transform(F.sequence(F.floor(F.col("start") / block), last), run)


def pieces(placed: DataFrame, block: int = BLOCK) -> DataFrame:
    """(number, start, block, at, first, n): the words of the documents that each block holds; ``at`` is where in the block they stand."""
    return placed.filter("size > 0").select("number", "start", F.inline(_runs(block)))


class Mix:
    """A mix of ``docs`` (doc_id, source, text): its parts as tables.

    sources: ``targets``. documents: ``place``, one row per document. draws: ``draw``, one row per slot. spans:
    one row per run of words of one document in a slot: shard, slot, at (first word in the slot), number and start
    (which name the document), first and n (its words).

    A null text or one of white space only has no words and is in no span. A null source is a source, the last. Repeated
    rows are documents of their own. The same documents give the same mix for any order and partitioning of the rows. An empty
    table gives an empty mix. Only sums over all sources come to the driver; the sources, a row each, are numbered in one
    task. Scratch tables without texts are written when this is made.
    """

    def __init__(self, docs: DataFrame, block: int = BLOCK, slots: int = SLOTS, weights=WEIGHTS, share: float = SHARE, seed: int = SEED):
        sized = materialise(_sizes(docs))
        self.docs, self.block = docs, block
        self.sources = materialise(targets(sized, weights, share))
        self.documents = materialise(place(sized, self.sources))
        self.draws = draw(materialise(quotas(self.sources, block)), slots, seed)
        self.spans = self.draws.join(pieces(self.documents, block), ["number", "block"]).select(
            "shard", "slot", "at", "number", "start", "first", "n"
        )

    def taken(self) -> DataFrame:
        """``documents`` with source_size and target of their source, and ``taken``: the words that the mix takes, repeats counted."""
        sums = self.spans.groupBy("number", "start").agg(F.sum("n").alias("taken"))
        some = self.documents.filter("size > 0").join(sums, ["number", "start"], "left")
        none = self.documents.filter("size = 0").withColumn("taken", F.lit(0).cast("long"))
        known = self.sources.select("number", "source_size", "target")
        return some.unionByName(none).withColumn("taken", F.coalesce("taken", F.lit(0))).join(known, "number")

    def texts(self) -> DataFrame:
        """(shard, slot, text): the words of every slot, single blanks between them. Texts are cut into blocks where they are read."""
        said = self.docs.select(_key(), words(F.col("text")).alias("words")).dropDuplicates(["key"])
        cut = said.join(self.documents.filter("size > 0").select("number", "start", "size", "key"), "key").drop("key")
        held = F.slice("words", (F.col("first") + 1).cast("int"), F.col("n").cast("int"))
        runs = cut.select("number", "words", F.inline(_runs(self.block))).select("number", "block", "at", F.array_join(held, " ").alias("text"))
        whole = runs.groupBy("number", "block").agg(F.array_sort(F.collect_list(F.struct("at", "text"))).alias("runs"))
        text = F.array_join(F.transform("runs", lambda r: r["text"]), " ").alias("text")
        return self.draws.join(whole.select("number", "block", text), ["number", "block"]).select("shard", "slot", "text")
