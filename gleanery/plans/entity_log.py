"""Rare entities of a growing corpus, batch by batch.

Kept on disk: how often each entity was mentioned, the texts, and which rare entities were found in which records. A batch adds
to the counts; only the entities it mentions can cross the threshold. Those that become rare are looked for in the earlier
texts, all at once; one that is no longer rare is looked up among what was found.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanery.operators import entities
from gleanery.operators.skew import bounded
from gleanery.operators.substring import contained_strings
from gleanery.schema import ID
from gleanery.session import materialise, path_exists

_COUNTS = "entity string, n long, opening long, lower long"
_TABLES = {
    "counts": _COUNTS,
    "texts": f"{ID} long, text string",
    "found": f"string string, {ID} long, fresh boolean",
}


@dataclass
class Change:
    """What a batch changed: entities that became rare and that ceased to be (entity, freq), records by their new verdict (record_id, rare)."""

    entered: DataFrame
    left: DataFrame
    flipped: DataFrame


class EntityLog:
    """The state below ``path``, a folder that all executors share. One writer at a time.

    A batch counts once its last table is written; what a broken one has left is overwritten. Record ids are unique over all
    batches; null texts hold nothing. The results are those of ``operators.entities`` over all records, whatever the
    batches and their order.
    """

    def __init__(self, spark: SparkSession, path: str, threshold: int = entities.THRESHOLD):
        self.spark, self.path, self.threshold = spark, path.rstrip("/"), threshold
        self.batches = 0
        while path_exists(spark, f"{self.path}/counts/{self.batches + 1}/_SUCCESS"):
            self.batches += 1

    def _write(self, df: DataFrame, table: str, batch: int) -> DataFrame:
        path = f"{self.path}/{table}/{batch}"
        df.write.mode("overwrite").parquet(path, compression="zstd")
        return self.spark.read.schema(_TABLES[table]).parquet(path)

    def _read(self, table: str, batches: range) -> DataFrame:
        paths = [f"{self.path}/{table}/{b}" for b in batches]
        return self.spark.read.schema(_TABLES[table]).parquet(*paths) if paths else self.spark.createDataFrame([], _TABLES[table])

    def _counts(self, batch: int) -> DataFrame:
        return self._read("counts", range(batch, batch + 1) if batch else range(0))

    def _rare(self, counts: DataFrame) -> DataFrame:
        return entities.rare_entities(entities.merged_frequencies(counts), self.threshold)

    def frequencies(self) -> DataFrame:
        """``entity_frequencies`` of all batches."""
        return entities.merged_frequencies(self._counts(self.batches))

    def rare_ids(self) -> DataFrame:
        """``rare_entity_ids`` of all batches."""
        return self._verdicts(self._read("found", range(1, self.batches + 1)), self._rare(self._counts(self.batches)))

    def _verdicts(self, found: DataFrame, rare: DataFrame) -> DataFrame:
        return found.join(bounded(rare.select(F.col("entity").alias("string"))), "string", "left_semi").select(ID).distinct()

    def add(self, batch: DataFrame, text: str = "text") -> Change:
        """Add records (record_id, text)."""
        now, earlier = self.batches + 1, range(1, self.batches + 1)
        batch = self._write(batch.select(ID, F.col(text).alias("text")), "texts", now)
        known = self._counts(self.batches).withColumn("known", F.lit(True))
        every = known.unionByName(entities.partial_frequencies(batch).withColumn("known", F.lit(False)))
        names = ("n", "opening", "lower")
        was = [F.sum(F.when(F.col("known"), F.col(c)).otherwise(0)).alias(f"{c}_was") for c in names]
        counts = materialise(every.groupBy("entity").agg(*[F.sum(c).alias(c) for c in names], *was))
        # the entities that are rare now or were so before
        freq = entities.merged_frequency(*[F.col(c) for c in names])
        before = entities.merged_frequency(*[F.col(f"{c}_was") for c in names])
        sides = counts.select(F.col("entity").alias("string"), freq.alias("freq"), before.alias("before"))
        sides = sides.withColumns({"rare": F.col("freq").between(1, self.threshold), "was": F.col("before").between(1, self.threshold)})
        sides = materialise(sides.filter("rare or was"))
        entered = sides.filter("rare and not was").select(F.col("string").alias("entity"), "freq")
        left = sides.filter("was and not rare").select(F.col("string").alias("entity"), F.col("before").alias("freq"))
        found = contained_strings(entities.lowered(batch, "text"), sides.filter("rare")).withColumn("fresh", F.lit(True))
        if self.batches and not entered.isEmpty():
            # one pass over the texts costs no more than a look at an index of their words, which is as long
            more = contained_strings(entities.lowered(self._read("texts", earlier), "text"), entered.select(F.col("entity").alias("string")))
            found = found.unionByName(more.withColumn("fresh", F.lit(False)))
        known = self._read("found", earlier).withColumn("fresh", F.lit(False))
        found = self._write(found.select("string", ID, "fresh"), "found", now)
        held = known.unionByName(found).join(bounded(sides.select("string", "rare", "was")), "string")
        both = held.groupBy(ID).agg(F.bool_or("rare").alias("rare"), (F.bool_or("was") & ~F.bool_or("fresh")).alias("was"))
        flipped = materialise(both.filter("rare != was").select(ID, "rare"))
        change = Change(entered, left, flipped)
        self._write(counts.select("entity", *names), "counts", now)
        self.batches = now
        return change
