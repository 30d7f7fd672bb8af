"""The corpus pipeline over ``documents``: its stages, and ``run`` for all of them.

A stage is called with the session, the rows its predecessor kept, and the folder of the tables.
Every stage works on all these rows, whatever further columns they have, and all but the last
return the columns they were given. Null and empty texts, ties, repeated rows and empty tables are
treated as the operators say.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanery.llm import decontaminate, packing, quality_knn, simhash, template_lines
from gleanery.session import materialise


def _with_text(docs: DataFrame, changed: DataFrame) -> DataFrame:
    """Rows (row, text) as rows of ``docs``, with their new texts and, where the text is another, new lengths."""
    same = F.col("text").eqNullSafe(F.col("row.text"))
    values = {"text": F.col("text"), "n_chars": F.when(same, F.col("row.n_chars")).otherwise(F.length("text").cast("long"))}
    return changed.select(*[values[c].alias(c) if c in values else F.col("row")[c].alias(c) for c in docs.columns])


def _text_key() -> Column:
    """Tells whether a text is still the same one, without carrying both."""
    return F.struct(F.xxhash64("text").alias("h"), F.hash("text").alias("g"))


def _others(docs: DataFrame) -> list[str]:
    return [c for c in docs.columns if c != "text"]


def reject_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the nearest-neighbour vote accepts (score of 0.5 or more)."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    # the text travels to Python once; whatever other columns there are are one
    rows = docs.select(F.struct(*_others(docs)).alias("row"), "text")
    scored = quality_knn.score(rows, quality_knn.fit(docs, labels)).filter("score >= 0.5")
    return scored.select(*[F.col("text") if c == "text" else F.col("row")[c].alias(c) for c in docs.columns])


def drop_recurring_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows with their texts without lines of templates that recur across documents; rows of which nothing is left go."""
    changed = template_lines.drop_recurring_lines(docs)
    left = (F.col("n_dropped") == 0) | F.col("text").rlike(r"[^\x20\x09-\x0D]")
    return _with_text(docs, changed.filter(left))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of every group of near-duplicates, the one with the smallest id."""
    return simhash.drop_near_duplicates(docs)


def cut_benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, their texts without passages of benchmark items."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    rows = docs.select(F.struct(*_others(docs)).alias("row"), _text_key().alias("was"), "text")
    changed = decontaminate.remove_passages(rows, benchmark)
    same = F.col("was") == _text_key()
    n_chars = F.when(same, F.col("row.n_chars")).otherwise(F.length("text").cast("long"))
    values = {"text": F.col("text"), "n_chars": n_chars}
    return changed.select(*[values[c].alias(c) if c in values else F.col("row")[c].alias(c) for c in docs.columns])


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The sequences of all rows in batches of a token budget."""
    return packing.pack(docs)


STAGES = [
    ("quality", reject_low_quality),
    ("lines", drop_recurring_lines),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", cut_benchmark_passages),
    ("packing", pack),
]

# The classifier is fitted and the buckets are optimised: SQL does not express them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; every stage reads what the one before has written."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
