"""Distinct counts that are kept per load and merged.

Each load of records leaves one small sketch per column; the number of different values of any loads
together comes from their sketches alone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# A sketch has 2^LG_SIZE registers: some KB.
LG_SIZE = 12
# Standard error of a merged count, as a share of it; three times as much is hardly ever exceeded.
STANDARD_ERROR = 1.04 / 2 ** (LG_SIZE / 2)

_SCHEMA = "load string, column string, sketch binary"


def column_sketches(df: DataFrame, columns: list[str], load: str) -> DataFrame:
    """(load, column, sketch) of text columns, in one pass; nulls are no value. A column without values has a null sketch."""
    made = df.agg(*[F.hll_sketch_agg(c, F.lit(LG_SIZE)).alias(c) for c in columns])
    each = [F.struct(F.lit(c).alias("column"), F.col(c).alias("sketch")) for c in columns]
    return made.select(F.lit(load).alias("load"), F.inline(F.array(*each)))


def add_load(df: DataFrame, columns: list[str], load: str, path: str) -> None:
    """Keep the sketches of a load below ``path``; the same load again replaces its earlier ones."""
    column_sketches(df, columns, load).drop("load").coalesce(1).write.mode("overwrite").parquet(f"{path.rstrip('/')}/load={load}")


def merged_counts(spark: SparkSession, path: str, loads: list[str] | None = None) -> DataFrame:
    """(column, unique_count): about how many different values the given loads, or all, have together."""
    kept = spark.read.schema(_SCHEMA).parquet(path)
    if loads is not None:
        kept = kept.filter(F.col("load").isin(loads))
    return kept.groupBy("column").agg(F.coalesce(F.hll_sketch_estimate(F.hll_union_agg("sketch")), F.lit(0)).alias("unique_count"))
