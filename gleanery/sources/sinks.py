"""Writers. Every path is a folder that Spark fills in parallel."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from gleanery.schema import ID, RECORD_COLUMNS


def write_jsonl(df: DataFrame, path: str) -> int:
    """One JSON object per row with all columns, NULLs included; returns the row count."""
    seen = Observation()
    df.observe(seen, F.count("*").alias("rows")).write.mode("overwrite").option("ignoreNullFields", False).json(path)
    return seen.get["rows"]


def export_subset(subset: DataFrame, path: str) -> int:
    """Write the seven record columns; an empty subset writes nothing and counts 0."""
    if subset.isEmpty():
        return 0
    return write_jsonl(subset.select(RECORD_COLUMNS), path)


def write_report(frames: dict[str, DataFrame], path: str) -> None:
    """Write report frames as JSON, one folder each, stamped with the time of writing."""
    for name, frame in frames.items():
        stamped = frame.withColumn("generation_timestamp", F.current_timestamp())
        stamped.write.mode("overwrite").option("ignoreNullFields", False).json(f"{path}/{name}")


# Columns of the comparison and how many characters are shown (0: all).
COMPARED = {"category": 100, "question": 200, "answer": 100, "value": 0, "round": 0}


def before_after(raw: DataFrame, clean: DataFrame, limit: int | None = 10) -> DataFrame:
    """Records next to their cleaned form, ``REMOVED`` where none is left.

    Pairs by record id. ``limit`` takes the first records by key.
    """
    if limit is not None:
        raw = raw.orderBy(ID).limit(limit)
    other = clean.select(F.col(ID), *[F.col(c).alias(f"new_{c}") for c in COMPARED], F.lit(True).alias("kept"))
    columns = []
    for c, n in COMPARED.items():
        old = F.coalesce(F.col(c).cast("string"), F.lit("None"))
        new = F.when(F.col("kept"), F.coalesce(F.col(f"new_{c}").cast("string"), F.lit("None"))).otherwise("REMOVED")
        columns += [
            (F.substring(old, 1, n) if n else old).alias(f"original_{c}"),
            (F.substring(new, 1, n) if n else new).alias(f"cleaned_{c}"),
        ]
    return raw.join(other, ID, "left").select(F.col(ID).alias("record_index"), *columns)


def write_before_after(raw: DataFrame, clean: DataFrame, path: str, limit: int = 10) -> None:
    before_after(raw, clean, limit).write.mode("overwrite").option("header", True).csv(path)
