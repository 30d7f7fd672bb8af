"""Normalising and counting freshly loaded records."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanery.functions.text import nonblank
from gleanery.schema import ID, RECORD_COLUMNS


def check_columns(columns: list[str]) -> None:
    """Raise when a required column is absent."""
    missing = [c for c in RECORD_COLUMNS if c not in columns]
    if missing:
        raise ValueError(f"Missing required columns: {missing}")


def first_rows(df: DataFrame, n: int) -> DataFrame:
    """The first ``n`` records by key."""
    return df.orderBy(ID).limit(n)


def normalise(df: DataFrame) -> DataFrame:
    """Drop records without question or answer and bring the columns to text.

    ``category``, ``question`` and ``answer`` are stripped and blank becomes NULL.
    ``category``, ``value``, ``show_number`` and ``air_date`` turn NULL into the
    text ``None``; ``round`` is left alone, so its NULLs reach the validator.
    """
    columns = {c: F.col(c).cast("string") for c in RECORD_COLUMNS}
    for c in ("category", "value", "show_number", "air_date"):
        columns[c] = F.coalesce(columns[c], F.lit("None"))
    for c in ("category", "question", "answer"):
        columns[c] = nonblank(columns[c])
    return (
        df.dropna(subset=["question", "answer"])
        .withColumns(columns)
        .dropna(how="all", subset=RECORD_COLUMNS)
    )


def load_counts(df: DataFrame) -> DataFrame:
    """Records before and after ``normalise``, and how many were dropped."""
    kept = F.count_if(F.col("question").isNotNull() & F.col("answer").isNotNull())
    return df.agg(F.count("*").alias("loaded"), kept.alias("kept")).withColumn("removed", F.col("loaded") - F.col("kept"))


def null_profile(df: DataFrame) -> DataFrame:
    """NULL count and share per column, in one pass."""
    counts = df.agg(F.count("*").alias("total"), *[F.count_if(F.col(c).isNull()).alias(c) for c in RECORD_COLUMNS])
    return counts.unpivot("total", RECORD_COLUMNS, "column", "null_count").select(
        "column", "null_count", F.try_divide(F.col("null_count") * 100, F.col("total")).alias("null_pct")
    )
