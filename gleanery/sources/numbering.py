"""Consecutive row numbers in the order of the input: by file, place in the file, position.

A row knows the part of the input it was read from and its position there. The parts are counted, the
counts are summed in order, and a row's number is the sum before its part plus its position. No
row is sorted or moved for it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gleanery.schema import ID
from gleanery.session import materialise

# Where a row was read: its file, the part of the file that was read in one go, and its position in it.
FILE, PART, POSITION = "_file", "_part", "_position"


def place_lines(df: DataFrame) -> DataFrame:
    """Where each row of a table read from lines of text files was read; rows of a part come in order."""
    return df.select(
        "*",
        F.col("_metadata.file_path").alias(FILE),
        F.col("_metadata.file_block_start").alias(PART),
        F.monotonically_increasing_id().alias(POSITION),
    )


def place_parquet(df: DataFrame) -> DataFrame:
    """Where each row of a table read from Parquet files was read."""
    return df.select(
        "*", F.col("_metadata.file_path").alias(FILE), F.lit(0).cast("long").alias(PART), F.col("_metadata.row_index").alias(POSITION)
    )


def number_rows(placed: DataFrame) -> DataFrame:
    """Give every row its number from 0 as ``record_id``, instead of its place.

    ``placed`` is a written table, so that places stay as they are; positions in a part are consecutive
    from any first one. The numbers do not depend on how the input was cut into parts.
    The parts, some 128 MB of input each, are counted in every task and summed in one.
    """
    parts = placed.groupBy(FILE, PART).agg(F.min(POSITION).alias("first"), F.count("*").alias("n"))
    before = Window.orderBy(FILE, PART).rowsBetween(Window.unboundedPreceding, -1)
    shift = (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")).alias("shift")
    shifts = materialise(parts.select(FILE, PART, shift))
    numbered = placed.join(shifts, [FILE, PART]).withColumn(ID, F.col(POSITION) + F.col("shift"))
    return numbered.drop(FILE, PART, POSITION, "shift")
