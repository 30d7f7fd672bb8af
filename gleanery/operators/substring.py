"""Which texts contain which strings, by one pass over the texts.

Comparing every text with every string is a cross join, and joining pieces of the texts with the strings shuffles
many times the texts. Here the texts stay where they are:

1. Bits of all strings, in tables of bounded size, are sent to all tasks (``scan``). They tell the places of a text
   where a string may stand; the distinct strings found in a text go on with its key.
2. The distinct strings found in all texts are compared with the strings themselves. What the bits let through by chance is
   taken out by a join whose right side is those few.

So the work grows with the texts, and what is written and shuffled with what is found.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanery.operators.scan import WINDOW, Strings, found_in, listed, packed, read_strings
from gleanery.operators.skew import bounded, is_small
from gleanery.schema import ID
from gleanery.session import materialise


def by_chance(found: DataFrame, strings: DataFrame) -> DataFrame:
    """The distinct rows of ``found`` that are not among the rows of ``strings``; both have the same columns."""
    right = strings.select(found.columns)
    return materialise(found.distinct().join(bounded(right, is_small(strings)), found.columns, "left_anti"))


def _held(strings: Strings, window: int):
    """Batches of (record_id, text) to the records that may hold a string, with the distinct ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, _, held in found_in(strings, batch.column("text"), window):
                some = [i for i, h in enumerate(held) if h]
                found = packed([string for i in some for string, _ in held[i]])
                keys = batch.column(ID).take(pa.array([row + i for i in some], pa.int64()))
                yield pa.RecordBatch.from_arrays([keys, listed([len(held[i]) for i in some], found)], [ID, "found"])

    return run


def contained_strings(texts: DataFrame, strings: DataFrame, window: int = WINDOW, ids_only: bool = False) -> DataFrame:
    """Distinct (record_id, string) where the text of the record contains the string.

    With ``ids_only`` the distinct record ids alone.

    ``texts`` holds (record_id, text), ``strings`` holds distinct non-empty strings. Both sides are compared
    as they are: lower-case them first for a caseless match. The texts are read once. ``window`` is the number of places of the
    texts that are looked at together. The steps run when this is called; what ``explain`` shows of the result is the last one.
    """
    texts, strings = texts.select(ID, "text"), materialise(strings.select("string"))
    shared = texts.sparkSession.sparkContext.broadcast(read_strings(strings))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _held(shared.value, window)(batches)

    held = materialise(texts.mapInArrow(run, f"{ID} {dict(texts.dtypes)[ID]}, found array<string>"), "zstd")
    shared.unpersist()
    pairs = held.select(ID, F.explode("found").alias("string"))
    false = by_chance(pairs.select("string"), strings)
    if not false.isEmpty():
        pairs = pairs.join(bounded(false), "string", "left_anti").select(ID, "string")
    elif ids_only:
        pairs = held
    if ids_only:
        return pairs.select(ID).distinct()
    repeated = held.groupBy(ID).agg(F.count("*").alias("n")).filter("n > 1")
    return pairs if repeated.isEmpty() else pairs.distinct()
