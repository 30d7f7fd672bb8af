"""Small helpers that several operators of this package share."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: what separates words in the contracts that speak of white space.
WORD_BREAK = r"[\x20\x09-\x0D]+"


def words(text: Column) -> Column:
    """The words of a text as an array; a null text has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), WORD_BREAK), "")


def bind(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns that are computed once.

    The optimiser merges neighbouring projections and would copy an expression into
    every lambda that uses it, to be evaluated per array element. A generator
    between the two keeps them apart.
    """
    row = F.struct(*[value.alias(name) for name, value in columns.items()])
    return df.select("*", F.inline(F.array(row)))


def let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once."""
    return F.transform(F.array(value), use)[0]


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % folds


def slices(batches: Iterator[pa.RecordBatch], column: str, most_bytes: int, most_rows: int = 4096) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that the texts of a slice hold about ``most_bytes`` bytes.

    A single longer text is a slice of its own.
    """
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        start, held = 0, 0
        for i, size in enumerate(sizes):
            if i > start and (held + size > most_bytes or i - start >= most_rows):
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += size
        if start < batch.num_rows:
            yield batch.slice(start)
