"""Joins whose left side may have a few very frequent keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanery.schema import ID

# A right side of more rows is never sent to all tasks: it would pass through the driver's memory. A written table
# may look small to the optimiser, which goes by the compressed size.
SENT_ROWS = 100_000

# Nor is one with more bytes in its strings.
SENT_BYTES = 16 << 20


def is_small(df: DataFrame) -> bool:
    """Whether a table has so few and short rows that it may be sent. It is counted, so it should be a written table or cheap."""
    size = sum((F.coalesce(F.octet_length(c), F.lit(0)) for c, kind in df.dtypes if kind == "string"), F.lit(0))
    rows, held = df.limit(SENT_ROWS + 1).agg(F.count("*"), F.sum(size)).first()
    return rows <= SENT_ROWS and (held or 0) <= SENT_BYTES


def bounded(right: DataFrame, few: bool | None = None) -> DataFrame:
    """The right side of a join, marked to be sent if it is small (``few``, if that is known) and else to be merged.

    Without a mark Spark might send the left side of an inner join: one of exploded rows, which the optimiser takes for no
    larger than the written table they come from.
    """
    few = is_small(right) if few is None else few
    return F.broadcast(right) if few else merged(right)


def merged(right: DataFrame) -> DataFrame:
    """The right side of a join, marked to be merged whatever size the optimiser expects."""
    return right.hint("merge")


def _partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def hot_keys(counts: DataFrame, key: str, n: str = "n") -> list:
    """The hot keys of a table with one row per key and its row count.

    A key is hot when it holds more rows than an average shuffle partition, so at most as many
    values as there are partitions come back to the driver. ``counts`` is read twice, so it should be a written table.
    """
    total = counts.agg(F.sum(n)).first()[0]
    if not total:
        return []
    return [r[0] for r in counts.filter(F.col(n) * _partitions(counts) > total).select(key).collect()]


def salted_join(left: DataFrame, right: DataFrame, key: str, hot: list, how: str = "inner") -> DataFrame:
    """Join on ``key``, splitting the ``hot`` keys of ``left`` over many tasks.

    Left rows of a hot key are spread by their record id over as many parts as there are shuffle
    partitions, so that even a key with a third of all rows weighs no more than others, and the few matching
    right rows are repeated once per part; all other rows are joined as usual. The
    rows are those of the plain join. ``how`` is inner, left or left_semi. A right side of many rows
    is merged, however small Spark takes it to be, and one of few is sent, which splits nothing; see ``bounded``.
    """
    few = is_small(right)
    if few or not hot:
        return left.join(bounded(right, few), key, how)
    is_hot, parts = F.col(key).isin(hot), _partitions(left)
    spread = F.when(is_hot, F.pmod(F.xxhash64(ID), F.lit(parts)).cast("int")).otherwise(F.lit(0))
    copies = F.when(is_hot, F.sequence(F.lit(0), F.lit(parts - 1))).otherwise(F.array(F.lit(0)))
    left = left.withColumn("part", spread)
    right = right.withColumn("part", F.explode(copies))
    return left.join(merged(right), [key, "part"], how).drop("part")
