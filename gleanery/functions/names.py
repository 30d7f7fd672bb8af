"""Proper-noun mentions by capitalisation.

A stand-in for a named-entity model: a mention is a run of capitalised words
separated by single blanks.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_NAME = r"\p{Lu}[\p{L}'’-]+"
# A sentence end before the run is taken along to tell sentence-initial runs; a
# letter or digit glued to it is taken along to tell that the run is no word start.
# The possessive loop keeps Java from recursing over texts in capitals.
MENTION = rf"(?:[.!?]\s+|[\p{{L}}\p{{N}}_])?{_NAME}(?: {_NAME})*+"
_PREFIX = r"^[.!?]\s+"
_TAIL = "(?:['’]s)?['’-]*$"

LOWER_WORD = r"(?<![\p{L}\p{N}_'’-])\p{Ll}[\p{L}\p{N}_'’-]*"


def mentions(c: Column) -> Column:
    """``array<struct<mention, initial>>``; ``initial`` marks a single word that opens a sentence."""
    runs = F.regexp_extract_all(F.concat(F.lit(". "), F.coalesce(c, F.lit(""))), F.lit(MENTION), 0)
    runs = F.filter(runs, lambda m: m.rlike(r"^(?:[.!?]|\p{Lu})"))
    found = F.transform(
        runs,
        lambda m: F.struct(
            F.regexp_replace(F.regexp_replace(m, _PREFIX, ""), _TAIL, "").alias("mention"),
            (m.rlike(_PREFIX) & ~F.regexp_replace(m, _PREFIX, "").contains(" ")).alias("initial"),
        ),
    )
    return F.filter(found, lambda m: F.length(m["mention"]) > 1)


def lower_words(c: Column) -> Column:
    """Distinct words of a text that start with a lower-case letter."""
    return F.array_distinct(F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit(LOWER_WORD), 0))
